"""Merkle manifest: against a plain tree, and the query against its SQL."""
import hashlib
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from fillbook.llm import merkle as M
from fillbook.llm.common import ORACLES, QUERIES, prepare
from tests.conftest import SF001


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(autouse=True)
def few_partitions(spark):
    """Many small steps over small tables."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def tree(leaves):
    """Root, and per leaf its steps (lefts, rights)."""
    steps, level, at = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        for i, p in enumerate(at):
            a = p - p % 3
            steps[i].append((level[a:p], level[p + 1:a + 3]))
            at[i] = p // 3
        level = [sha("".join(level[a:a + 3])) for a in range(0, len(level), 3)]
    return level[0], steps


def leaf(row, text):
    show = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return sha("".join(map(show, (*row[:4], text))))


def plain(rows):
    """Rows (doc_id, source, lang, n_chars, text) -> result rows."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    out, below = [], []
    for s in names:
        rs = sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[4])))
        below.append((rs, *tree([leaf(r, r[4]) for r in rs])))
    root, above = tree([b[1] for b in below])
    for (rs, subroot, steps), more in zip(below, above, strict=True):
        for r, own in zip(rs, steps, strict=True):
            path = own + more
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None
            folded = leaf(r, r[4].replace("\n", "") if hit else r[4])
            for left, right in path:
                folded = sha("".join([*left, folded, *right]))
            proof = sha("".join("".join(left + right) for left, right in path))
            out.append((r[0], leaf(r, r[4]), subroot, root, proof, folded, folded == root))
    return out


def result(df):
    order = lambda r: (r[0] is not None, r[0] or 0, *map(str, r[1:]))
    return sorted((tuple(r) for r in df.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=order)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


@pytest.mark.parametrize("sizes", [[1], [3], [1, 2, 28], [82, 1, 10, 27, 3]])
def test_against_plain_trees(spark, sizes):
    prepare(spark)
    r = random.Random(sum(sizes))
    rows = []
    for i, n in enumerate(sizes):
        for _ in range(n):
            text = r.choice([None, "", "a\nb", "é\n\n", "plain", "\n" * 50])
            rows.append((r.choice([None, *range(-3, 40)]), None if i == 1 else f"s{i}", r.choice([None, "en"]), r.choice([None, 7]), text))
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    docs = docs.withColumns({c: F.lit("x") for c in ("digest", "group", "pos", "n", "witness", "top")})
    got = M.verify(M.manifest(M.document_leaves(docs), levels=1 if len(sizes) > 3 else 2))
    assert result(got) == sorted(plain(rows), key=lambda r: (r[0] is not None, r[0] or 0, *map(str, r[1:])))


def test_many_sources_and_repeated_rows(spark):
    prepare(spark)
    rows = [(5, f"s{i % 40}", "en", 1, "t\nt") for i in range(200)] + [(7, "", None, None, None)] * 30
    docs = spark.createDataFrame(rows, SCHEMA)
    got = M.verify(M.manifest(M.document_leaves(docs), levels=1))
    assert result(got) == sorted(plain(rows), key=lambda r: (r[0] is not None, r[0] or 0, *map(str, r[1:])))


def test_appends_extend_witnesses():
    """At every length the open frontier closes to the plain tree's root and witnesses."""
    for n in range(1, 60):
        leaves = [sha(str(i)) for i in range(n)]
        f = M.Frontier()
        for d in leaves:
            f.append(bytes.fromhex(d))
        root, steps = tree(leaves)
        assert f.close().hex() == root
        for d, w, own in zip(leaves, f.witness, steps, strict=True):
            assert M.fold(bytes.fromhex(d), bytes(w)).hex() == root
            assert [x.hex() for x in M.siblings(bytes(w))] == [x for left, right in own for x in left + right]


def test_empty_table(spark):
    prepare(spark)
    docs = spark.createDataFrame([], SCHEMA)
    assert M.verify(M.manifest(M.document_leaves(docs))).collect() == []


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF001}/documents.parquet'")
    got = QUERIES["op12_merkle"](spark, SF001)
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({ORACLES['op12_merkle']})").fetchall()
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
