"""Prefix trie: against a plain trie, and the query against its SQL."""
import hashlib
import random
import re
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from fillbook.llm import prefix_trie as T
from fillbook.llm.common import ORACLES, QUERIES, prepare
from tests.conftest import SF001

SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.fixture(autouse=True)
def few_partitions(spark):
    """Many small steps over small tables."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def plain(rows):
    turns = {}
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            x = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            turns.setdefault(c, []).append((t is not None, t or 0, x, role, text))
    own = {c: [x[3:] for x in sorted(v)] for c, v in turns.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = own.get(c - c % 20, [])[:h] + own[c][h:]
    members = {}
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members.setdefault(tuple(seq[:d]), []).append(c)
    out = []
    for node, cs in members.items():
        below = [n for n in members if n[:len(node)] == node]
        children = [n for n in below if len(n) == len(node) + 1]
        saved = sum((len(members[n]) - 1) * len(re.findall("[^\x20\x09-\x0D]+", n[-1][1])) for n in below if n)
        leaves = sum(not any(len(m) == len(n) + 1 and m[:len(n)] == n for m in below) for n in below)
        ends = ",".join(str(c) for c in sorted(cs) if len(built[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(cs), len(node), parent, len(cs), len(children), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[1], r[0]))


def made(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[1], r[0]))


def conversations(seed, families=4, width=8, longest=9):
    r = random.Random(seed)
    rows = []
    for c in (20 * f + i for f in range(families) for i in r.sample(range(20), width)):
        for t in range(r.randint(1, longest)):
            rows.append((c, r.choice([t, t, t, None, 3]), r.choice(["user", "assistant", None]), r.choice(["a b", "", None, "one two three", "x\ny"])))
    return rows


@pytest.mark.parametrize("seed", range(2))
def test_against_plain_trie(spark, seed):
    prepare(spark)
    rows = conversations(seed) + [(None, 1, "user", "lost"), (-7, 0, "u", "t"), (-40, 0, "u", "t")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5).withColumns({c: F.lit(1) for c in ("i", "part", "at", "upto", "words", "digest")})
    assert made(T.trie(df, last=4, block=2)) == plain(rows)


def test_long_conversation_over_many_parts(spark):
    """One conversation of most rows, cut into parts, under a turn that all share."""
    prepare(spark)
    rows = [(c, 0, "user", "hello") for c in range(0, 400, 2)] + [(6, t, "user", f"turn {t % 3}") for t in range(1, 1500)]
    rows += [(26, t, "user", f"turn {t % 3}") for t in range(1, 40)]
    keys = {}
    for r in T.members(spark.createDataFrame(rows, SCHEMA)).collect():
        keys.setdefault(r.conv_id, []).append((r.d, r.k1, r.k2, r.p1, r.p2))
    assert [d for d, *_ in sorted(keys[6])] == list(range(len(keys[6])))
    for path in map(sorted, keys.values()):
        assert all(a[1:3] == b[3:] for a, b in zip(path, path[1:], strict=False))
    got = {r.depth: r for r in T.trie(spark.createDataFrame(rows, SCHEMA), block=64).collect() if r.conv_id == 6}
    assert max(got) == len(keys[6]) - 1 and got[max(got)].n_leaves == 1


def test_rows_that_repeat_and_empty_table(spark):
    prepare(spark)
    rows = [(c, 0, "u", "same") for c in range(100)] * 2
    assert made(T.trie(spark.createDataFrame(rows, SCHEMA))) == plain(rows)
    assert T.trie(spark.createDataFrame([], SCHEMA)).collect() == []


def test_very_long_text(spark):
    prepare(spark)
    rows = [(1, 0, "u", "w " * 300_000), (2, 0, "u", "w " * 300_000), (3, 0, None, None)]
    assert made(T.trie(spark.createDataFrame(rows, SCHEMA))) == plain(rows)


def test_list_ranking(spark):
    """A list in random order, with and without blocks, against its sums."""
    prepare(spark)
    order = list(range(500))
    random.Random(3).shuffle(order)
    rows = [(x, order[i + 1] if i + 1 < len(order) else None, 1, x % 3, x) for i, x in enumerate(order)]
    items = spark.createDataFrame(rows, "id long, next long, arcs long, leaves long, saved long")
    want, total = {}, (0, 0, 0)
    for x in reversed(order):
        total = (total[0] + 1, total[1] + x % 3, total[2] + x)
        want[x] = total
    for blocks in ([], [F.col("id") % 7]):
        got = {r.id: (r.arcs, r.leaves, r.saved) for r in T.rank_list(items, blocks, last=60).collect()}
        assert got == want


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF001}/conversations.parquet'")
    got = QUERIES["op13_prefix_trie"](spark, SF001)
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({ORACLES['op13_prefix_trie']})").fetchall()
    assert made(got) == sorted(want, key=lambda r: (r[1], r[0]))
