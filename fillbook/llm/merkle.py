"""Operator 12, Merkle manifest of a dataset with incremental witnesses.

Each document is a leaf, each source a ternary tree, and the sources' roots are
the leaves of one more tree. A witness holds, level by level, the siblings left
and right of a node's path; folding it over a leaf gives the root.

Leaves are placed by range sorting (no source is one task) and dealt in aligned
blocks of 3**LEVELS places. A task streams the rows of a block and appends each
to the open subtrees: one run of at most two waiting nodes a level. When a run
of three is complete, the partial witnesses of all leaves below its nodes are
extended by their new siblings and the run's hash waits one level up; the end
of a group closes what is open. Block roots are then appended in the same way,
block by block of blocks, until one root is left, and their own witnesses
extend those of the rows below by a join on the block.

Defined results: a null field is ``-``; a null source is its own group, the
first; null ids come first; ties in doc_id are ordered by leaf (rows alike in
all five columns are interchangeable); rows without doc_id are not tampered
with; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fillbook.llm.common import frugal, register, table, write_read
from fillbook.llm.ordered import places

FANOUT = 3
#: Levels of a block: 2,187 leaves.
LEVELS = 7
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field_bytes(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, colon, value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(*values: Column) -> Column:
    """Lowercase hex SHA-256 of the values' bytes."""
    return F.sha2(F.concat(*map(field_bytes, values)), 256)


def _hash(digests: list[bytes]) -> bytes:
    """Hash of a run: its digests are hashed as hex text."""
    return hashlib.sha256(b"".join(d.hex().encode() for d in digests)).digest()


class Frontier:
    """Open subtrees of a tree that grows by appends, with the partial witness
    of every leaf appended so far."""

    def __init__(self):
        self.open: list[list[tuple[bytes, int, int]]] = []  # by level: digest, first and end leaf
        self.witness: list[bytearray] = []

    def append(self, digest: bytes) -> None:
        n = len(self.witness)
        self.witness.append(bytearray())
        self._wait(0, (digest, n, n + 1))

    def _wait(self, level: int, node: tuple[bytes, int, int]) -> None:
        if level == len(self.open):
            self.open.append([])
        self.open[level].append(node)
        if len(self.open[level]) == FANOUT:
            self._complete(level)

    def _complete(self, level: int) -> None:
        """The waiting run becomes a node; its siblings extend the witnesses below."""
        run, self.open[level] = self.open[level], []
        digests = [d for d, _, _ in run]
        for i, (_, a, z) in enumerate(run):
            step = bytes([i, len(run) - 1 - i]) + b"".join(digests[:i] + digests[i + 1:])
            for leaf in range(a, z):
                self.witness[leaf] += step
        self._wait(level + 1, (_hash(digests), run[0][1], run[-1][2]))

    def close(self, levels: int | None = None) -> bytes:
        """The root: of the whole tree, or of a block that is folded ``levels`` up."""
        level = 0
        while True:
            last = level == levels if levels is not None else len(self.open[level]) == 1 and not any(self.open[level + 1:])
            if last:
                return self.open[level][0][0]
            if self.open[level]:
                self._complete(level)
            level += 1


def fold(digest: bytes, witness: bytes) -> bytes:
    """The root that a leaf and its witness give."""
    at = 0
    while at < len(witness):
        left, right = witness[at], witness[at + 1]
        ends = [at + 2 + 32 * i for i in range(left + right + 1)]
        digests = [witness[a:z] for a, z in zip(ends, ends[1:], strict=False)]
        digest = _hash([*digests[:left], digest, *digests[left:]])
        at = ends[-1]
    return digest


def siblings(witness: bytes) -> list[bytes]:
    """All siblings of a witness, level by level, left to right."""
    at, out = 0, []
    while at < len(witness):
        end = at + 2 + 32 * (witness[at] + witness[at + 1])
        out += [witness[a:a + 32] for a in range(at + 2, end, 32)]
        at = end
    return out


def _append_batches(levels: int):
    """Rows sorted by group, block and place -> the same rows with ``witness``
    (to the block's root) and ``top`` (that root)."""
    def run(batches: Iterator[pa.RecordBatch]):
        tree, held, key, whole = None, [], None, True

        def flush():
            root = tree.close(None if whole else levels)
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            columns = [*rows.columns, pa.array(map(bytes, tree.witness), pa.binary()), pa.array([root] * rows.num_rows, pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=[*rows.schema.names, "witness", "top"])

        for b in batches:
            group, block, n, digest = (b.column(b.schema.get_field_index(c)).to_pylist() for c in ("group", "block", "n", "digest"))
            start = 0
            for i in range(b.num_rows):
                if (group[i], block[i]) != key:
                    if tree is not None:
                        held.append(b.slice(start, i - start))
                        yield flush()
                    tree, held, start = Frontier(), [], i
                    key, whole = (group[i], block[i]), n[i] <= FANOUT ** levels
                tree.append(digest[i])
            held.append(b.slice(start))
        if tree is not None:
            yield flush()
    return frugal(run)


def _climb(rows: DataFrame, levels: int) -> DataFrame:
    """``rows`` (group, pos, n, digest, ...) with ``witness`` up to their group's root and ``top``, that root."""
    rows = rows.withColumn("block", F.floor(F.col("pos") / F.lit(FANOUT ** levels)).cast("long"))
    dealt = rows.repartition("group", "block").sortWithinPartitions("group", "block", "pos")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema.fields)
    done = write_read(dealt.mapInArrow(_append_batches(levels), f"{schema}, witness binary, top binary"), "merkle")
    many = F.col("n") > FANOUT ** levels
    if not done.where(many).take(1):
        return done.drop("block")
    tops = done.where(many & (F.col("pos") % FANOUT ** levels == 0)).select(
        "group", F.col("block").alias("pos"), F.ceil(F.col("n") / F.lit(FANOUT ** levels)).cast("long").alias("n"), F.col("top").alias("digest"))
    above = _climb(tops, levels).select("group", F.col("pos").alias("block"), F.col("witness").alias("_more"), F.col("top").alias("_top"))
    joined = done.join(above, ["group", "block"], "left")
    return joined.select(*[c for c in rows.columns if c != "block"], F.concat("witness", F.coalesce("_more", F.lit(b""))).alias("witness"),
                         F.coalesce("_top", "top").alias("top"))


def witnesses(leaves: DataFrame, group: str, order: list[str], levels: int = LEVELS) -> DataFrame:
    """``leaves`` (with ``digest``, binary) and for each the ``witness`` up to
    the root of its ``group`` and ``top``, that root."""
    return _climb(places(leaves.withColumnRenamed(group, "group"), "group", order, "leaves"), levels).withColumnRenamed("group", group).drop("pos", "n")


def manifest(leaves: DataFrame, levels: int = LEVELS) -> DataFrame:
    """``leaves`` (source, doc_id, digest, ...) with ``subroot``, ``root`` and the ``witness`` from the leaf to the root."""
    # One key that sorts like the source, null first.
    keyed = leaves.withColumn("_source", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")))
    below = write_read(witnesses(keyed, "_source", [F.col("doc_id").asc_nulls_first(), F.col("digest")], levels), "subtrees")
    subroots = below.groupBy("_source").agg(F.first("top").alias("digest"))
    above = witnesses(subroots.withColumn("_all", F.lit("all")), "_all", ["_source"], levels)
    above = above.select("_source", F.col("witness").alias("_above"), F.col("top").alias("root"))
    joined = below.join(above, "_source")
    return joined.select(*leaves.columns, F.col("top").alias("subroot"), "root", F.concat("witness", "_above").alias("witness"))


def _verify_batches(batches: Iterator[pa.RecordBatch]):
    for b in batches:
        leaf, claimed, witness = (b.column(b.schema.get_field_index(c)).to_pylist() for c in ("digest", "claimed", "witness"))
        proof = [hashlib.sha256(b"".join(d.hex().encode() for d in siblings(w))).hexdigest() for w in witness]
        folded = [fold(c, w).hex() for c, w in zip(claimed, witness, strict=True)]
        texts = [pa.array(x, pa.string()) for x in (map(bytes.hex, leaf), map(bytes.hex, b.column(b.schema.get_field_index("subroot")).to_pylist()),
                                                    map(bytes.hex, b.column(b.schema.get_field_index("root")).to_pylist()), proof, folded)]
        yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index("doc_id")), *texts],
                                         names=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root"])


def verify(rows: DataFrame) -> DataFrame:
    """Folds ``claimed``, the digest of a text as found, over the witness of ``digest``."""
    kind = rows.schema["doc_id"].dataType.simpleString()
    found = rows.mapInArrow(frugal(_verify_batches), f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string")
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


def document_leaves(docs: DataFrame) -> DataFrame:
    """``source, doc_id, digest, claimed``: leaves, and what is found where a text lost its line feeds."""
    values = [F.col(c) for c in FIELDS]
    plain = [*values[:-1], F.replace(F.col("text"), F.lit("\n"), F.lit(""))]
    hit = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    claimed = F.when(hit & F.contains("text", F.lit("\n")), leaf_hash(*plain))
    rows = docs.select("source", "doc_id", leaf_hash(*values).alias("digest"), claimed.alias("claimed"))
    return rows.select("source", "doc_id", F.unhex("digest").alias("digest"), F.unhex(F.coalesce("claimed", "digest")).alias("claimed"))


def crc32_sql(text: str) -> str:
    """DuckDB: unsigned CRC-32 of an ASCII text, bit by bit."""
    step = "list_reduce(list_prepend(xor(c, b), range(8)), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)"
    codes = f"list_transform(string_split({text}, ''), lambda x: ord(x)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda c, b: {step}), 4294967295::BIGINT)"


def _field_sql(c: str) -> str:
    return f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(_field_sql(c) for c in (*FIELDS[:-1], text)) + ")"


SQL = f"""
WITH RECURSIVE
l AS (SELECT doc_id, coalesce('s' || source, 'n') AS g, {_leaf_sql("text")} AS leaf,
        CASE WHEN {crc32_sql("CAST(doc_id AS VARCHAR)")} % 2 = 0 THEN {_leaf_sql("replace(text, chr(10), '')")} END AS found FROM documents),
p AS (SELECT row_number() OVER () AS rid, *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM l),
sub(level, g, pos, n, d) AS (
    SELECT 0, g, pos, n, leaf FROM p
    UNION ALL
    SELECT level + 1, g, pos // 3, (n + 2) // 3, sha256(string_agg(d, '' ORDER BY pos)) FROM sub WHERE n > 1 GROUP BY level, g, pos // 3, n),
tops AS (SELECT g, level, d, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n FROM sub WHERE n = 1),
up(level, pos, n, d) AS (
    SELECT 0, pos, n, d FROM tops
    UNION ALL
    SELECT level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(d, '' ORDER BY pos)) FROM up WHERE n > 1 GROUP BY level, pos // 3, n),
steps AS (
    SELECT rid, sub.level, coalesce(string_agg(d, '' ORDER BY sub.pos) FILTER (sub.pos < p.pos // (3 ** sub.level)::BIGINT), '') AS lefts,
        coalesce(string_agg(d, '' ORDER BY sub.pos) FILTER (sub.pos > p.pos // (3 ** sub.level)::BIGINT), '') AS rights
    FROM p JOIN sub ON sub.g = p.g AND sub.n > 1 AND sub.pos // 3 = p.pos // (3 ** (sub.level + 1))::BIGINT GROUP BY rid, sub.level
    UNION ALL
    SELECT rid, tops.level + up.level, coalesce(string_agg(up.d, '' ORDER BY up.pos) FILTER (up.pos < tops.pos // (3 ** up.level)::BIGINT), ''),
        coalesce(string_agg(up.d, '' ORDER BY up.pos) FILTER (up.pos > tops.pos // (3 ** up.level)::BIGINT), '')
    FROM p JOIN tops ON tops.g = p.g JOIN up ON up.n > 1 AND up.pos // 3 = tops.pos // (3 ** (up.level + 1))::BIGINT GROUP BY rid, tops.level, up.level),
proofs AS (SELECT rid, sha256(string_agg(lefts || rights, '' ORDER BY level)) AS proof, max(level) AS last FROM steps GROUP BY rid),
folds(rid, level, d) AS (
    SELECT rid, 0, coalesce(found, leaf) FROM p
    UNION ALL
    SELECT folds.rid, folds.level + 1, sha256(lefts || d || rights) FROM folds JOIN steps ON steps.rid = folds.rid AND steps.level = folds.level)
SELECT p.doc_id, p.leaf, tops.d AS subroot, up.d AS root, coalesce(proof, sha256('')) AS proof_sha256, folds.d AS folded_root, folds.d = up.d AS verified
FROM p JOIN tops ON tops.g = p.g JOIN up ON up.n = 1 LEFT JOIN proofs ON proofs.rid = p.rid
JOIN folds ON folds.rid = p.rid AND folds.level = coalesce(last + 1, 0)"""


@register("op12_merkle", SQL)
def op12_merkle(spark, sf_dir) -> DataFrame:
    """Manifest of ``documents``, and each leaf checked again after some texts lost their line feeds."""
    return verify(manifest(document_leaves(table(spark, sf_dir, "documents"))))
