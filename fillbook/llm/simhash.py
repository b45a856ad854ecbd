"""Operator 8, near duplicates by SimHash with pivot distance tables.

1. Fingerprint: per text the XXH64 of each 4-word shingle; a bit is set when
   over half of the hashes have it. Rows with the same fingerprint are one
   class (aggregate, combined before the shuffle), so groups of exact copies
   of any size are one row from here on.
2. Blocks: the 64 bits are cut into ``segments`` parts. At most 4 differing
   bits leave at least ``segments - 4`` parts alike, so every linked pair
   shares the bits of one choice of parts; each choice is a view, and a row is
   dealt once to each view. Blocks above ``BLOCK`` rows are split into pairs
   of sub-blocks, so no task gets an unbounded block and no pair is lost.
3. Pivot tables: inside a block the Hamming distances to ``PIVOTS`` reference
   fingerprints are computed once per row. Rows are sorted by the first
   distance; a pair is discarded when any coordinate differs by more than the
   limit (the triangle inequality), and survivors are verified bit by bit.
4. Only a spanning forest of the verified links leaves a task, and connected
   components join the classes.

Why step 2: one reference distance of random 64-bit codes has a standard
deviation of 4 bits, so a window of +-4 keeps 0.62 of all pairs; a pivot grid
alone cannot search in less than quadratic time.

Defined results: a null, empty or wordless text has fingerprint zero and links
like any other; rows that share a doc_id are separate rows with one id; rows
without doc_id get the smallest id of their component (null when it has none);
extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fillbook.llm.common import free_names, frugal, register, table, write_read
from fillbook.llm.components import components

SHINGLE = 4
MAX_BITS = 4
SEED = 42
SEGMENTS = 6
PIVOTS = 8
BLOCK = 2048
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)
_COLUMN = 256 * np.arange(8)


def fingerprint(text: str | None, k: int = SHINGLE) -> int:
    """The 64-bit SimHash of a text, as an unsigned integer."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    data = b" ".join(words)
    if len(words) <= k:
        return xxhash.xxh64_intdigest(data, SEED)
    gaps = np.flatnonzero(np.frombuffer(data, np.uint8) == 32).tolist()
    begin, end = [0, *[g + 1 for g in gaps]], [*gaps, len(data)]
    digest = xxhash.xxh64_digest
    raw = b"".join([digest(data[a:b], SEED) for a, b in zip(begin, end[k - 1:], strict=False)])
    rows = np.frombuffer(raw, np.uint8).reshape(-1, 8)
    ones = np.bincount((rows + _COLUMN).ravel(), minlength=2048).reshape(8, 256) @ _BYTE_BITS
    return int.from_bytes(np.packbits((2 * ones > len(rows)).ravel()).tobytes(), "big")


def _fingerprint_batches(k: int, carry: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            fp = np.array([fingerprint(t, k) for t in b.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp), *b.columns[2:]], names=["id", "fp", *carry])
    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE,
                 carry: tuple[str, ...] = ()) -> DataFrame:
    """``(id, fp)`` and the bigint columns ``carry`` of every row; the fingerprint's 64 bits as a bigint."""
    kind = docs.schema[id_col].dataType.simpleString()
    columns = ", ".join([f"id {kind}", "fp bigint", *[f"{c} bigint" for c in carry]])
    return docs.select(id_col, text_col, *carry).mapInArrow(frugal(_fingerprint_batches(k, carry)), columns)


def pivots(n: int = PIVOTS) -> np.ndarray:
    """Reference fingerprints: rows of the 64-bit Hadamard code, any two of
    which differ in 32 bits, so their distances tell rows apart well."""
    bits = np.arange(64)
    rows = [np.bitwise_count(bits & (2 * i + 1)) & 1 for i in range(n)]
    return np.array([sum(int(b) << int(j) for j, b in enumerate(r)) for r in rows], np.uint64)


def views(segments: int = SEGMENTS, max_bits: int = MAX_BITS) -> list[int]:
    """Bit masks of every choice of ``segments - max_bits`` of the segments."""
    cut = [round(64 * i / segments) for i in range(segments + 1)]
    part = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cut, cut[1:], strict=False)]
    return [sum(c) for c in combinations(part, segments - max_bits)]


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning star for each component of the links (a[i], b[i])."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y, label = at[:len(a)], at[len(a):], np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    child = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[child], nodes[label[child]]


def block_links(group: np.ndarray, fp: np.ndarray, refs: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links inside each block of equal ``group``."""
    near = np.bitwise_count(fp[:, None] ^ refs[None, :]).astype(np.int8)
    order = np.lexsort((near[:, 0], group))
    group, fp, near = group[order], fp[order], near[order]
    left, right, held = [], [], 0
    i, lag = np.arange(len(fp)), 0
    while len(i):
        lag += 1
        i = i[i < len(fp) - lag]
        j = i + lag
        keep = (group[i] == group[j]) & (near[j, 0] - near[i, 0] <= max_bits)
        i, j = i[keep], j[keep]
        close = np.abs(near[i] - near[j]).max(axis=1, initial=0) <= max_bits
        a, b = fp[i[close]], fp[j[close]]
        linked = np.bitwise_count(a ^ b) <= max_bits
        left.append(a[linked])
        right.append(b[linked])
        held += int(linked.sum())
        if held > 500_000:
            a, b = _forest(np.concatenate(left), np.concatenate(right))
            left, right, held = [a], [b], len(a)
    if not held:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return _forest(np.concatenate(left), np.concatenate(right))


def _link_batches(n_pivots: int, max_bits: int):
    def run(batches: Iterator[pa.RecordBatch]):
        refs = pivots(n_pivots)
        waiting, rows = [], 0

        def links(g, f):
            starts = np.flatnonzero(np.r_[True, g[1:] != g[:-1]]) if len(g) else np.zeros(0, int)
            size = np.diff(np.r_[starts, len(g)])
            paired = np.repeat(size > 1, size)
            a, b = block_links(g[paired], f[paired], refs, max_bits)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["u", "v"])

        def joined():
            return (np.concatenate([x[0] for x in waiting]), np.concatenate([x[1] for x in waiting]).view(np.uint64))

        for b in batches:  # in order of g; the last block may go on in the next batch
            waiting.append((b.column(0).to_numpy(), b.column(1).to_numpy()))
            rows += b.num_rows
            if rows >= 100_000:
                g, f = joined()
                last = int(np.searchsorted(g, g[-1]))
                if last:
                    yield links(g[:last], f[:last])
                waiting, rows = [(g[last:], f[last:].view(np.int64))], 0
        if waiting:
            yield links(*joined())
    return run


def near_links(classes: DataFrame, max_bits: int = MAX_BITS, segments: int = SEGMENTS,
               n_pivots: int = PIVOTS, block: int = BLOCK) -> DataFrame:
    """Links ``(u, v)`` that join all distinct fingerprints within ``max_bits``.

    ``segments`` sets the key width, about 64 * (segments - max_bits) /
    segments bits: 21 bits in 15 views for 6, 27 bits in 35 views for 7. More
    rows want wider keys; any value finds every link.
    """
    keys = F.explode(F.array(*[F.struct(F.lit(i).alias("view"), F.col("fp").bitwiseAND(F.lit(m - (1 << 64) if m >> 63 else m)).alias("bits"))
                               for i, m in enumerate(views(segments, max_bits))]))
    rows = classes.select("fp", keys.alias("k")).select("fp", F.xxhash64("k.view", "k.bits").alias("g"))
    # Blocks too large for one task: dealt as pairs of sub-blocks.
    large = rows.groupBy("g").count().where(F.col("count") > block).select("g", F.ceil(F.col("count") / block).cast("int").alias("parts"))
    rows = rows.join(large, "g", "left")
    own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    other = F.explode(F.when(F.col("parts").isNull(), F.array(F.lit(None).cast("int")))
                      .otherwise(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.select("fp", "g", "parts", own.alias("own"), other.alias("other"))
    g = F.when(F.col("parts").isNull(), F.col("g")).otherwise(
        F.xxhash64("g", F.least("own", "other"), F.greatest("own", "other")))
    rows = rows.select(g.alias("g"), "fp").repartition("g").sortWithinPartitions("g")
    return rows.mapInArrow(_link_batches(n_pivots, max_bits), "u bigint, v bigint")


def _members(rows: DataFrame, first: Column, max_bits: int, segments: int) -> DataFrame:
    """``(fp, first, root)`` of every distinct fingerprint of ``rows``: the
    smallest ``first`` of its rows and the root of its component."""
    classes = rows.groupBy("fp").agg(F.min(first).alias("first")).checkpoint()
    roots = components(near_links(classes.select("fp"), max_bits, segments))
    return classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE,
                       max_bits: int = MAX_BITS, segments: int = SEGMENTS) -> DataFrame:
    """``(id, fp, component_id)`` of every row; linked rows share the smallest id."""
    rows = write_read(fingerprints(docs, id_col, text_col, k), "simhash")
    member = _members(rows, F.col("id"), max_bits, segments)
    low = member.groupBy("root").agg(F.min("first").alias("component_id"))
    named = member.join(low, "root").select("fp", "component_id")
    return rows.join(named, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def _row_hash(docs: DataFrame, seed: int) -> Column:
    """64-bit hash of a whole row, nulls told apart; maps, which have no hash, go as JSON."""
    parts = []
    for f in docs.schema.fields:
        column = F.col(f"`{f.name}`")
        parts += [column.isNull(), F.to_json(F.struct(column)) if "map<" in f.dataType.simpleString() else column]
    return F.xxhash64(F.lit(seed), *parts)


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE,
                         max_bits: int = MAX_BITS, segments: int = SEGMENTS) -> DataFrame:
    """One row of ``docs`` (all columns) for each component: that of the smallest
    id, rows without id last; of several rows the one of the smallest hash.

    Rows are told apart by a 128-bit hash of all their columns, so rows that
    share an id, or have none, stay or go by their own components.
    """
    key = tuple(free_names(docs, "key", "key2"))
    docs = docs.withColumns({c: _row_hash(docs, i) for i, c in enumerate(key)})
    rows = write_read(fingerprints(docs, id_col, text_col, k, key), "simhash")
    member = _members(rows, F.struct(F.col("id").isNull().alias("no_id"), "id", *key), max_bits, segments)
    keep = member.groupBy("root").agg(F.min("first").alias("first")).select(*[F.col(f"first.{c}").alias(c) for c in key])
    # The same plain key for both steps, so that the texts are shuffled once.
    return docs.join(keep, list(key), "left_semi").dropDuplicates(list(key)).drop(*key)


@register("op8_simhash")
def op8_simhash(spark, sf_dir) -> DataFrame:
    """Fingerprint and component of every row of ``documents``."""
    found = simhash_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
