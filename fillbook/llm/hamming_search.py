"""Operator 9, exact top-k by Hamming distance: incremental multi-index hashing.

Codes are words of 64 bits, as many as the longest embedding needs, and each
word is cut into about 64 / log2 N segments, so that a segment value holds about
one code; m is the number of segments of a code. A code within distance m * (r + 1) - 1 of a query
differs from it by at most r bits in some segment. The search grows r: each
pass looks up the segment values at the next radii, verifies the full distance
of what it finds, and a query leaves once its k-th distance is covered by that
bound; unfinished queries carry their k-th distance along as a limit.

Rows with one code are one entry (its k smallest ids suffice), so any number of
equal vectors costs one row. The leading bits of a segment value name a shard
of the index, shards above twice ``SHARD`` codes are split, and a query goes to
the shards within its radius. A task holds one shard at a time and streams the
queries past it; it returns at most k candidates per query and shard.

Defined results: neighbours are ordered by distance, then id, the query's own
row among them; fewer than k rows give fewer neighbours; rows without id or
embedding are neither queries nor found; a missing or NaN element counts as bit
0, and so do the places that a shorter embedding lacks; repeated rows are separate
rows; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fillbook.llm.common import register, table, write_read

BITS = 64
TOP_K = 10
SHARD = 4096
#: Radii of the first pass; later passes take one radius each.
FIRST_RADII = 2
#: A shard's leading bits are kept to this many, so its list of flips stays small.
MAX_LEAD = 16
QUERY_STEP = 100


def words_for(rows: DataFrame, column: str) -> int:
    """Words of 64 bits that hold the longest embedding of a table."""
    most = rows.agg(F.max(F.size(column))).first()[0]
    return max(1, -(-(most or 0) // BITS))


def sign_words(embedding: Column, words: int) -> Column:
    """The signs of an embedding's elements as an array of words, first element
    in the lowest bit of the first word."""
    bit = F.transform(embedding, lambda x, i: F.when((x > 0) & ~F.isnan(x), F.expr("1L")).otherwise(F.expr("0L")))

    def word(n: int) -> Column:
        # Each bit is set once, so the bits can be joined one by one.
        shifted = F.transform(F.slice(bit, BITS * n + 1, BITS), lambda b, i: F.call_function("shiftleft", b, i))
        return F.aggregate(shifted, F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b))
    return F.when(embedding.isNotNull(), F.array(*[word(n) for n in range(words)]))


def sign_code(embedding: Column) -> Column:
    """The signs of an embedding of 64 elements at most, as one word."""
    code = F.get(sign_words(embedding, 1), F.lit(0))
    return F.when(F.size(embedding) > BITS, F.raise_error(F.lit(f"embeddings of more than {BITS} elements need sign_words"))).otherwise(code)


def segments_for(n: int, words: int = 1) -> list[tuple[int, int, int]]:
    """(word, shift, width) of each segment for an index of ``n`` codes."""
    m = int(np.clip(round(BITS / np.log2(max(n, 4))), 2, 8))
    cut = [round(BITS * i / m) for i in range(m + 1)]
    return [(w, a, b - a) for w in range(words) for a, b in zip(cut, cut[1:], strict=False)]


@lru_cache(maxsize=256)
def flips(width: int, radius: int) -> np.ndarray:
    """All masks of ``radius`` of ``width`` bits."""
    if radius == 0:
        return np.zeros(1, np.int64)
    if radius > width:
        return np.zeros(0, np.int64)
    return np.concatenate([flips(width - 1, radius), flips(width - 1, radius - 1) | (1 << (width - 1))])


_FOUND = "q array<bigint>, code array<bigint>, first_id bigint, n bigint, d int"


def _codes(column: pa.Array, words: int) -> np.ndarray:
    """A column of codes as rows of words."""
    return column.flatten().to_numpy().view(np.uint64).reshape(-1, words)


def _column(codes: np.ndarray, words: int) -> pa.Array:
    return pa.ListArray.from_arrays(np.arange(0, words * len(codes) + 1, words, dtype=np.int32), pa.array(codes.view(np.int64).ravel()))


class _Shard:
    """The codes of a shard, by the trailing bits of their segment value."""

    def __init__(self, rows: list[tuple], low: int):
        value, code, first, n = (np.concatenate([r[i] for r in rows]) for i in range(4))
        order = np.argsort(value, kind="stable")
        self.code, self.first, self.n = code[order], first[order], n[order]
        self.offset = np.searchsorted(value[order], np.arange((1 << low) + 1)) if low <= 16 else None
        self.value, self.low = value[order], low

    def near(self, value: int, radii: range) -> np.ndarray:
        """Numbers of the codes whose trailing bits are at one of the radii from ``value``."""
        if len(self.code) <= 64 or sum(len(flips(self.low, r)) for r in radii if r <= self.low) > 2 * len(self.code):
            apart = np.bitwise_count(self.value ^ value)  # looking at each code is less than each flip
            return np.flatnonzero((apart >= radii.start) & (apart < radii.stop))
        at = value ^ np.concatenate([flips(self.low, r) for r in radii])
        if self.offset is not None:
            a, b = self.offset[at], self.offset[at + 1]
        else:
            a, b = np.searchsorted(self.value, at), np.searchsorted(self.value, at, "right")
        some = b > a
        a, size = a[some], (b - a)[some]
        ends = np.cumsum(size)
        return np.repeat(a - ends + size, size) + np.arange(ends[-1]) if len(ends) else np.zeros(0, np.int64)


def _search_batches(lows: list[int], radii: range, k: int, words: int):
    def run(batches: Iterator[pa.RecordBatch]):
        shard, rows, index = None, [], None
        for b in batches:
            key = b.column(0).to_numpy()
            seg, query, value, first, n, extra = (b.column(i).to_numpy() for i in (1, 2, 3, 5, 6, 7))
            code = _codes(b.column(4), words)
            cuts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (query[1:] != query[:-1])]) if len(key) else []
            out = []
            for a, z in zip(cuts, [*cuts[1:], len(key)], strict=True):
                if key[a] != shard:
                    shard, rows, index = key[a], [], None
                if not query[a]:
                    rows.append((value[a:z], code[a:z], first[a:z], n[a:z]))
                    continue
                if not rows:
                    continue
                low = lows[seg[a]]
                index = index or _Shard(rows, low)
                for i in range(a, z):  # n: leading bits apart; extra: distance limit
                    part = range(max(0, radii.start - int(n[i])), radii.stop - int(n[i]))
                    hit = index.near(int(value[i]), part) if len(part) else np.zeros(0, np.int64)
                    d = np.bitwise_count(index.code[hit] ^ code[i]).sum(axis=1, dtype=np.int32)
                    ok = d <= extra[i]
                    hit, d = hit[ok], d[ok]
                    if len(hit) > k:
                        best = np.lexsort((index.first[hit], d))[:k]
                        hit, d = hit[best], d[best]
                    if len(hit):
                        out.append((np.repeat(code[i:i + 1], len(hit), axis=0), index.code[hit], index.first[hit], index.n[hit], d))
            none = [np.zeros((0, words), np.uint64)] * 2 + [np.zeros(0, np.int64)] * 2 + [np.zeros(0, np.int32)]
            cols = [np.concatenate(c) for c in zip(*out, strict=True)] if out else none
            yield pa.RecordBatch.from_arrays([*[_column(c, words) for c in cols[:2]], *map(pa.array, cols[2:])], names=["q", "code", "first_id", "n", "d"])
    return run


def top_codes(index: DataFrame, queries: DataFrame, k: int = TOP_K, shard: int | None = None, words: int = 1) -> DataFrame:
    """``(q, code, d)``: for each query code the codes that hold its k nearest rows.

    ``index``: code, first_id (its smallest id), n (its rows, k at most);
    ``queries``: q, distinct.
    """
    shard = shard or SHARD
    size = index.agg(F.count(F.lit(1)).alias("codes"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows")).first()
    if not size.codes:
        return queries.select("q", F.col("q").alias("code"), F.lit(0).alias("d")).limit(0)
    want = min(k, size.rows)
    cut, bits = segments_for(size.codes, words), BITS * words
    lead = [min(w - 1, MAX_LEAD, max(0, int(np.ceil(np.log2(size.codes / shard))))) for _, _, w in cut]
    lows = [w - t for (_, _, w), t in zip(cut, lead, strict=True)]

    def spread(code: str) -> Column:
        """A code's segments: number, leading and trailing bits."""
        value = lambda n, s, w: F.shiftrightunsigned(F.get(code, F.lit(n)), s).bitwiseAND(F.lit((1 << w) - 1))
        return F.explode(F.array(*[F.struct(F.lit(j).alias("seg"), F.shiftrightunsigned(value(n, s, w), low).alias("lead"),
                                            value(n, s, w).bitwiseAND(F.lit((1 << low) - 1)).alias("value"))
                                   for j, ((n, s, w), low) in enumerate(zip(cut, lows, strict=True))]))
    entries = index.select("code", "first_id", "n", spread("code").alias("x")).select("code", "first_id", "n", "x.*")
    parts = entries.groupBy("seg", "lead").agg(F.ceil(F.count(F.lit(1)) / (2 * shard)).cast("int").alias("parts")).checkpoint()
    key = lambda part: F.xxhash64("seg", "lead", part)
    entries = entries.join(parts, ["seg", "lead"]).select(
        key(F.pmod(F.xxhash64("code"), F.col("parts")).cast("int")).alias("shard"), "seg", F.lit(0).alias("query"), "value", "code", "first_id", "n",
        F.lit(0).cast("long").alias("extra"))

    open_ = queries.select("q", F.lit(bits).alias("most"))
    best, first, last = None, 0, FIRST_RADII
    widest = max(w for _, _, w in cut)
    while True:
        masks = {t: F.array(*[F.lit(int(x)) for r in range(min(last, t) + 1) for x in flips(t, r)]) for t in set(lead)}
        choose = None
        for j, t in enumerate(lead):
            choose = F.when(F.col("seg") == j, masks[t]) if choose is None else choose.when(F.col("seg") == j, masks[t])
        asked = open_.select("q", "most", spread("q").alias("x")).select("q", "most", "x.*").withColumn("flip", F.explode(choose))
        asked = asked.withColumn("lead", F.col("lead").bitwiseXOR(F.col("flip"))).join(parts, ["seg", "lead"])
        asked = asked.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
            key(F.col("part")).alias("shard"), "seg", F.lit(1).alias("query"), "value", F.col("q").alias("code"),
            F.lit(0).cast("long").alias("first_id"), F.bit_count("flip").cast("long").alias("n"), F.col("most").cast("long").alias("extra"))
        both = entries.unionByName(asked).repartition("shard").sortWithinPartitions("shard", "query")
        found = both.mapInArrow(_search_batches(lows, range(first, last + 1), k, words), _FOUND)
        found = found if best is None else found.unionByName(best)
        found = found.groupBy("q", "code").agg(F.first("first_id").alias("first_id"), F.first("n").alias("n"), F.first("d").alias("d"))
        by = Window.partitionBy("q").orderBy("d", "first_id")
        found = found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k).drop("rank")
        best = write_read(found, "hamming")
        if last >= widest:
            break
        upto = F.sum("n").over(by)
        kth = best.withColumn("upto", upto).where(F.col("upto") >= want).groupBy("q").agg(F.min("d").alias("kth"))
        open_ = queries.join(kth, "q", "left").where(F.coalesce(F.col("kth"), F.lit(bits + 1)) > len(cut) * (last + 1) - 1)
        open_ = open_.select("q", F.coalesce("kth", F.lit(bits)).alias("most")).checkpoint()
        if not open_.take(1):
            break
        first, last = last + 1, last + 1
    return best.select("q", "code", "d")


def top_k(rows: DataFrame, queries: DataFrame, k: int = TOP_K, words: int = 1) -> DataFrame:
    """The k nearest rows of each query: ``(query_id, rank, neighbor_id, distance)``.

    ``rows`` and ``queries``: id, code (an array of ``words`` words, or one word).
    """
    rows, queries = (d.withColumn("code", F.when(F.col("code").isNotNull(), F.array("code"))) if dict(d.dtypes)["code"] == "bigint" else d for d in (rows, queries))
    rows = rows.where("id is not null and code is not null")
    queries = queries.where("id is not null and code is not null")
    near = F.row_number().over(Window.partitionBy("code").orderBy("id"))
    ids = write_read(rows.withColumn("at", near).where(F.col("at") <= k).select("code", "id"), "codes")
    index = ids.groupBy("code").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("n")).checkpoint()
    asked = queries.select(F.col("code").alias("q")).distinct().checkpoint()
    best = top_codes(index, asked, k, words=words).join(ids, "code")
    rank = F.row_number().over(Window.partitionBy("q").orderBy("d", "id"))
    best = best.withColumn("rank", rank).where(F.col("rank") <= k)
    return queries.join(best.withColumnRenamed("id", "neighbor_id").drop("code"), F.col("code") == F.col("q")).select(
        F.col("id").alias("query_id"), "rank", "neighbor_id", F.col("d").cast("int").alias("distance"))


SQL = f"""
WITH e AS (SELECT vec_id, [x > 0 AND NOT isnan(x) for x in embedding] AS b FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
d AS (SELECT q.vec_id AS query_id, e.vec_id AS neighbor_id,
        CAST(len([i for i in range(1, len(e.b) + 1) if q.b[i] <> e.b[i]]) AS INTEGER) AS distance
      FROM e AS q JOIN e ON q.vec_id % {QUERY_STEP} = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, neighbor_id, distance FROM
    (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id) AS rank FROM d) WHERE rank <= {TOP_K}"""


@register("op9_hamming_topk", SQL)
def op9_hamming_topk(spark, sf_dir) -> DataFrame:
    """The ten nearest sign codes of every vector whose id is divisible by 100, among all vectors."""
    vectors = table(spark, sf_dir, "embeddings")
    words = words_for(vectors, "embedding")
    rows = vectors.select(F.col("vec_id").alias("id"), sign_words(F.col("embedding"), words).alias("code"))
    return top_k(rows, rows.where(F.col("id") % QUERY_STEP == 0), words=words)
