"""Operator 6, packing: order-preserving windows by dynamic programming.

Documents are dealt by ranges of doc_id, one shard a task, sorted inside. A
task lays its documents' ids end to end and cuts the line into sequences of at
most ``WINDOW`` ids. Cuts are offered at document ends (free), at sentence ends
(``SENTENCE_CUT``) and, so that long sentences fit, on a grid inside them
(``INNER_CUT``): inside every sentence, or with ``inner_cuts=False``, as the
query and the pipeline have it, only where the next boundary is farther away
than a window. The cheapest set of cuts minimises

    padding + cut penalties + SEQUENCE_COST per sequence

where a sequence is padded to ``WINDOW`` unless its length is a power of two.
With pad = WINDOW - (p[j] - p[i]) the best start for a cut at p[j] minimises
cost[i] + p[i] over the last WINDOW ids: a sliding minimum kept in a monotone
queue, so a line of n cuts takes n steps; the unpadded lengths are at most
eleven further candidates a cut. The line is solved in stretches of about
``STRETCH`` ids that end at document ends, which bounds a task's memory.

Defined results: a null or empty text is its end id alone; ties in doc_id are
ordered by the text's hash; documents that occur several times are packed
several times; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fillbook.llm.common import register, table
from fillbook.llm.tokens import TOKENIZER, encoder

WINDOW = 1024
END_ID = 0
SENTENCE_CUT = 1.0
INNER_CUT = 16.0
SEQUENCE_COST = 32.0
#: Places offered inside a sentence: every so many ids.
GRID = 64
STRETCH = 1 << 18
#: Sequence numbers of a shard start at shard * 2 ** SHARD_BITS.
SHARD_BITS = 40


def offered_cuts(ids: np.ndarray, doc_ends: np.ndarray, ends_sentence: np.ndarray, grid: int = GRID,
                 window: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Places where the line may be cut, in order, and what each costs; with a
    ``window``, places inside a sentence only between boundaries farther apart than it."""
    n = len(ids)
    cost = np.full(n + 1, np.inf)
    if window is None:
        cost[grid::grid] = INNER_CUT
    cost[np.flatnonzero(ends_sentence[ids]) + 1] = SENTENCE_CUT
    cost[doc_ends] = 0.0
    cost[0] = cost[n] = 0.0
    if window is not None:
        at = np.flatnonzero(np.isfinite(cost))
        for i in np.flatnonzero(np.diff(at) > window).tolist():
            cost[at[i] + grid:at[i + 1]:grid] = INNER_CUT
    at = np.flatnonzero(np.isfinite(cost))
    return at, cost[at]


def best_cuts(place: np.ndarray, penalty: np.ndarray, window: int = WINDOW, sequence_cost: float = SEQUENCE_COST) -> list[int]:
    """The cheapest increasing choice of ``place`` from its first to its last,
    no step above ``window`` (``place`` never leaves a wider gap)."""
    p, pen = place.tolist(), (penalty + sequence_cost).tolist()
    n = len(p)
    # Starts at an unpadded length before each cut: (cut, start) by number.
    number = np.full(p[-1] + 1, -1, np.int64)
    number[place] = np.arange(n)
    later, earlier = [], []
    length = 1
    while length < window:
        ok = place >= length
        start = number[place[ok] - length]
        hit = start >= 0
        later.append(np.flatnonzero(ok)[hit])
        earlier.append(start[hit])
        length *= 2
    cut, start = np.concatenate(later), np.concatenate(earlier)
    order = np.argsort(cut, kind="stable")
    first = np.searchsorted(cut[order], np.arange(n + 1)).tolist()
    start = start[order].tolist()

    cost, came, key = [0.0] * n, [0] * n, [0.0] * n
    key[0] = float(p[0])
    queue, head, to = [0], 0, first[1]
    for j in range(1, n):
        at, to = to, first[j + 1]
        low = p[j] - window
        while p[queue[head]] < low:
            head += 1
        i = queue[head]
        best = key[i] + window - p[j]
        if at < to:
            for s in start[at:to]:
                if cost[s] < best:
                    best, i = cost[s], s
        best += pen[j]
        cost[j], came[j] = best, i
        k = key[j] = best + p[j]
        while len(queue) > head and key[queue[-1]] >= k:
            queue.pop()
        queue.append(j)
    cuts, j = [], n - 1
    while j:
        cuts.append(p[j])
        j = came[j]
    return cuts[::-1]


_PIECES = "doc_id {id}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


def _pack_batches(tokenizer: str, end_id: int, window: int, stretch: int, inner_cuts: bool, id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]):
        sequence, held, docs, parts = 0, 0, [], []

        def flush(ends_sentence):
            nonlocal sequence, held, docs, parts
            ids = np.concatenate(parts)
            size = np.array([len(x) for x in parts])
            ends = np.cumsum(size)
            cuts = np.array(best_cuts(*offered_cuts(ids, ends, ends_sentence, min(GRID, window), None if inner_cuts else window), window))
            stop = np.union1d(ends, cuts)
            start = np.append(0, stop[:-1])
            doc, seq = np.searchsorted(ends, start, "right"), np.searchsorted(cuts, start, "right")
            raw = memoryview(ids.astype("<u4").tobytes())
            crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(start.tolist(), stop.tolist(), strict=True)]
            rows = pa.RecordBatch.from_arrays(
                [pa.array([docs[i] for i in doc.tolist()], id_type), pa.array(start - (ends - size)[doc]), pa.array(stop - start),
                 pa.array(crc, pa.int64()), pa.array(size[doc]), pa.array(sequence + seq), pa.array(start - np.append(0, cuts)[seq])],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
            sequence, held, docs, parts = sequence + len(cuts), 0, [], []
            return rows

        code = None
        for b in batches:
            code = encoder(tokenizer)
            if b.num_rows and sequence == 0 and not docs:
                sequence = b.column(2)[0].as_py() << SHARD_BITS
            for doc, ids in zip(b.column(0).to_pylist(), code.encode(b.column(1)), strict=True):
                docs.append(doc)
                parts.append(np.append(ids, np.array([end_id], ids.dtype)))
                held += len(parts[-1])
                if held >= stretch:
                    yield flush(code.ends)
        if docs:
            yield flush(code.ends)
    return run


def pack_sequences(docs: DataFrame, tokenizer: str = TOKENIZER, end_id: int = END_ID, window: int = WINDOW,
                   stretch: int = STRETCH, id_col: str = "doc_id", text_col: str = "text", inner_cuts: bool = True) -> DataFrame:
    """One row per piece: document, place in it, length, crc32, sequence and offset there."""
    from pyspark.sql.pandas.types import to_arrow_type
    kind = docs.schema[id_col].dataType
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = rows.repartitionByRange("id", F.xxhash64("text")).sortWithinPartitions("id", F.xxhash64("text"))
    rows = rows.withColumn("shard", F.spark_partition_id().cast("long"))
    run = _pack_batches(tokenizer, end_id, window, stretch, inner_cuts, to_arrow_type(kind))
    return rows.mapInArrow(run, _PIECES.format(id=kind.simpleString()))


@register("op6_packing")
def op6_packing(spark, sf_dir) -> DataFrame:
    """All ``documents`` packed into sequences of at most 1024 ids, cut at document or sentence ends."""
    return pack_sequences(table(spark, sf_dir, "documents"), inner_cuts=False)
