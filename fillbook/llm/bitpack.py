"""Operator 3, token ids in fixed-width bit-packed files.

Documents are dealt by ranges of doc_id, one shard a task, sorted inside. A
task tokenizes its texts and writes blocks: the ids of whole documents, about
``BLOCK_IDS`` of them, each id in the fewest bits that hold the vocabulary. A
block is one row of a Parquet table (Spark's writer commits it, so a lost
executor leaves no half file, and any store that Spark reaches will do):

    shard, block, first     place of the block; ids of the shard before it
    doc_ids, lengths        its documents in order and their id counts
    data                    header (magic, version, bits, count), then the bits

An id's place is ``bit = bits * i``: any slice unpacks with numpy alone, and a
range of ids is found by the block offsets without reading other blocks. The
ids before a shard are sums over one row per shard.

Defined results: a null text counts as empty and has only the end id; ties in
doc_id are ordered by the text's hash (rows alike in both are interchangeable);
null ids come first; extra columns are ignored; an empty table writes an empty table.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fillbook.llm.common import register, table
from fillbook.llm.tokens import TOKENIZER, encoder
from fillbook.session import scratch_path

BLOCK_IDS = 1 << 16
END_ID = 2
MAGIC, VERSION = b"FBID", 1
_HEADER = struct.Struct("<4sBBxxQ")
#: Widths that are whole bytes, as little-endian numbers.
_WHOLE = {8: "<u1", 16: "<u2", 32: "<u4"}


def bits_for(vocabulary: int) -> int:
    """The fewest bits that hold the ids of a vocabulary."""
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Header and ids, ``bits`` bits each, lowest bit first."""
    head = _HEADER.pack(MAGIC, VERSION, bits, len(ids))
    if bits in _WHOLE:  # the same bytes, without a step per bit
        return head + ids.astype(_WHOLE[bits]).tobytes()
    out = bytearray(head)
    step = np.arange(bits, dtype=np.uint32)
    for at in range(0, len(ids), BLOCK_IDS):  # whole bytes: BLOCK_IDS is a multiple of 8
        part = ids[at:at + BLOCK_IDS].astype(np.uint32)
        out += np.packbits(((part[:, None] >> step) & 1).astype(np.uint8).ravel(), bitorder="little").tobytes()
    return bytes(out)


def unpack(data: bytes, start: int = 0, count: int | None = None) -> np.ndarray:
    """Ids ``start`` to ``start + count`` of a packed block, as uint32."""
    magic, version, bits, n = _HEADER.unpack_from(data)
    if magic != MAGIC or version != VERSION:
        raise ValueError("not a packed id block")
    count = n - start if count is None else min(count, n - start)
    raw = np.frombuffer(data, np.uint8, offset=_HEADER.size)
    if bits in _WHOLE:
        return raw.view(_WHOLE[bits])[start:start + count].astype(np.uint32)
    bit = bits * np.arange(start, start + count, dtype=np.int64)
    byte, shift = bit >> 3, (bit & 7).astype(np.uint64)
    word = np.zeros(count, np.uint64)
    for j in range((bits + 14) // 8):  # the bytes that an id can touch
        at = byte + j
        word |= np.where(at < len(raw), raw[np.minimum(at, len(raw) - 1)], 0).astype(np.uint64) << np.uint64(8 * j) if len(raw) else word
    return ((word >> shift) & np.uint64((1 << bits) - 1)).astype(np.uint32)


_BLOCK = "shard int, block int, first bigint, n_ids bigint, doc_ids array<{id}>, lengths array<bigint>, data binary"


def _pack_batches(tokenizer: str, end_id: int, block_ids: int, id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]):
        bits = None
        shard = block = first = held = 0
        docs, parts = [], []

        def flush():
            nonlocal block, first, held, docs, parts
            ids = np.concatenate(parts)
            row = pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([block], pa.int32()), pa.array([first], pa.int64()), pa.array([len(ids)], pa.int64()),
                 pa.array([docs], pa.list_(id_type)), pa.array([[len(p) for p in parts]], pa.list_(pa.int64())), pa.array([pack(ids, bits)], pa.binary())],
                names=["shard", "block", "first", "n_ids", "doc_ids", "lengths", "data"])
            block, first, held, docs, parts = block + 1, first + len(ids), 0, [], []
            return row

        for b in batches:
            code = encoder(tokenizer)
            bits = bits_for(max(code.size, end_id + 1))
            if b.num_rows:
                shard = b.column(2)[0].as_py()
            for doc, ids in zip(b.column(0).to_pylist(), code.encode(b.column(1)), strict=True):
                docs.append(doc)
                parts.append(np.append(ids, np.array([end_id], ids.dtype)))
                held += len(parts[-1])
                if held >= block_ids:
                    yield flush()
        if docs:
            yield flush()
    return run


def write_ids(docs: DataFrame, path: str, tokenizer: str = TOKENIZER, end_id: int = END_ID,
              block_ids: int = BLOCK_IDS, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Tokenize ``docs`` and write the block table at ``path``."""
    from pyspark.sql.pandas.types import to_arrow_type
    kind = docs.schema[id_col].dataType
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = rows.repartitionByRange("id", F.xxhash64("text")).sortWithinPartitions("id", F.xxhash64("text"))
    rows = rows.withColumn("shard", F.spark_partition_id())
    run = _pack_batches(tokenizer, end_id, block_ids, to_arrow_type(kind))
    rows.mapInArrow(run, _BLOCK.format(id=kind.simpleString())).write.parquet(path)


def shard_starts(spark, path: str) -> list[tuple[int, int]]:
    """(shard, ids before it): one row per shard, so the driver may hold them."""
    sums = spark.read.parquet(path).groupBy("shard").agg(F.sum("n_ids").alias("n")).orderBy("shard").collect()
    ends = np.cumsum([0, *[x.n for x in sums]]).tolist()
    return [(x.shard, a) for x, a in zip(sums, ends, strict=False)]


def read_blocks(spark, path: str) -> DataFrame:
    """The block table with ``start``: the ids of all blocks before each."""
    starts = spark.createDataFrame(shard_starts(spark, path), "shard int, before bigint")
    rows = spark.read.parquet(path).join(F.broadcast(starts), "shard")
    return rows.withColumn("start", F.col("before") + F.col("first"))


def _digest_batches(batches: Iterator[pa.RecordBatch]):
    for b in batches:
        out = []
        for docs, lengths, data, start in zip(*(b.column(c).to_pylist() for c in ("doc_ids", "lengths", "data", "start")), strict=True):
            raw = memoryview(unpack(data).astype("<u4").tobytes())
            at = 0
            for doc, n in zip(docs, lengths, strict=True):
                out.append((doc, start + at, n, zlib.crc32(raw[4 * at:4 * (at + n)])))
                at += n
        cols = list(zip(*out, strict=True)) or [[]] * 4
        doc_type = b.schema.field("doc_ids").type.value_type
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (doc_type, pa.int64(), pa.int64(), pa.int64()), strict=True)],
                                         names=["doc_id", "start", "n_tokens", "ids_crc32"])


def document_digests(spark, path: str) -> DataFrame:
    """Per document, from the files: first id's place, id count, crc32 of its ids."""
    blocks = read_blocks(spark, path)
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    return blocks.select("doc_ids", "lengths", "data", "start").mapInArrow(
        _digest_batches, f"doc_id {kind}, start bigint, n_tokens bigint, ids_crc32 bigint")


def read_range(spark, path: str, start: int, count: int) -> np.ndarray:
    """Ids ``start`` to ``start + count`` of the whole corpus: only the blocks that hold them are read."""
    rows = read_blocks(spark, path).where((F.col("start") < start + count) & (F.col("start") + F.col("n_ids") > start))
    got = sorted(rows.select("start", "n_ids", "data").collect(), key=lambda x: x.start)
    parts = [unpack(bytes(x.data), max(0, start - x.start), min(x.start + x.n_ids, start + count) - max(x.start, start)) for x in got]
    return np.concatenate(parts) if parts else np.zeros(0, np.uint32)


@register("op3_bitpack")
def op3_bitpack(spark, sf_dir) -> DataFrame:
    """Write the ids of ``documents`` and read per-document digests back from the files."""
    path = scratch_path(spark, "ids")
    write_ids(table(spark, sf_dir, "documents"), path)
    return document_digests(spark, path)
