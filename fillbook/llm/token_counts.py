"""Operator 11, token counts without token ids.

A tokenizer that drops white space never builds a token across it, so a text's
count is the sum over its pre-tokens. Each distinct pre-token of the corpus is
cut into pieces once, and only counts travel:

1. texts are read in blocks (an Arrow batch, at most ``ARROW_BYTES`` of text).
   Arrow splits and numbers the words of a block, the library's normalizer and
   pre-tokenizer cut the distinct words, and numpy counts (pre-token, document)
   pairs. A block keeps the frequencies, and deals its distinct pre-tokens into
   buckets by their hash, as many as the session has shuffle partitions;
2. a bucket meets the pre-tokens of all blocks that hash to it, and the
   vocabulary's model cuts each distinct one once;
3. the numbers of pieces join their block, where frequencies times pieces are
   added up per document. A pre-token that every document holds is one entry a
   block, so no key is hot.

A word that holds the string of an added token is counted whole, by the library.

Defined results: a null text counts as empty (0 bytes, 0 tokens); white space
alone has no tokens; special strings in a text are one token, the library's
default; repeated rows are separate rows; extra columns are ignored; an empty
table gives an empty result. The largest text bounds a task's memory.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fillbook.llm.common import frugal, register, table, write_read
from fillbook.llm.tokens import tokenizer_path

TOKENIZER = "word_bpe_49k.json"
LIMIT = 2048
#: Words, or pre-tokens of a bucket, that a task process remembers.
REMEMBERED = 400_000
#: Longer ones are not remembered.
LONGEST = 64


class Counter:
    """Pre-tokens of words and pieces of pre-tokens, as a vocabulary file has them.

    A unit is a pre-token in the byte letters of the model (never with a blank),
    or a blank and a whole word that holds the string of an added token.
    """

    def __init__(self, name: str = TOKENIZER):
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a task per core
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(tokenizer_path(name))
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model, self.normalizer = self.tokenizer.model, self.tokenizer.normalizer
        self.cut = self.tokenizer.pre_tokenizer
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.words: dict[str, list[str]] = {}
        apart = sum(self._whole(w) for w in "aZ9.")
        if self._whole(" a\nZ \t9\r. ") != apart or self._whole(" \n\t\r"):
            raise ValueError(f"{name}: white space is part of its tokens")

    def _whole(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _units(self, word: str, plain: str) -> list[str]:
        if any(a in word or a in plain for a in self.added):
            return [" " + word]
        return [u for u, _ in self.cut.pre_tokenize_str(plain)]

    def units(self, words: list[str]) -> list[list[str]]:
        """The units of words without blanks, tabs or line ends."""
        known = list(map(self.words.get, words))
        new = [w for w, x in zip(words, known, strict=True) if x is None]
        found = dict(zip(new, self._cut(new), strict=True)) if new else {}
        if len(self.words) > REMEMBERED:
            self.words.clear()
        self.words.update((w, x) for w, x in found.items() if len(w) <= LONGEST)
        return [found[w] if x is None else x for w, x in zip(words, known, strict=True)]

    def _cut(self, words: list[str]) -> list[list[str]]:
        """Cuts words in one call each of normalizer and pre-tokenizer, or one
        by one where a word has white space of another kind or an added token."""
        text = " ".join(words)
        plain = self.normalizer.normalize_str(text) if self.normalizer else text
        parts = plain.split(" ")
        if len(parts) != len(words) or any(a in text or a in plain for a in self.added):
            if len(words) > 1:
                half = len(words) // 2
                return self._cut(words[:half]) + self._cut(words[half:])
            return [self._units(words[0], plain)]
        out: list[list[str]] = [[] for _ in words]
        word, end = 0, len(parts[0])
        for unit, (a, _) in self.cut.pre_tokenize_str(plain):
            while a > end:
                word += 1
                end += 1 + len(parts[word])
            out[word].append(unit)
        return out

    def pieces(self, unit: str) -> int:
        """Number of tokens of a unit."""
        return self._whole(unit[1:]) if unit[0] == " " else len(self.model.tokenize(unit))


@lru_cache(maxsize=1)
def counter(name: str = TOKENIZER) -> Counter:
    """The task process's counter, kept from batch to batch."""
    return Counter(name)


def block_frequencies(code: Counter, texts: pa.Array, buckets: int) -> tuple[list[list[str]], np.ndarray, np.ndarray, np.ndarray]:
    """Distinct units of a block by bucket; and, unit by unit in that order, how
    many documents hold it, their numbers in the block, its frequency in them."""
    flat = pc.fill_null(texts, "")
    for blank in "\n\t\r":
        flat = pc.replace_substring(flat, blank, " ")
    lists = pc.split_pattern(flat, " ")
    numbered = lists.values.dictionary_encode()
    words = numbered.dictionary.to_pylist()
    cut = code.units([w or "." for w in words])
    number: dict[str, int] = {}
    cut = [[number.setdefault(u, len(number)) for u in us] if w else [] for w, us in zip(words, cut, strict=True)]
    bucket = np.fromiter((zlib.crc32(u.encode()) % buckets for u in number), np.int64, len(number))
    order = np.argsort(bucket, kind="stable")
    rank = np.empty(len(number), np.int64)
    rank[order] = np.arange(len(number))
    size = np.fromiter(map(len, cut), np.int32, len(cut))
    pool = rank[np.fromiter((u for us in cut for u in us), np.int64, int(size.sum()))]
    begin = np.cumsum(size) - size
    at = numbered.indices.to_numpy()
    doc = np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))
    n = size[at]
    upto = np.cumsum(n)
    pair = pool[np.repeat(begin[at] - upto + n, n) + np.arange(upto[-1] if len(n) else 0)]
    pair *= max(len(texts), 1)
    pair += np.repeat(doc, n)
    pair, times = np.unique(pair, return_counts=True)
    held, doc = np.divmod(pair, max(len(texts), 1))
    names = list(number)
    ends = np.searchsorted(bucket[order], np.arange(buckets + 1)).tolist()
    units = [[names[i] for i in order[a:z].tolist()] for a, z in zip(ends, ends[1:], strict=False)]
    return units, np.bincount(held, minlength=len(names)), doc, times


def _squeeze(numbers: np.ndarray) -> bytes:
    return zlib.compress(numbers.astype("<u4").tobytes(), 1)


def _numbers(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), "<u4").astype(np.int64)


#: A block's frequencies (bucket null), or its units of one bucket.
_BLOCK = "block bigint, bucket int, doc_ids array<{id}>, n_bytes array<bigint>, holders binary, docs binary, times binary, units binary"


def _block_batches(tokenizer: str, buckets: int, id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]):
        from pyspark import TaskContext
        block = TaskContext.get().partitionId() << 32
        kinds = [pa.int64(), pa.int32(), pa.list_(id_type), pa.list_(pa.int64()), *[pa.binary()] * 4]
        names = ["block", "bucket", "doc_ids", "n_bytes", "holders", "docs", "times", "units"]
        for b in batches:
            ids, texts = b.column(0), b.column(1)
            units, *counts = block_frequencies(counter(tokenizer), texts, buckets)
            size = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            lists = [pa.ListArray.from_arrays([0, len(ids)], x) for x in (ids.cast(id_type), size)]
            yield pa.RecordBatch.from_arrays([pa.array([block], kinds[0]), pa.nulls(1, kinds[1]), *lists,
                                              *[pa.array([_squeeze(c)], pa.binary()) for c in counts], pa.nulls(1, pa.binary())], names=names)
            full = [i for i, us in enumerate(units) if us]
            data = [zlib.compress("\n".join(units[i]).encode(), 1) for i in full]
            yield pa.RecordBatch.from_arrays([pa.array([block] * len(full), kinds[0]), pa.array(full, kinds[1]), *[pa.nulls(len(full), k) for k in kinds[2:7]],
                                              pa.array(data, pa.binary())], names=names)
            block += 1
    return frugal(run)


def _piece_batches(tokenizer: str):
    """Units of a bucket, block after block -> their numbers of pieces."""
    def run(batches: Iterator[pa.RecordBatch]):
        bucket, known = None, {}
        for b in batches:
            code, out = counter(tokenizer), []
            for k, data in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                if k != bucket or len(known) > REMEMBERED:
                    bucket, known = k, {}
                units = zlib.decompress(data).decode().split("\n")
                for u in units:
                    if u not in known:
                        known[u] = code.pieces(u)
                out.append(_squeeze(np.fromiter(map(known.get, units), np.int64, len(units))))
                for u in units:
                    if len(u) > LONGEST:
                        known.pop(u, None)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.binary())], names=["block", "bucket", "pieces"])
    return frugal(run)


def _sum_batches(id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            for i in range(b.num_rows):
                row = {name: b.column(k)[i] for k, name in enumerate(b.schema.names)}
                ids = row["doc_ids"].values
                found = sorted((row["found"].as_py() or []), key=lambda x: x["bucket"])
                holders, docs, times = (_numbers(row[c].as_py()) for c in ("holders", "docs", "times"))
                pieces = np.concatenate([_numbers(x["pieces"]) for x in found] or [np.zeros(0, np.int64)])
                amounts = np.repeat(pieces, holders) * times
                order = np.argsort(docs, kind="stable")
                upto = np.append(0, np.cumsum(amounts[order]))
                ends = np.searchsorted(docs[order], np.arange(len(ids)), "right")
                total = np.diff(upto[np.append(0, ends)])
                yield pa.RecordBatch.from_arrays([ids.cast(id_type), row["n_bytes"].values, pa.array(total)], names=["doc_id", "n_bytes", "n_tokens"])
    return frugal(run)


def token_counts(docs: DataFrame, tokenizer: str = TOKENIZER, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_bytes, n_tokens)`` of every row."""
    from pyspark.sql.pandas.types import to_arrow_type
    kind = docs.schema[id_col].dataType
    id_type = to_arrow_type(kind)
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = write_read(rows.mapInArrow(_block_batches(tokenizer, buckets, id_type), _BLOCK.format(id=kind.simpleString())), "frequencies")
    units = rows.where("bucket is not null").select("block", "bucket", "units").repartition(buckets, "bucket").sortWithinPartitions("bucket")
    found = units.mapInArrow(_piece_batches(tokenizer), "block bigint, bucket int, pieces binary")
    found = found.groupBy("block").agg(F.collect_list(F.struct("bucket", "pieces")).alias("found"))  # one a bucket at most
    blocks = rows.where("bucket is null").drop("bucket", "units").join(found, "block", "left")
    return blocks.select("doc_ids", "n_bytes", "holders", "docs", "times", "found").mapInArrow(
        _sum_batches(id_type), f"doc_id {kind.simpleString()}, n_bytes bigint, n_tokens bigint")


@register("op11_token_counts")
def op11_token_counts(spark, sf_dir) -> DataFrame:
    """Bytes and tokens of every whole text of ``documents``, and which are above 2048 tokens."""
    return token_counts(table(spark, sf_dir, "documents")).withColumn("over_limit", F.col("n_tokens") > LIMIT)
