"""Bit packing: round trips, random access, and the query against plain encoding."""
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from fillbook.llm import bitpack as B
from fillbook.llm.common import table
from fillbook.llm.tokens import Encoder, tokenizer_path
from fillbook.session import scratch_path


@pytest.mark.parametrize("bits", [1, 3, 8, 11, 15, 16, 17, 24, 31, 32])
def test_round_trip(bits):
    r = np.random.default_rng(bits)
    for n in (0, 1, 7, 1000, (1 << 16) + 5):
        ids = r.integers(0, 1 << bits, n).astype(np.uint32)
        data = B.pack(ids, bits)
        assert np.array_equal(B.unpack(data), ids) and len(data) <= 16 + n * bits / 8 + 8
        assert np.array_equal(B.unpack(data, n // 3, n // 2), ids[n // 3:n // 3 + n // 2])
    assert B.bits_for(50257) == 16 and B.bits_for(2) == 1 and B.bits_for(65537) == 17


def test_pieces_equal_whole_encoding():
    import random
    code, r = Encoder(), random.Random(2)
    parts = ["a ", "The ", "é ", "12. ", "<|endoftext|> ", "word, ", "ß, ", "漢字\n", "́ ", "x.y ", "it's. ", "..., ", "q<|endoftext|>\n", "z",
             "  ", "\t", "\n\n", " ", "\x1c", "᠎", "\nAb. "]
    for _ in range(1500):
        t = "".join(r.choice(parts) for _ in range(r.randint(0, 25)))
        assert code.encode([t])[0].tolist() == code.tokenizer.encode(t, add_special_tokens=False).ids, t


def plain(rows):
    t = Tokenizer.from_file(tokenizer_path())
    out, at = [], 0
    for i, text in rows:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def test_query_equals_plain(spark):
    from fillbook.llm.common import QUERIES
    docs = table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text").orderBy("doc_id").collect()
    got = QUERIES["op3_bitpack"](spark, "/root/testdata/sf0.001").orderBy("doc_id").collect()
    assert [tuple(x) for x in got] == plain([(x.doc_id, x.text) for x in docs])


def test_edges_and_random_access(spark):
    rows = [(5, "long words " * 3000, 1), (1, None, 1), (2, "", 1), (2, "", 1), (None, "x", 1), (9, "end.", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, shard int")
    path = scratch_path(spark, "t-ids")
    B.write_ids(df, path, block_ids=100)
    got = [tuple(x) for x in B.document_digests(spark, path).orderBy("start").collect()]
    order = [(None, "x"), (1, None), (2, ""), (2, ""), (5, rows[0][1]), (9, "end.")]
    assert got == plain(order)
    code = Encoder()
    whole = np.concatenate([np.append(code.encode([t])[0], 2) for _, t in order])
    assert np.array_equal(B.read_range(spark, path, 3, 500), whole[3:503])
    assert np.array_equal(B.read_range(spark, path, len(whole) - 2, 50), whole[-2:])
    empty = scratch_path(spark, "t-none")
    B.write_ids(df.limit(0), empty)
    assert B.document_digests(spark, empty).count() == 0
