"""Token counts: against the library on whole texts."""
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fillbook.llm import token_counts as C
from fillbook.llm.common import QUERIES, prepare, table
from tests.conftest import SF001

ODD = ["", None, " ", "\n\t\r ", "Don't we'LL I'M it's 'S", "<|endoftext|>", "a<|startoftext|>b <|ENDOFTEXT|> <|endoftext|", "<|endoftext|≯x",
       "é ́a   x y\u0085z", "\x00\x0b\x0c\x1c​﻿", "ΑΣ ΣΑΣ ß İ ǅ ﬁ", "漢字かな123 ①½ 🙂🏽👩‍🚀", "x" * 5000, "9" * 3000 + "!" * 400,
       "word " * 4000, "\n\n a\n\nb\r\nc", "naïve café №5 \U0001d54f"]


def library(texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(C.tokenizer_path(C.TOKENIZER))
    return [len(e.ids) for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def by_units(texts):
    import numpy as np
    import pyarrow as pa
    code = C.counter()
    units, holders, docs, times = C.block_frequencies(code, pa.array(texts, pa.string()), 3)
    pieces = np.repeat(np.array([code.pieces(u) for us in units for u in us], int), holders)
    return np.bincount(docs, weights=pieces * times, minlength=len(texts)).astype(int).tolist()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from("aA9'.!̸́ \n<|>"))), min_size=1, max_size=4))
def test_units_count_like_the_library(texts):
    assert by_units(texts) == library(texts)


def test_rows(spark):
    prepare(spark)
    rows = [(i, t, "x") for i, t in enumerate(ODD)] + [(3, ODD[4], "y"), (None, "one two", "z"), (None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, units string").repartition(3)
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.n_bytes, r.n_tokens) for r in C.token_counts(docs).collect())
    want = sorted((i is not None, i or 0, len((t or "").encode()), n) for (i, t, _), n in zip(rows, library([r[1] for r in rows]), strict=True))
    assert got == want


def test_other_id_types_and_empty_table(spark):
    prepare(spark)
    docs = spark.createDataFrame([("a", "x y")], "doc_id string, text string")
    assert [tuple(r) for r in C.token_counts(docs).collect()] == [("a", 3, 2)]
    assert C.token_counts(docs.limit(0)).collect() == []


def test_white_space_tokens_are_refused():
    with pytest.raises(ValueError):
        C.Counter("byte_bpe_50k.json")


def test_query(spark):
    docs = table(spark, SF001, "documents").select("doc_id", "text").collect()
    want = dict(zip([d.doc_id for d in docs], library([d.text for d in docs]), strict=True))
    got = QUERIES["op11_token_counts"](spark, SF001).collect()
    assert len(got) == len(docs)
    assert all(r.n_tokens == want[r.doc_id] and r.over_limit == (r.n_tokens > 2048) for r in got)
