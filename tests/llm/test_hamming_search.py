"""Exact top-k: multi-index search against brute force."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from fillbook.llm import hamming_search as H


def brute(rows, queries, k):
    out = []
    for qid, q in queries:
        near = sorted(((q ^ c) & (2**64 - 1)).bit_count() * 10**9 + i for i, c in rows)[:k]
        out += [(qid, r + 1, x % 10**9, x // 10**9) for r, x in enumerate(near)]
    return sorted(out)


@pytest.mark.parametrize("seed,shard,k", [(0, 4096, 5), (1, 16, 3), (2, 8, 12)])
def test_equals_brute_force(spark, seed, shard, k):
    r = np.random.default_rng(seed)
    codes = r.integers(-2**63, 2**63 - 1, 250).tolist()
    codes += [codes[0]] * 40 + [c ^ (1 << int(b)) for c in codes[:30] for b in r.integers(0, 63, 2)]
    codes += [int(c) & 0xFFFF for c in codes[:40]]  # one leading value for many codes
    rows = list(enumerate(codes))
    df = spark.createDataFrame(rows, "id long, code long")
    qs = rows[::40] + [(3, codes[3])]
    old, H.SHARD = H.SHARD, shard
    try:
        got = H.top_k(df, spark.createDataFrame(qs, "id long, code long"), k)
        assert sorted(tuple(x) for x in got.collect()) == brute(rows, qs, k)
    finally:
        H.SHARD = old


def test_edges(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (None, 5), (3, 5), (3, 5)], "id long, code long")
    got = sorted(tuple(x) for x in H.top_k(df, df.where("id = 1"), 10).collect())
    assert got == [(1, 1, 1, 0), (1, 2, 3, 0), (1, 3, 3, 0)]
    assert H.top_k(df, df.limit(0)).count() == 0 and H.top_k(df.limit(0), df).count() == 0
    e = spark.createDataFrame([([0.5, -1.0, None, float("nan"), 2.0],), ([],), (None,)], "embedding array<float>")
    assert [x.c for x in e.select(H.sign_code(F.col("embedding")).alias("c")).collect()] == [17, 0, None]


def test_flips():
    for w in (1, 5, 8):
        for r in range(w + 2):
            assert sorted(H.flips(w, r).tolist()) == [x for x in range(1 << w) if x.bit_count() == r]


@pytest.mark.parametrize("size", [65, 200])
def test_long_embeddings(spark, size):
    """Codes of several words, short and missing vectors among them, against all distances."""
    r = np.random.default_rng(size)
    vectors = [r.normal(size=size).round(2).tolist() for _ in range(60)] + [r.normal(size=int(n)).tolist() for n in r.integers(0, 65, 20)]
    vectors += [[-x if r.random() < 0.05 else x for x in vectors[int(i)]] for i in r.integers(0, 60, 60)] + [vectors[0]] * 5
    rows = [(i, v, "x") for i, v in enumerate(vectors)] + [(None, vectors[0], "x"), (900, None, "x")]
    df = spark.createDataFrame(rows, "id long, embedding array<double>, code string")
    words = H.words_for(df, "embedding")
    assert words == -(-size // 64)
    coded = df.select("id", H.sign_words(F.col("embedding"), words).alias("code"))
    code = lambda v: sum(1 << i for i, x in enumerate(v) if x > 0)
    plain = [(i, code(v)) for i, v, _ in rows if v is not None and i is not None]
    want = []
    for q, c in plain[::9]:
        near = sorted(((c ^ x).bit_count(), i) for i, x in plain)[:7]
        want += [(q, n + 1, i, d) for n, (d, i) in enumerate(near)]
    got = H.top_k(coded, coded.where(F.col("id").isin([q for q, _ in plain[::9]])), 7, words)
    assert sorted(tuple(x) for x in got.collect()) == sorted(want)
