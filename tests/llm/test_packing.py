"""Packing: the program against all choices of cuts, and the pieces' accounts."""
import zlib
from collections import defaultdict

import numpy as np
import pytest

from fillbook.llm import packing as P
from fillbook.llm.common import table
from fillbook.llm.tokens import Encoder


def pad(n, window):
    return 0 if n & (n - 1) == 0 else window - n


def quadratic(place, penalty, window, each):
    best = [0.0] + [float("inf")] * (len(place) - 1)
    for j in range(1, len(place)):
        for i in range(j):
            n = place[j] - place[i]
            if n <= window:
                best[j] = min(best[j], best[i] + pad(n, window) + penalty[j] + each)
    return best[-1]


@pytest.mark.parametrize("seed", range(30))
def test_cuts_are_cheapest(seed):
    r = np.random.default_rng(seed)
    window = int(r.choice([8, 16, 64]))
    gaps = r.integers(1, window + 1, int(r.integers(1, 80)))
    place = np.append(0, np.cumsum(gaps))
    penalty = np.append(0, r.choice([0.0, 1.0, 5.0], len(gaps)))
    cuts = P.best_cuts(place, penalty, window, 2.0)
    steps = np.diff([0, *cuts])
    at = dict(zip(place.tolist(), penalty.tolist(), strict=True))
    cost = sum(pad(int(n), window) + 2.0 for n in steps) + sum(at[c] for c in cuts)
    assert cuts[-1] == place[-1] and steps.max() <= window
    assert abs(cost - quadratic(place.tolist(), penalty.tolist(), window, 2.0)) < 1e-9


def check(rows, docs, window=1024):
    """Every id once, sequences gapless; returns the share of padding."""
    code = Encoder()
    whole = defaultdict(list)
    for i, t in docs:
        whole[i].append(np.append(code.encode([t])[0], 0).astype("<u4"))
    pieces, seqs = defaultdict(list), defaultdict(list)
    for x in rows:
        pieces[x.doc_id].append(x)
        seqs[x.sequence_id].append((x.offset, x.length))
    assert pieces.keys() == whole.keys()
    for i, ps in pieces.items():
        if len(whole[i]) == 1:
            ids, at = whole[i][0], 0
            for x in sorted(ps, key=lambda x: x.start):
                assert x.start == at and x.doc_tokens == len(ids) and x.ids_crc32 == zlib.crc32(ids[at:at + x.length].tobytes())
                at += x.length
            assert at == len(ids)
        assert sum(x.length for x in ps) == sum(map(len, whole[i]))
    fill = 0
    for s in seqs.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at and length > 0
            at += length
        assert at <= window
        fill += pad(at, window)
    return fill / sum(len(x) for v in whole.values() for x in v)


def test_documents(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = P.pack_sequences(docs).collect()
    assert check(rows, [(x.doc_id, x.text) for x in docs.select("doc_id", "text").collect()]) < 0.01
    order = [(x.doc_id, x.start) for x in sorted(rows, key=lambda x: (x.sequence_id, x.offset))]
    assert order == sorted(order)


def test_edges(spark):
    rows = [(5, "one word " * 5000, 1), (1, None, 1), (2, "", 1), (3, "same", 1), (3, "same", 1), (None, "x. y", 1), (9, "w" * 5000, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, start int")
    check(P.pack_sequences(df, stretch=500).collect(), [(i, t) for i, t, _ in rows])
    assert P.pack_sequences(df.limit(0)).count() == 0


def test_boundaries_only(spark):
    """The query cuts inside a sentence only where no boundary lies within a window."""
    from fillbook.llm.common import QUERIES
    docs = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text").collect()
    rows = QUERIES["op6_packing"](spark, "/root/testdata/sf0.01").collect()
    assert check(rows, docs) < 0.02
    code = Encoder()
    whole = {x.doc_id: np.append(code.encode([x.text])[0], 0) for x in docs}
    inside = 0
    for x in rows:
        stop, ids = x.start + x.length, whole[x.doc_id]
        if stop == len(ids) or code.ends[ids[stop - 1]]:
            continue
        at = np.concatenate(([0], np.flatnonzero(code.ends[ids]) + 1, [len(ids)]))
        n = np.searchsorted(at, stop)
        inside += 1
        assert at[n] - at[n - 1] > 1024
    assert inside > 0


def test_places_inside_long_sentences():
    """Gaps up to a window get no inner place, longer ones get places no farther apart than the grid."""
    ends = np.array([False, True])
    ids = np.array([0] * 7 + [1] + [0] * 8 + [0] * 30 + [1])
    at, cost = P.offered_cuts(ids, np.array([16, len(ids)]), ends, 4, 8)
    assert at.tolist() == [0, 8, 16, 20, 24, 28, 32, 36, 40, 44, 47] and cost.tolist() == [0, 1, 0] + [P.INNER_CUT] * 7 + [0]
    assert P.offered_cuts(ids[:16], np.array([16]), ends, 4, 8)[0].tolist() == [0, 8, 16]
