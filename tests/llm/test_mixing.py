"""Mixing: targets, flow against enumeration, selection near target, edges."""
from collections import defaultdict
from itertools import product

import pytest
from pyspark.sql import functions as F

from fillbook.llm import mixing as M
from fillbook.llm.common import table, word_count


def test_targets():
    t = M.weighted_targets({"b": 100, "a": 1, None: 50, "c": 200})
    assert t["a"] == 3 and abs(sum(t.values()) - 351) < 1e-9
    assert abs(t["b"] / t["c"] - 2) < 1e-9 and t[None] <= 150  # weights by order: a 5, b 2, c 1, null 5
    assert M.weighted_targets({}) == {} and M.weighted_targets({"a": 0}) == {"a": 0.0}


def brute_cost(cap, target):
    """Least cost at most served, by enumerating whole words."""
    pairs = [(p, s) for p in cap for s in p]
    best = None
    for flows in product(*[range(int(min(target[s], 3 * cap[p])) + 1) for p, s in pairs]):
        into, used = defaultdict(int), defaultdict(int)
        for (p, s), f in zip(pairs, flows, strict=True):
            into[s] += f
            used[p] += f
        if any(into[s] > target[s] for s in into) or any(used[p] > 3 * cap[p] for p in used):
            continue
        cost = sum(c * min(max(used[p] - i * cap[p], 0), cap[p]) for p in cap for i, c in enumerate(M.USE_COSTS))
        key = (-sum(flows), cost)
        best = key if best is None or key < best else best
    return best


@pytest.mark.parametrize("cap,target", [
    ({("a",): 2, ("a", "b"): 2, ("b",): 1}, {"a": 5, "b": 4}),
    ({("a", "b"): 2, ("b",): 3}, {"a": 6, "b": 3}),
    ({("a", "b"): 1, ("a", "c"): 2}, {"a": 4, "b": 2, "c": 1}),
    ({("a",): 2, ("b",): 1}, {"a": 3, "b": 9}),
])
def test_route_is_optimal(cap, target):
    flow = M.route(cap, {k: float(v) for k, v in target.items()})
    used = {p: sum(f.values()) for p, f in flow.items()}
    cost = sum(c * min(max(used[p] - i * cap[p], 0), cap[p]) for p in cap for i, c in enumerate(M.USE_COSTS))
    want = brute_cost(cap, target)
    assert abs(sum(used.values()) + want[0]) < 1e-4 and abs(cost - want[1]) < 1e-4


def test_every_source_goes_through_the_flow(monkeypatch):
    """Groups of overlapping sources are networks of their own, single sources too."""
    seen = []
    real = M._shortest_paths
    monkeypatch.setattr(M, "_shortest_paths", lambda cap, *a: (seen.append(set(cap)), real(cap, *a)))
    cap = {("a",): 10, (None,): 4, ("b", "c"): 6, ("c", "d"): 8, ("e",): 0, (): 3}
    flow = M.route(cap, {"a": 25.0, None: 2.5, "b": 3.0, "c": 9.0, "d": 1.0, "e": 0.0})
    assert sorted(map(len, seen)) == [1, 1, 1, 2]
    assert abs(flow[("a",)]["a"] - 25) < 1e-6 and abs(flow[(None,)][None] - 2.5) < 1e-6 and flow[()] == {}
    assert abs(sum(sum(f.values()) for f in flow.values()) - 40.5) < 1e-5


def test_mix_of_documents(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    size, src = word_count(F.col("text")), F.array("source")
    one, two = (M.Mix.fit(docs, src, size).uses(docs, src, size).select("doc_id", "source", "size", "target", "uses").toPandas() for _ in range(2))
    assert one.sort_values("doc_id").reset_index(drop=True).equals(two.sort_values("doc_id").reset_index(drop=True))
    one["taken"] = one["size"] * one["uses"]
    g = one.groupby("source").agg(taken=("taken", "sum"), target=("target", "first"))
    assert one.uses.max() <= 3 and ((g.taken - g.target).abs() / g.target).max() < 0.02


def test_overlap_and_edges(spark):
    rows = [(i, "w " * (1 + i % 7), ["a"] if i % 3 else ["b", "a", "a"], 9) for i in range(300)]
    rows += [(1000, None, ["a"], 9), (1001, "", [None], 9), (None, "x y", [None], 9), (1002, "w", [None, "a"], 9), (1003, "w w", [], 9)]
    df = spark.createDataFrame(rows + rows[:2], "doc_id long, text string, s array<string>, target int")
    df = df.withColumns({c: F.lit(7) for c in ("uses", "source_size", "_pattern", "_hash", "pattern")})
    size = word_count(F.col("text"))
    got = M.Mix.fit(df, F.col("s"), size).uses(df, F.col("s"), size)
    assert sorted(got.columns) == sorted([*df.columns, "size"]) and got.where("_pattern <> 7 or _hash <> 7 or pattern <> 7").count() == 0
    assert dict(got.dtypes)["target"] == "double"
    assert got.count() == len(rows) + 2 and got.where("uses > 3 or (size = 0 and uses > 0)").count() == 0
    assert M.Mix.fit(df.limit(0), F.col("s"), size).uses(df.limit(0), F.col("s"), size).count() == 0


@pytest.mark.parametrize("sizes,share", [
    ([60_000] + [1_000] * 40, 40_000),
    ([4_000] + [8] * 1_000, 8_400),  # the long one is needed
    ([4_000] + [8] * 1_000, 6_000),
    ([4_000, 4_000] + [10] * 300, 9_000),
    ([5_000] + [500] * 5 + [1] * 100, 5_050),
])
def test_one_document_dominates(spark, sizes, share):
    """An exact choice exists; the sources are trials that differ in their documents' hashes."""
    rows = [(f"{t} {i}", t, n) for t in range(12) for i, n in enumerate(sizes)]
    docs = spark.createDataFrame(rows, "doc_id string, source string, words long").repartition(4)
    size, src = F.col("words"), F.array("source")
    mix = M.Mix.fit(docs, src, size, targets=lambda sums: dict.fromkeys(sums, float(share)))
    got = mix.uses(docs, src, size).groupBy("source").agg(F.sum(F.col("size") * F.col("uses")).alias("taken"), F.max("uses").alias("most")).collect()
    assert len(got) == 12 and all(x.most == 1 and abs(x.taken - share) <= M.CLOSE * share + 1e-6 for x in got)


def test_rows_without_id_are_weighed_together(spark):
    """Rows without id of one size have one hash: all or none of them, and not above the share."""
    rows = [(None, "a", 50)] * 200 + [(i, "a", 30) for i in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, words long")
    size, src = F.col("words"), F.array("source")
    for share in (9_050, 10_010, 30_050):
        mix = M.Mix.fit(docs, src, size, targets=lambda sums: {"a": float(share)})
        taken = mix.uses(docs, src, size).agg(F.sum(F.col("size") * F.col("uses"))).first()[0]
        assert abs(taken - share) <= 30
