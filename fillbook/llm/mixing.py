"""Operator 4, mixing sources to target weights by min-cost flow.

A document belongs to one or more sources; its *pattern* is that set. Spark
sums the words of each pattern; the driver (one row per pattern, bounded by
``MAX_PATTERNS``) routes pattern capacity to source targets as a min-cost flow
in which the second and third use of the same words cost more and more, so
repetition is spread before it is stacked. Each pattern then takes whole passes
over all its documents and a seeded share of one more pass: documents in hash
order, each that does not fit passed over, then the one that fits the rest
best. Where that misses by more than ``CLOSE`` of the pattern's words, all that
is left is larger than the gap; the share is then chosen anew with the larger
documents first, which the smaller ones fill up, and the better choice holds.

The share is found without sorting a pattern. A round takes the documents up to
the first that does not fit: sums over ``2 ** BUCKET_BITS`` hash buckets give
the bucket where that is, and only this bucket is ordered. The next round goes
on behind it with the documents no larger than the gap, until the gap is within
``CLOSE`` or nothing fits. A round is kept as a range of hashes and of sizes, so
the choice is a function of pattern, id and size, is applied in one projection,
and reruns agree.

Defined results: a null text has size 0 and is taken 0 words; a null source is
a source of its own, last in order; rows that agree in id, size and pattern
are taken alike in the partial pass; no document is taken more than
``MAX_USES`` times; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import defaultdict, deque

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fillbook.llm.common import free_names, register, table, word_count, write_read

WEIGHTS = (5, 2, 1)
MAX_USES = 3
#: What a word's first, second and third use cost: convex.
USE_COSTS = (0, 1, 3)
SEED = 5
BUCKET_BITS = 12
#: The driver gets one row per pattern; more patterns than this are an error.
MAX_PATTERNS = 1_000_000
#: A pattern table up to this many rows and ranges is broadcast (under 200 bytes each).
BROADCAST_ROWS = 50_000
#: A pattern is close enough to its target at this fraction of its words.
CLOSE = 0.001
_FIRST, _LAST = -(1 << 63), (1 << 63) - 1

Pattern = tuple  # of sources; None is a source


def weighted_targets(sizes: dict, weights=WEIGHTS, most: int = MAX_USES) -> dict:
    """Words to take of each source: shares of all words by repeating weights in
    code point order (null last), none above ``most`` times its size; what a
    source cannot take is shared again among the others by weight."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, rest = {}, list(names), float(sum(sizes.values()))
    while open_:
        total = sum(weight[s] for s in open_)
        full = [s for s in open_ if rest * weight[s] / total > most * sizes[s]]
        if not full:
            target |= {s: rest * weight[s] / total for s in open_}
            break
        for s in full:
            target[s] = float(most * sizes[s])
        rest -= sum(target[s] for s in full)
        open_ = [s for s in open_ if s not in target]
    return target


def route(capacity: dict[Pattern, int], target: dict, costs=USE_COSTS) -> dict[Pattern, dict]:
    """Words of each pattern that each of its sources takes.

    Serves as much of the targets as the patterns can, at the least cost of
    repeated use: successive shortest paths from patterns through their sources
    to the targets, one network for each group of sources that overlap.
    """
    flow: dict[Pattern, dict] = {p: {} for p in capacity}
    for part in _linked(capacity):
        _shortest_paths({p: capacity[p] for p in part}, target, costs, flow)
    return flow


def _linked(patterns) -> list[list[Pattern]]:
    """Patterns that share sources, directly or through others, together: a
    source without overlap is a network of one path."""
    top: dict = {}

    def find(s):
        while top[s] != s:
            top[s] = s = top[top[s]]
        return s
    for p in patterns:
        for s in p:
            top.setdefault(s, s)
            top[find(s)] = find(p[0])
    parts = defaultdict(list)
    for p in patterns:
        if p:
            parts[find(p[0])].append(p)
    return list(parts.values())


def _shortest_paths(capacity, target, costs, flow) -> None:
    """Min-cost flow from a root through patterns and sources to a sink, into ``flow``."""
    edges: list[list] = []  # [from, to, room, cost]; an edge's twin is its number ^ 1
    out = defaultdict(list)

    def link(a, b, room, cost):
        for x, y, r, c in ((a, b, room, cost), (b, a, 0.0, -cost)):
            out[x].append(len(edges))
            edges.append([x, y, r, c])
    root, sink = ("root",), ("sink",)
    served = {}
    for p, c in sorted(capacity.items(), key=lambda x: str(x[0])):
        for cost in costs:
            link(root, ("p", p), float(c), cost)
        for s in p:
            served[p, s] = len(edges)
            link(("p", p), ("s", s), float("inf"), 0)
    for s in sorted({s for p in capacity for s in p}, key=lambda s: (s is None, s or "")):
        link(("s", s), sink, float(target.get(s, 0.0)), 0)
    while True:
        far, came, todo, waiting = {root: 0}, {}, deque([root]), {root}
        while todo:
            a = todo.popleft()
            waiting.discard(a)
            for n in out[a]:
                _, b, room, cost = edges[n]
                if room > 1e-6 and far[a] + cost < far.get(b, float("inf")):
                    far[b], came[b] = far[a] + cost, n
                    if b not in waiting:
                        waiting.add(b)
                        todo.append(b)
        if sink not in far:
            break
        path, at = [], sink
        while at != root:
            path.append(came[at])
            at = edges[came[at]][0]
        push = min(edges[n][2] for n in path)
        for n in path:
            edges[n][2] -= push
            edges[n ^ 1][2] += push
    for (p, s), n in served.items():
        flow[p][s] = edges[n ^ 1][2]


def _order(id_col: str) -> Column:
    return F.xxhash64(F.lit(SEED), F.col(id_col), F.col("size"))


#: The documents of a round: hashes ``first`` to ``last``, sizes above ``over`` up to ``most``.
_RANGES = "array<struct<first:bigint,last:bigint,over:bigint,most:bigint>>"


def _within(ranges: str, hash_col: str) -> Column:
    h, size = F.col(hash_col), F.col("size")
    return F.exists(ranges, lambda r: h.between(r["first"], r["last"]) & (size > r["over"]) & (size <= r["most"]))


class Mix:
    """A fitted mix: for each pattern its passes and the ranges of its partial pass."""

    COLUMNS = f"pattern string, source_size bigint, target double, passes int, ranges {_RANGES}, fit_hash bigint, fit_size bigint"

    def __init__(self, spark, rows: list[tuple], id_col: str):
        self.id_col = id_col
        self.rows = rows
        plan = spark.createDataFrame(rows, self.COLUMNS)
        self.plan = F.broadcast(plan) if sum(1 + len(r[4]) for r in rows) <= BROADCAST_ROWS else plan

    @classmethod
    def fit(cls, docs: DataFrame, sources: Column, size: Column, targets=weighted_targets, id_col: str = "doc_id") -> Mix:
        """``sources``: array of a row's sources; ``targets``: function from the
        words of each source to the words wanted."""
        spark = docs.sparkSession
        items = docs.select(F.col(id_col), F.to_json(F.array_sort(F.array_distinct(sources))).alias("pattern"), size.alias("size"))
        # Rows of equal hash and size (repeated rows) are one step: taken together or not at all.
        steps = items.withColumn("hash", _order(id_col)).groupBy("pattern", "hash", "size").agg(F.sum("size").alias("n"))
        steps = write_read(steps, "mixing")
        sums = steps.groupBy("pattern").agg(F.sum("n").alias("n")).limit(MAX_PATTERNS + 1).collect()
        if len(sums) > MAX_PATTERNS:
            raise ValueError(f"more than {MAX_PATTERNS} patterns of sources: mix coarser sources")
        members = {x.pattern: tuple(json_list(x.pattern)) for x in sums}
        capacity = {members[x.pattern]: x.n for x in sums}
        sizes: dict = defaultdict(int)
        for p, n in capacity.items():
            for s in p:
                sizes[s] += n
        target = targets(dict(sizes))
        flow = route(capacity, target)
        passes, share, close = {}, {}, {}
        for x in sums:
            words = min(sum(flow[members[x.pattern]].values()), float(MAX_USES * x.n))
            passes[x.pattern] = int((words + 1e-6) // x.n) if x.n else 0
            share[x.pattern] = max(0.0, words - passes[x.pattern] * x.n)
            close[x.pattern] = max(CLOSE * words, 0.5)  # sizes are whole
        chosen = _partial(steps, {p: v for p, v in share.items() if v > 1e-6}, close)
        rows = []
        for x in sums:
            p, first = x.pattern, members[x.pattern][0] if members[x.pattern] else None
            rows.append((p, int(sizes.get(first, 0)), float(target.get(first, 0.0)), passes[p], *chosen.get(p, ([], None, None))))
        return cls(spark, rows, id_col)

    def uses(self, docs: DataFrame, sources: Column, size: Column) -> DataFrame:
        """The rows of ``docs`` with size, source_size, target and uses of each;
        columns of ``docs`` that have one of these names are replaced."""
        made = ("size", "source_size", "target", "uses")
        pattern, hash_, passes, ranges, fit_hash, fit_size = free_names(docs, "pattern", "hash", "passes", "ranges", "fit_hash", "fit_size")
        kept = [c for c in docs.columns if c.lower() not in made]
        d = docs.select(*[F.col(f"`{c}`") for c in kept], size.alias("size"), F.to_json(F.array_sort(F.array_distinct(sources))).alias(pattern),
                        _order(self.id_col).alias(hash_))
        plan = self.plan.select(F.col("pattern").alias(pattern), "source_size", "target",
                                *[F.col(c).alias(n) for c, n in (("passes", passes), ("ranges", ranges), ("fit_hash", fit_hash), ("fit_size", fit_size))])
        d = d.join(plan, pattern)
        more = _within(ranges, hash_)
        more = more | F.coalesce((F.col(hash_) == F.col(fit_hash)) & (F.col("size") == F.col(fit_size)), F.lit(False))
        uses = F.when(F.col("size") > 0, F.col(passes) + more.cast("int")).otherwise(0)
        return d.select(*[F.col(f"`{c}`") for c in kept], "size", "source_size", "target", uses.cast("int").alias("uses"))


def json_list(text: str) -> list:
    import json
    return json.loads(text)


def _side(spark, rows: list[tuple], schema: str) -> DataFrame:
    df = spark.createDataFrame(rows, schema)
    return F.broadcast(df) if len(rows) <= BROADCAST_ROWS else df


def _rounds(steps: DataFrame, todo: dict[str, tuple], close: dict[str, float]):
    """First fit in hash order. ``todo``: for each pattern the words to fill and
    the sizes (above the first, up to the second) of the documents that may;
    returns the ranges taken and the words still open of each."""
    spark = steps.sparkSession
    taken, gap = {p: [] for p in todo}, {p: t[0] for p, t in todo.items()}
    first = dict.fromkeys(todo, _FIRST)

    def most(p):
        return int(min(gap[p], todo[p][2]))

    def candidates():
        rows = [(p, gap[p], first[p], todo[p][1], most(p)) for p in first]
        at = steps.join(_side(spark, rows, "pattern string, gap double, first bigint, over bigint, most bigint"), "pattern")
        return at.where("hash >= first and size > over and size <= most")
    first = {p: f for p, f in first.items() if gap[p] > close[p] and most(p) > todo[p][1]}
    while first:
        b = candidates().withColumn("bucket", F.shiftright("hash", 64 - BUCKET_BITS).cast("int"))
        sums = b.groupBy("pattern", "gap", "bucket").agg(F.sum("n").alias("n"))
        sums = sums.withColumn("upto", F.sum("n").over(Window.partitionBy("pattern", "gap").orderBy("bucket")))
        cut = F.min(F.when(F.col("upto") > F.col("gap"), F.struct("bucket", (F.col("upto") - F.col("n")).alias("before"))))
        cuts = sums.groupBy("pattern").agg(cut.alias("cut"), F.max("upto").alias("total")).collect()
        for x in cuts:
            if x.cut is None:  # all of them fit
                taken[x.pattern].append((first[x.pattern], _LAST, todo[x.pattern][1], most(x.pattern)))
                gap[x.pattern] -= x.total
        ends = [(x.pattern, x.cut.bucket, x.cut.before) for x in cuts if x.cut]
        if not ends:
            break
        at = b.join(_side(spark, ends, "pattern string, bucket int, before bigint"), ["pattern", "bucket"])
        run = F.sum("n").over(Window.partitionBy("pattern").orderBy("hash").rangeBetween(Window.unboundedPreceding, Window.currentRow))
        upto = F.col("before") + run
        fits = F.col("upto") <= F.col("gap")
        got = at.withColumn("upto", upto).groupBy("pattern").agg(
            F.coalesce(F.max(F.when(fits, F.col("upto"))), F.max("before")).alias("words"), F.min(F.when(~fits, F.col("hash"))).alias("stop")).collect()
        begin, first = first, {}
        for x in got:
            p = x.pattern
            if x.words:
                taken[p].append((begin[p], x.stop - 1, todo[p][1], most(p)))
                gap[p] -= x.words
            if gap[p] > close[p] and x.stop < _LAST and most(p) > todo[p][1]:
                first[p] = x.stop + 1
        if first:  # a round begins at a document that fits, so each one takes some
            first = {x.pattern: x.h for x in candidates().where("n <= gap").groupBy("pattern").agg(F.min("hash").alias("h")).collect()}
    return taken, gap


def _nearest(steps: DataFrame, taken: dict[str, list], gap: dict[str, float]) -> dict:
    """(words, hash, size) of the document outside ``taken`` that comes nearest to the gap."""
    rows = [(p, taken[p], gap[p]) for p in gap]
    rest = steps.join(_side(steps.sparkSession, rows, f"pattern string, ranges {_RANGES}, gap double"), "pattern")
    rest = rest.where(F.expr("size > 0 and abs(n - gap) < gap") & ~_within("ranges", "hash"))
    best = rest.groupBy("pattern").agg(F.min(F.struct(F.abs(F.col("n") - F.col("gap")).alias("off"), "hash", "size")).alias("x")).collect()
    return {r.pattern: (r.x.off, r.x.hash, r.x["size"]) for r in best}


def _partial(steps: DataFrame, share: dict[str, float], close: dict[str, float]) -> dict[str, tuple]:
    """The partial pass of each pattern: its ranges, and hash and size of the document that fits the rest.

    A choice is made class by class, larger sizes first. It begins with one
    class of all sizes; a choice that misses adds its gap, as a power of two, as
    a bound between classes, until the miss is close or the bound is there.
    """
    best: dict[str, tuple] = {}
    bounds: dict[str, list] = {p: [] for p in share}
    while bounds:
        taken, gap = {p: [] for p in bounds}, {p: share[p] + 1e-6 for p in bounds}
        for i in range(1 + max(map(len, bounds.values()))):
            todo = {}
            for p, at in bounds.items():
                cuts = [int(share[p] + 1e-6), *sorted(at, reverse=True), 0]
                if i + 1 < len(cuts):
                    todo[p] = (gap[p], cuts[i + 1], cuts[i])
            more, left = _rounds(steps, todo, close)
            for p in todo:
                taken[p] += more[p]
            gap |= left
        fit = _nearest(steps, taken, gap)
        again = {}
        for p, at in bounds.items():
            miss, *last = fit.get(p, (gap[p], None, None))
            if p not in best or miss < best[p][0]:
                best[p] = (miss, taken[p], *last)
            bound = 1 << int(gap[p]).bit_length() >> 1
            if miss > close[p] and 0 < bound < share[p] and bound not in at:
                again[p] = [*at, bound]
        bounds = again
    return {p: x[1:] for p, x in best.items()}


def _one_source(column: str) -> Column:
    return F.array(F.col(column))


@register("op4_mixing")
def op4_mixing(spark, sf_dir) -> DataFrame:
    """Words the mix takes of every row of ``documents``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    size, sources = word_count(F.col("text")), _one_source("source")
    mix = Mix.fit(docs, sources, size)
    return mix.uses(docs, sources, size).select("doc_id", "size", "source_size", "target", (F.col("uses") * F.col("size")).cast("long").alias("taken"))
