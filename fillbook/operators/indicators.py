"""Bar indicators: simple moving average and Wilder RSI, for every market at once.

Both run on segments of a market's bars (``scan.with_segments``), so a market
with any number of bars is many tasks, and both are built-in expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fillbook.operators.scan import Segments, either, fold_rows, last_state, segmented_running, with_segments
from fillbook.session import materialize

SEG = "_seg"


def segmented(bars: DataFrame, keys: list[str], order: str) -> DataFrame:
    """``bars`` with their segments, which the operators hand on to each other.

    Bars are an aggregate of ticks that every indicator reads several times, so
    they are written once when the segments are found."""
    return bars if SEG in bars.columns else with_segments(materialize(bars, "bars"), keys, order, SEG)


def sma(bars: DataFrame, n: int | list[int], key: str = "market_id", order: str = "bar_start",
        value: str = "close", out: str | None = None) -> DataFrame:
    """Mean of the last ``n`` values; null until ``n`` values exist. Several
    ``n`` make several columns in one pass, ``sma_<n>`` each.

    Rows behind the first ``n - 1`` of a segment take a window mean; those at
    its start add the last values of the segments before, in the same order.
    """
    ns = [n] if isinstance(n, int) else list(n)
    most = max(ns)
    d = segmented(bars, [key], order)
    s = Segments(d, [key], SEG, [order])
    means = {f"_mean{i}": F.when(F.count(value).over(w) == n, F.avg(value).over(w))
             for i, n in enumerate(ns) for w in [s.window.rowsBetween(-(n - 1), 0)]}
    if s.whole:
        s.with_columns(**means)
        made = [F.col(f"_mean{i}") for i in range(len(ns))]
        rows = s.rows
    else:
        near = F.collect_list(F.struct(F.col(value).alias("v"))).over(s.window.rowsBetween(-(most - 1), 0))
        s.with_columns(_pos=F.row_number().over(s.window), _near=near, **means)

        def tails() -> DataFrame:
            t = s.summary(F.max_by("_near", "_pos").alias("_end"))
            # Each earlier segment holds a row at least, so this many are enough.
            return t.withColumn("_tail", F.flatten(F.collect_list("_end").over(s.key.rowsBetween(-most, -1))))
        rows = s.entered(tails, _tail=F.array()).withColumn("_last", F.concat("_tail", "_near"))
        made = []
        for i, n in enumerate(ns):
            last = F.slice("_last", F.greatest(F.size("_last") - n + 1, F.lit(1)), F.lit(n))
            full = (F.size(last) == n) & F.forall(last, lambda x: x["v"].isNotNull())
            total = F.aggregate(last, F.lit(0.0), lambda a, x: a + x["v"])
            made.append(F.when(F.col("_pos") >= n, F.col(f"_mean{i}")).when(full, total / F.lit(float(n))))
    names = [out or f"sma_{n}" for n in ns] if len(ns) == 1 else [f"sma_{n}" for n in ns]
    return rows.select(*d.columns, *[m.alias(name) for m, name in zip(made, names, strict=True)]).drop(*_own(bars))


def _own(bars: DataFrame) -> list[str]:
    """Columns that the caller did not have."""
    return [] if SEG in bars.columns else [SEG]


def _averages(x: Column, u: Column, d: Column, p: int) -> list[Column]:
    """Wilder's averages after bar ``x.i``: the first ``p`` moves are summed and
    divided once, then a <- (a (p - 1) + move) / p."""
    k = F.lit(float(p))

    def after(a: Column, move: Column) -> Column:
        return either([(x["i"] < 1, F.lit(0.0)), (x["i"] < p, a + move), (x["i"] == p, (a + move) / k)], (a * F.lit(float(p - 1)) + move) / k)
    return [after(u, x["up"]), after(d, x["dn"])]


def _index(u: Column, d: Column) -> Column:
    """RSI of the two averages. No losses -> 100; no moves at all -> 50."""
    return F.when(d == 0.0, F.when(u == 0.0, F.lit(50.0)).otherwise(F.lit(100.0))).otherwise(F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + u / d))


def rsi(bars: DataFrame, periods: list[int] | int = 2, key: str = "market_id",
        order: str = "bar_start", value: str = "close") -> DataFrame:
    """Add ``rsi_<p>`` for each period; null for the first ``p`` bars of a market.

    A bar maps Wilder's average a to alpha a + beta. Each segment composes its
    bars to one such pair; the pairs of a market, one per segment, give the
    averages that enter each segment; then the segment's bars are folded from
    there, in order. A market of one segment is folded in order as a whole.
    """
    ps = [periods] if isinstance(periods, int) else list(periods)
    d = segmented(bars, [key], order)
    s = Segments(d, [key], SEG, [order])
    # Each bar's number in the market and its move.
    s.with_columns(_pos=F.row_number().over(s.window), _prev=F.lag(value).over(s.window))

    def ends() -> DataFrame:
        e = s.summary(F.max("_pos").alias("_n"), F.max_by(value, "_pos").alias("_last"))
        return e.select("_gk", SEG, F.coalesce(F.sum("_n").over(s.before), F.lit(0)).alias("_before"), F.lag("_last").over(s.key).alias("_end"),
                        F.lead("_n").over(s.key).isNotNull().alias("_more"))

    rows = s.entered(ends, _before=F.lit(0), _end=F.lit(None), _more=F.lit(False))
    move = F.col(value) - F.when(F.col("_pos") == 1, F.col("_end")).otherwise(F.col("_prev"))
    row = F.struct(F.col("_pos").alias("pos"), (F.col("_pos") - 1 + F.col("_before")).alias("i"),
                   F.when(move > 0, move).otherwise(F.lit(0.0)).alias("up"), F.when(move < 0, -move).otherwise(F.lit(0.0)).alias("dn"),
                   F.struct(*[F.col(c) for c in d.columns if c != SEG]).alias("bar"))
    rows = rows.select("_gk", SEG, "_more", row.alias("_row"))
    in_order = F.array_sort(F.collect_list("_row")).alias("_rows")  # bounded by the segment

    zero, one = F.lit(0.0), F.lit(1.0)

    def compose(a: Column, x: Column) -> Column:
        """One more bar: the factor and what is added, for both averages."""
        fields = []
        for p in ps:
            alpha = either([(x["i"] < 1, zero), (x["i"] < p, one), (x["i"] == p, F.lit(1.0 / p))], F.lit((p - 1.0) / p))
            up, dn = _averages(x, a[f"u{p}"], a[f"d{p}"], p)
            fields += [(alpha * a[f"a{p}"]).alias(f"a{p}"), up.alias(f"u{p}"), dn.alias(f"d{p}")]
        return F.struct(*fields)

    unit = F.struct(*[c.alias(f"{n}{p}") for p in ps for n, c in (("a", one), ("u", zero), ("d", zero))])
    def enter(e: Column, x: Column) -> Column:
        """The averages behind a segment that they enter."""
        return F.struct(*[(x["_map"][f"a{p}"] * e[f"{n}{p}"] + x["_map"][f"{n}{p}"]).alias(f"{n}{p}") for p in ps for n in "ud"])

    start = F.struct(*[zero.alias(f"{n}{p}") for p in ps for n in "ud"])
    def enters() -> DataFrame:
        """The averages that enter each segment but the first of a key."""
        # Only a segment that another one follows needs its map.
        maps = rows.where("_more").groupBy("_gk", SEG).agg(in_order).select("_gk", SEG, last_state(F.col("_rows"), unit, compose).alias("_map"))
        after = maps.groupBy("_gk").agg(F.array_sort(F.collect_list(F.struct(SEG, "_map"))).alias("_maps"))  # one per segment
        after = after.select("_gk", F.explode(F.arrays_zip(F.transform("_maps", lambda x: x[SEG]).alias("seg"),
                                                           fold_rows(F.col("_maps"), start, enter).alias("state"))).alias("_e"))
        next_ = ends().select("_gk", SEG, F.lag(SEG).over(s.key).alias("_last_seg")).where("_last_seg is not null")
        return next_.join(after.select("_gk", F.col("_e.seg").alias("_last_seg"), F.col("_e.state").alias("_enter")), ["_gk", "_last_seg"]).drop("_last_seg")

    def bar(e: Column, x: Column) -> Column:
        return F.struct(*[c.alias(f"{n}{p}") for p in ps for n, c in zip("ud", _averages(x, e[f"u{p}"], e[f"d{p}"], p), strict=True)])

    segments = rows.groupBy("_gk", SEG).agg(in_order)
    segments = segments.withColumn("_enter", start) if s.whole else segments.join(enters(), ["_gk", SEG], "left")
    folded = segments.select(
        SEG, F.explode(F.arrays_zip(F.col("_rows").alias("row"), fold_rows(F.col("_rows"), F.coalesce("_enter", start), bar).alias("state"))).alias("_x"))
    made = [F.when(F.col("_x.row.i") >= p, _index(F.col(f"_x.state.u{p}"), F.col(f"_x.state.d{p}"))).alias(f"rsi_{p}") for p in ps]
    out = folded.select(*[F.col(SEG) if c == SEG else F.col(f"_x.row.bar.{c}").alias(c) for c in d.columns], *made)
    return out.drop(*_own(bars))


def bar_index(bars: DataFrame, key: str = "market_id", order: str = "bar_start") -> DataFrame:
    """0-based bar number within the market."""
    d = segmented(bars, [key], order).withColumn("_one", F.lit(1))
    d = segmented_running(d, [key], SEG, [order], "_one", "sum", "bar_no")
    return d.select(*bars.columns, (F.col("bar_no") - 1).alias("bar_no"))
