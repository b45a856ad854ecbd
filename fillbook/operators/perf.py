"""Performance reports over many series at once.

Inputs are long tables: ``equity(series, ts, seq, value)`` (account value
over time) and ``ledger(series, closed_on, side, bars, pnl)`` (closed trades).
The fields are the ones the plotting reports show; the formulas are the
published ones (drawdown, Sharpe 1994, Calmar/Young 1991, VWR, Tharp SQN).
Running values per series use segments of equal size, so a hot series is many
tasks; period tables (one row per series and day/year) are small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fillbook.operators.scan import Segments, last_state, segmented_running, segmented_shift, with_segments


def drawdown(equity: DataFrame, key: str = "series", ts: str = "ts", seq: str = "seq",
             value: str = "value", segment: Column | None = None) -> DataFrame:
    """Per row: running peak, money down, percent down, bars since the last peak.

    The latest highest row of a segment, as (value, place), is a summary that
    merges by its maximum, so peak and length come from one pass over the rows.
    ``segment``: an explicit segment column monotone in (ts, seq), e.g.
    ``floor(seq / 2^20)``; default = segments of equal size per series.
    """
    d = equity.withColumn("_seg", segment) if segment is not None else with_segments(equity, [key], ts)
    s = Segments(d, [key], "_seg", [ts, seq])
    s.with_columns(_pos=F.row_number().over(s.window))
    here = F.struct(F.col(value).alias("v"), F.col("_pos").cast("bigint").alias("p"))
    s.with_columns(_top=F.max(F.when(F.col(value).isNotNull(), here)).over(s.running))
    moved = lambda top: F.when(F.col(top).isNotNull(), F.struct(F.col(f"{top}.v").alias("v"), (F.col("_before") + F.col(f"{top}.p")).alias("p")))

    def ends() -> DataFrame:
        e = s.summary(F.max("_pos").alias("_n"), F.max_by("_top", "_pos").alias("_end"))
        e = e.withColumn("_before", F.coalesce(F.sum("_n").over(s.before), F.lit(0)))
        return e.withColumn("_high", F.max(moved("_end")).over(s.before))

    none = F.lit(None).cast(s.rows.schema["_top"].dataType)
    rows = s.entered(ends, _before=F.lit(0).cast("bigint"), _high=none).withColumn("_top", F.greatest("_high", moved("_top"))).withColumn("pos", F.col("_before") + F.col("_pos"))
    peak = F.col("_top.v")
    return rows.select(key, ts, seq, value, peak.alias("peak"), (peak - F.col(value)).alias("moneydown"),
                       F.try_divide(F.lit(100.0) * (peak - F.col(value)), peak).alias("drawdown"),
                       (F.col("pos") - F.col("_top.p")).alias("len"), "pos")


def drawdown_report(equity: DataFrame, key: str = "series", **kw) -> DataFrame:
    """Current (last row) and maximum drawdown, money down and length per series."""
    dd = drawdown(equity, key, **kw)
    return dd.groupBy(key).agg(
        F.max_by("len", "pos").alias("len"),
        F.max_by("drawdown", "pos").alias("drawdown"),
        F.max_by("moneydown", "pos").alias("moneydown"),
        F.max("len").alias("max_len"),
        F.max("drawdown").alias("max_drawdown"),
        F.max("moneydown").alias("max_moneydown"))


def period_ends(equity: DataFrame, period: Column, key: str = "series", ts: str = "ts",
                seq: str = "seq", value: str = "value") -> DataFrame:
    """Value at the end of each period plus the series' first value."""
    order = F.struct(F.col(ts), F.col(seq))
    return equity.groupBy(key, period.alias("period")).agg(
        F.max_by(value, order).alias("end_value"),
        F.min_by(value, order).alias("first_value"))


def period_returns(equity: DataFrame, period: Column, key: str = "series", **kw) -> DataFrame:
    """(series, period, return): end / previous end - 1; the first period is
    measured from the series' first value."""
    p = period_ends(equity, period, key, **kw)
    w = Window.partitionBy(key).orderBy("period")
    base = F.coalesce(F.lag("end_value").over(w), F.col("first_value"))
    return p.select(key, "period", "end_value", (F.try_divide(F.col("end_value"), base) - 1).alias("ret"))


def period_stats(rets: DataFrame, key: str = "series", ddof: int = 1) -> DataFrame:
    r = F.col("ret")
    sd = F.stddev_samp(r) if ddof == 1 else F.stddev_pop(r)
    return rets.groupBy(key).agg(
        F.avg(r).alias("average"), sd.alias("stddev"),
        F.count_if(r > 0).alias("positive"), F.count_if(r < 0).alias("negative"),
        F.count_if(r == 0).alias("nzero"), F.max(r).alias("best"), F.min(r).alias("worst"))


def sharpe(rets: DataFrame, key: str = "series", risk_free: float = 0.0,
           periods_per_year: float | None = None, ddof: int = 1) -> DataFrame:
    """(mean excess return) / stddev of returns, optionally annualised by sqrt(k)."""
    ex = F.col("ret") - F.lit(risk_free)
    sd = F.stddev_samp("ret") if ddof == 1 else F.stddev_pop("ret")
    s = F.try_divide(F.avg(ex), sd)
    if periods_per_year:
        s = s * F.lit(periods_per_year ** 0.5)
    return rets.groupBy(key).agg(s.alias("sharpe"))


def _max_drawdown_of(arr: Column) -> Column:
    """Maximum fractional drawdown of an ordered (bounded) array of values."""
    init = F.struct(F.lit(None).cast("double").alias("peak"), F.lit(0.0).alias("mdd"))

    def step(acc, x):
        peak = F.greatest(acc["peak"], x)
        return F.struct(peak.alias("peak"), F.greatest(acc["mdd"], F.try_divide(peak - x, peak)).alias("mdd"))
    return F.aggregate(arr, init, step, lambda acc: acc["mdd"])


def calmar(ends: DataFrame, window: int, key: str = "series") -> DataFrame:
    """Rolling Calmar per period: return over the last ``window`` periods divided
    by the maximum drawdown of the period ends inside that window."""
    w = Window.partitionBy(key).orderBy("period")
    trailing = w.rowsBetween(-window, 0)
    d = ends.select(key, "period", "end_value",
                    F.lag("end_value", window).over(w).alias("_start"),
                    F.collect_list("end_value").over(trailing).alias("_win"))
    mdd = _max_drawdown_of(F.col("_win"))
    ret = F.try_divide(F.col("end_value"), F.col("_start")) - 1
    return d.select(key, "period", F.when(mdd > 0, F.try_divide(ret, mdd)).alias("calmar"))


def vwr(ends: DataFrame, key: str = "series", tau: float = 2.0, sdev_max: float = 0.2,
        periods_per_year: int = 252) -> DataFrame:
    """Variability-weighted return over period ends.

    ravg = mean log return; rnorm = (exp(ravg * periods_per_year) - 1) * 100;
    sdev = population stddev of value / (v0 * exp(ravg * i)) - 1;
    vwr = rnorm * (1 - (sdev / sdev_max) ** tau).
    """
    w = Window.partitionBy(key).orderBy("period")
    d = ends.select(key, "period", "end_value", (F.row_number().over(w) - 1).alias("i"),
                    F.first("end_value").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("v0"))
    n = d.groupBy(key).agg(F.max("i").alias("n"), F.max_by("end_value", "i").alias("vn"),
                           F.min_by("end_value", "i").alias("v0"))
    n = n.withColumn("ravg", F.try_divide(F.log(F.try_divide(F.col("vn"), F.col("v0"))), F.col("n")))
    d = d.drop("v0").join(n, key)
    dev = F.try_divide(F.col("end_value"), F.col("v0") * F.exp(F.col("ravg") * F.col("i"))) - 1
    g = d.groupBy(key).agg(F.first("ravg").alias("ravg"), F.stddev_pop(dev).alias("sdev"))
    rnorm = (F.exp(F.col("ravg") * periods_per_year) - 1) * 100
    return g.select(key, (rnorm * (1 - F.pow(F.col("sdev") / sdev_max, tau))).alias("vwr"))


def sqn(ledger: DataFrame, key: str = "series", pnl: str = "pnl") -> DataFrame:
    """System quality number: sqrt(n) * mean(pnl) / stddev(pnl)."""
    return ledger.groupBy(key).agg(
        F.try_divide(F.sqrt(F.count(pnl)) * F.avg(pnl), F.stddev_samp(pnl)).alias("sqn"),
        F.count(pnl).alias("trades"))


def streaks(ledger: DataFrame, key: str, order: list[str], won: Column,
            segment: Column | None = None) -> DataFrame:
    """Won/lost streaks: current and longest per series.

    A segment's runs are summed up by its first and last run and its longest
    ones; the summaries of a series, one per segment, merge in order. Rows
    without an outcome end a streak.
    """
    side = F.when(won, F.lit(1)).when(~won, F.lit(-1)).otherwise(F.lit(0))
    d = ledger.select(key, *order, side.alias("_side"), *([segment.alias("_seg")] if segment is not None else []))
    d = d if segment is not None else with_segments(d, [key], order[0])
    s = Segments(d, [key], "_seg", order)
    s.with_columns(_turn=(F.col("_side") != F.lag("_side", 1, 9).over(s.window)).cast("int"))
    s.with_columns(_run=F.sum("_turn").over(s.running))
    # Runs and segments stay where the windows dealt the rows.
    runs = s.rows.groupBy("_gk", "_seg", "_run").agg(F.max("_side").alias("side"), F.count(F.lit(1)).alias("len"))
    longest = lambda side: F.coalesce(F.max(F.when(F.col("side") == side, F.col("len"))), F.lit(0))
    run = F.struct("side", "len")
    parts = runs.groupBy("_gk", "_seg").agg(F.min_by(run, "_run").alias("first"), F.max_by(run, "_run").alias("last"), F.count(F.lit(1)).alias("n"),
                                            longest(1).alias("won"), longest(-1).alias("lost"))

    def merge(a: Column, x: Column) -> Column:
        joined = F.when(x["first"]["side"] == a["side"], a["len"] + x["first"]["len"]).otherwise(F.lit(0))
        best = lambda c, side: F.greatest(a[c], x[c], F.when(a["side"] == side, joined).otherwise(F.lit(0)))
        size = F.when((x["n"] == 1) & (joined > 0), joined).otherwise(x["last"]["len"])
        return F.struct(x["last"]["side"].alias("side"), size.alias("len"), best("won", 1).alias("won"), best("lost", -1).alias("lost"))

    none = F.lit(0).cast("bigint")
    start = F.struct(F.lit(0).alias("side"), none.alias("len"), none.alias("won"), none.alias("lost"))
    total = parts.groupBy("_gk").agg(F.array_sort(F.collect_list(F.struct("_seg", "first", "last", "n", "won", "lost"))).alias("parts"))
    total = total.select("_gk", last_state(F.col("parts"), start, merge).alias("t"))
    current = lambda side: F.when(F.col("t.side") == side, F.col("t.len")).otherwise(F.lit(0))
    return total.select(F.col(f"_gk.{key}").alias(key), F.col("t.won").alias("won_longest"), F.col("t.lost").alias("lost_longest"),
                        current(1).alias("won_current"), current(-1).alias("lost_current"))


def pnl_report(ledger: DataFrame, key: str, pnl: str, side: str, won: Column,
               commission: Column | None = None) -> DataFrame:
    """Gross/net totals and averages, by side and by outcome."""
    p = F.col(pnl)
    net = p - (commission if commission is not None else F.lit(0))
    long_, short_ = F.col(side) == "long", F.col(side) == "short"
    cols = [F.sum(p).alias("gross_total"), F.avg(p).alias("gross_average"),
            F.sum(net).alias("net_total"), F.avg(net).alias("net_average")]
    for nm, cond in (("long", long_), ("short", short_), ("won", won), ("lost", ~won),
                     ("long_won", long_ & won), ("long_lost", long_ & ~won),
                     ("short_won", short_ & won), ("short_lost", short_ & ~won)):
        cols += [F.sum(F.when(cond, net)).alias(f"{nm}_total"),
                 F.avg(F.when(cond, net)).alias(f"{nm}_average")]
    return ledger.groupBy(key).agg(*cols)


SIDES = ("long", "short")


def _groups(ledger: DataFrame, key: str, groups: dict[tuple, Column], measures) -> DataFrame:
    """One row per key and group, also for groups without trades: one
    aggregate (combined before the shuffle) of ``measures(condition)``."""
    made = [F.struct(*[F.lit(x).alias(n) for n, x in zip(("side", "outcome"), names, strict=False)],
                     *measures(cond)) for names, cond in groups.items()]
    rows = ledger.groupBy(key).agg(F.array(*made).alias("_g"))
    return rows.select(key, F.explode("_g").alias("g")).select(key, "g.*")


def win_counts(ledger: DataFrame, key: str, side: str, won: Column) -> DataFrame:
    """Long, short and all trades: total, won, lost. A trade without a side counts under all."""
    groups = {(s,): F.col(side) == s for s in SIDES} | {("all",): F.lit(True)}
    rows = ledger.where(F.col(key).isNotNull()).withColumn("_won", won)
    return _groups(rows, key, groups, lambda c: [
        F.count_if(c).alias("total"), F.count_if(c & F.col("_won")).alias("won"), F.count_if(c & ~F.col("_won")).alias("lost")])


def trade_length(ledger: DataFrame, key: str, side: str, won: Column, bars: str = "bars") -> DataFrame:
    """Bars held: total, min, max and average for all trades, each side, each
    outcome and the four crosses; groups without trades have total 0 and nulls."""
    sides = {"all": F.lit(True)} | {s: F.col(side) == s for s in SIDES}
    ends = {"all": F.lit(True), "won": F.col("_won"), "lost": ~F.col("_won")}
    groups = {(s, e): a & b for s, a in sides.items() for e, b in ends.items()}

    def measures(c: Column) -> list[Column]:
        held = F.when(c, F.col(bars))
        return [F.coalesce(F.sum(held), F.lit(0)).alias("total"), F.min(held).alias("min"), F.max(held).alias("max"),
                F.avg(held).alias("average")]
    return _groups(ledger.withColumn("_won", F.coalesce(won, F.lit(False))), key, groups, measures)


def gross_leverage(trades: DataFrame, key: list[str], segment: str, order: list[str], size: str, price: str,
                   value: str) -> DataFrame:
    """Gross exposure over account value at each time: the position held (running
    signed size, segmented so that no series is one task) valued at the price.

    One instrument per series. A zero value gives null.
    """
    held = segmented_running(trades, key, segment, order, size, "sum", "position")
    exposure = F.abs(F.coalesce("position", F.lit(0)) * F.col(price))
    return held.withColumn("leverage", F.try_divide(exposure, F.col(value)))



def portfolio_leverage(equity: DataFrame, trades: DataFrame, key: str = "series", instrument: str = "instrument", ts: str = "ts",
                       seq: str = "seq", size: str = "size", price: str = "price", value: str = "value") -> DataFrame:
    """Gross exposure over account value at each row of ``equity`` (key, ts, seq,
    value): the sum over instruments of |position x last price|, as of ``ts``.

    ``trades`` (key, instrument, ts, seq, signed size, price) have clocks of their
    own. A trade changes the sum by the change of its instrument's exposure, so
    one running sum per key merges any number of instruments; it and the
    positions are segmented scans. Trades at the time of an equity row count. A
    zero value gives null.
    """
    names = [key, instrument]
    d = with_segments(trades.select(*names, ts, seq, size, price), names, ts)
    d = segmented_running(d, names, "_seg", [ts, seq], size, "sum", "_held")
    d = d.withColumn("_exposure", F.abs(F.col("_held") * F.col(price)))
    d = segmented_shift(d, names, "_seg", [ts, seq], [("_exposure", -1, "_was")])
    change = F.coalesce("_exposure", F.lit(0.0)) - F.coalesce("_was", F.lit(0.0))
    none = F.lit(None).cast("double")
    events = d.select(key, ts, F.lit(0).alias("_kind"), F.col(seq).alias("_n"), change.cast("double").alias("_change"), none.alias(value))
    rows = equity.select(key, ts, F.lit(1).alias("_kind"), F.col(seq).alias("_n"), F.lit(0.0).alias("_change"), F.col(value).cast("double").alias(value))
    both = with_segments(events.unionByName(rows), [key], ts)
    run = segmented_running(both, [key], "_seg", [ts, "_kind", "_n"], "_change", "sum", "_gross")
    return run.where("_kind = 1").select(key, ts, F.col("_n").alias(seq), F.try_divide(F.col("_gross"), F.col(value)).alias("leverage"))
