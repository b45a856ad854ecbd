"""Entry/exit rules over bars: signals, positions, round trips, equity.

A rule is a pair of boolean Columns (entry, exit) evaluated per bar. The
position follows the usual long-only event loop: when flat, enter on an entry
signal; when long, leave on an exit signal. Orders fill at the next bar's
open. Everything is window algebra on segments of a market's bars: no market
is one task, and no Python loop.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fillbook.operators.indicators import SEG, rsi, segmented, sma
from fillbook.operators.scan import WHOLE, Segments, segmented_running
from fillbook.session import materialize

START_CASH = 10000.0
INVEST_FRACTION = 0.97


@dataclass
class Rule:
    """User rule: entry and exit conditions plus a name and parameters."""
    entry: Column
    exit: Column
    name: str = "rule"
    params: dict = field(default_factory=dict)


def signals(rule: Rule, ready: Column | None = None) -> tuple[Column, Column]:
    """Entry and exit flags; null conditions and bars before every indicator is
    defined (``ready``) count as no signal."""
    gate = ready if ready is not None else F.lit(True)
    return F.coalesce(gate & rule.entry, F.lit(False)), F.coalesce(gate & rule.exit, F.lit(False))


def signal_flags(bars: DataFrame, rule: Rule, ready: Column | None = None) -> DataFrame:
    """``bars`` with the flags of a rule, ``entry`` and ``exit``."""
    return bars.withColumns(dict(zip(("entry", "exit"), signals(rule, ready), strict=True)))


def position_state(sig: DataFrame, keys: list[str], order: str = "bar_start", open_col: str = "open") -> DataFrame:
    """Position after each bar's decision (``pos``: 0 flat, 1 long) and the
    position the bar saw (``pos_before``); also what trades are made of: the
    bar's number ``bar_no`` (from 1), the next bar's start and open ``next_ts``
    and ``next_open`` (if there is an ``open_col``), and ``trade_no``, the
    number of filled entries up to here."""
    return positions(sig, keys, {"": ("entry", "exit")}, order, open_col)


def positions(sig: DataFrame, keys: list[str], rules: dict[str, tuple[str, str]], order: str = "bar_start",
              open_col: str = "open") -> DataFrame:
    """``position_state`` of several rules in one pass: ``rules`` maps a suffix of
    ``pos``, ``pos_before`` and ``trade_no`` to the names of two boolean columns.

    Per bar: entry only sets long, exit only sets flat, both toggle (flat ->
    enter, long -> leave), neither keeps. A run of bars is therefore a map of
    {flat, long} to itself: the value of its last "set" bar, if there is one
    (else the state that entered), plus the toggles since, mod 2. Inside a
    segment windows give that map up to each bar; the maps of whole segments,
    one row each, compose to the state that enters each segment.
    """
    d = segmented(sig, keys, order)
    if not d.schema[SEG].metadata.get(WHOLE):
        d = materialize(d, "signals")  # read twice: for the segments' maps, and for the rows
    s = Segments(d, keys, SEG, [order])
    has_open = open_col in d.columns
    last = lambda c, w: F.last(c, ignorenulls=True).over(w)
    flag = lambda c: F.coalesce(F.col(c), F.lit(False))
    both = [(x, i) for x in rules for i in ((0,) if s.whole else (0, 1))]  # a rule, and the state that enters the segment

    def windows(base: str, turn: str, running) -> dict[str, Column]:
        """Turns in all and at the last set row (a second window), of ``base`` (or null) and ``turn``."""
        return {f"_all{x}": F.sum(f"{turn}{x}").over(running) for x in rules} | {f"_held{x}": last(f"{base}{x}", running) for x in rules}

    def state(x: str, start: Column) -> Column:
        return ((F.coalesce(f"_held{x}", start) + F.col(f"_all{x}") - F.coalesce(f"_then{x}", F.lit(0))) % 2).cast("int")

    first = {"_pos": F.row_number().over(s.window), "_next_ts": F.lead(order).over(s.window)}
    if has_open:
        first["_next_open"] = F.lead(open_col).over(s.window)
    s.with_columns(**{f"_base{x}": F.when(flag(e) != flag(q), flag(e).cast("int")) for x, (e, q) in rules.items()},
                   **{f"_turn{x}": (flag(e) & flag(q)).cast("int") for x, (e, q) in rules.items()})
    s.with_columns(**first, **windows("_base", "_turn", s.running))
    s.with_columns(**{f"_then{x}": last(F.when(F.col(f"_base{x}").isNotNull(), F.col(f"_all{x}")), s.running) for x in rules})
    s.with_columns(**{f"_state{i}{x}": state(x, F.lit(i)) for x, i in both})
    s.with_columns(**{f"_saw{i}{x}": F.lag(f"_state{i}{x}", 1, i).over(s.window) for x, i in both})
    s.with_columns(**{f"_enter{i}{x}": ((F.col(f"_saw{i}{x}") == 0) & (F.col(f"_state{i}{x}") == 1)).cast("long") for x, i in both})
    # Filled entries; only the segment's last bar needs the next segment to know whether it is filled.
    fills = F.col("_next_open" if has_open else "_next_ts").isNotNull()
    s.with_columns(**{f"_made{i}{x}": F.sum(F.when(fills, F.col(f"_enter{i}{x}")).otherwise(0)).over(s.running) for x, i in both})

    edge_fills = F.col("_edge_open" if has_open else "_edge_ts").isNotNull()

    def pick(n: str, x: str) -> Column:
        return F.when(F.col(f"_start{x}") == 0, F.col(f"_{n}0{x}")).otherwise(F.col(f"_{n}1{x}"))

    def table() -> DataFrame:
        ends = s.summary(F.max("_pos").alias("_n"), F.min(order).alias("_ts"), *([F.min_by(open_col, "_pos").alias("_first_open")] if has_open else []),
                         *[F.max_by(f"_{n}{i}{x}", "_pos").alias(f"_{n}{i}{x}") for x, i in both for n in ("state", "made", "enter")])
        # A segment's map as a bar: it sets (both states lead to one) or turns (they change places).
        ends = ends.select("*", *[F.when(F.col(f"_state0{x}") == F.col(f"_state1{x}"), F.col(f"_state0{x}")).alias(f"_base{x}") for x in rules],
                           *[((F.col(f"_state0{x}") == 1) & (F.col(f"_state1{x}") == 0)).cast("int").alias(f"_turn{x}") for x in rules],
                           F.lead("_ts").over(s.key).alias("_edge_ts"), *([F.lead("_first_open").over(s.key).alias("_edge_open")] if has_open else []),
                           F.coalesce(F.sum("_n").over(s.before), F.lit(0)).alias("_bars"))
        ends = ends.select("*", *[c.alias(n) for n, c in windows("_base", "_turn", s.upto).items()])
        ends = ends.select("*", *[last(F.when(F.col(f"_base{x}").isNotNull(), F.col(f"_all{x}")), s.upto).alias(f"_then{x}") for x in rules])
        ends = ends.select("*", *[F.lag(state(x, F.lit(0)), 1, 0).over(s.key).alias(f"_start{x}") for x in rules])
        return ends.select("_gk", SEG, F.col("_n").alias("_bars_in"), "_bars", "_edge_ts", *(["_edge_open"] if has_open else []), *[f"_start{x}" for x in rules],
                           *[F.coalesce(F.sum(pick("made", x) + F.when(edge_fills, pick("enter", x)).otherwise(0)).over(s.before), F.lit(0)).alias(f"_trades{x}")
                             for x in rules])

    if s.whole:
        return s.rows.select(*sig.columns, F.col("_pos").cast("long").alias("bar_no"), F.col("_next_ts").alias("next_ts"),
                             *([F.col("_next_open").alias("next_open")] if has_open else []),
                             *[F.col(f"_{n}0{x}").alias(f"{name}{x}") for x in rules for n, name in (("saw", "pos_before"), ("state", "pos"), ("made", "trade_no"))])
    rows = s.rows.join(table(), ["_gk", SEG], "left")
    at_edge = F.col("_pos") == F.col("_bars_in")
    out = [(F.col("_bars") + F.col("_pos")).alias("bar_no"), F.when(at_edge, F.col("_edge_ts")).otherwise(F.col("_next_ts")).alias("next_ts")]
    if has_open:
        out.append(F.when(at_edge, F.col("_edge_open")).otherwise(F.col("_next_open")).alias("next_open"))
    for x in rules:
        out += [pick("saw", x).alias(f"pos_before{x}"), pick("state", x).alias(f"pos{x}"),
                (F.col(f"_trades{x}") + pick("made", x) + F.when(at_edge & edge_fills, pick("enter", x)).otherwise(0)).alias(f"trade_no{x}")]
    return rows.select(*sig.columns, *out)


def round_trips(pos: DataFrame, keys: list[str], order: str = "bar_start", close_col: str = "close") -> DataFrame:
    """One row per trade: entry/exit signal bars, fills at the next bar's open,
    bars held, return, and the compounding factor of the 97 %-invested rule.

    ``pos`` comes from ``position_state`` (with opens). A signal on the last bar
    never fills. A trade without a filled exit is reported open (exit fields null).
    """
    enter = (F.col("pos_before") == 0) & (F.col("pos") == 1) & F.col("next_open").isNotNull()
    leave = (F.col("pos_before") == 1) & (F.col("pos") == 0)
    d = pos.withColumn("_enter", enter).withColumn("_leave", leave)
    ev = d.where((F.col("trade_no") > 0) & (F.col("_enter") | F.col("_leave")))
    ent = F.when(F.col("_enter"), F.struct(F.col(order).alias("sig_ts"), F.col("bar_no").alias("n"), F.col("next_ts").alias("ts"),
                                           F.col("next_open").alias("px"), F.col(close_col).alias("sig_close")))
    ext = F.when(F.col("_leave") & F.col("next_open").isNotNull(),
                 F.struct(F.col(order).alias("sig_ts"), F.col("bar_no").alias("n"), F.col("next_ts").alias("ts"), F.col("next_open").alias("px")))
    g = ev.groupBy(*keys, "trade_no").agg(F.max(ent).alias("e"), F.max(ext).alias("x"))
    # Zero prices give null (not an error, not inf). An entry whose signal
    # close is 0 cannot be sized (size = cash / 0): such a closed trade
    # leaves the account unchanged (factor 1); open trades have no factor.
    ret = F.try_divide(F.col("x.px"), F.col("e.px")) - 1
    sized = 1 + F.try_divide(F.lit(INVEST_FRACTION) * (F.col("x.px") - F.col("e.px")),
                             F.col("e.sig_close"))
    factor = F.when(F.col("x").isNotNull(), F.coalesce(sized, F.lit(1.0)))
    return g.select(
        *keys, "trade_no",
        F.col("e.sig_ts").alias("entry_signal_ts"), F.col("e.ts").alias("entry_ts"),
        F.col("e.px").alias("entry_price"),
        F.col("x.sig_ts").alias("exit_signal_ts"), F.col("x.ts").alias("exit_ts"),
        F.col("x.px").alias("exit_price"),
        (F.col("x.n") - F.col("e.n")).cast("bigint").alias("bars_held"),
        ret.alias("ret"), factor.alias("factor"),
        F.col("x").isNull().alias("is_open"))


#: Closed trades of a key that are multiplied up in one task.
TRADES_PER_SEGMENT = 1 << 16


def valued_trips(trips: DataFrame, keys: list[str], start: float = START_CASH) -> DataFrame:
    """Closed trades with ``value``, the account after each: running product of
    the trades' compounding factors (in trade order, no log/exp round trip) times
    the start value (cash cancels out of the sizing rule)."""
    closed = trips.where(~F.col("is_open")).withColumn(SEG, F.floor((F.col("trade_no") - 1) / TRADES_PER_SEGMENT))
    run = segmented_running(closed, keys, SEG, ["trade_no"], "factor", "product", "growth")
    return run.withColumn("value", F.col("growth") * F.lit(start)).drop(SEG, "growth")


def rule_equity(trips: DataFrame, keys: list[str], start: float = START_CASH) -> DataFrame:
    """Account value after each closed trade."""
    return valued_trips(trips, keys, start).select(*keys, "trade_no", "exit_ts", "value")


@dataclass
class UserMetric:
    """A metric as a Python function: ``fn`` gets the named columns of one key's
    closed trades, in trade order, as pandas Series, and returns a number."""
    fn: Callable[..., float]
    columns: tuple[str, ...]
    dtype: str = "double"

    def column(self) -> Column:
        fn, dtype, n = self.fn, self.dtype, len(self.columns)

        def run(*cols):
            order = cols[0].sort_values(kind="stable").index
            return fn(*[c.loc[order] for c in cols[1:]])
        return F.pandas_udf(run, dtype, F.PandasUDFType.GROUPED_AGG)("trade_no", *self.columns[:n])


def final_equity(equity: DataFrame, keys: list[str], metrics: dict[str, Column | UserMetric] | None = None) -> DataFrame:
    """Last account value per key (after its last closed trade), with any
    ``metrics`` over the trades' columns: aggregate Columns, or ``UserMetric``
    functions, which see one key's trades at a time in a Python task."""
    metrics = metrics or {}
    plain = {n: m for n, m in metrics.items() if isinstance(m, Column)}
    own = {n: m for n, m in metrics.items() if n not in plain}
    out = equity.groupBy(*keys).agg(F.max_by("value", "trade_no").alias("final_value"), F.count(F.lit(1)).alias("n_closed"),
                                    *[expr.alias(name) for name, expr in plain.items()])
    if own:  # Spark does not mix these with built-in aggregates in one step
        out = out.join(equity.groupBy(*keys).agg(*[m.column().alias(n) for n, m in own.items()]), keys, "left")
    return out


def leaderboard(results: DataFrame, sort_col: str, n: int, ascending: bool = False,
                tie_breakers: list[str] | None = None) -> DataFrame:
    """Top ``n`` rows by ``sort_col`` (then the tie-breakers, ascending):
    ``orderBy().limit()`` plans as a per-task top-k plus one final merge."""
    key = F.col(sort_col).asc_nulls_last() if ascending else F.col(sort_col).desc_nulls_last()
    return results.orderBy(key, *(tie_breakers or [])).limit(n)


def rsi_sma_sweep(bars: DataFrame, grid: list[tuple[int, float, int]], keys: list[str] | None = None,
                  order: str = "bar_start", changes_only: bool = False) -> DataFrame:
    """Positions of the RSI-entry / SMA-exit rule for every parameter set
    ``(rsi_period, entry_below, sma_bars)`` over every market.

    Indicators are computed once per distinct period, and the positions of all
    parameter sets in one pass over the bars: each set is a few more columns of
    the same windows and segment summaries. Only then each bar becomes one row
    per set (a fixed literal grid, not a join). Output: bars + ``param_id, rp,
    lo, sma_n, entry, exit`` and the columns of ``position_state``; with
    ``changes_only`` the bars whose decision changes the position, which are all
    that trades are made of.
    """
    keys = keys or ["market_id"]
    b = segmented(bars, keys, order)
    b = sma(b, sorted({n for _, _, n in grid}), key=keys[0], order=order)
    b = rsi(b, sorted({rp for rp, _, _ in grid}), key=keys[0], order=order)
    flags, rules = {}, {}
    for i, (rp, lo, n) in enumerate(grid):
        ready = F.col(f"rsi_{rp}").isNotNull() & F.col(f"sma_{n}").isNotNull()
        rules[f"_{i}"] = (f"entry_{i}", f"exit_{i}")
        flags |= dict(zip(rules[f"_{i}"], signals(Rule(entry=F.col(f"rsi_{rp}") < F.lit(lo), exit=F.col("close") > F.col(f"sma_{n}")), ready), strict=True))
    b = b.withColumns(flags)
    p = positions(b, keys, rules, order)
    sets = F.array(*[F.struct(F.lit(i).alias("param_id"), F.lit(rp).alias("rp"), F.lit(lo).alias("lo"), F.lit(n).alias("sma_n"),
                              *[F.col(f"{c}_{i}").alias(c) for c in ("entry", "exit", "pos_before", "pos", "trade_no")])
                     for i, (rp, lo, n) in enumerate(grid)])
    kept = [c for c in p.columns if c in bars.columns or c.startswith(("rsi_", "sma_")) or c in ("bar_no", "next_ts", "next_open")]
    if changes_only:
        sets = F.filter(sets, lambda x: x["pos"] != x["pos_before"])
    return p.select(*kept, F.explode(sets).alias("_p")).select(*kept, "_p.*")


def sweep_sets(bars: DataFrame, grid: list[tuple[int, float, int]], keys: list[str] | None = None) -> DataFrame:
    """Every market with every parameter set."""
    sets = F.array(*[F.struct(F.lit(i).alias("param_id"), F.lit(rp).alias("rp"), F.lit(lo).alias("lo"), F.lit(n).alias("sma_n"))
                     for i, (rp, lo, n) in enumerate(grid)])
    return bars.select(*(keys or ["market_id"])).distinct().select("*", F.explode(sets).alias("_p")).select(*(keys or ["market_id"]), "_p.*")


def sweep_board(pos: DataFrame, keys: list[str], params: list[str], metrics: dict | None = None, sets: DataFrame | None = None) -> DataFrame:
    """One row per (market, parameter set): closed trades, final value and any
    user metrics (aggregate Columns over the closed round trips). ``sets``: all
    markets and parameter sets, where ``pos`` holds changes only."""
    fin = final_equity(valued_trips(round_trips(pos, keys), keys), keys, metrics)
    board = (pos if sets is None else sets).select(*keys, *params).distinct().join(fin, keys, "left")
    return board.select(*keys, *params,
                        F.coalesce("n_closed", F.lit(0)).cast("bigint").alias("n_closed"),
                        F.coalesce("final_value", F.lit(START_CASH)).alias("final_value"),
                        *[F.col(n) for n in (metrics or {})])
