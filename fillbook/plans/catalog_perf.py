"""Queries for the performance reports over fx_equity / fx_ledger."""

from __future__ import annotations

from pyspark.sql import functions as F

from fillbook.operators import perf as P
from fillbook.plans.catalog_rules import ENTRY, EXIT, _trips, ind_sql, pos_sql
from fillbook.plans.catalog_trades import _trades, trades_with
from fillbook.plans.fixture_sql import fx
from fillbook.plans.registry import register
from fillbook.sources import fixtures as X

CALMAR_WINDOW = 7


def _equity(spark, sf):
    return X.fx_equity(spark, sf)


def _ledger(spark, sf):
    return X.fx_ledger(spark, sf).withColumnRenamed("pnl_cents", "pnl")


def _won():
    return F.col("pnl") >= 0  # a zero-pnl trade counts as won
LEDGER_ORDER = ["closed_on", "side", "bars", "pnl"]

DD_SQL = """dd AS (
  select series, ts, seq, value, pk,
    pk - value as moneydown, 100.0 * (pk - value) / nullif(pk, 0) as drawdown,
    pos - max(case when value >= pk then pos end) over (partition by series order by ts, seq
      rows between unbounded preceding and current row) as len, pos
  from (select *, max(value) over (partition by series order by ts, seq
      rows between unbounded preceding and current row) as pk,
    row_number() over (partition by series order by ts, seq) as pos from fx_equity))"""


@register("perf_drawdown", f"""WITH {fx("fx_equity")}, {DD_SQL}
select series, arg_max(len, pos) as len, arg_max(drawdown, pos) as drawdown,
  arg_max(moneydown, pos) as moneydown, max(len) as max_len, max(drawdown) as max_drawdown,
  max(moneydown) as max_moneydown
from dd group by series""")
def q_perf_drawdown(spark, sf):
    return P.drawdown_report(_equity(spark, sf))


ENDS_SQL = """ends AS (select series, cast(ts as date) as period, arg_max(value, (ts, seq)) as end_value,
    arg_min(value, (ts, seq)) as first_value from fx_equity group by all),
rets AS (select series, period, end_value,
    end_value / nullif(coalesce(lag(end_value) over (partition by series order by period), first_value), 0) - 1 as ret
  from ends)"""


@register("perf_time_return", f"""WITH {fx("fx_equity")}, {ENDS_SQL}
select series, period, ret from rets""")
def q_perf_time_return(spark, sf):
    return P.period_returns(_equity(spark, sf), F.to_date("ts")).select("series", "period", "ret")


@register("perf_annual_return", f"""WITH {fx("fx_equity")},
ends AS (select series, year(ts) as period, arg_max(value, (ts, seq)) as end_value,
    arg_min(value, (ts, seq)) as first_value from fx_equity group by all)
select series, period, end_value / nullif(coalesce(lag(end_value) over (partition by series order by period),
  first_value), 0) - 1 as ret from ends""")
def q_perf_annual_return(spark, sf):
    return P.period_returns(_equity(spark, sf), F.year("ts").cast("bigint")).select("series", "period", "ret")


@register("perf_period_stats", f"""WITH {fx("fx_equity")}, {ENDS_SQL}
select series, round(avg(ret), 6) as average, round(stddev_samp(ret), 6) as stddev,
  count(*) filter (where ret > 0) as positive, count(*) filter (where ret < 0) as negative,
  count(*) filter (where ret = 0) as nzero, max(ret) as best, min(ret) as worst
from rets group by series""")
def q_perf_period_stats(spark, sf):
    s = P.period_stats(P.period_returns(_equity(spark, sf), F.to_date("ts")))
    return s.withColumn("average", F.round("average", 6)).withColumn("stddev", F.round("stddev", 6))


@register("perf_sharpe", f"""WITH {fx("fx_equity")}, {ENDS_SQL}
select series, round(avg(ret - 0.0) / nullif(stddev_samp(ret), 0), 6) as sharpe from rets group by series""")
def q_perf_sharpe(spark, sf):
    s = P.sharpe(P.period_returns(_equity(spark, sf), F.to_date("ts")))
    return s.withColumn("sharpe", F.round("sharpe", 6))


@register("perf_calmar", f"""WITH {fx("fx_equity")}, {ENDS_SQL},
e AS (select *, row_number() over (partition by series order by period) as i,
      lag(end_value, {CALMAR_WINDOW}) over (partition by series order by period) as start_value from ends),
mdd AS (select a.series, a.period, max((p.end_value - q.end_value) / nullif(p.end_value, 0)) as mdd
  from e a join e p on p.series = a.series and p.i between a.i - {CALMAR_WINDOW} and a.i
           join e q on q.series = a.series and q.i between p.i and a.i
  group by a.series, a.period)
select e.series, e.period,
  case when mdd.mdd > 0 then (e.end_value / nullif(e.start_value, 0) - 1) / mdd.mdd end as calmar
from e join mdd using (series, period)""")
def q_perf_calmar(spark, sf):
    ends = P.period_ends(_equity(spark, sf), F.to_date("ts"))
    return P.calmar(ends, CALMAR_WINDOW)


@register("perf_vwr", f"""WITH {fx("fx_equity")}, {ENDS_SQL},
e AS (select *, row_number() over (partition by series order by period) - 1 as i from ends),
n AS (select series, max(i) as n, arg_max(end_value, i) as vn, arg_min(end_value, i) as v0 from e group by series),
r AS (select n.*, ln(vn / nullif(v0, 0)) / nullif(n, 0) as ravg from n),
g AS (select e.series, any_value(r.ravg) as ravg,
    stddev_pop(e.end_value / nullif(r.v0 * exp(r.ravg * e.i), 0) - 1) as sdev from e join r using (series) group by e.series)
select series, round((exp(ravg * 252) - 1) * 100 * (1 - pow(sdev / 0.2, 2.0)), 6) as vwr from g""")
def q_perf_vwr(spark, sf):
    ends = P.period_ends(_equity(spark, sf), F.to_date("ts"))
    return P.vwr(ends).withColumn("vwr", F.round("vwr", 6))


LEDGER_SQL = """led AS (select series, closed_on, side, bars, pnl_cents as pnl, pnl_cents >= 0 as won from fx_ledger)"""


@register("perf_sqn", f"""WITH {fx("fx_ledger")}, {LEDGER_SQL}
select series, round(sqrt(count(pnl)) * avg(pnl) / nullif(stddev_samp(pnl), 0), 6) as sqn, count(pnl) as trades
from led group by series""")
def q_perf_sqn(spark, sf):
    return P.sqn(_ledger(spark, sf)).withColumn("sqn", F.round("sqn", 6))


@register("perf_streaks", f"""WITH {fx("fx_ledger")}, {LEDGER_SQL},
o AS (select *, row_number() over (partition by series order by closed_on, side, bars, pnl) as rn,
        row_number() over (partition by series, won order by closed_on, side, bars, pnl) as rnw from led),
isl AS (select series, won, rn - rnw as island, count(*) as len, max(rn) as last from o group by all)
select series,
  coalesce(max(case when won then len end), 0) as won_longest,
  coalesce(max(case when not won then len end), 0) as lost_longest,
  arg_max(case when won then len else 0 end, last) as won_current,
  arg_max(case when not won then len else 0 end, last) as lost_current
from isl group by series""")
def q_perf_streaks(spark, sf):
    return P.streaks(_ledger(spark, sf), "series", LEDGER_ORDER, _won())


def _pnl_sql() -> str:
    conds = [("long", "side = 'long'"), ("short", "side = 'short'"), ("won", "won"), ("lost", "not won"),
             ("long_won", "side = 'long' and won"), ("long_lost", "side = 'long' and not won"),
             ("short_won", "side = 'short' and won"), ("short_lost", "side = 'short' and not won")]
    cols = ", ".join(f"cast(sum(case when {c} then pnl end) as bigint) as {n}_total, "
                     f"round(avg(case when {c} then pnl end), 6) as {n}_average" for n, c in conds)
    return f"""WITH {fx("fx_ledger")}, {LEDGER_SQL}
select series, cast(sum(pnl) as bigint) as gross_total, round(avg(pnl), 6) as gross_average,
  cast(sum(pnl - 0) as bigint) as net_total, round(avg(pnl - 0), 6) as net_average, {cols}
from led group by series"""


@register("perf_pnl", _pnl_sql())
def q_perf_pnl(spark, sf):
    r = P.pnl_report(_ledger(spark, sf), "series", "pnl", "side", _won())
    return r.select(*[F.round(c, 6).alias(c) if c.endswith("_average") else F.col(c) for c in r.columns])


@register("perf_win_counts", f"""WITH {fx("fx_ledger")}, {LEDGER_SQL}
select series, g.side, count(*) filter (where g.side = 'all' or led.side = g.side) as total,
  count(*) filter (where won and (g.side = 'all' or led.side = g.side)) as won,
  count(*) filter (where not won and (g.side = 'all' or led.side = g.side)) as lost
from led, (values ('long'), ('short'), ('all')) g(side) where series is not null group by series, g.side""")
def q_perf_win_counts(spark, sf):
    return P.win_counts(_ledger(spark, sf), "series", "side", _won())


@register("perf_trade_length", f"""WITH {fx("fx_ledger")}, {LEDGER_SQL},
l2 AS (select *, case when won then 'won' else 'lost' end as outcome from led),
l3 AS (select series, g.side, h.outcome, case when (g.side = 'all' or l2.side = g.side)
    and (h.outcome = 'all' or l2.outcome = h.outcome) then bars end as held
  from l2, (values ('long'), ('short'), ('all')) g(side), (values ('won'), ('lost'), ('all')) h(outcome))
select series, side, outcome, cast(coalesce(sum(held), 0) as bigint) as total, min(held) as min, max(held) as max,
  round(avg(held), 6) as average from l3 group by all""")
def q_perf_trade_length(spark, sf):
    return P.trade_length(_ledger(spark, sf), "series", "side", _won()).withColumn(
        "average", F.round("average", 6))


@register("perf_gross_leverage", f"""WITH {fx("fx_equity")},
x AS (select e.series, e.ts, e.seq, e.value, t.price, cast(round(t.usd_amount - 50) as bigint) as size from fx_equity e
      join fx_ticks t on t.market_id = e.series and t.seq = e.seq),
h AS (select *, coalesce(sum(size) over (partition by series order by seq), 0) as position from x)
select series, seq, ts, round(abs(position * price) / nullif(value, 0), 6) as leverage from h""")
def q_perf_gross_leverage(spark, sf):
    """Position held after each tick (a tick above 50 buys, one below sells) against the account's value."""
    t = X.fx_ticks(spark, sf).select(F.col("market_id").alias("series"), "seq", "price",
                                     F.round(F.col("usd_amount") - 50).cast("bigint").alias("size"),
                                     F.floor(F.col("seq") / X.SEGMENT_ROWS).alias("_seg"))
    x = _equity(spark, sf).join(t, ["series", "seq"])
    r = P.gross_leverage(x, ["series"], "_seg", ["seq"], "size", "price", "value")
    return r.select("series", "seq", "ts", F.round("leverage", 6).alias("leverage"))


@register("perf_portfolio_leverage", f"""WITH {fx("fx_equity")},
x AS (select market_id as series, event_type as instrument, timestamp as ts, seq, price,
        cast(sum(cast(round(usd_amount - 50) as bigint)) over (partition by market_id, event_type order by timestamp, seq) as double) as held
      from fx_ticks),
i AS (select distinct series, instrument from x),
g AS (select e.series, e.ts, e.seq, e.value, i.instrument from fx_equity e join i using (series)),
l AS (select g.series, g.ts, g.seq, g.value, abs(x.held * x.price) as exposure
      from g asof left join (select series, instrument, ts, arg_max(held, seq) as held, arg_max(price, seq) as price from x group by all) x
      on g.series = x.series and g.instrument = x.instrument and g.ts >= x.ts)
select series, seq, ts, round(sum(coalesce(exposure, 0)) / nullif(any_value(value), 0), 6) as leverage from l group by series, seq, ts""")
def q_perf_portfolio_leverage(spark, sf):
    """Five instruments a series (one per kind of event), each with a clock of its own."""
    t = X.fx_ticks(spark, sf).select(F.col("market_id").alias("series"), F.col("event_type").alias("instrument"), F.col("timestamp").alias("ts"), "seq", "price",
                                     F.round(F.col("usd_amount") - 50).cast("bigint").alias("size"))
    r = P.portfolio_leverage(_equity(spark, sf), t)
    return r.select("series", "seq", "ts", F.round("leverage", 6).alias("leverage"))


@register("perf_transactions", f"""WITH {trades_with()}
select maker as account, timestamp as ts, market_id as instrument,
  case when maker_direction = 'BUY' then token_amount else -token_amount end as size, price,
  -(case when maker_direction = 'BUY' then token_amount else -token_amount end) * price as total
from t""")
def q_perf_transactions(spark, sf):
    """Every fill as a transaction of the maker account (all rows kept)."""
    t = _trades(spark, sf)
    size = F.when(F.col("maker_direction") == "BUY", F.col("token_amount")).otherwise(-F.col("token_amount"))
    return t.select(F.col("maker").alias("account"), F.col("timestamp").alias("ts"),
                    F.col("market_id").alias("instrument"), size.alias("size"), "price",
                    (-size * F.col("price")).alias("total"))


@register("perf_trade_counts", f"""WITH RECURSIVE {fx("fx_ticks")}, {ind_sql()}, {pos_sql(ENTRY, EXIT)}
select market_id, count(*) as total, count(*) filter (where is_open) as open,
  count(*) filter (where not is_open) as closed from trips group by market_id""")
def q_perf_trade_counts(spark, sf):
    t = _trips(spark, sf)
    return t.groupBy("market_id").agg(F.count(F.lit(1)).alias("total"),
                                      F.count_if("is_open").alias("open"),
                                      F.count_if(~F.col("is_open")).alias("closed"))


# --- report registry ---------------------------------------------------------

from fillbook.operators.reports import register_report, report  # noqa: E402


@register_report("TradeCounts")
def _trade_counts_report(r):
    """Custom layout: one row per series and counter."""
    return r.select("series", F.explode(F.map_from_arrays(
        F.array(F.lit("total"), F.lit("won"), F.lit("lost")),
        F.array(F.col("total").cast("string"), F.col("won").cast("string"),
                F.col("lost").cast("string")))).alias("path", "value"))


@register("custom_report", f"""WITH {fx("fx_equity")}, {DD_SQL},
dr AS (select series, arg_max(len, pos) as len, max(len) as max_len,
         cast(round(max(moneydown) * 100) as bigint) as max_cents from dd group by series)
select 'DrawDown' as report, series, 'len' as path, cast(len as varchar) as value from dr
union all select 'DrawDown', series, 'max - len', cast(max_len as varchar) from dr
union all select 'DrawDown', series, 'max - moneydown_cents', cast(max_cents as varchar) from dr
union all
select 'TradeCounts', series, x.path, x.value from (
  select series, count(*) as total, count(*) filter (where pnl_cents >= 0) as won,
    count(*) filter (where pnl_cents < 0) as lost from ({fx("fx_ledger").split(" AS (", 1)[1][:-1]})
  group by series) c,
  lateral (select 'total' as path, cast(c.total as varchar) as value union all
           select 'won', cast(c.won as varchar) union all select 'lost', cast(c.lost as varchar)) x""")
def q_custom_report(spark, sf):
    """Generic nested layout for the drawdown analyzer, a registered custom
    layout for trade counts."""
    dd = P.drawdown_report(_equity(spark, sf))
    nested = dd.select("series", "len", F.struct(
        F.col("max_len").alias("len"),
        F.round(F.col("max_moneydown") * 100).cast("bigint").alias("moneydown_cents")).alias("max"))
    counts = _ledger(spark, sf).groupBy("series").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(_won()).alias("won"),
        F.count_if(~_won()).alias("lost"))
    return report("DrawDown", nested, ["series"]).unionByName(report("TradeCounts", counts, ["series"]))
