"""Queries for indicators, the trading rule, sweeps and leaderboards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fillbook.operators import indicators as I
from fillbook.operators import rules as R
from fillbook.operators.bars import threshold_clip
from fillbook.plans.catalog_series import BARS_SQL, _bars
from fillbook.plans.fixture_sql import fx
from fillbook.plans.registry import register

# Fixed values of the notebook rule: RSI period 2, entry below 15, exit when
# the close rises above the 5-bar SMA.
RSI_PERIOD, RSI_LOW, SMA_EXIT = 2, 15, 5
SWEEP = [(rp, lo, ex) for rp in (2, 3) for lo in (15, 25) for ex in (5, 10)]
TOP_N = 10


def _indicators(spark, sf) -> DataFrame:
    # Segments once: the indicators and the rule hand them on, and with them
    # the partitioning by (market, segment).
    b = I.segmented(_bars(spark, sf), ["market_id"], "bar_start")
    return I.rsi(I.sma(b, SMA_EXIT), RSI_PERIOD)


def _rule() -> R.Rule:
    return R.Rule(entry=F.col("rsi_2") < RSI_LOW, exit=F.col("close") > F.col("sma_5"),
                  name="rsi2", params={"rp": RSI_PERIOD, "lo": RSI_LOW, "exit": SMA_EXIT})


def _signals(spark, sf, rule=None) -> DataFrame:
    ready = F.col("rsi_2").isNotNull() & F.col("sma_5").isNotNull()
    return R.signal_flags(_indicators(spark, sf), rule or _rule(), ready)


def _positions(spark, sf, rule=None) -> DataFrame:
    return R.position_state(_signals(spark, sf, rule), ["market_id"])


def _trips(spark, sf, rule=None) -> DataFrame:
    return R.round_trips(_positions(spark, sf, rule), ["market_id"])


# --- DuckDB: indicators, recursive RSI and the state machine -----------------

def ind_sql(periods=(RSI_PERIOD,), smas=(SMA_EXIT,)) -> str:
    sma_cols = ", ".join(
        f"case when count(close) over (partition by market_id order by rn rows between {n - 1} preceding "
        f"and current row) = {n} then avg(close) over (partition by market_id order by rn rows between "
        f"{n - 1} preceding and current row) end as sma_{n}" for n in smas)
    seeds = " union all ".join(
        f"select market_id, {p} as rp, {p} as rn, sum(up) / {p} as au, sum(dn) / {p} as ad from ud "
        f"where rn <= {p} group by market_id having count(*) = {p}" for p in periods)
    rsi_cols = ", ".join(f"max(case when r.rp = {p} then r.rsi end) as rsi_{p}" for p in periods)
    return f"""{BARS_SQL},
b AS (select *, row_number() over (partition by market_id order by bar_start) - 1 as rn from bars),
sm AS (select *, {sma_cols} from b),
mv AS (select market_id, rn, close - lag(close) over (partition by market_id order by rn) as delta from b),
ud AS (select market_id, rn, case when delta > 0 then delta else 0.0 end as up,
         case when delta < 0 then -delta else 0.0 end as dn from mv where rn >= 1),
rec(market_id, rp, rn, au, ad) AS (
  {seeds}
  union all
  select r.market_id, r.rp, r.rn + 1, (r.au * (r.rp - 1) + u.up) / r.rp, (r.ad * (r.rp - 1) + u.dn) / r.rp
  from rec r join ud u on u.market_id = r.market_id and u.rn = r.rn + 1),
rs AS (select market_id, rp, rn, case when ad = 0 then (case when au = 0 then 50.0 else 100.0 end)
         else 100.0 - 100.0 / (1.0 + au / ad) end as rsi from rec),
ind AS (select sm.*, {rsi_cols} from sm left join rs r on r.market_id = sm.market_id and r.rn = sm.rn
        group by all)"""


def pos_sql(entry: str, exit_: str, src: str = "ind", keys: str = "market_id") -> str:
    """Signals + recursive state machine + fills at the next open + trips."""
    kjoin = " and ".join(f"s.{k.strip()} = p.{k.strip()}" for k in keys.split(","))
    return f"""sig AS (select *, coalesce(({entry}), false) as entry, coalesce(({exit_}), false) as exit_ from {src}),
ps AS (
  select {keys}, rn, case when entry then 1 else 0 end as pos from sig where rn = 0
  union all
  select {", ".join("s." + k.strip() for k in keys.split(","))}, s.rn,
    case when p.pos = 0 then (case when s.entry then 1 else 0 end) else (case when s.exit_ then 0 else 1 end) end
  from ps p join sig s on {kjoin} and s.rn = p.rn + 1),
pp AS (select sig.*, ps.pos, coalesce(lag(ps.pos) over w, 0) as pos_before,
         lead(open) over w as next_open, lead(bar_start) over w as next_ts
       from sig join ps using ({keys}, rn) window w as (partition by {keys} order by rn)),
ev AS (select *, pos_before = 0 and pos = 1 and next_open is not null as enter_,
         pos_before = 1 and pos = 0 as leave_ from pp),
tn AS (select *, cast(sum(case when enter_ then 1 else 0 end) over (partition by {keys} order by rn) as bigint)
        as trade_no from ev),
tr AS (select {keys}, trade_no,
    max(case when enter_ then bar_start end) as entry_signal_ts, max(case when enter_ then next_ts end) as entry_ts,
    max(case when enter_ then next_open end) as entry_price, max(case when enter_ then close end) as sig_close,
    max(case when enter_ then rn end) as en,
    max(case when leave_ and next_open is not null then bar_start end) as exit_signal_ts,
    max(case when leave_ and next_open is not null then next_ts end) as exit_ts,
    max(case when leave_ and next_open is not null then next_open end) as exit_price,
    max(case when leave_ and next_open is not null then rn end) as xn
  from tn where trade_no > 0 and (enter_ or leave_) group by {keys}, trade_no),
trips AS (select {keys}, trade_no, entry_signal_ts, entry_ts, entry_price, exit_signal_ts, exit_ts, exit_price,
    xn - en as bars_held, exit_price / nullif(entry_price, 0) - 1 as ret,
    case when exit_price is not null then coalesce(1 + 0.97 * (exit_price - entry_price) / nullif(sig_close, 0), 1.0)
    end as factor, exit_price is null as is_open from tr)"""


READY = "rsi_2 is not null and sma_5 is not null"
ENTRY = f"{READY} and rsi_2 < {RSI_LOW}"
EXIT = f"{READY} and close > sma_5"
def equity_sql(keys: str = "market_id") -> str:
    """Sequential running product of closed-trade factors (recursive CTE)."""
    kj = " and ".join(f"c.{k.strip()} = e.{k.strip()}" for k in keys.split(","))
    ck = ", ".join("c." + k.strip() for k in keys.split(","))
    return f"""closed AS (select * from trips where not is_open),
eqr AS (select {keys}, trade_no, exit_ts, factor as growth from closed where trade_no = 1
  union all
  select {ck}, c.trade_no, c.exit_ts, e.growth * c.factor from eqr e join closed c
  on {kj} and c.trade_no = e.trade_no + 1),
eq AS (select {keys}, trade_no, exit_ts, growth * 10000.0 as value from eqr)"""


EQUITY_SQL = equity_sql()


@register("ind_sma", f"""WITH RECURSIVE {fx("fx_ticks")}, {ind_sql()}
select market_id, bar_start, close, sma_5 from ind""")
def q_ind_sma(spark, sf):
    return I.sma(_bars(spark, sf), SMA_EXIT, out="sma_5").select("market_id", "bar_start", "close", "sma_5")


@register("ind_rsi", f"""WITH RECURSIVE {fx("fx_ticks")}, {ind_sql()}
select market_id, bar_start, rsi_2 from ind""")
def q_ind_rsi(spark, sf):
    return I.rsi(_bars(spark, sf), RSI_PERIOD).select("market_id", "bar_start", "rsi_2")


@register("threshold_clip", f"""WITH RECURSIVE {fx("fx_ticks")}, {ind_sql()}
select market_id, bar_start, case when rsi_2 > 70 then rsi_2 else 70 end as rsi_hi,
  case when close < sma_5 then close else sma_5 end as close_lo from ind""")
def q_threshold_clip(spark, sf):
    d = _indicators(spark, sf)
    return d.select("market_id", "bar_start",
                    threshold_clip("rsi_2", 70.0, ">").alias("rsi_hi"),
                    threshold_clip("close", "sma_5", "<").alias("close_lo"))


@register("signal_flags", f"""WITH RECURSIVE {fx("fx_ticks")}, {ind_sql()}
select market_id, bar_start, coalesce({ENTRY}, false) as entry, coalesce({EXIT}, false) as exit from ind""")
def q_signal_flags(spark, sf):
    return _signals(spark, sf).select("market_id", "bar_start", "entry", "exit")


@register("position_state", f"""WITH RECURSIVE {fx("fx_ticks")}, {ind_sql()}, {pos_sql(ENTRY, EXIT)}
select market_id, bar_start, pos_before, pos from pp""")
def q_position_state(spark, sf):
    return _positions(spark, sf).select("market_id", "bar_start", "pos_before", "pos")


TRIP_COLS = ("market_id, trade_no, entry_signal_ts, entry_ts, entry_price, exit_signal_ts, exit_ts, "
             "exit_price, bars_held, ret, factor, is_open")


@register("round_trips", f"""WITH RECURSIVE {fx("fx_ticks")}, {ind_sql()}, {pos_sql(ENTRY, EXIT)}
select {TRIP_COLS} from trips""")
def q_round_trips(spark, sf):
    return _trips(spark, sf)


@register("rule_equity", f"""WITH RECURSIVE {fx("fx_ticks")}, {ind_sql()}, {pos_sql(ENTRY, EXIT)}, {EQUITY_SQL}
select market_id, trade_no, exit_ts, value from eq""")
def q_rule_equity(spark, sf):
    return R.rule_equity(_trips(spark, sf), ["market_id"])


# --- user rule: a second strategy through the same machinery -----------------

@register("user_rule", f"""WITH RECURSIVE {fx("fx_ticks")}, {ind_sql()},
{pos_sql(f"{READY} and close < sma_5 * 0.9", f"{READY} and rsi_2 > 60")}
select market_id, bar_start, pos_before, pos from pp""")
def q_user_rule(spark, sf):
    rule = R.Rule(entry=F.col("close") < F.col("sma_5") * 0.9, exit=F.col("rsi_2") > 60,
                  name="dip", params={})
    return _positions(spark, sf, rule).select("market_id", "bar_start", "pos_before", "pos")


# --- parameter sweep and leaderboard -----------------------------------------

SWEEP_KEYS = "market_id, param_id, rp, lo, sma_n"


def sweep_sql() -> str:
    grid = " union all ".join(f"select {i} as param_id, {rp} as rp, {lo} as lo, {ex} as sma_n"
                              for i, (rp, lo, ex) in enumerate(SWEEP))
    periods = sorted({rp for rp, _, _ in SWEEP})
    smas = sorted({ex for _, _, ex in SWEEP})
    rsi_v = "case " + " ".join(f"when g.rp = {p} then rsi_{p}" for p in periods) + " end"
    sma_v = "case " + " ".join(f"when g.sma_n = {n} then sma_{n}" for n in smas) + " end"
    return f"""{fx("fx_ticks")}, {ind_sql(periods, smas)},
grid AS ({grid}),
sw AS (select ind.*, g.param_id, g.rp, g.lo, g.sma_n, {rsi_v} as rsi_v, {sma_v} as sma_v
       from ind, grid g),
{pos_sql("rsi_v is not null and sma_v is not null and rsi_v < lo",
         "rsi_v is not null and sma_v is not null and close > sma_v", "sw", "market_id, param_id")},
{equity_sql("market_id, param_id")},
res AS (select t.market_id, t.param_id,
    count(*) filter (where not is_open) as n_closed,
    avg(ret) filter (where not is_open) as avg_ret,
    avg(case when ret > 0 then 1.0 else 0.0 end) filter (where not is_open) as win_rate
  from trips t group by all),
fin AS (select market_id, param_id, arg_max(value, trade_no) as final_value from eq group by all),
board AS (select p.market_id, p.param_id, g.rp, g.lo, g.sma_n,
    coalesce(res.n_closed, 0) as n_closed, coalesce(fin.final_value, 10000.0) as final_value,
    round(res.avg_ret, 6) as avg_ret, round(res.win_rate, 6) as win_rate
  from (select distinct market_id, param_id from sw) p join grid g using (param_id)
  left join res using (market_id, param_id) left join fin using (market_id, param_id))"""


def _sweep_board(spark, sf, metrics=None) -> DataFrame:
    bars = I.segmented(_bars(spark, sf), ["market_id"], "bar_start")
    b = R.sweep_board(R.rsi_sma_sweep(bars, SWEEP, changes_only=True), ["market_id", "param_id"], ["rp", "lo", "sma_n"],
                      metrics, R.sweep_sets(bars, SWEEP))
    for n in metrics or {}:
        b = b.withColumn(n, F.round(n, 6))
    return b


@register("param_sweep", f"""WITH RECURSIVE {sweep_sql()}
select market_id, param_id, rp, lo, sma_n, n_closed, final_value from board""")
def q_param_sweep(spark, sf):
    return _sweep_board(spark, sf)


@register("leaderboard", f"""WITH RECURSIVE {sweep_sql()}
select market_id, param_id, rp, lo, sma_n, n_closed, final_value from board
order by final_value desc, market_id, param_id limit {TOP_N}""")
def q_leaderboard(spark, sf):
    return R.leaderboard(_sweep_board(spark, sf), "final_value", TOP_N,
                         tie_breakers=["market_id", "param_id"])


@register("user_metrics", f"""WITH RECURSIVE {sweep_sql()}
select market_id, param_id, rp, lo, sma_n, n_closed, final_value, avg_ret, win_rate from board
order by win_rate desc nulls last, final_value desc, market_id, param_id limit {TOP_N}""")
def q_user_metrics(spark, sf):
    """Leaderboard with user-supplied metric columns (aggregate expressions)."""
    metrics = {"avg_ret": F.avg("ret"),
               "win_rate": F.avg(F.when(F.col("ret") > 0, 1.0).otherwise(0.0))}
    b = _sweep_board(spark, sf, metrics)
    return b.orderBy(F.col("win_rate").desc_nulls_last(), F.col("final_value").desc(),
                     "market_id", "param_id").limit(TOP_N)
