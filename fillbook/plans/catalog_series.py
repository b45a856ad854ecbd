"""Queries for bars and aligned series."""

from __future__ import annotations

from pyspark.sql import functions as F

from fillbook.operators import align as A
from fillbook.operators.bars import bar_direction, drop_empty_bars, ohlcv_bars
from fillbook.plans.fixture_sql import fx
from fillbook.plans.registry import register
from fillbook.sources import fixtures as X

WIDTH = "2 minutes"
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]

# DuckDB: epoch-aligned 2-minute bin start.
BIN = "make_timestamp((epoch_us(timestamp) // 120000000) * 120000000)"
BARS_SQL = f"""bars AS (
  select market_id, {BIN} as bar_start,
    first(price order by timestamp, seq) filter (where price is not null) as open,
    max(price) as high, min(price) as low,
    last(price order by timestamp, seq) filter (where price is not null) as close,
    coalesce(sum(usd_amount), 0.0) as volume, count(*) as n_trades
  from fx_ticks group by all having count(price) > 0)"""


def _bars(spark, sf):
    return ohlcv_bars(X.fx_ticks(spark, sf), WIDTH)


@register("ohlcv_bars", f"""WITH {fx("fx_ticks")}, {BARS_SQL}
select market_id, bar_start, open, high, low, close, round(volume, 6) as volume, n_trades from bars""")
def q_ohlcv_bars(spark, sf):
    b = _bars(spark, sf)
    return b.withColumn("volume", F.round("volume", 6))


@register("bar_direction", f"""WITH {fx("fx_ticks")}, {BARS_SQL}
select market_id, bar_start, case when open is null then null when close >= open then 'up' else 'down' end
  as direction from bars""")
def q_bar_direction(spark, sf):
    return _bars(spark, sf).select("market_id", "bar_start", bar_direction().alias("direction"))


@register("drop_empty_bars", f"""WITH {fx("fx_ticks")},
t AS (select market_id, timestamp, seq, case when event_type = 'error' then null else price end as price,
      usd_amount from fx_ticks),
raw AS (select market_id, {BIN} as bar_start,
    first(price order by timestamp, seq) filter (where price is not null) as open, max(price) as high,
    min(price) as low, last(price order by timestamp, seq) filter (where price is not null) as close,
    coalesce(sum(usd_amount), 0.0) as volume, count(*) as n_trades from t group by all)
select market_id, bar_start, open, high, low, close, round(volume, 6) as volume, n_trades from raw
where open is not null and high is not null and low is not null and close is not null and volume is not null""")
def q_drop_empty_bars(spark, sf):
    """Bars over ticks whose 'error' prices are missing: all-missing bins go."""
    t = X.fx_ticks(spark, sf).withColumn(
        "price", F.when(F.col("event_type") == "error", F.lit(None)).otherwise(F.col("price")))
    b = drop_empty_bars(ohlcv_bars(t, WIDTH))
    return b.withColumn("volume", F.round("volume", 6))


# --- aligned series ----------------------------------------------------------
# Long series from ticks: group = market, one line per event type.

def _series(spark, sf):
    return X.fx_ticks(spark, sf).select(
        "market_id", F.col("event_type").alias("series"), F.col("timestamp").alias("ts"),
        F.col("price").alias("value"), "seq")


SERIES_SQL = """src AS (select market_id, event_type as series, timestamp as ts, price as value, seq from fx_ticks),
clock AS (select distinct market_id, ts from src),
lines AS (select distinct market_id, series from src),
grid AS (select clock.market_id, lines.series, clock.ts from clock join lines using (market_id))"""


@register("master_clock", f"""WITH {fx("fx_ticks")}, {SERIES_SQL}
select market_id, ts from clock""")
def q_master_clock(spark, sf):
    return A.master_clock(_series(spark, sf), ["market_id"], "ts")


@register("align_exact", f"""WITH {fx("fx_ticks")}, {SERIES_SQL}
select g.market_id, g.series, g.ts, s.value from grid g
left join src s on g.market_id = s.market_id and g.series = s.series and g.ts = s.ts""")
def q_align_exact(spark, sf):
    return A.align_exact(_series(spark, sf), ["market_id"], "series", "ts", "value", "seq")


ASOF_SQL = """aligned AS (
  select g.market_id, g.series, g.ts,
    case when e.ts is not null then e.value else p.value end as value
  from grid g
  left join src e on g.market_id = e.market_id and g.series = e.series and g.ts = e.ts
  asof left join src p on g.market_id = p.market_id and g.series = p.series and g.ts > p.ts)"""


@register("align_asof", f"""WITH {fx("fx_ticks")}, {SERIES_SQL}, {ASOF_SQL}
select * from aligned""")
def q_align_asof(spark, sf):
    return A.align_asof(_series(spark, sf), ["market_id"], "series", "ts", "value", "seq")


@register("series_widen", f"""WITH {fx("fx_ticks")}, {SERIES_SQL}, {ASOF_SQL}
select market_id, ts,
  {", ".join(f"first(value) filter (where series = '{e}') as {e}" for e in EVENT_TYPES)}
from aligned group by market_id, ts""")
def q_series_widen(spark, sf):
    a = A.align_asof(_series(spark, sf), ["market_id"], "series", "ts", "value", "seq")
    return A.series_widen(a, ["market_id"], "series", "ts", "value", EVENT_TYPES)


@register("gapfree_index", f"""WITH {fx("fx_ticks")}, {SERIES_SQL}
select market_id, ts, row_number() over (partition by market_id order by ts) - 1 + 100 as idx from clock""")
def q_gapfree_index(spark, sf):
    clock = A.master_clock(_series(spark, sf), ["market_id"], "ts")
    return A.gapfree_index(clock, ["market_id"], "ts", start=100)


LOOKBACK = 23


@register("last_n_rows", f"""WITH {fx("fx_ticks")}, {SERIES_SQL}
select market_id, ts from (select *, row_number() over (partition by market_id order by ts desc) as rn
  from clock) where rn <= {LOOKBACK}""")
def q_last_n_rows(spark, sf):
    clock = A.master_clock(_series(spark, sf), ["market_id"], "ts")
    return A.last_n_rows(clock, ["market_id"], "ts", LOOKBACK)


@register("filter_time_range", f"""WITH {fx("fx_ticks")}
select seq, market_id, timestamp from fx_ticks
where timestamp >= TIMESTAMP '2024-01-10 00:00:00' and timestamp <= TIMESTAMP '2024-01-20 12:00:00'""")
def q_filter_time_range(spark, sf):
    t = X.fx_ticks(spark, sf).select("seq", "market_id", "timestamp")
    return A.filter_time_range(t, "timestamp", F.lit("2024-01-10 00:00:00").cast("timestamp_ntz"),
                               F.lit("2024-01-20 12:00:00").cast("timestamp_ntz"))


@register("filter_positions", f"""WITH {fx("fx_ticks")}
select seq, market_id, timestamp from (
  select *, row_number() over (partition by market_id order by timestamp) - 1 as pos,
    count(*) over (partition by market_id) as n from fx_ticks)
where pos >= 5 and pos < n + 1 - 3""")
def q_filter_positions(spark, sf):
    """Positional range: skip 5 rows per market, end=-3 drops the last two."""
    t = X.fx_ticks(spark, sf).select("seq", "market_id", "timestamp")
    return A.filter_positions(t, ["market_id"], "timestamp", start=5, end=-3)


# Shared (domain-less) lines: 'error' events belong to every market's plot.
DOMAIN_SQL = """dom AS (select seq, event_type as series, timestamp as ts, price as value,
  case when event_type = 'error' then null else market_id end as domain from fx_ticks)"""


def _domains(spark, sf):
    t = X.fx_ticks(spark, sf)
    return t.select("seq", F.col("event_type").alias("series"), F.col("timestamp").alias("ts"),
                    F.col("price").alias("value"),
                    F.when(F.col("event_type") == "error", F.lit(None))
                    .otherwise(F.col("market_id")).alias("domain"))


@register("filter_domain", f"""WITH {fx("fx_ticks")}, {DOMAIN_SQL}
select * from dom where domain is null or domain in ('m1', 'm3')""")
def q_filter_domain(spark, sf):
    return A.filter_domain(_domains(spark, sf), "domain", ["m1", "m3"])


@register("domain_union", f"""WITH {fx("fx_ticks")}, {DOMAIN_SQL}
select distinct domain from dom""")
def q_domain_union(spark, sf):
    return A.domain_union(_domains(spark, sf), "domain")


@register("drop_nan", f"""WITH {fx("fx_ticks")}
select seq, v from (select seq, case when event_type = 'view' then 'NaN'::double else price end as v
  from fx_ticks) where v is not null and not isnan(v)""")
def q_drop_nan(spark, sf):
    t = X.fx_ticks(spark, sf).select(
        "seq", F.when(F.col("event_type") == "view", F.lit(float("nan")))
        .otherwise(F.col("price")).alias("v"))
    return A.drop_nan(t, "v")
