"""OHLCV bars and per-bar flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bar_start(ts: str, width: str) -> Column:
    """Start of the epoch-aligned bin holding ``ts`` (closed left, labelled at start).

    Epoch alignment equals start-of-day alignment for widths dividing a day.
    """
    return F.window(ts, width).start


def ohlcv_bars(ticks: DataFrame, width: str = "2 minutes", key: str = "market_id",
               ts: str = "timestamp", price: str = "price", volume: str = "usd_amount",
               seq: str = "seq") -> DataFrame:
    """Per (key, bin): open/high/low/close of ``price``, summed ``volume``, tick count.

    Ticks are ordered by (ts, seq) - never by arrival. Null prices are skipped
    for OHLC; a bin whose prices are all null is dropped (its volume alone is
    not a bar). All aggregates are partial-aggregatable, so a hot market is
    pre-combined in every task before the shuffle on (key, bin).
    """
    parts = bar_parts(ticks, width, key, ts, price, volume, seq).drop("first_at", "last_at")
    return drop_empty_bars(parts.withColumn("volume", F.coalesce("volume", F.lit(0.0))))


def bar_parts(ticks: DataFrame, width: str = "2 minutes", key: str = "market_id",
              ts: str = "timestamp", price: str = "price", volume: str = "usd_amount",
              seq: str = "seq") -> DataFrame:
    """What some of a bar's ticks say about it: parts of one bar merge in any
    order, so ticks may come in any number of deliveries, however late."""
    order = F.when(F.col(price).isNotNull(), F.struct(F.col(ts).alias("ts"), F.col(seq).alias("seq")))
    return (ticks.groupBy(F.col(key), bar_start(ts, width).alias("bar_start"))
            .agg(F.min(order).alias("first_at"), F.min_by(price, order).alias("open"),
                 F.max(price).alias("high"), F.min(price).alias("low"),
                 F.max(order).alias("last_at"), F.max_by(price, order).alias("close"),
                 F.sum(volume).alias("volume"), F.count(F.lit(1)).alias("n_trades")))


def combine_bar_parts(parts: DataFrame, key: str = "market_id") -> DataFrame:
    """Parts of bars -> one part of each bar, which merges on like any other."""
    return parts.groupBy(key, "bar_start").agg(
        F.min("first_at").alias("first_at"), F.min_by("open", "first_at").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"),
        F.max("last_at").alias("last_at"), F.max_by("close", "last_at").alias("close"), F.sum("volume").alias("volume"), F.sum("n_trades").alias("n_trades"))


def merge_bar_parts(parts: DataFrame, key: str = "market_id") -> DataFrame:
    """Parts of bars -> bars; those with any null OHLC field are dropped."""
    bars = combine_bar_parts(parts, key).drop("first_at", "last_at").withColumn("volume", F.coalesce("volume", F.lit(0.0)))
    return drop_empty_bars(bars)


def drop_empty_bars(bars: DataFrame) -> DataFrame:
    """Drop bars with any null OHLCV field."""
    return bars.dropna("any", subset=["open", "high", "low", "close", "volume"])


def bar_direction(open_col: str = "open", close_col: str = "close") -> Column:
    """'up' when close >= open, 'down' otherwise, null without an open."""
    o, c = F.col(open_col), F.col(close_col)
    return F.when(o.isNull(), F.lit(None).cast("string")) \
        .when(c >= o, F.lit("up")).otherwise(F.lit("down"))


def threshold_clip(line: str, ref, op: str = ">") -> Column:
    """Keep ``line`` where ``line op ref`` holds, else ``ref`` (null compare -> ref).

    ``ref`` is a column name or a constant.
    """
    r = F.col(ref) if isinstance(ref, str) else F.lit(ref)
    cond = F.col(line) > r if op == ">" else F.col(line) < r
    return F.when(cond, F.col(line)).otherwise(r)
