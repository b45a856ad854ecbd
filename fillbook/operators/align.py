"""Aligning many time series to a shared clock.

Long form throughout: a series table has ``group`` columns (one plot, e.g. a
market), a ``series`` column (one line), a timestamp and a value. The clock of
a group is the distinct union of its series' timestamps. Every operator is
partitioned by group/series; running values use the segmented scan so a hot
series is split into segments of equal size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fillbook.operators.scan import segmented_running, segmented_shift, with_segments
from fillbook.operators.dedupe import first_per_key
from fillbook.session import materialize


def master_clock(series: DataFrame, group: list[str], ts: str = "ts") -> DataFrame:
    """Distinct timestamps per group (no global sort: order only when shown)."""
    return series.select(*group, ts).distinct()


def _grid(series: DataFrame, group: list[str], name: str, ts: str) -> DataFrame:
    """(group, series, clock tick) for every series of the group."""
    clock = master_clock(series, group, ts)
    lines = series.select(*group, name).distinct()
    return clock.join(lines, group, "inner")


def _first_per_tick(series: DataFrame, group: list[str], name: str, ts: str, value: str,
                    seq: str | None) -> DataFrame:
    keyed = series.select(F.struct(*group, name, ts).alias("_k"), value,
                          *([seq] if seq else []))
    order = [F.col(seq)] if seq else [F.lit(0)]
    first = first_per_key(keyed, "_k", order)
    return first.select("_k.*", F.struct(F.col(value).alias("v")).alias("_exact"))


def align_exact(series: DataFrame, group: list[str], name: str = "series", ts: str = "ts",
                value: str = "value", seq: str | None = None) -> DataFrame:
    """Value of each series at each clock tick of its group; null where the
    series has no row at that tick (first row wins on duplicate ticks)."""
    grid = _grid(series, group, name, ts)
    exact = _first_per_tick(series, group, name, ts, value, seq)
    return grid.join(exact, group + [name, ts], "left").select(
        *group, name, ts, F.col("_exact.v").alias(value))


#: Ticks of a clock that are one row while series meet them.
BUCKET_TICKS = 1024
#: Ticks of a clock that hold a segment of a series' rows.
SEGMENT_TICKS = 1 << 16


def indexed_clock(series: DataFrame, group: list[str], ts: str = "ts") -> DataFrame:
    """(group, ts, idx): each tick's 0-based place on its group's clock. The
    clock is written once (ticks without values), as it is read several times."""
    clock = materialize(master_clock(series.where(F.col(ts).isNotNull()).dropna(subset=group), group, ts), "clock")
    return gapfree_index(clock, group, ts)


def align_asof(series: DataFrame, group: list[str], name: str = "series", ts: str = "ts",
               value: str = "value", seq: str | None = None) -> DataFrame:
    """As ``align_exact`` but a tick without a row takes the latest earlier
    row's value - that row's value even if it is null (forward fill by row,
    not by non-null value). Rows without a timestamp or group are left out.

    A series is a list of intervals of the clock: from each of its ticks to the
    next one. Intervals are cut at the borders of buckets of ``BUCKET_TICKS``
    ticks and meet one row per bucket, the bucket's ticks as an array; the part
    that an interval covers is then unfolded in place. So ticks times series
    appear only as the result, behind the last shuffle, and a group of any size
    is spread over its buckets.
    """
    clock = indexed_clock(series, group, ts)
    order = F.struct(F.col(seq)) if seq else F.struct(F.lit(0))
    held = F.struct(F.col(value).alias("v"))
    points = series.where(F.col(ts).isNotNull()).groupBy(*group, name, ts).agg(
        F.min_by(held, order).alias("_first"), F.max_by(held, order).alias("_last"))
    points = points.join(clock, group + [ts]).withColumn("_seg", F.floor(F.col("idx") / SEGMENT_TICKS))
    points = segmented_shift(points, group + [name], "_seg", ["idx"], [("idx", -1, "_before"), ("idx", 1, "_next")])
    size = clock.groupBy(*group).agg((F.max("idx") + 1).alias("_size"))
    points = points.join(size, group)
    end = F.coalesce("_next", "_size")
    piece = lambda lo, hi, first, last: F.struct(lo.alias("lo"), hi.alias("hi"), first.alias("first"), last.alias("last"))
    none = F.lit(None).cast(points.schema["_first"].dataType)
    # Before its first row a series has no value: one more interval.
    lead = F.when(F.col("_before").isNull() & (F.col("idx") > 0), piece(F.lit(0).cast("bigint"), F.col("idx"), none, none))
    spans = points.select(*group, name, F.explode(F.array_compact(F.array(lead, piece(F.col("idx"), end, F.col("_first"), F.col("_last"))))).alias("x"))
    b = F.lit(BUCKET_TICKS)
    spans = spans.select(*group, name, "x.*").withColumn(
        "_bucket", F.explode(F.sequence(F.floor(F.col("lo") / b), F.floor((F.col("hi") - 1) / b))))
    ticks = clock.groupBy(*group, F.floor(F.col("idx") / b).alias("_bucket")).agg(F.array_sort(F.collect_list(ts)).alias("_ticks"))
    met = spans.join(ticks, group + ["_bucket"])
    start = F.greatest(F.col("lo"), F.col("_bucket") * b)
    length = F.least(F.col("hi"), (F.col("_bucket") + 1) * b) - start
    covered = F.slice("_ticks", (start - F.col("_bucket") * b + 1).cast("int"), length.cast("int"))
    out = met.select(*group, name, "first", "last", (start == F.col("lo")).alias("_own"), F.posexplode(covered).alias("_k", ts))
    return out.select(*group, name, ts, F.when(F.col("_own") & (F.col("_k") == 0), F.col("first.v")).otherwise(F.col("last.v")).alias(value))


def series_widen(aligned: DataFrame, group: list[str], name: str, ts: str, value: str,
                 names: list[str]) -> DataFrame:
    """Long aligned series -> one row per (group, tick), one column per series.

    ``names`` is the explicit column list (no extra job to discover it).
    """
    return aligned.groupBy(*group, ts).pivot(name, names).agg(F.first(value))


def gapfree_index(clock: DataFrame, group: list[str], ts: str = "ts", start: int = 0,
                  segment: Column | None = None) -> DataFrame:
    """Consecutive 0-based position of each tick within its group, plus ``start``."""
    c = clock.withColumn("_one", F.lit(1))
    c = c.withColumn("_seg", segment) if segment is not None else with_segments(c, group, ts)
    run = segmented_running(c, group, "_seg", [ts], "_one", "sum", "_pos")
    return run.select(*group, ts, (F.col("_pos") - 1 + F.lit(start)).alias("idx"))


def last_n_rows(df: DataFrame, group: list[str], ts: str, n: int) -> DataFrame:
    """Latest ``n`` rows per group (row_number desc <= n: a group limit that
    Spark applies per task before the shuffle)."""
    w = Window.partitionBy(*group).orderBy(F.col(ts).desc())
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def filter_time_range(df: DataFrame, ts: str, start=None, end=None) -> DataFrame:
    """Rows with start <= ts <= end (either bound optional, both inclusive)."""
    cond = F.lit(True)
    if start is not None:
        cond = cond & (F.col(ts) >= F.lit(start))
    if end is not None:
        cond = cond & (F.col(ts) <= F.lit(end))
    return df.where(cond)


def filter_positions(df: DataFrame, group: list[str], ts: str, start: int = 0,
                     end: int | None = None, segment: Column | None = None) -> DataFrame:
    """Positional range per group: rows [start, end); a negative ``end``
    counts from the tail (-1 keeps everything, -2 drops the last row).

    Position = segmented running count; group size = an aggregate joined back.
    """
    d = df.withColumn("_one", F.lit(1))
    d = d.withColumn("_seg", segment) if segment is not None else with_segments(d, group, ts)
    d = segmented_running(d, group, "_seg", [ts], "_one", "sum", "_pos")
    sizes = df.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"))
    d = d.join(sizes, group, "left").withColumn("_pos", F.col("_pos") - 1)
    cond = F.col("_pos") >= start
    if end is not None:
        stop = F.col("_n") + 1 + F.lit(end) if end < 0 else F.lit(end)
        cond = cond & (F.col("_pos") < stop)
    return d.where(cond).drop("_pos", "_n", "_one", "_seg")


def filter_domain(df: DataFrame, domain: str, keep: list[str]) -> DataFrame:
    """Series of the given domains plus the domain-less (shared) series."""
    return df.where(F.col(domain).isNull() | F.col(domain).isin(*keep))


def drop_nan(df: DataFrame, value: str) -> DataFrame:
    """Drop rows whose value is NaN or null."""
    return df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value)))


def domain_union(df: DataFrame, domain: str) -> DataFrame:
    """Distinct domains over all series (null = the shared, domain-less ones)."""
    return df.select(domain).distinct()
