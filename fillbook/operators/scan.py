"""Running (prefix) computations that stay bounded under key skew.

A plain ``Window.partitionBy(key).orderBy(t)`` puts every row of a key into
one task. If one market carries a third of all rows that task holds a third of
the table. Here the ordered rows of a key are cut into segments (a number that
never decreases along the order), and a running value is built in two levels:

1. inside each (key, segment): a window, or a fold over the segment's rows;
2. one summary row per (key, segment), combined per key in segment order - the
   number of segments per key is rows / segment size, tiny;
3. what entered a segment is joined back to its rows.

Anything with an associative summary fits: sums, maxima, last values
(``segmented_running_many``), neighbours (``segmented_shift``), and states that
follow x -> a x + b or a finite map (``fold_rows``, used by the indicators and
the trading rule).

``with_segments`` finds the borders: equal numbers of rows, by quantiles of the
order column, so neither a burst nor a quiet year makes a segment large.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fillbook.session import materialize

_AGGS = {"sum": F.sum, "max": F.max, "min": F.min, "product": F.product}

#: Rows of a segment, about. A key with fewer rows is one segment.
TARGET_SEGMENT_ROWS = 1 << 16
#: Quantile borders of a large key.
BORDERS = 256
#: Metadata of a segment column: every key is one segment.
WHOLE = "whole_keys"
#: Steps of a fold that share one growing array.
_FOLD_STEP = 64


def order_number(order: str | Column, kind: T.DataType | None = None) -> Column:
    """An order column as a number that grows with it: microseconds, days or the number itself."""
    c = F.col(order) if isinstance(order, str) else order
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp"))
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("bigint")
    return c.cast("bigint")


def with_segments(df: DataFrame, keys: list[str], order: str, out: str = "_seg", target_rows: int | None = None) -> DataFrame:
    """Add ``out``, a segment number that grows with ``order`` inside each key.

    Keys of at most ``target_rows`` rows are segment 0. Larger ones are cut at
    ``BORDERS`` quantiles from a mergeable sketch (``percentile_approx``), and
    pieces that are still too large are cut again in the same way. Rows of one
    instant stay together; a null order comes first.

    Runs a count per key when called, and reads large keys once more for their
    sketch. Borders are one row per large key, written once (a sketch may come
    out otherwise when its parts meet in another order); the rows are not.
    """
    target = target_rows or TARGET_SEGMENT_ROWS
    at = order_number(order, df.schema[order].dataType)
    cuts = [i / BORDERS for i in range(1, BORDERS)]
    step = round(BORDERS ** 0.5)
    number, d = F.lit(0).cast("bigint"), df
    while True:
        keyed = d.select(F.struct(*keys, number.alias("_piece")).alias("_gk"), at.alias("_at"))
        large = keyed.groupBy("_gk").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_lo"), F.max("_at").alias("_hi"))
        large = large.where((F.col("_n") > target) & (F.col("_lo") < F.col("_hi")))
        if large.isEmpty():  # said with the column, so that no operator looks for what entered a segment
            return d.withColumn(out, number.alias(out, metadata={WHOLE: True}) if d is df else number).select(*[c for c in df.columns if c != out], out)
        sketch = keyed.join(large, "_gk").groupBy("_gk").agg(F.max("_n").alias("_n"), F.max("_lo").alias("_lo"), F.max("_hi").alias("_hi"),
                                                             F.percentile_approx("_at", cuts, 10 * BORDERS).alias("_cuts"))
        borders = F.concat(F.array("_lo"), "_cuts", F.array(F.col("_hi") + 1))
        large = materialize(sketch.select("_gk", "_n", borders.alias("_cuts")), "borders")
        most = large.agg(F.max("_n")).first()[0]
        coarse = F.transform(F.sequence(F.lit(1), F.lit(BORDERS), F.lit(step)), lambda i: F.get("_cuts", i - 1))
        d = d.withColumns({"_gk": F.struct(*keys, number.alias("_piece")), "_at": at}).join(large.withColumn("_coarse", coarse).drop("_n"), "_gk", "left")
        # Two short looks instead of one along all borders.
        first = F.size(F.filter("_coarse", lambda b: b <= F.col("_at"))) - 1
        near = F.slice("_cuts", first * step + 1, F.lit(step))
        place = F.when(F.col("_cuts").isNotNull() & F.col("_at").isNotNull(), first * step + F.size(F.filter(near, lambda b: b <= F.col("_at"))))
        number = (number * (BORDERS + 1) + F.coalesce(place, F.lit(0))).cast("bigint")
        d = d.withColumn("_number", number).drop("_gk", "_at", "_cuts", "_coarse")
        number = F.col("_number")
        if most <= target * BORDERS // 2:  # no piece is left that is worth another pass
            return d.withColumn(out, number).select(*[c for c in df.columns if c != out], out)


def _order(order: list) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


class Segments:
    """Rows of a table dealt out by (key, segment), and one row per segment.

    The key columns travel as one struct (never null, and equal when its fields
    are null), so windows, summaries and the join back all use the same
    (struct, segment) hash partitioning: the rows are shuffled once, and only
    the small table of segments moves again. Where ``with_segments`` found that
    every key is one segment, there is no such table.
    """

    def __init__(self, df: DataFrame, keys: list[str], seg: str, order: list):
        self.seg = seg
        self.whole = bool(df.schema[seg].metadata.get(WHOLE))
        self.rows = df.withColumn("_gk", F.struct(*keys))
        #: Over the rows of a segment, and running up to the row.
        self.window = Window.partitionBy("_gk", seg).orderBy(*_order(order))
        self.running = self.window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        #: Over the segments of a key, all earlier ones, and up to the segment.
        self.key = Window.partitionBy("_gk").orderBy(seg)
        self.before = self.key.rowsBetween(Window.unboundedPreceding, -1)
        self.upto = self.key.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def with_columns(self, **columns: Column) -> Segments:
        """Columns from the rows of a segment (windows over ``window`` or ``running``)."""
        self.rows = self.rows.select("*", *[c.alias(n) for n, c in columns.items()])
        return self

    def summary(self, *aggs: Column) -> DataFrame:
        """One row per segment; partly aggregated where the windows already dealt the rows."""
        return self.rows.groupBy("_gk", self.seg).agg(*aggs)

    def entered(self, table: Callable[[], DataFrame], **start: Column) -> DataFrame:
        """Rows with what entered their segment: the columns of ``table()``, one
        row per segment, or ``start``, what enters the first segment of a key."""
        if self.whole:
            return self.rows.select("*", *[c.alias(n) for n, c in start.items()])
        return self.rows.join(table().select("_gk", self.seg, *start), ["_gk", self.seg], "left")


def segmented_running(df: DataFrame, keys: list[str], seg: str, order: list,
                      value: str, op: str, out: str) -> DataFrame:
    """Add ``out`` = running ``op`` of ``value`` over rows of ``keys`` ordered by
    ``order`` (rows frame, current row included). ``seg`` must be monotone in
    ``order`` within a key and non-null; ``order`` should be a total order."""
    return segmented_running_many(df, keys, seg, order, [(value, op, out)])


def segmented_running_many(df: DataFrame, keys: list[str], seg: str, order: list,
                           specs: list[tuple[str, str, str]]) -> DataFrame:
    """Several running values ``(value, op, out)`` over the same ordering in
    one pass: one window, one totals aggregate, one carry scan, one join.
    ``op``: sum, max, min, product or last (last non-null value, a forward fill)."""
    s = Segments(df, keys, seg, order)
    runs, totals, carries, outs, none = {"_pos": F.row_number().over(s.window)}, [], [], [], {}
    # Row number in the same window: the segment's full value is the running
    # value of its last row. Taking it from the window output (instead of
    # re-aggregating the input) reuses the window's partitioning and order:
    # no second evaluation of the input, no extra shuffle.
    for n, (value, op, out) in enumerate(specs):
        if op not in (*_AGGS, "last"):
            raise ValueError(f"unsupported running op {op!r}")
        run = (lambda c, w: F.last(c, ignorenulls=True).over(w)) if op == "last" else (lambda c, w, op=op: _AGGS[op](c).over(w))
        runs[f"_run{n}"] = run(value, s.running)
        none[f"_c{n}"] = F.lit(None)
        totals.append(F.max_by(f"_run{n}", "_pos").alias(f"_sv{n}"))
        carries.append(run(f"_sv{n}", s.before).alias(f"_c{n}"))
        r, c = F.col(f"_run{n}"), F.col(f"_c{n}")
        both = {"sum": c + r, "max": F.greatest(c, r), "min": F.least(c, r), "product": c * r}.get(op, F.coalesce(r, c))
        outs.append(F.coalesce(both, r, c).alias(out))
    s.with_columns(**runs)
    return s.entered(lambda: s.summary(*totals).select("_gk", seg, *carries), **none).select(*df.columns, *outs)


def segmented_shift(df: DataFrame, keys: list[str], seg: str, order: list,
                    specs: list[tuple[str, int, str]]) -> DataFrame:
    """``lag`` (offset -1) / ``lead`` (offset +1) of ``value`` per key across
    segments, without putting a key in one task.

    Inside a segment it is a window ``lag``/``lead``; the first (last) row of
    a segment takes the last (first) value of the previous (next) non-empty
    segment from a one-row-per-segment table.
    """
    s = Segments(df, keys, seg, order)
    shifts = {f"_in{n}": (F.lag if off < 0 else F.lead)(value).over(s.window) for n, (value, off, _) in enumerate(specs)}
    s.with_columns(_pos=F.row_number().over(s.window), **shifts)

    def edges() -> DataFrame:
        ends = s.summary(F.max("_pos").alias("_cnt"), *[(F.max_by if off < 0 else F.min_by)(value, "_pos").alias(f"_end{n}")
                                                        for n, (value, off, _) in enumerate(specs)])
        return ends.select("_gk", seg, "_cnt", *[(F.lag if off < 0 else F.lead)(f"_end{n}").over(s.key).alias(f"_edge{n}")
                                                 for n, (_, off, _) in enumerate(specs)])
    outs = []
    for n, (_, off, out) in enumerate(specs):
        at_edge = F.col("_pos") == (F.lit(1) if off < 0 else F.col("_cnt"))
        outs.append(F.when(at_edge, F.col(f"_edge{n}")).otherwise(F.col(f"_in{n}")).alias(out))
    return s.entered(edges, _cnt=F.lit(None), **{f"_edge{n}": F.lit(None) for n in range(len(specs))}).select(*df.columns, *outs)


def fold_rows(rows: Column, start: Column, step: Callable[[Column, Column], Column]) -> Column:
    """States after each element of an ordered array: ``step(state, element)``
    from ``start`` on, strictly in order, as an array of the same length.

    Built-in higher-order functions only. States are collected in short arrays
    of ``_FOLD_STEP`` (appending to one long array would copy it each time).
    """
    k, rest = F.lit(_FOLD_STEP), F.lit(1 << 30)
    parts = F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(F.size(rows) / k).cast("int") - 1, F.lit(0))),
                        lambda i: F.slice(rows, i * k + 1, k))

    def grow(out: Column, x: Column) -> Column:  # the transform names the last state once
        return F.concat(out, F.transform(F.slice(out, F.lit(-1), F.lit(1)), lambda state: step(state, x)))

    done = F.aggregate(parts, F.array(F.array(start)),
                       lambda done, xs: F.concat(done, F.array(F.aggregate(xs, F.slice(F.element_at(done, -1), F.lit(-1), F.lit(1)), grow))))
    # Each part starts with the state that entered it.
    return F.flatten(F.transform(F.slice(done, F.lit(2), rest), lambda p: F.slice(p, F.lit(2), rest)))


def last_state(rows: Column, start: Column, step: Callable[[Column, Column], Column]) -> Column:
    """The state after the last element of an ordered array."""
    return F.aggregate(rows, start, step)


def either(cases: list[tuple[Column, Column]], otherwise: Column) -> Column:
    """``CASE WHEN`` over a list."""
    return reduce(lambda c, x: c.when(*x), cases[1:], F.when(*cases[0])).otherwise(otherwise)
