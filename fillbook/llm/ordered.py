"""Places of rows in a global or per-group order, without one task per group.

Rows are dealt by ranges of the order and sorted inside, and the sorted table is
written in the shared folder, so places never change when a task runs again. A
place is the row's number in its part plus the rows of earlier parts, a sum over
one row per part (and group), however many rows a group has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fillbook.llm.common import write_read

_ROW = (1 << 33) - 1


def sorted_parts(rows: DataFrame, order: list[str | Column], name: str) -> DataFrame:
    """``rows`` written in sorted parts, with ``part`` and ``at``, the row's number in it."""
    cut = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    cut = cut.withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW)))
    return write_read(cut, name)


def places(rows: DataFrame, group: str, order: list[str | Column], name: str) -> DataFrame:
    """``rows`` with ``pos``, the 0-based place within ``group`` (not null) by
    ``order``, and ``n``, the group's number of rows."""
    cut = sorted_parts(rows, [group, *order], name)
    parts = cut.groupBy("part", group).agg(F.min("at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    whole = Window.partitionBy(group)
    before = F.coalesce(F.sum("_rows").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("part", group, "_first", before.alias("_before"), F.sum("_rows").over(whole).alias("n"))
    placed = cut.join(parts, ["part", group])
    return placed.withColumn("pos", F.col("at") - F.col("_first") + F.col("_before")).drop("part", "at", "_first", "_before")


def numbered(rows: DataFrame, order: list[str | Column], name: str) -> DataFrame:
    """``rows`` with ``pos``, the 0-based place in the whole order."""
    return places(rows.withColumn("_all", F.lit(0)), "_all", order, name).drop("_all", "n")
