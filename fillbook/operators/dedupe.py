"""Keep-one-row-per-key operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """One row per ``key``: the row smallest in ``order``.

    An aggregate (``min_by`` on a struct), not a window: it is combined
    map-side, so an id repeated across a third of the input costs one row per
    task before the shuffle.
    """
    cols = [c for c in df.columns if c != key]
    picked = df.groupBy(key).agg(
        F.min_by(F.struct(*cols), F.struct(*order)).alias("_row"))
    return picked.select(key, *[F.col("_row")[c].alias(c) for c in cols])
