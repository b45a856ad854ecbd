"""Live-table helpers: upserts of the latest rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def patch_rows(current: DataFrame, patch: DataFrame, keys: list[str]) -> DataFrame:
    """Overwrite the non-null fields of ``patch`` onto matching ``current`` rows."""
    vals = [c for c in current.columns if c not in keys]
    p = patch.select(*keys, *[F.col(c).alias(f"_p_{c}") for c in vals])
    j = current.join(p, keys, "inner")
    return j.select(*keys, *[F.coalesce(F.col(f"_p_{c}"), F.col(c)).alias(c) for c in vals])


def upsert_latest(current: DataFrame, updates: DataFrame, keys: list[str], version: str) -> DataFrame:
    """Keep the newest ``version`` of every key across both inputs."""
    u = current.unionByName(updates)
    return u.groupBy(*keys).agg(F.max_by(F.struct(*[c for c in u.columns if c not in keys]),
                                         F.col(version)).alias("_r")).select(*keys, "_r.*")


# --- consumers that read what is new to them -------------------------------------

def cursor(spark: SparkSession, path: str, consumer: str, start: int = -1) -> int:
    """The last index that ``consumer`` has committed at ``path`` (``start`` if none)."""
    from fillbook.streaming.jobs import path_exists
    if not path_exists(spark, path):
        return start
    rows = spark.read.schema(_CURSOR).parquet(path).where(F.col("consumer") == consumer)
    last = rows.agg(F.max("idx")).first()[0]
    return start if last is None else last


_CURSOR = T.StructType([T.StructField("consumer", T.StringType()), T.StructField("idx", T.LongType())])


def commit(spark: SparkSession, path: str, consumer: str, idx: int) -> None:
    """Remember that ``consumer`` has taken everything up to ``idx``. A commit is
    one more row, and the highest counts, so repeating one changes nothing."""
    spark.createDataFrame([(consumer, idx)], _CURSOR).coalesce(1).write.mode("append").parquet(path)


def changes_since(rows: DataFrame, path: str, consumer: str, idx: str = "idx") -> tuple[DataFrame, int]:
    """The rows above the consumer's cursor, and the index to commit once they
    are processed. Rows of several markets share one index column."""
    spark = rows.sparkSession
    last = cursor(spark, path, consumer)
    new = rows.where(F.col(idx) > last)
    high = new.agg(F.max(idx)).first()[0]
    upto = last if high is None else high
    return new.where(F.col(idx) <= upto), upto
