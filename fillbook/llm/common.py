"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fillbook.session import ensure_checkpoint_dir, ensure_utc, scratch_path, ship_package

#: A word, everywhere: a run of characters that are not space, tab, line feed,
#: vertical tab, form feed or carriage return.
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]"
SPACES = " \t\n\x0b\x0c\r"

#: Rows and bytes of an Arrow batch: a run of very long texts makes short batches.
ARROW_ROWS = 4096
ARROW_BYTES = 8 << 20


def prepare(spark: SparkSession) -> None:
    """Session settings that every operator with Python tasks relies on."""
    ensure_utc(spark)
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def write_read(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts lineage with files that every executor can reach, so a lost executor
    costs a re-read and not a recomputation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def frugal(run):
    """A ``mapInArrow`` function that gives its freed memory back at the end.

    Worker processes outlive their tasks; what their allocators keep for later
    would stand beside the next stage's memory on the same executor.
    """
    def wrapped(batches):
        yield from run(batches)
        import ctypes

        import pyarrow as pa
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
        if trim:
            trim(0)
    return wrapped


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names with as many leading underscores as none of the columns has."""
    taken = {c.lower() for c in df.columns}
    lead = "_"
    while any((lead + n).lower() in taken for n in names):
        lead += "_"
    return [lead + n for n in names]


def word_count(text: Column) -> Column:
    """Number of words of a text (null: 0), JVM-side."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_CLASS + "+")), F.lit(0)).cast("long")


def seeded_sample(rows: DataFrame, key: str, size: int, seed: int, by: str | None = None) -> DataFrame:
    """The ``size`` rows of smallest seeded hash of ``key`` (of each ``by``).

    Rows far above the expected cut are left out before anything is ordered, so
    what is ordered holds about twice the sample however many rows there are.
    A sample can be a little short only where twice its size is expected to pass.
    ``by`` is a column of few values, such as the languages: their counts are broadcast.
    """
    place = F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    rows = rows.withColumn("_place", place)
    if by is None:
        low = rows.where(F.col("_place") * max(rows.count(), 1) < 2 * size)
        return low.orderBy("_place", key).limit(size).drop("_place")
    counts = rows.groupBy(by).agg(F.count(F.lit(1)).alias("_count"))
    low = rows.join(F.broadcast(counts), by).where(F.col("_place") * F.col("_count") < 2 * size)
    rank = F.row_number().over(Window.partitionBy(by).orderBy("_place", key))
    return low.withColumn("_rank", rank).where(F.col("_rank") <= size).drop("_rank", "_place", "_count")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` as query ``name``."""
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)
        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco
