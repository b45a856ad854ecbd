"""File sources and sinks for fills and trades.

Parquet is the internal format; CSV only at the import/export edge, always
with an explicit schema (asset ids must stay text) and the quoting of
Python's csv writer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fillbook import session as S
from fillbook.functions import hexcodec as H
from fillbook.operators.label import TRADE_COLUMNS
from fillbook.sources.markets import CSV_OPTIONS

# Cells of fills and trades hold no line feeds, so a large file splits into
# many tasks (market questions can, and their files cannot).
FLAT_CSV = {**CSV_OPTIONS, "multiLine": "false"}

FILL_SCHEMA = T.StructType([
    T.StructField("timestamp", T.LongType()),
    T.StructField("maker", T.StringType()),
    T.StructField("makerAssetId", T.StringType()),
    T.StructField("makerAmountFilled", T.LongType()),
    T.StructField("taker", T.StringType()),
    T.StructField("takerAssetId", T.StringType()),
    T.StructField("takerAmountFilled", T.LongType()),
    T.StructField("transactionHash", T.StringType()),
])

TRADE_SCHEMA = T.StructType([
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("market_id", T.StringType()),
    T.StructField("maker", T.StringType()),
    T.StructField("taker", T.StringType()),
    T.StructField("nonusdc_side", T.StringType()),
    T.StructField("maker_direction", T.StringType()),
    T.StructField("taker_direction", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("usd_amount", T.DoubleType()),
    T.StructField("token_amount", T.DoubleType()),
    T.StructField("transactionHash", T.StringType()),
])


def read_fills_csv(spark: SparkSession, path: str) -> DataFrame:
    """Order-fill CSV with the fixed schema (ids as text, amounts BIGINT)."""
    return spark.read.options(**FLAT_CSV).schema(FILL_SCHEMA).csv(path)


def write_fills_csv(fills: DataFrame, path: str, mode: str = "overwrite") -> None:
    fills.write.mode(mode).options(**CSV_OPTIONS).csv(path)


def export_trades_csv(trades: DataFrame, path: str, mode: str = "overwrite", compression: str = "none") -> None:
    """User-facing CSV: the 11 trade columns in fixed order, header once per file.
    ``compression`` (such as gzip) is for large exports: every reader of CSV takes
    gzip, and the text takes less than half the room. A compressed file is read by
    one task, so there are as many files as the trades have parts."""
    with S.releasing(trades.sparkSession):
        (trades.select(*TRADE_COLUMNS).write.mode(mode).options(**CSV_OPTIONS)
         .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path, compression=compression))


def read_trades_csv(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.options(**FLAT_CSV).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
            .schema(TRADE_SCHEMA).csv(path))


def append_trades(trades: DataFrame, path: str, run_id: str, granularity: str = "day") -> None:
    """Append labelled trades as Parquet partitioned by trade date (not by
    market: there are far too many markets for directory partitions).

    The run writes its own ``run_id=<id>`` folder with overwrite, so a re-run
    after a failure replaces its output. Rows are rebalanced by date before the
    write: few files per date, and AQE splits a heavy one. ``granularity='month'``
    labels each partition with the month's first day (for small tables).

    A large run is written in portions of whole dates, the first with overwrite,
    so that the exchanges of one portion lie on disk at a time.
    """
    date = F.to_date(F.date_trunc(granularity, F.col("timestamp")))
    dated, mode = trades.withColumn("trade_date", date), "overwrite"
    with S.releasing(trades.sparkSession):
        groups = S.portions([tuple(r) for r in dated.groupBy("trade_date").count().collect()])
        for dates in groups:
            some = dated.where(S.among(F.col("trade_date"), dates)) if len(groups) > 1 else dated
            by_date(some).write.mode(mode).option("compression", "zstd").partitionBy("trade_date").parquet(f"{path}/run_id={run_id}")
            mode = "append"


def by_date(trades: DataFrame) -> DataFrame:
    """Trades rebalanced by date, hashes and addresses as bytes on the way."""
    return H.unpacked(H.packed(trades).hint("rebalance", "trade_date"))


def read_trades(spark: SparkSession, path: str) -> DataFrame:
    """Trades table; a date filter prunes partitions, columns prune the scan."""
    return spark.read.parquet(path).drop("run_id")
