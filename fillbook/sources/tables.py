"""Reading the driver's parquet tables.

Only the columns a caller selects are read: Spark prunes the parquet scan to
the projected columns and pushes filters into it, so nothing here selects.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fillbook.session import table_path

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read a driver table."""
    if name not in TABLES:
        raise KeyError(f"unknown table {name!r}")
    return spark.read.parquet(table_path(sf_dir, name))
