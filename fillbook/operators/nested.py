"""Nested records -> (path, value) rows, e.g. for generic report tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEP = " - "
FIRST_LEVELS = 4


def _open_level(df: DataFrame, keys: list[str]) -> DataFrame:
    """Replace every object by its entries; other values stay as they are."""
    inside = F.map_entries(F.expr("cast(_open as map<string, variant>)"))
    entries = F.transform(inside, lambda e: F.struct(
        F.concat_ws(SEP, F.col("path"), e["key"]).alias("path"), e["value"].alias("value")))
    is_object = F.col("value").isNotNull() & F.schema_of_variant("value").startswith("OBJECT")
    itself = F.array(F.struct(F.col("path"), F.col("value")))
    # A non-object must not meet the cast, so it is replaced by null before it.
    df = df.withColumn("_object", is_object).withColumn("_open", F.expr("if(_object, value, null)"))
    return df.select(*keys, F.explode(F.when(F.col("_object"), entries).otherwise(itself)).alias("e")).select(*keys, "e.*")


def nested_to_path_rows(df: DataFrame, keys: list[str], json_col: str) -> DataFrame:
    """Flatten a JSON object column into rows ``(keys..., path, value)``.

    Objects are opened until none is left, however deep; the path joins their
    keys with ' - '. Other values keep their JSON text, strings unquoted (also
    a string that looks like an object). An empty object has no rows, a null
    value is a row. One chain of projections over one scan: the levels it needs
    are found by asking whether an object is left after 4, 8, 16, ... levels.
    """
    cur = df.select(*keys, F.lit(None).cast("string").alias("path"), F.try_parse_json(json_col).alias("value"))
    cur = _open_level(cur.where(F.col("value").isNotNull()), keys)
    more = FIRST_LEVELS - 1
    while True:
        for _ in range(more):
            cur = _open_level(cur, keys)
        left = cur.where(F.col("value").isNotNull() & F.schema_of_variant("value").startswith("OBJECT"))
        if not left.take(1):
            return cur.select(*keys, "path", F.col("value").cast("string").alias("value"))
        more = FIRST_LEVELS if more < FIRST_LEVELS else 2 * more
