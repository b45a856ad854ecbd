"""Market tables: landed pages, stored CSV/Parquet, supplements, dedupe."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fillbook.functions.tokens import (json_string_array, market_id_coalesce, python_json_layout,
                                       token_ids_from_struct)
from fillbook.operators.dedupe import first_per_key
from fillbook.operators.label import with_tokens

# Options for CSV written by Python's csv module: doubled quotes inside quoted
# cells, and cells (questions) that contain newlines.
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "multiLine": "true",
               "mode": "PERMISSIVE"}

MISSING_COLUMNS = ["id", "clobTokenIds", "conditionId", "question", "slug", "closed"]

TOKEN = T.StructType([T.StructField("token_id", T.StringType()),
                      T.StructField("outcome", T.StringType())])
MARKET_OBJECT = T.StructType([
    T.StructField("condition_id", T.StringType()),
    T.StructField("tokens", T.ArrayType(TOKEN)),
    T.StructField("question", T.StringType()),
    T.StructField("market_slug", T.StringType()),
    T.StructField("closed", T.BooleanType()),
])
# A market arrives as the text of its JSON object: declared fields are parsed
# from it, all others are kept in ``extras``.
MARKET_PAGE = T.StructType([
    T.StructField("page_offset", T.LongType()),
    T.StructField("data", T.ArrayType(T.StringType())),
])


def read_markets_csv(spark: SparkSession, path: str, columns: list[str] | None = None,
                     keep_order: bool = True) -> DataFrame:
    """Stored markets CSV; every column text (ids must never become numbers).

    ``keep_order`` adds ``_ingest_seq`` (stored row order) so that "first row
    per id wins" means first in the file, as the CSV was written.
    """
    df = spark.read.options(**CSV_OPTIONS).option("inferSchema", "false").csv(path)
    if columns:
        df = df.select(*columns)
    return with_ingest_seq(df) if keep_order else df


def with_ingest_seq(df: DataFrame) -> DataFrame:
    """Order of rows as stored: (file, block start, position in the read)."""
    return df.withColumn("_ingest_seq", F.struct(
        F.col("_metadata.file_path").alias("f"),
        F.col("_metadata.file_block_start").alias("b"),
        F.monotonically_increasing_id().alias("r")))


def union_first_wins(frames: list[DataFrame], key: str = "id",
                     seq_col: str | None = None) -> DataFrame:
    """Union by name (missing columns become null, types relaxed to the wider
    one); keep one row per ``key``, earlier frame first, then ``seq_col``."""
    # Relax types: a column typed differently across frames becomes text.
    types: dict[str, set] = {}
    for f in frames:
        for fld in f.schema.fields:
            types.setdefault(fld.name, set()).add(fld.dataType.simpleString())
    mixed = {c for c, ts in types.items() if len(ts) > 1}
    tagged = []
    for prio, f in enumerate(frames):
        f = f.select(*[F.col(c).cast("string").alias(c) if c in mixed else F.col(c)
                       for c in f.columns])
        tagged.append(f.withColumn("_src_prio", F.lit(prio)))
    u = tagged[0]
    for f in tagged[1:]:
        u = u.unionByName(f, allowMissingColumns=True)
    order = [F.col("_src_prio")] + ([F.col(seq_col)] if seq_col else [])
    out = first_per_key(u, key, order).drop("_src_prio")
    return out.drop(seq_col) if seq_col else out


def load_markets(frames: list[DataFrame], lean: bool = False) -> DataFrame:
    """Markets (+ supplement) -> one row per id with ``token1``/``token2``.

    ``lean`` keeps only the three join columns; Catalyst prunes the scan to
    ``id, clobTokenIds`` either way when the caller projects.
    """
    if not frames:
        raise FileNotFoundError("no market table given")
    for f in frames:
        if "id" not in f.columns:
            raise KeyError("market table lacks the 'id' column")
    seq = "_ingest_seq" if all("_ingest_seq" in f.columns for f in frames) else None
    if lean:
        # Project before the dedupe: columns inside the kept-row struct are
        # invisible to column pruning, so narrow the scan here.
        if any("clobTokenIds" not in f.columns for f in frames):
            raise KeyError("market table lacks the 'clobTokenIds' column")
        frames = [f.select("id", "clobTokenIds", *([seq] if seq else [])) for f in frames]
    else:
        frames = [f.drop("_ingest_seq") if not seq else f for f in frames]
    m = union_first_wins(frames, "id", seq)
    if "clobTokenIds" not in m.columns:
        raise KeyError("market table lacks the 'clobTokenIds' column")
    m = with_tokens(m)
    if lean:
        return m.select("id", "token1", "token2")
    return m


def read_market_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed API pages (one JSON object per line: page_offset, data[])."""
    return spark.read.schema(MARKET_PAGE).json(path)


def markets_from_pages(pages: DataFrame) -> DataFrame:
    """Pages -> one row per market: blank condition ids skipped, first
    occurrence (page offset, position in page) wins, ``id`` and
    ``clobTokenIds`` first, nested fields as JSON text. Fields without a column
    of their own are in ``extras`` (name -> text, nested ones as JSON)."""
    one = pages.select("page_offset", F.posexplode("data").alias("pos", "m"))
    if dict(one.dtypes)["m"] != "string":
        one = one.withColumn("m", F.to_json("m", {"ignoreNullFields": "false"}))
    declared = [f.name for f in MARKET_OBJECT.fields]
    rows = one.select("page_offset", "pos", "m", F.from_json("m", MARKET_OBJECT).alias("o")).select("page_offset", "pos", "m", "o.*")
    rows = rows.where(F.col("condition_id").isNotNull() & (F.col("condition_id") != ""))
    first = first_per_key(rows, "condition_id", [F.col("page_offset"), F.col("pos")])
    ids = token_ids_from_struct("tokens")
    return first.select(
        F.col("condition_id").alias("id"),
        json_string_array(ids).alias("clobTokenIds"),
        F.col("condition_id"),
        F.coalesce(python_json_layout(F.to_json("tokens", {"ignoreNullFields": "false"})), F.lit("")).alias("tokens"),
        F.coalesce(F.col("question"), F.lit("")).alias("question"),
        F.coalesce(F.col("market_slug"), F.lit("")).alias("market_slug"),
        F.col("closed"),
        F.map_filter(F.from_json("m", "map<string,string>"), lambda k, _: ~k.isin(declared)).alias("extras"),
    )


def export_markets_csv(markets: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Markets as CSV text cells (``id``, ``clobTokenIds`` first), every cell
    flattened the way the original writer printed it."""
    from fillbook.functions.tokens import flatten_cell
    first = [c for c in ("id", "clobTokenIds") if c in markets.columns]
    cols = first + [c for c in markets.columns if c not in first and not c.startswith("_")]
    types = dict(markets.dtypes)
    (markets.select(*[flatten_cell(c, types[c]).alias(c) for c in cols])
     .write.mode(mode).options(**CSV_OPTIONS).csv(path))


def new_markets(stored: DataFrame, fresh: DataFrame, key: str = "id") -> DataFrame:
    """Markets in ``fresh`` whose id is not stored yet (append set of a resume)."""
    return fresh.join(stored.select(key), key, "left_anti")


def supplement_rows(payloads: DataFrame) -> DataFrame:
    """Fetched supplement payloads -> the six stored columns.

    ``payloads``: (fetch_seq, body) where body is a list, or an object with a
    ``markets`` or ``data`` list. ``id`` = conditionId, else id. Within the
    fetched set the later record of a market replaces the earlier one.
    """
    item = T.StructType([
        T.StructField("conditionId", T.StringType()), T.StructField("id", T.StringType()),
        T.StructField("clobTokenIds", T.StringType()), T.StructField("question", T.StringType()),
        T.StructField("slug", T.StringType()), T.StructField("closed", T.StringType())])
    as_list = F.from_json("body", T.ArrayType(item))
    as_obj = F.from_json("body", T.StructType([T.StructField("markets", T.ArrayType(item)),
                                               T.StructField("data", T.ArrayType(item))]))
    # from_json with an array schema also accepts a lone object (as a one
    # element array), so the body shape is decided by its first character.
    is_list = F.startswith(F.ltrim(F.col("body")), F.lit("["))
    from_obj = F.coalesce(F.when(F.size(as_obj["markets"]) > 0, as_obj["markets"]), as_obj["data"])
    items = F.coalesce(F.when(is_list, as_list).otherwise(from_obj), F.array().cast(T.ArrayType(item)))
    rows = payloads.select("fetch_seq", F.posexplode(items).alias("pos", "m")).select(
        "fetch_seq", "pos", "m.*")
    rows = rows.withColumn("mid", market_id_coalesce("conditionId", "id")).where(F.col("mid") != "")
    last = first_per_key(rows.drop("id"), "mid", [-F.col("fetch_seq"), -F.col("pos")])
    return last.select(
        F.col("mid").alias("id"),
        F.coalesce(F.col("clobTokenIds"), F.lit("")).alias("clobTokenIds"),
        F.col("mid").alias("conditionId"),
        F.coalesce(F.col("question"), F.lit("")).alias("question"),
        F.coalesce(F.col("slug"), F.lit("")).alias("slug"),
        F.coalesce(F.col("closed"), F.lit("")).alias("closed"))


def supplement_merge(existing_ids: DataFrame, payloads: DataFrame) -> DataFrame:
    """Supplement rows not already stored (anti join on id): the append set."""
    return supplement_rows(payloads).join(existing_ids.select("id"), "id", "left_anti")
