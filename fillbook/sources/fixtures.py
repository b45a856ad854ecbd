"""Domain tables derived from the driver's TPC-H-like tables.

The driver ships generic tables; the library works on markets, order fills,
ticks, equity curves and trade ledgers. These functions derive those from the
given tables with ordinary DataFrame expressions, so their size grows with the
input. The same definitions are written as SQL CTEs for DuckDB in
``fillbook.plans.oracle`` (they must stay in step).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fillbook.sources.tables import read_table
from fillbook.operators.scan import segmented_running


def _epoch(c: Column) -> Column:
    return F.unix_timestamp(c.cast("timestamp"))


def fx_markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Markets from ``part``: every 11th part missing, every 13th blank tokens,
    every 7th a single token."""
    p = read_table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    t1 = (2 * k + 1).cast("string")
    t2 = (2 * k + 2).cast("string")
    clob = (F.when(k % 13 == 0, F.lit(""))
            .when(k % 7 == 0, F.concat(F.lit('["'), t1, F.lit('"]')))
            .otherwise(F.concat(F.lit('["'), t1, F.lit('", "'), t2, F.lit('"]'))))
    return (p.where(k % 11 != 0)
            .select(F.concat(F.lit("0xm"), k.cast("string")).alias("id"),
                    clob.alias("clobTokenIds"),
                    F.col("p_name").alias("question"),
                    F.col("p_brand").alias("market_slug"),
                    (F.col("p_size") % 2 == 0).alias("closed")))


def fx_order_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The eight order-fill columns from ``lineitem``; status 'O' = maker pays USDC."""
    return _fills_from(_landed(spark, sf_dir), with_seq=False)


def fx_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trade ticks for ten markets from ``events``."""
    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").alias("seq"),
        F.concat(F.lit("m"), (F.col("user_id") % 10).cast("string")).alias("market_id"),
        F.col("ts").alias("timestamp"),
        (F.col("value") / F.lit(500.0)).alias("price"),
        F.col("value").alias("usd_amount"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("maker"),
        F.col("event_type"),
    )


# Rows per ordered segment of a running computation. Each segment is one
# window partition, so this bounds task memory whatever the key skew.
SEGMENT_ROWS = 1 << 20


def fx_equity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running account value per market, in whole cents (exact in any engine)."""
    t = fx_ticks(spark, sf_dir)
    cents = F.round((F.col("usd_amount") - 50) * 100).cast("bigint")
    t = t.select(F.col("market_id").alias("series"), "seq", F.col("timestamp").alias("ts"),
                 cents.alias("cents"), F.floor(F.col("seq") / SEGMENT_ROWS).alias("_seg"))
    t = segmented_running(t, ["series"], "_seg", ["seq"], "cents", "sum", "run_cents")
    return t.select("series", "seq", "ts",
                    ((F.lit(10000000) + F.col("run_cents")) / F.lit(1e2)).alias("value"))


def fx_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed trades per supplier from ``lineitem``."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("series"),
        F.col("l_shipdate").alias("closed_on"),
        F.when(F.col("l_returnflag") == "N", F.lit("short")).otherwise(F.lit("long")).alias("side"),
        F.col("l_quantity").cast("bigint").alias("bars"),
        F.round(F.col("l_extendedprice") * (F.col("l_discount") - 0.05) * 100)
        .cast("bigint").alias("pnl_cents"),
    )


def fx_missing_markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplement table (six text columns): the parts absent from
    ``fx_markets`` plus every 17th part again with other tokens, which must
    lose to the main table."""
    p = read_table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    mid = F.concat(F.lit("0xm"), k.cast("string"))
    t1 = (2 * k + 1).cast("string")
    t2 = (2 * k + 2).cast("string")
    clob = (F.when(k % 11 == 0, F.concat(F.lit('["'), t1, F.lit('", "'), t2, F.lit('"]')))
            .otherwise(F.concat(F.lit('["9'), t1, F.lit('", "9'), t2, F.lit('"]'))))
    return (p.where((k % 11 == 0) | (k % 17 == 0))
            .select(mid.alias("id"), clob.alias("clobTokenIds"), mid.alias("conditionId"),
                    F.col("p_name").alias("question"), F.col("p_brand").alias("slug"),
                    F.when(F.col("p_size") % 2 == 0, F.lit("True")).otherwise(F.lit("False"))
                    .alias("closed")))


# Stand-ins for configuration constants of the chain decode (fixed values).
FX_CONTRACT = "0x00000000000000000000000000000000000ec0de"
FX_OTHER_CONTRACT = "0x0000000000000000000000000000000000000bad"
FX_TOPIC0 = "0x" + "ab" * 32
FX_OTHER_TOPIC = "0x" + "cd" * 32


def _word(c: Column) -> Column:
    return F.lpad(F.hex(c), 64, "0")


def _landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` dealt out as a landed table of many files would be, where the
    driver's file is so small that a few tasks read it; a table of as many parts
    as there are cores is read as it lies."""
    li = read_table(spark, sf_dir, "lineitem")
    cores = spark.sparkContext.defaultParallelism
    return li if li.rdd.getNumPartitions() >= cores else li.repartition(cores)


def fx_raw_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw event logs encoding the fills of ``lineitem``: some from another
    contract (orderkey % 50 = 0), some another event (linenumber = 7), block
    numbers as hex or decimal text, hashes with or without ``0x``, token ids
    above 2^100 for orderkey % 3 = 0."""
    li = _landed(spark, sf_dir)
    is_o = F.col("l_linestatus") == "O"
    small = 2 * F.col("l_partkey") + 1 + F.col("l_linenumber") % 2
    usd = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    qty = F.col("l_quantity").cast("bigint") * 1000000
    ts = (_epoch(F.col("l_shipdate"))
          + (F.col("l_orderkey") * 37 + F.col("l_linenumber") * 11) % 86400)
    block = F.floor(ts / 2).cast("bigint")
    key = F.concat_ws("-", *[F.col(c).cast("string") for c in
                             ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")])
    high = F.when(F.col("l_orderkey") % 3 == 0, F.col("l_suppkey")).otherwise(F.lit(0))
    token_word = F.concat(F.lpad(F.hex(high), 39, "0"), F.lpad(F.hex(small), 25, "0"))
    data = F.concat(F.lit("0x"), _word(F.when(is_o, 0).otherwise(1)), token_word,
                    _word(F.when(is_o, usd).otherwise(qty)), _word(F.when(is_o, qty).otherwise(usd)),
                    _word(F.lit(0)), _word(F.lit(0)), _word(F.lit(0)))
    h = F.sha2(key, 256)
    return li.select(
        F.when(F.col("l_orderkey") % 2 == 0, F.concat(F.lit("0x"), F.lower(F.hex(block))))
        .otherwise(block.cast("string")).alias("block_number"),
        _log_index().alias("log_index"),
        F.when(F.col("l_linenumber") % 2 == 0, F.concat(F.lit("0x"), h)).otherwise(h)
        .alias("transaction_hash"),
        F.when(F.col("l_orderkey") % 50 == 0, F.lit(FX_OTHER_CONTRACT)).otherwise(F.lit(FX_CONTRACT))
        .alias("address"),
        F.array(F.when(F.col("l_linenumber") == 7, F.lit(FX_OTHER_TOPIC)).otherwise(F.lit(FX_TOPIC0)),
                F.concat(F.lit("0x"), F.sha2(F.concat(key, F.lit("#")), 256)),
                F.concat(F.lit("0x"), _word(F.col("l_suppkey"))),
                F.concat(F.lit("0x"), _word(F.col("l_orderkey") % 997))).alias("topics"),
        data.alias("data"))


def fx_raw_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Block headers for every landed block: timestamp = 2 x number."""
    li = read_table(spark, sf_dir, "lineitem")
    ts = (_epoch(F.col("l_shipdate"))
          + (F.col("l_orderkey") * 37 + F.col("l_linenumber") * 11) % 86400)
    b = li.select(F.floor(ts / 2).cast("bigint").alias("number")).distinct()
    return b.select("number", (F.col("number") * 2).alias("timestamp"))


def fx_market_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """API pages of 1000 markets from ``part`` (page = partkey div 1000):
    every 19th id blank, every 23rd null, every 13th without tokens, and every
    17th market repeated on the next page with another question (the first
    copy must win)."""
    p = read_table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    cid = (F.when(k % 19 == 0, F.lit("")).when(k % 23 == 0, F.lit(None))
           .otherwise(F.concat(F.lit("0xc"), k.cast("string"))))
    tok = F.struct(F.lit(None).cast("string").alias("token_id"), F.lit("x").alias("outcome"))
    tokens = (F.when(k % 13 == 0, F.lit(None).cast("array<struct<token_id:string,outcome:string>>"))
              .otherwise(F.array(
                  F.struct((2 * k + 1).cast("string").alias("token_id"), F.lit("Yes").alias("outcome")),
                  F.struct((2 * k + 2).cast("string").alias("token_id"), F.lit("No").alias("outcome")),
                  tok)))

    def market(question):
        return F.struct(cid.alias("condition_id"), tokens.alias("tokens"), question.alias("question"),
                        F.col("p_brand").alias("market_slug"), (F.col("p_size") % 2 == 0).alias("closed"),
                        F.concat(F.lit("i"), k.cast("string"), F.lit(".png")).alias("icon"),
                        F.struct((k % 7).alias("min"), F.array(k % 3, F.lit(2)).alias("rates")).alias("rewards"))
    first = p.select(F.floor(k / 1000).alias("page"), k.alias("pos"), market(F.col("p_name")).alias("m"))
    again = p.where(k % 17 == 0).select(
        (F.floor(k / 1000) + 1).alias("page"), (k - 1000000000).alias("pos"),
        market(F.concat(F.col("p_name"), F.lit(" (repeat)"))).alias("m"))
    items = first.unionByName(again)
    pages = items.groupBy("page").agg(F.sort_array(F.collect_list(F.struct("pos", "m"))).alias("items"))
    return pages.select((F.col("page") * 1000).alias("page_offset"),
                        F.transform("items", lambda x: x["m"]).alias("data"))


def fx_order_filled_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``fx_order_filled`` plus its ingest sequence (orderkey * 8 + linenumber)."""
    return _fills_from(_landed(spark, sf_dir), with_seq=True)


def fx_order_filled_identified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``fx_order_filled`` plus the identity of each fill, (block_number, log_index)."""
    li = read_table(spark, sf_dir, "lineitem")
    block = F.floor((_epoch(F.col("l_shipdate")) + (F.col("l_orderkey") * 37 + F.col("l_linenumber") * 11) % 86400) / 2)
    li = li.withColumns({"block_number": block.cast("bigint"), "log_index": _log_index()})
    return _fills_from(li, with_seq=False, extra=("block_number", "log_index"))


def _log_index() -> Column:
    """lineitem has no unique key: a log is identified by every column that varies."""
    return F.xxhash64("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                      "l_extendedprice", "l_linestatus", "l_shipdate").bitwiseAND(F.lit(0x7FFFFFFFFFFFFFFF))


def _fills_from(li: DataFrame, with_seq: bool, extra: tuple[str, ...] = ()) -> DataFrame:
    is_o = F.col("l_linestatus") == "O"
    token = (2 * F.col("l_partkey") + 1 + F.col("l_linenumber") % 2).cast("string")
    usd = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    qty = F.col("l_quantity").cast("bigint") * 1000000
    key = F.concat_ws("-", *[F.col(c).cast("string") for c in
                             ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")])
    seq = [(F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("ingest_seq")] if with_seq else []
    return li.select(
        *seq, *extra,
        (_epoch(F.col("l_shipdate"))
         + (F.col("l_orderkey") * 37 + F.col("l_linenumber") * 11) % 86400).alias("timestamp"),
        F.concat(F.lit("0xa"), F.col("l_suppkey").cast("string")).alias("maker"),
        F.when(is_o, F.lit("0")).otherwise(token).alias("makerAssetId"),
        F.when(is_o, usd).otherwise(qty).alias("makerAmountFilled"),
        F.concat(F.lit("0xb"), (F.col("l_orderkey") % 997).cast("string")).alias("taker"),
        F.when(is_o, token).otherwise(F.lit("0")).alias("takerAssetId"),
        F.when(is_o, qty).otherwise(usd).alias("takerAmountFilled"),
        F.concat(F.lit("0x"), F.sha2(key, 256)).alias("transactionHash"))
