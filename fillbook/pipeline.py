"""Thin job driver: markets -> chain -> process -> backfill, over landed files.

Each step is a Spark job (or an availableNow stream) over a shared root:

  <root>/landing/market_pages/   JSON pages (page_offset, data[])
  <root>/landing/logs/           raw logs (parquet, RAW_LOG schema)
  <root>/landing/blocks/         block headers (parquet, RAW_BLOCK schema)
  <root>/landing/supplements/    fetched supplement payloads (JSON: fetch_seq, body)
  <root>/data/markets/           markets table (parquet, appended)
  <root>/data/missing_markets/   supplement table (parquet, optional)
  <root>/data/order_filled/      decoded fills (per-batch folders)
  <root>/processed/trades/       labelled trades (per-batch folders)
  <root>/processed/missing_tokens/

Stream checkpoints go under ``<root>/_checkpoints``. Any failing step stops the run.
Usage: python -m fillbook.pipeline ROOT [markets|chain|process|backfill|all]
       [--contract 0x..] [--topic0 0x..]
"""

from __future__ import annotations

import argparse
import os
import sys

from functools import reduce

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from fillbook.operators.label import label_trades
from fillbook.session import get_session
from fillbook.sources import chain as C
from fillbook.sources.markets import load_markets, supplement_merge
from fillbook.streaming import jobs as J


def _ckpt(root: str, name: str) -> str:
    """Stream checkpoints live with the data they describe (shared storage),
    so two pipelines never share offsets."""
    return f"{root}/_checkpoints/{name}"


def update_markets(spark: SparkSession, root: str) -> int:
    """Page files landed since the last run -> markets not stored yet. Returns rows added."""
    out = f"{root}/data/markets"
    stored = lambda: spark.read.parquet(out).count() if J.path_exists(spark, out) else 0
    before = stored()
    J.run_to_end(J.stream_markets(spark, f"{root}/landing/market_pages", out, _ckpt(root, "markets")))
    return stored() - before


def update_chain(spark: SparkSession, root: str, contract: str, topic0: str) -> None:
    """Decode every landed log not yet processed (checkpointed stream)."""
    blocks = lambda: C.read_blocks(spark, f"{root}/landing/blocks")
    out = f"{root}/data/order_filled"
    J.run_to_end(J.stream_fills(spark, f"{root}/landing/logs", blocks, contract, topic0, out, _ckpt(root, "chain")))
    J.release_pending(spark, blocks, out)


def _markets(spark: SparkSession, root: str):
    """Stored markets, then supplements, as they are now. Page batches come in
    the order of their ids, so an earlier one wins."""
    main = spark.read.parquet(f"{root}/data/markets").withColumnRenamed("batch_id", "_ingest_seq")
    frames = [main]
    if J.path_exists(spark, f"{root}/data/missing_markets"):
        frames.append(spark.read.parquet(f"{root}/data/missing_markets").withColumn("_ingest_seq", F.lit(0)))
    return load_markets(frames, lean=True)


def process(spark: SparkSession, root: str) -> None:
    """Label fills not yet labelled; markets are re-read for every batch."""
    fills_path = f"{root}/data/order_filled"
    schema = spark.read.parquet(fills_path).schema
    stream = spark.readStream.schema(schema).parquet(fills_path).select(*C.FILL_COLUMNS, *J.FILL_ID)
    q = J.stream_label(spark, stream, lambda: _markets(spark, root), f"{root}/processed/trades", _ckpt(root, "process"),
                       missing_path=f"{root}/processed/missing_tokens", identity=J.FILL_ID)
    J.run_to_end(q)


def backfill(spark: SparkSession, root: str) -> int:
    """Store landed supplement payloads and label again the trades that lacked
    a market. Only the trade partitions that change are rewritten. Returns the
    number of trades that found their market."""
    landed, store, trades_path = f"{root}/landing/supplements", f"{root}/data/missing_markets", f"{root}/processed/trades"
    if not (J.path_exists(spark, landed) and J.path_exists(spark, trades_path)):
        return 0
    payloads = spark.read.schema("fetch_seq long, body string").json(landed)
    known = [spark.read.parquet(p).select("id") for p in (f"{root}/data/markets", store) if J.path_exists(spark, p)]
    have = reduce(lambda a, b: a.unionByName(b), known, spark.createDataFrame([], "id string"))
    supplement_merge(have, payloads).write.mode("append").parquet(store)

    trades = spark.read.parquet(trades_path)
    part, ids = ["batch_id", "trade_date"], list(J.FILL_ID)
    unknown = trades.where(F.col("market_id").isNull()).select(*part, *ids)
    fills = spark.read.parquet(f"{root}/data/order_filled").drop("batch_id").dropDuplicates(ids)
    found = label_trades(fills.join(unknown, ids, "left_semi"), _markets(spark, root), keep=J.FILL_ID)
    found = found.where(F.col("market_id").isNotNull()).join(unknown, ids).select(*trades.columns).checkpoint()
    changed = trades.join(found.select(*part).distinct(), part, "left_semi").join(found.select(*ids), ids, "left_anti")
    changed.select(*trades.columns).unionByName(found).checkpoint().write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy(*part).parquet(trades_path)
    return found.count()


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="fillbook.pipeline")
    ap.add_argument("root")
    ap.add_argument("step", nargs="?", default="all", choices=["markets", "chain", "process", "backfill", "all"])
    ap.add_argument("--contract", default=os.environ.get("FILLBOOK_CONTRACT", ""))
    ap.add_argument("--topic0", default=os.environ.get("FILLBOOK_TOPIC0", ""))
    a = ap.parse_args(argv)
    spark = get_session()
    steps = ["markets", "chain", "process", "backfill"] if a.step == "all" else [a.step]
    for s in steps:
        if s == "markets":
            print(f"markets: +{update_markets(spark, a.root)} rows")
        elif s == "chain":
            if not (a.contract and a.topic0):
                raise SystemExit("chain step needs --contract and --topic0")
            update_chain(spark, a.root, a.contract, a.topic0)
        elif s == "process":
            process(spark, a.root)
        else:
            print(f"backfill: {backfill(spark, a.root)} trades")
    return 0


if __name__ == "__main__":
    sys.exit(main())
