"""End to end: landed pages + logs -> markets -> fills -> trades, twice (no duplicates)."""

import json
import tempfile

from pyspark.sql import functions as F

from fillbook import pipeline as P
from fillbook.sources import chain as C
from fillbook.sources import fixtures as X
from tests.conftest import SF001


def test_pipeline_end_to_end(spark):
    root = tempfile.mkdtemp(prefix="pipe-")
    pages = X.fx_market_pages(spark, SF001)
    pages.write.json(f"{root}/landing/market_pages")
    X.fx_raw_logs(spark, SF001).write.parquet(f"{root}/landing/logs")
    X.fx_raw_blocks(spark, SF001).write.parquet(f"{root}/landing/blocks")
    added = P.update_markets(spark, root)
    assert added > 0
    assert P.update_markets(spark, root) == 0          # re-run adds nothing
    P.update_chain(spark, root, X.FX_CONTRACT, X.FX_TOPIC0)
    P.process(spark, root)
    P.update_chain(spark, root, X.FX_CONTRACT, X.FX_TOPIC0)   # nothing new
    P.process(spark, root)
    fills = spark.read.parquet(f"{root}/data/order_filled")
    trades = spark.read.parquet(f"{root}/processed/trades")
    assert trades.count() == fills.count() > 0
    # page markets are '0xc<k>' with tokens 2k+1 / 2k+2: some fills must match
    assert trades.where(F.col("market_id").isNotNull()).count() > 0


def test_held_back_blocks_and_replays(spark):
    """Two runs with a moving head, a replayed decode batch, then a run without
    news: every block up to the head - 20 is a fill and a trade exactly once."""
    root = tempfile.mkdtemp(prefix="steps-")
    X.fx_market_pages(spark, SF001).write.json(f"{root}/landing/market_pages")
    P.update_markets(spark, root)
    word = lambda n: format(n, "064x")
    for run in range(2):
        numbers = range(1 + 100 * run, 101 + 100 * run)
        logs = [(str(n), 0, word(n), X.FX_CONTRACT, [X.FX_TOPIC0, "0x1", "0x" + word(1), "0x" + word(2)],
                 "0x" + "".join(map(word, (0, n, 5, 10, 0, 0, 0)))) for n in numbers]
        spark.createDataFrame(logs, C.RAW_LOG).write.mode("append").parquet(f"{root}/landing/logs")
        spark.createDataFrame([(n, 2 * n) for n in numbers], C.RAW_BLOCK).write.mode("append").parquet(f"{root}/landing/blocks")
        P.update_chain(spark, root, X.FX_CONTRACT, X.FX_TOPIC0)
        P.process(spark, root)
    again = spark.read.parquet(f"{root}/data/order_filled/batch_id=0").checkpoint()
    again.write.mode("overwrite").parquet(f"{root}/data/order_filled/batch_id=0")  # new file names, same fills
    spark.createDataFrame([(205, 410)], C.RAW_BLOCK).write.mode("append").parquet(f"{root}/landing/blocks")
    P.update_chain(spark, root, X.FX_CONTRACT, X.FX_TOPIC0)
    P.process(spark, root)
    for path in ("data/order_filled", "processed/trades"):
        got = sorted(x.block_number for x in spark.read.parquet(f"{root}/{path}").collect())
        assert got == list(range(1, 186)), path


def test_backfill_labels_again(spark):
    root = tempfile.mkdtemp(prefix="fill-")
    X.fx_market_pages(spark, SF001).write.json(f"{root}/landing/market_pages")
    P.update_markets(spark, root)
    rows = [(i, 0, 60 * i, "m", "0", 5, "t", token, 10, "same") for i, token in ((1, "3"), (2, "7000001"), (2, "7000002"))]
    rows[2] = (2, 1, *rows[2][2:])  # two fills of one transaction and the same parties
    cols = "block_number long, log_index long, timestamp long, maker string, makerAssetId string, makerAmountFilled long, " \
           "taker string, takerAssetId string, takerAmountFilled long, transactionHash string"
    spark.createDataFrame(rows, cols).write.parquet(f"{root}/data/order_filled/batch_id=0")
    P.process(spark, root)
    assert P.backfill(spark, root) == 0
    body = json.dumps({"markets": [{"conditionId": "late", "clobTokenIds": json.dumps(["7000001", "1"])}]})
    spark.createDataFrame([(0, body)], "fetch_seq long, body string").write.json(f"{root}/landing/supplements")
    assert [P.backfill(spark, root) for _ in range(2)] == [1, 0]
    got = {(x.block_number, x.log_index): x.market_id for x in spark.read.parquet(f"{root}/processed/trades").collect()}
    assert got == {(1, 0): "0xc1", (2, 0): "late", (2, 1): None}
    assert spark.read.parquet(f"{root}/processed/trades").count() == 3


def test_pipeline_cli(spark):
    import pytest
    root = tempfile.mkdtemp(prefix="cli-")
    X.fx_market_pages(spark, SF001).write.json(f"{root}/landing/market_pages")
    assert P.main([root, "markets"]) == 0
    assert spark.read.parquet(f"{root}/data/markets").count() > 0
    with pytest.raises(SystemExit):
        P.main([root, "chain"])          # contract / topic are required
