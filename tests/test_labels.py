"""Labelled trades against a plain reading of who paid what."""

import random
import tempfile

import pytest
from pyspark.sql import functions as F

from fillbook.operators.label import TRADE_COLUMNS, join_fills_markets, label_trades
from fillbook.sources.files import append_trades, read_trades

FILL = ("timestamp long, maker string, makerAssetId string, makerAmountFilled long, taker string, "
        "takerAssetId string, takerAmountFilled long, transactionHash string")
MARKETS = [("north", "71", "72"), ("south", "81", None)]
SIDES = {"71": ("north", "token1"), "72": ("north", "token2"), "81": ("south", "token1")}

# Fixed values of the labelling contract: 3.4 of collateral for 5 tokens is a price of 0.68.
CASH, TOKENS, PRICE = 3_400_000, 5_000_000, 0.68


def fills_of(spark, rows):
    """rows: (maker asset, maker amount, taker asset, taker amount); the hash is the row's number."""
    return spark.createDataFrame(
        [(60 * i, f"m{i}", a, x, f"t{i}", b, y, str(i)) for i, (a, x, b, y) in enumerate(rows)], FILL)


def markets_of(spark, rows=tuple(MARKETS)):
    return spark.createDataFrame(list(rows), "id string, token1 string, token2 string")


def expected(maker_asset, maker_amount, taker_asset, taker_amount):
    token = taker_asset if maker_asset == "0" else maker_asset
    market, side = SIDES.get(token, (None, None))
    taker_buys = taker_asset == "0"
    cash, tokens = (taker_amount, maker_amount) if taker_buys else (maker_amount, taker_amount)
    shown = maker_amount if market is None and not taker_buys else tokens  # the unknown market's quirk
    return (market, side, "SELL" if taker_buys else "BUY", "BUY" if taker_buys else "SELL",
            cash / tokens if tokens else None, cash / 1e6, shown / 1e6)


def test_random_fills_follow_the_contract(spark):
    r = random.Random(8)
    rows = [("0", CASH, "71", TOKENS), ("72", TOKENS, "0", CASH), ("0", 5, "71", 0), ("0", CASH, "999", TOKENS)]
    for _ in range(200):
        legs = [("0", r.randrange(1, 10**9)), (r.choice(["71", "72", "81", "999"]), r.randrange(0, 10**9))]
        r.shuffle(legs)
        rows.append((*legs[0], *legs[1]))
    got = label_trades(fills_of(spark, rows), markets_of(spark))
    assert got.columns == TRADE_COLUMNS
    for x in got.collect():
        want = expected(*rows[int(x.transactionHash)])
        have = (x.market_id, x.nonusdc_side, x.maker_direction, x.taker_direction, x.price, x.usd_amount, x.token_amount)
        assert have[:4] == want[:4] and have[4:] == pytest.approx(want[4:]), rows[int(x.transactionHash)]
    first = got.where("transactionHash = '0'").first()
    assert (first.price, first.usd_amount, first.token_amount) == pytest.approx((PRICE, 3.4, 5.0))


def test_strict_token_leg_and_times(spark):
    got = label_trades(fills_of(spark, [("0", CASH, "999", TOKENS)]), markets_of(spark), strict_amounts=True).first()
    assert got.token_amount == pytest.approx(5.0) and got.market_id is None
    late = fills_of(spark, [("0", 1, "71", 1)]).withColumn("timestamp", F.lit(1_700_000_000).cast("long"))
    assert str(label_trades(late, markets_of(spark)).first().timestamp) == "2023-11-14 22:13:20"


def test_a_token_of_two_markets_gives_two_trades(spark):
    twice = markets_of(spark, [("p", "71", None), ("q", "5", "71")])
    assert {x.market_id for x in label_trades(fills_of(spark, [("0", 1, "71", 1)]), twice).collect()} == {"p", "q"}


def test_append_trades_rerun_is_idempotent(spark):
    t = label_trades(fills_of(spark, [("0", CASH, "71", TOKENS)]), markets_of(spark))
    d = tempfile.mkdtemp(prefix="trades-")
    for run in ("r1", "r1", "r2"):  # the same run again, then another
        append_trades(t, d, run_id=run)
    assert read_trades(spark, d).count() == 2


def test_few_files_per_date_and_splitting_csv(spark):
    """A write makes about one file per date; a flat CSV file is read by several tasks."""
    import os
    from fillbook.sources.files import read_fills_csv, write_fills_csv
    fills = fills_of(spark, [("0", CASH, "71", TOKENS)] * 3000).withColumn("timestamp", F.col("timestamp") * 20).repartition(6)
    d = tempfile.mkdtemp(prefix="files-")
    append_trades(label_trades(fills, markets_of(spark)), f"{d}/trades", "r")
    files = [f for at, _, names in os.walk(f"{d}/trades") for f in names if f.endswith(".parquet")]
    dates = [x for x in os.listdir(f"{d}/trades/run_id=r") if x.startswith("trade_date=")]
    assert len(dates) == 42 and len(files) <= 2 * len(dates)
    write_fills_csv(fills.coalesce(1), f"{d}/csv")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        back = read_fills_csv(spark, f"{d}/csv")
        assert back.rdd.getNumPartitions() > 3 and back.exceptAll(fills).count() == 0 and back.count() == 3000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_packed_hex_comes_back_as_it_was(spark):
    from fillbook.functions import hexcodec as H
    texts = ["0x" + "ab" * 32, "ab" * 32, "0xAB", "AB", "0xabc", "abc", "", "0x", "0xzz", "é\n", "ab\n", " ab", None]
    rows = spark.createDataFrame([(i, x, [x, "0xcd", None]) for i, x in enumerate(texts)],
                                 "i long, transactionHash string, topics array<string>")
    moved = H.packed(rows)
    assert H.unpacked(moved).orderBy("i").collect() == rows.orderBy("i").collect()
    assert len(moved.where("i = 0").first().transactionHash) == 33


def test_fills_move_with_their_hashes_as_bytes_and_one_plan(spark):
    """Few markets give the plan that many do: a shuffled hash join."""
    j = join_fills_markets(fills_of(spark, [("0", CASH, "71", TOKENS)]), markets_of(spark))
    j.collect()
    plan = j._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "BroadcastHashJoin" not in plan and "unhex" in plan


def test_a_large_append_goes_in_portions_of_dates(spark, monkeypatch):
    from fillbook import session as S
    from tests.test_streaming import _left, _shuffle_files, _writes
    fills = fills_of(spark, [("0", CASH, "71", TOKENS)] * 300).withColumn("timestamp", F.when(F.col("timestamp") > 0, F.col("timestamp") * 30))
    trades = label_trades(fills, markets_of(spark))
    d = tempfile.mkdtemp(prefix="dates-")
    monkeypatch.setattr(S, "PORTION_ROWS", 100, raising=False)
    before = _shuffle_files(spark)
    for _ in range(2):  # a run again replaces its output
        append_trades(trades, d, "r")
    assert len(_writes(d)) >= 3 and not _left(spark, before)
    back = read_trades(spark, d)
    assert back.count() == 300 and back.select(trades.columns).exceptAll(trades).count() == 0
    assert back.where("trade_date is null").count() == 1
    dates = [f"{x.trade_date}" for x in back.select("trade_date").distinct().collect()]
    assert len(dates) == 8


def test_a_compressed_export_reads_back(spark):
    import gzip
    import os
    from fillbook.sources.files import export_trades_csv, read_trades_csv
    from tests.test_streaming import _left, _shuffle_files
    trades = label_trades(fills_of(spark, [("0", CASH, "71", TOKENS), ("72", TOKENS, "0", CASH), ("0", 5, "999", 0)]), markets_of(spark))
    d, before = tempfile.mkdtemp(prefix="csv-"), _shuffle_files(spark)
    export_trades_csv(trades, f"{d}/gz", compression="gzip")
    assert not _left(spark, before)
    files = [f"{d}/gz/{f}" for f in os.listdir(f"{d}/gz") if f.startswith("part-")]
    assert files and all(f.endswith(".csv.gz") and gzip.open(f, "rt").readline().strip() == ",".join(TRADE_COLUMNS) for f in files)
    export_trades_csv(trades, f"{d}/plain")
    assert all(f.endswith(".csv") for f in os.listdir(f"{d}/plain") if f.startswith("part-"))
    for p in ("gz", "plain"):
        back = read_trades_csv(spark, f"{d}/{p}")
        assert back.count() == 3 and back.exceptAll(trades).count() == 0
