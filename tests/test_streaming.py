"""Streams equal batches; restarts from a checkpoint do not duplicate."""

import datetime as dt
import random
import tempfile

from pyspark.sql import functions as F

from fillbook.operators.bars import ohlcv_bars
from fillbook.streaming import jobs as J


def _ticks(spark, n=600, seed=2):
    rnd = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    rows = [(i, f"m{i % 3}", base + dt.timedelta(seconds=7 * i), rnd.random(), rnd.random())
            for i in range(n)]
    return spark.createDataFrame(rows, "seq long, market_id string, timestamp timestamp_ntz, "
                                       "price double, usd_amount double")


def test_stream_bars_equal_batch(spark):
    t = _ticks(spark)
    src, out, ck = (tempfile.mkdtemp(prefix=p) for p in ("ticks-", "bars-", "ck-"))
    for h in (2, 0, 1):  # three deliveries, the latest first: all others are late
        t.where(F.floor(F.col("seq") / 200) == h).write.mode("append").parquet(src)
    stream = spark.readStream.schema(t.schema).option("maxFilesPerTrigger", 2).parquet(src)
    J.run_to_end(J.stream_bars(spark, stream, out, ck))
    got = J.latest_bars(spark.read.parquet(out))
    exp = ohlcv_bars(t)
    cols = ["market_id", "bar_start", "open", "high", "low", "close", "n_trades"]
    assert got.select(cols).exceptAll(exp.select(cols)).count() == 0
    assert exp.select(cols).exceptAll(got.select(cols)).count() == 0


def test_restart_does_not_duplicate(spark):
    t = _ticks(spark, 300)
    src, out, ck = (tempfile.mkdtemp(prefix=p) for p in ("in-", "out-", "ck-"))
    t.where("seq < 150").write.mode("append").parquet(src)
    stream = lambda: spark.readStream.schema(t.schema).parquet(src)
    for _ in range(2):
        J.run_to_end(J.start(stream(), J.batch_writer(out), ck))
    t.where("seq >= 150").write.mode("append").parquet(src)
    J.run_to_end(J.start(stream(), J.batch_writer(out), ck))
    assert spark.read.parquet(out).count() == 300


def test_crash_mid_batch_replays_without_duplicates(spark):
    """The first attempt writes part of batch 0 and dies; the restart replays
    batch 0 into the same folder (overwrite), so nothing is doubled."""
    t = _ticks(spark, 300)
    src, out, ck, flag = (tempfile.mkdtemp(prefix=p) for p in ("in-", "out-", "ck-", "flag-"))
    t.write.mode("append").parquet(src)
    import os
    marker = os.path.join(flag, "crashed")
    write_ok = J.batch_writer(out)

    def flaky(batch, batch_id):
        if not os.path.exists(marker):
            open(marker, "w").close()
            batch.limit(10).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
            raise RuntimeError("simulated executor loss")
        write_ok(batch, batch_id)

    stream = lambda: spark.readStream.schema(t.schema).parquet(src)
    import pytest
    from pyspark.errors import StreamingQueryException
    with pytest.raises(StreamingQueryException):
        J.start(stream(), flaky, ck).awaitTermination()
    J.run_to_end(J.start(stream(), flaky, ck))
    got = spark.read.parquet(out).drop("batch_id")
    assert got.count() == 300
    assert got.exceptAll(t).count() == 0


def test_stream_fills_stats_add_up(spark):
    from fillbook.sources import fixtures as X
    from tests.conftest import SF001
    src, out, ck, stats = (tempfile.mkdtemp(prefix=p) for p in ("logs-", "fills-", "ck-", "stats-"))
    logs = X.fx_raw_logs(spark, SF001)
    for part in range(2):
        logs.where((F.col("log_index") % 2) == part).write.mode("append").parquet(src)
    J.run_to_end(J.stream_fills(spark, src, X.fx_raw_blocks(spark, SF001), X.FX_CONTRACT, X.FX_TOPIC0,
                                out, ck, stats_path=stats))
    total = spark.read.parquet(stats).agg(F.sum("rows_written")).first()[0]
    assert total == spark.read.parquet(out).count() > 0


def test_stream_markets_incremental(spark):
    """Two deliveries with overlapping pages: every market stored once; a
    re-run on the same checkpoint adds nothing."""
    from fillbook.sources import fixtures as X
    from tests.conftest import SF001
    src, out, ck = (tempfile.mkdtemp(prefix=p) for p in ("pages-", "mk-", "ck-"))
    pages = X.fx_market_pages(spark, SF001)
    pages.where("page_offset <= 0").write.mode("append").json(src)
    J.run_to_end(J.stream_markets(spark, src, out, ck))
    pages.write.mode("append").json(src)      # re-delivers page 0 plus the rest
    J.run_to_end(J.stream_markets(spark, src, out, ck))
    J.run_to_end(J.stream_markets(spark, src, out, ck))
    from fillbook.sources.markets import markets_from_pages
    got = spark.read.parquet(out)
    exp = markets_from_pages(pages)
    assert got.count() == got.select("id").distinct().count() == exp.count()


def test_new_logs_are_kept_however_late_and_replays_dropped(spark):
    """A first-time log far behind the newest block stays; a replayed one,
    whatever its spelling, goes; a batch that runs again changes nothing."""
    from fillbook.sources import chain as C
    src, out, ck = (tempfile.mkdtemp(prefix=p) for p in ("logs-", "new-", "ck-"))
    log = lambda block, i, style=str: (style(block), i, "h", "0xa", ["t"], "0x")
    deliveries = [[log(90_000_000, 1), log(90_000_000, 1, hex), log(90_000_000, 2)],
                  [log(90_000_000, 2), log(7, 1), log(90_000_001, 1)],
                  [log(7, 1, hex), log(7, 2), log(90_000_000, 1)]]
    for rows in deliveries:
        spark.createDataFrame(rows, C.RAW_LOG).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(C.RAW_LOG).parquet(src)
        J.run_to_end(J.stream_new_logs(stream, out, ck))
    got = [(int(r.block_number, 0), r.log_index, r.batch_id) for r in spark.read.parquet(out).collect()]
    assert sorted(got) == [(7, 1, 1), (7, 2, 2), (90_000_000, 1, 0), (90_000_000, 2, 0), (90_000_001, 1, 1)]
    assert spark.read.parquet(f"{out}_seen").count() == 5


def test_bars_are_compacted_and_looked_back(spark):
    """Thirteen batches, merged by threes: few folders hold each part once, the
    look-back table holds the latest bars, and late ticks reach both."""
    t = _ticks(spark, 650)
    src, out, ck = (tempfile.mkdtemp(prefix=p) for p in ("ticks-", "bars-", "ck-"))
    order = [5, 0, 1, 2, 3, 4, 6, 7, 8, 9, 10, 12, 11]
    for k in order:
        t.where(F.floor(F.col("seq") / 50) == k).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(t.schema).parquet(src)
        J.run_to_end(J.stream_bars(spark, stream, out, ck, keep=4, every=3))
    assert J.live_folders(13, 3) == [(2, 8), (1, 11), (0, 12)]
    cols = ["market_id", "bar_start", "open", "high", "low", "close", "n_trades"]
    exp = ohlcv_bars(t).select(cols)
    got = J.latest_bars(J.live_parts(spark, out)).select(cols)
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0
    last, want = J.live_lookback(spark, out).select(cols), J.lookback(exp, 4)
    assert last.exceptAll(want).count() == 0 and want.exceptAll(last).count() == 0


def test_live_folders_hold_each_batch_once():
    for every in (2, 3, 8):
        for n in range(1, 200):
            at = 0
            for level, last in J.live_folders(n, every):
                at += every ** level
                assert last == at - 1 and (last + 1) % every ** level == 0
            assert at == n and len(J.live_folders(n, every)) <= (every - 1) * 9


def test_cursors_of_consumers(spark):
    from fillbook.streaming.live import changes_since, commit, cursor
    path = tempfile.mkdtemp(prefix="cur-") + "/c"
    rows = spark.range(10).withColumnRenamed("id", "idx")
    assert cursor(spark, path, "a") == -1
    new, upto = changes_since(rows.where("idx < 4"), path, "a")
    assert new.count() == 4 and upto == 3
    assert changes_since(rows.where("idx < 4"), path, "a")[1] == 3  # not committed: seen again
    commit(spark, path, "a", upto)
    commit(spark, path, "a", upto)
    new, upto = changes_since(rows, path, "a")
    assert [r.idx for r in new.orderBy("idx").collect()] == [4, 5, 6, 7, 8, 9] and upto == 9
    assert changes_since(rows, path, "b")[0].count() == 10 and cursor(spark, path, "a") == 3
    commit(spark, path, "a", upto)
    assert changes_since(rows, path, "a")[0].count() == 0


def test_a_batch_that_writes_nothing_is_observed(spark):
    """All logs lie above the head: the stats row says zero."""
    from fillbook.sources import chain as C
    from fillbook.sources import fixtures as X
    from tests.conftest import SF001
    src, out, ck, stats = (tempfile.mkdtemp(prefix=p) for p in ("logs-", "fills-", "ck-", "stats-"))
    X.fx_raw_logs(spark, SF001).limit(50).write.mode("append").parquet(src)
    blocks = spark.createDataFrame([(5, 10)], C.RAW_BLOCK)
    J.run_to_end(J.stream_fills(spark, src, blocks, X.FX_CONTRACT, X.FX_TOPIC0, out, ck, stats_path=stats))
    assert [(r.rows_written, r.first_ts, r.last_ts) for r in spark.read.parquet(stats).collect()] == [(0, None, None)]


def _logs_of(spark, keys):
    rows = [(str(b), i, "0x" + f"{b:064x}", ["0x" + "ab" * 32, None], "x") for b, i in keys]
    return spark.createDataFrame(rows, "block_number string, log_index long, transaction_hash string, topics array<string>, data string")


def test_rows_without_repeats_do_not_move(spark):
    key = ["block_number", "log_index"]
    rows, seen = _logs_of(spark, [(1, 1), (1, 2), (2, 1)]), _logs_of(spark, [(9, 9)])
    fresh = J._first_time(rows, key, seen)
    assert fresh.orderBy(*key).collect() == rows.orderBy(*key).collect()
    assert "Exchange" not in fresh._jdf.queryExecution().executedPlan().toString()


def test_repeats_and_seen_rows_go(spark):
    key = ["block_number", "log_index"]
    rows, seen = _logs_of(spark, [(1, 1), (1, 1), (1, 2), (2, 1), (3, 1)]), _logs_of(spark, [(2, 1), (9, 9)])
    assert J._first_time(rows, key, seen).orderBy(*key).collect() == _logs_of(spark, [(1, 1), (1, 2), (3, 1)]).collect()
    assert J._first_time(rows, key, None).count() == 4


def test_landed_slices_have_a_bounded_number_of_files(spark):
    from fillbook.plans.catalog_stream import land_slices
    path = tempfile.mkdtemp(prefix="slices-") + "/t"
    many = 3 * spark.sparkContext.defaultParallelism
    land_slices(spark.range(0, 100 * many, 1, many).withColumn("s", F.col("id") % 2), path, F.col("s"), [0, 1])
    got = spark.read.parquet(path)
    assert got.count() == 100 * many and len(got.inputFiles()) <= 2 * spark.sparkContext.defaultParallelism


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f.getName() for f in (files.apply(i) for i in range(files.size())) if f.getName().startswith("shuffle_")}


def _left(spark, before):
    """Exchange files made since ``before``, once the removal, which is not waited for, is through."""
    import time
    for _ in range(50):
        if not (more := _shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    return more


def _no_persist(monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    def refuse(self, *a):
        raise AssertionError("a batch is kept")
    for name in ("persist", "cache"):
        monkeypatch.setattr(DataFrame, name, refuse)


def _writes(path):
    """Write jobs whose files lie under ``path``, by the id that each puts into its files' names."""
    import pathlib
    import re
    return {re.search(r"part-\d+-([0-9a-f-]{36})", p.name)[1] for p in pathlib.Path(path).rglob("part-*")}


def test_unknown_trades_are_labelled_again_in_portions(spark, monkeypatch):
    """No exchange is left to the reader, and portions give the rows that one pass gives."""
    from fillbook import session as S
    from fillbook.operators.label import label_trades
    fills = spark.range(400).select(
        F.col("id").alias("timestamp"), F.lit("m").alias("maker"), F.lit("0").alias("makerAssetId"), (F.col("id") + 1).alias("makerAmountFilled"),
        F.lit("t").alias("taker"), (F.col("id") % 7).cast("string").alias("takerAssetId"), F.lit(5).cast("long").alias("takerAmountFilled"),
        F.sha2(F.col("id").cast("string"), 256).alias("transactionHash"), F.floor(F.col("id") / 3).alias("block_number"), (F.col("id") % 3).alias("log_index"))
    some = spark.createDataFrame([("a", "1", "2")], "id string, token1 string, token2 string")
    full = spark.createDataFrame([("a", "1", "2"), ("b", "3", "4")], some.schema)
    path = tempfile.mkdtemp(prefix="trades-") + "/t"
    label_trades(fills, some, keep=J.FILL_ID).write.parquet(path)
    want = label_trades(fills, full, keep=J.FILL_ID)
    for rows in (1 << 25, 90):
        monkeypatch.setattr(S, "PORTION_ROWS", rows, raising=False)
        before = _shuffle_files(spark)
        got = J.relabel_unknown(spark.read.parquet(path), fills, full)
        assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString() and not _left(spark, before)
        assert got.count() == 400 and got.exceptAll(want.select(got.columns)).count() == 0


def test_label_batches_are_not_kept(spark, monkeypatch):
    _no_persist(monkeypatch)
    src, out, ck, miss = (tempfile.mkdtemp(prefix=p) for p in ("fills-", "trades-", "ck-", "missing-"))
    rows = [(60, "m", "0", 5, "t", "71", 7, "0xab", 1, i) for i in range(4)]
    fills = spark.createDataFrame(rows, "timestamp long, maker string, makerAssetId string, makerAmountFilled long, taker string, "
                                        "takerAssetId string, takerAmountFilled long, transactionHash string, block_number long, log_index long")
    markets = spark.createDataFrame([("a", "1", "2")], "id string, token1 string, token2 string")
    before = _shuffle_files(spark)
    for _ in range(2):  # the second delivery repeats the first
        fills.repartition(3).write.mode("append").parquet(src)
        before |= _shuffle_files(spark)
        stream = spark.readStream.schema(fills.schema).parquet(src)
        J.run_to_end(J.stream_label(spark, stream, lambda: markets, out, ck, missing_path=miss, identity=J.FILL_ID))
        assert spark.read.parquet(out).count() == 4
    assert [r.asset_id for r in spark.read.parquet(miss).select("asset_id").distinct().collect()] == ["71"]


def test_fills_are_settled_in_portions_and_not_kept(spark, monkeypatch):
    """A batch as large as all that has landed: it is neither cached nor joined at once."""
    from fillbook import session as S
    from fillbook.sources import fixtures as X
    from tests.conftest import SF001
    logs, blocks = X.fx_raw_logs(spark, SF001), X.fx_raw_blocks(spark, SF001)
    src = tempfile.mkdtemp(prefix="logs-")
    logs.write.mode("append").parquet(src)
    got = []
    _no_persist(monkeypatch)
    for rows in (1 << 25, 1000):
        monkeypatch.setattr(S, "PORTION_ROWS", rows, raising=False)
        out, ck, stats = (tempfile.mkdtemp(prefix=p) for p in ("fills-", "ck-", "stats-"))
        J.run_to_end(J.stream_fills(spark, src, blocks, X.FX_CONTRACT, X.FX_TOPIC0, out, ck, stats_path=stats))
        got.append((spark.read.parquet(out), spark.read.parquet(stats).collect(), len(_writes(out))))
    (one, stats_one, writes_one), (many, stats_many, writes_many) = got
    assert writes_one == 1 and writes_many >= 5 and stats_one == stats_many and one.count() == stats_one[0].rows_written > 0
    assert one.exceptAll(many).count() == 0 and many.exceptAll(one).count() == 0


def test_new_logs_go_in_portions_and_are_not_kept(spark, monkeypatch):
    from fillbook import session as S
    _no_persist(monkeypatch)
    monkeypatch.setattr(S, "PORTION_ROWS", 10, raising=False)
    src, out, ck = (tempfile.mkdtemp(prefix=p) for p in ("logs-", "new-", "ck-"))
    first = [(b, i) for b in range(10) for i in range(4)]
    for keys in (first + first[:5], first[20:] + [(b, 9) for b in range(8, 12)]):
        _logs_of(spark, keys).write.mode("append").parquet(src)
        J.run_to_end(J.stream_new_logs(spark.readStream.schema(_logs_of(spark, keys).schema).parquet(src), out, ck, blocks_per_range=2))
    got = sorted((int(r.block_number), r.log_index) for r in spark.read.parquet(out).collect())
    assert got == sorted(first + [(b, 9) for b in range(8, 12)]) and spark.read.parquet(f"{out}_seen").count() == len(got)
    assert len(_writes(f"{out}/batch_id=0")) > 2


def test_whole_rows_move_in_mixed_parts_only(spark):
    """A replayed range goes and a new one stays without an exchange."""
    key, part = ["block_number", "log_index"], F.floor(F.col("block_number").cast("long") / 10)
    seen = _logs_of(spark, [(1, 1), (2, 1), (25, 1)])
    rows = _logs_of(spark, [(1, 1), (2, 1), (2, 1), (11, 1), (12, 1)])
    fresh = J._first_time(rows, key, seen, part)
    assert fresh.orderBy(*key).collect() == _logs_of(spark, [(11, 1), (12, 1)]).orderBy(*key).collect()
    assert "Exchange" not in fresh._jdf.queryExecution().executedPlan().toString()
    more = J._first_time(_logs_of(spark, [(11, 1), (21, 1), (21, 1), (25, 1), (1, 1)]), key, seen, part)
    assert sorted((r.block_number, r.log_index) for r in more.collect()) == [("11", 1), ("21", 1)]
    odd = _logs_of(spark, [(1, 1)]).withColumn("block_number", F.lit(None).cast("string"))  # a key with a null was never seen
    assert J._first_time(odd.unionByName(odd), key, odd.unionByName(seen), part).count() == 1
