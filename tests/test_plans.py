"""Physical-plan properties the design relies on (checked on sf0.001)."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from fillbook.operators import scan
from fillbook.operators.scan import segmented_running
from tests.conftest import SF001


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _read_schemas(df) -> list[str]:
    return re.findall(r"ReadSchema: (struct<[^>]*>)", _plan(df))


def test_label_trades_prunes_and_stays_jvm(spark):
    df = E.queries()["label_trades"](spark, SF001)
    plan = _plan(df)
    assert "ReadSchema: struct<p_partkey:bigint>" in plan       # lean market scan
    assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_bars_scan_reads_only_needed_columns(spark):
    df = E.queries()["ohlcv_bars"](spark, SF001)
    schemas = _read_schemas(df)
    assert schemas and all("props" not in s and "event_type" not in s for s in schemas)


def test_time_filter_pushed_to_scan(spark):
    df = E.queries()["filter_time_range"](spark, SF001)
    pushed = re.findall(r"PushedFilters: \[([^\]]*)\]", _plan(df))
    assert any("GreaterThanOrEqual(ts" in p and "LessThanOrEqual(ts" in p for p in pushed)


def test_segmented_scan_shuffles_large_side_once(spark):
    df = spark.range(0, 20000).select((F.col("id") % 3).cast("string").alias("k"),
                                      F.col("id").alias("t"), (F.col("id") % 7).alias("v"),
                                      F.floor(F.col("id") / 1000).alias("seg"))
    out = segmented_running(df, ["k"], "seg", ["t"], "v", "sum", "run")
    plan = out._jdf.queryExecution().executedPlan().toString()
    # One hash exchange on (key, segment) for the rows; the carry table is
    # small and joins on the same keys, so no second exchange of the rows.
    big = [m for m in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)]
    assert sum(1 for m in big if "_gk" in m and "seg" in m) <= 2
    assert "CartesianProduct" not in plan


def test_drawdown_lineage_is_cut(spark):
    """Chained segmented scans read checkpoints, not the source lineage again."""
    df = E.queries()["perf_drawdown"](spark, SF001)
    plan = _plan(df)
    assert plan.count("Scan parquet") <= 2     # was 24 without the checkpoints


MARKET_QUERIES = ["ind_sma", "ind_rsi", "threshold_clip", "signal_flags", "position_state", "round_trips", "rule_equity", "user_rule",
                  "param_sweep", "leaderboard", "user_metrics", "perf_trade_counts", "perf_streaks", "perf_drawdown"]


@pytest.mark.parametrize("name", MARKET_QUERIES)
def test_rules_stay_in_the_jvm(spark, name):
    plan = _plan(E.queries()[name](spark, SF001))
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("name", ["position_state", "ind_rsi", "ind_sma"])
def test_rows_of_a_market_are_dealt_by_segment(spark, monkeypatch, name):
    """With more rows than a segment holds, windows over rows are per (market, segment);
    those per market alone run over the segments' summaries."""
    monkeypatch.setattr(scan, "TARGET_SEGMENT_ROWS", 8)
    plan = _plan(E.queries()[name](spark, SF001))
    rows = [w for w in re.findall(r"Window \[.*", plan) if "row_number()" in w or "_pos" in w.split("AS")[0]]
    assert rows and all(re.search(r"_gk#\d+, _seg#\d+", w) for w in rows)


def test_asset_sides_decode_the_token_once(spark):
    """Not within each branch of a condition, where nothing of a word's digits is shared."""
    steps = {n: E.queries()[n](spark, SF001)._jdf.queryExecution().optimizedPlan().toString().count("conv(")
             for n in ("side_to_assets", "uint256_decimal")}
    assert steps["side_to_assets"] < 1.5 * steps["uint256_decimal"]
