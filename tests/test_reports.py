"""Report tables, user metrics and leverage over several instruments."""

import datetime as dt
import random

import pandas as pd
from pyspark.sql import functions as F

from fillbook.operators import perf as P
from fillbook.operators import reports as Q
from fillbook.operators import rules as R


def test_every_table_has_its_builder(spark):
    titles = {"Annual Return", "Time Return", "Calmar", "Gross Leverage", "Transactions", "Sharpe-Ratio", "SystemQualityNumber",
              "Variability-Weighted Return", "Drawdown", "Trade Analyzer"}
    assert titles <= set(Q.REPORTS)
    figures = spark.createDataFrame([("a", 1, 2.5, 10.0, 4, 3.5, 12.0), ("b", 0, 0.0, None, 1, 1.0, 2.0)],
                                    "series string, len long, moneydown double, drawdown double, max_len long, max_moneydown double, max_drawdown double")
    rows = {(r.series, r.path): r.value for r in Q.report("Drawdown", figures, ["series"]).collect()}
    assert len(rows) == 12 and rows["a", "Length - Maximum"] == "4" and rows["a", "Moneydown - Value"] == "2.5" and rows["b", "Drawdown - Value"] is None


def test_tables_over_time_and_trade_analyzer(spark):
    rets = spark.createDataFrame([("a", dt.date(2024, 1, 1), 0.5), ("a", None, 0.25)], "series string, period date, ret double")
    got = sorted((r.report, r.series, r.path, r.value) for r in Q.report("Time Return", rets, ["series"]).collect())
    assert got == [("Time Return", "a", " - Return", "0.25"), ("Time Return", "a", "2024-01-01 - Return", "0.5")]
    led = spark.createDataFrame([("s", i, "long" if i % 2 else "short", 3, float(i - 2)) for i in range(6)], "series string, n long, side string, bars long, pnl double")
    won = F.col("pnl") >= 0
    counts = led.groupBy("series").agg(F.count(F.lit(1)).alias("total"), F.lit(0).alias("open"), F.count(F.lit(1)).alias("closed"))
    figures = counts.join(P.streaks(led, "series", ["n"], won), "series").join(P.pnl_report(led, "series", "pnl", "side", won), "series")
    kept = ["series", *[c for cells in ("total open closed won_current won_longest lost_current lost_longest",) for c in cells.split()],
            *[c for c in figures.columns if c.endswith(("_total", "_average")) and not c.startswith(("won_", "lost_"))]]
    rows = {r.path: r.value for r in Q.report("Trade Analyzer", figures.select(*kept), ["series"]).collect()}
    assert rows["Number of Trades - Total"] == "6" and rows["Won - Longest"] == "4" and rows["Lost - Longest"] == "2"
    assert float(rows["Long - Total"]) == 3.0 and float(rows["Gross Profit - Average"]) == 0.5


def test_user_functions_as_metrics(spark):
    """A Python function sees its key's trades in trade order."""
    rows = [(k, t, float((t * 7 + len(k)) % 5 - 2), 100.0 + t) for k in ("a", "bb") for t in random.Random(1).sample(range(1, 40), 39)]
    trips = spark.createDataFrame(rows, "market_id string, trade_no long, ret double, value double").repartition(4)

    def longest_loss(ret: pd.Series) -> float:
        run = best = 0
        for x in ret:
            run = run + 1 if x < 0 else 0
            best = max(best, run)
        return float(best)

    metrics = {"mean": F.avg("ret"), "longest_loss": R.UserMetric(longest_loss, ("ret",)), "spread": R.UserMetric(lambda r, v: float((r * v).sum()), ("ret", "value"))}
    got = {r.market_id: r for r in R.final_equity(trips, ["market_id"], metrics).collect()}
    for k in ("a", "bb"):
        mine = sorted(r for r in rows if r[0] == k)
        assert got[k].longest_loss == longest_loss(pd.Series([r[2] for r in mine]))
        assert abs(got[k].spread - sum(r[2] * r[3] for r in mine)) < 1e-9 and got[k].n_closed == 39 and got[k].final_value == 139.0


def test_leverage_over_instruments(spark, monkeypatch):
    """Two instruments with clocks of their own, against a loop; long and short segments."""
    from fillbook.operators import scan
    rnd = random.Random(5)
    base = dt.datetime(2024, 1, 1)
    equity = [("s", base + dt.timedelta(minutes=10 * i), i, 1000.0 + i) for i in range(60)]
    trades = [("s", rnd.choice("xy"), base + dt.timedelta(minutes=rnd.randint(-20, 620)), i, float(rnd.randint(-5, 5)), float(rnd.randint(1, 9))) for i in range(200)]
    want = []
    for _, ts, _, value in equity:
        held = {}
        for _, name, at, _, size, price in sorted(trades, key=lambda t: (t[2], t[3])):
            if at <= ts:
                held[name] = (held.get(name, (0.0, 0.0))[0] + size, price)
        want.append(sum(abs(a * b) for a, b in held.values()) / value)
    e = spark.createDataFrame(equity, "series string, ts timestamp_ntz, seq long, value double")
    t = spark.createDataFrame(trades, "series string, instrument string, ts timestamp_ntz, seq long, size double, price double")
    for rows in (1 << 16, 8):
        monkeypatch.setattr(scan, "TARGET_SEGMENT_ROWS", rows)
        got = [r.leverage for r in P.portfolio_leverage(e, t).orderBy("seq").collect()]
        assert all(abs(a - b) < 1e-9 for a, b in zip(got, want, strict=True))
