"""Randomised checks of running/ordered operators against plain Python loops."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from fillbook.operators import align as A
from fillbook.operators import indicators as I
from fillbook.operators import rules as R
from fillbook.operators import scan
from fillbook.operators.scan import segmented_running


def test_segmented_running_matches_loop(spark):
    rnd = random.Random(1)
    rows = []
    for k in ("a", "b", "hot"):
        n = 2000 if k == "hot" else 50
        for i in range(n):
            v = None if rnd.random() < 0.2 else rnd.randint(-50, 50)
            rows.append((k, i, v))
    df = spark.createDataFrame(rows, "k string, i long, v long").withColumn("seg", F.floor(F.col("i") / 37))
    for op in ("sum", "max", "min", "last"):
        got = {(r.k, r.i): r.out for r in
               segmented_running(df, ["k"], "seg", ["i"], "v", op, "out").collect()}
        for k in ("a", "b", "hot"):
            acc = None
            for (kk, i, v) in [r for r in rows if r[0] == k]:
                if v is not None:
                    if acc is None or op == "last":
                        acc = v
                    elif op == "sum":
                        acc += v
                    elif op == "max":
                        acc = max(acc, v)
                    elif op == "min":
                        acc = min(acc, v)
                assert got[(k, i)] == acc, (op, k, i)


def _asof_loop(src, clock):
    """Reference rule: exact tick -> its value; else latest earlier row's value (even null)."""
    out = []
    for t in clock:
        exact = [v for (ts, v) in src if ts == t]
        if exact:
            out.append(exact[0])
            continue
        earlier = [v for (ts, v) in src if ts < t]
        out.append(earlier[-1] if earlier else None)
    return out


def test_align_asof_matches_loop(spark):
    rnd = random.Random(3)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for s in ("x", "y"):
        for i in sorted(rnd.sample(range(400), 120)):
            v = None if rnd.random() < 0.15 else float(rnd.randint(0, 9))
            rows.append(("g", s, base + dt.timedelta(hours=i), v, i))
    df = spark.createDataFrame(rows, "g string, series string, ts timestamp_ntz, value double, seq long")
    got = {(r.series, r.ts): r.value for r in A.align_asof(df, ["g"], "series", "ts", "value", "seq").collect()}
    clock = sorted({r[2] for r in rows})
    for s in ("x", "y"):
        src = [(r[2], r[3]) for r in rows if r[1] == s]
        for t, v in zip(clock, _asof_loop(src, clock)):
            assert got[(s, t)] == v


def _rsi_loop(closes, p):
    out = [None] * len(closes)
    ups = [max(closes[i] - closes[i - 1], 0.0) for i in range(1, len(closes))]
    dns = [max(closes[i - 1] - closes[i], 0.0) for i in range(1, len(closes))]
    if len(ups) < p:
        return out
    au, ad = sum(ups[:p]) / p, sum(dns[:p]) / p
    for i in range(p, len(closes)):
        if i > p:
            au = (au * (p - 1) + ups[i - 1]) / p
            ad = (ad * (p - 1) + dns[i - 1]) / p
        out[i] = (50.0 if au == 0 else 100.0) if ad == 0 else 100.0 - 100.0 / (1.0 + au / ad)
    return out


def _bars(spark, n=300, seed=5):
    rnd = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for m in ("m1", "m2"):
        c = 0.5
        for i in range(n):
            c = max(0.01, c + rnd.choice([-0.02, -0.01, 0.0, 0.0, 0.01, 0.02]))
            rows.append((m, base + dt.timedelta(minutes=2 * i), c, c))
    return rows, spark.createDataFrame(rows, "market_id string, bar_start timestamp_ntz, open double, close double")


def test_rsi_matches_loop(spark):
    rows, df = _bars(spark)
    got = {(r.market_id, r.bar_start): r.rsi_3 for r in I.rsi(df, [3]).collect()}
    for m in ("m1", "m2"):
        mr = [r for r in rows if r[0] == m]
        exp = _rsi_loop([r[2] for r in mr], 3)
        for r, e in zip(mr, exp):
            g = got[(m, r[1])]
            assert (g is None and e is None) or math.isclose(g, e, rel_tol=1e-12)


def test_position_state_matches_loop(spark):
    rnd = random.Random(11)
    rows = [("m", i, rnd.random() < 0.3, rnd.random() < 0.3) for i in range(3000)]
    df = spark.createDataFrame(rows, "market_id string, bar_start long, entry boolean, exit boolean")
    got = {r.bar_start: (r.pos_before, r.pos) for r in R.position_state(df, ["market_id"]).collect()}
    pos = 0
    for (_, i, e, x) in rows:
        before = pos
        if pos == 0 and e:
            pos = 1
        elif pos == 1 and x:
            pos = 0
        assert got[i] == (before, pos), i


def test_round_trips_and_equity(spark):
    rows = [("m", i, o, c, e, x) for i, (o, c, e, x) in enumerate([
        (1.0, 1.0, True, False), (2.0, 2.0, False, False), (3.0, 3.0, False, True),
        (4.0, 4.0, False, False), (5.0, 5.0, True, False)])]
    df = spark.createDataFrame(rows, "market_id string, bar_start long, open double, close double, "
                                     "entry boolean, exit boolean")
    trips = R.round_trips(R.position_state(df, ["market_id"]), ["market_id"]).collect()
    assert len(trips) == 1  # the last entry signal has no next bar: never fills
    t = trips[0]
    assert (t.entry_price, t.exit_price, t.bars_held) == (2.0, 4.0, 2)
    assert math.isclose(t.factor, 1 + 0.97 * 2.0 / 1.0)
    eq = R.rule_equity(R.round_trips(R.position_state(df, ["market_id"]), ["market_id"]), ["market_id"]).first()
    assert math.isclose(eq.value, 10000 * (1 + 0.97 * 2.0))


def test_last_n_and_positions(spark):
    df = spark.createDataFrame([("a", i) for i in range(10)], "g string, t long")
    assert sorted(r.t for r in A.last_n_rows(df, ["g"], "t", 3).collect()) == [7, 8, 9]
    dft = df.withColumn("ts", F.timestamp_seconds("t"))
    kept = A.filter_positions(dft, ["g"], "ts", start=2, end=-2).collect()
    assert sorted(r.t for r in kept) == list(range(2, 9))


@pytest.fixture
def short_segments(monkeypatch):
    """Segments of about 16 rows, cut in two rounds of 16 quantiles."""
    monkeypatch.setattr(scan, "TARGET_SEGMENT_ROWS", 16)
    monkeypatch.setattr(scan, "BORDERS", 16)


def test_rsi_segments_match_loop(spark, short_segments):
    """Affine maps of many segments per market equal the one-pass fold."""
    rows, df = _bars(spark, n=900, seed=9)
    assert scan.with_segments(df, ["market_id"], "bar_start").select("market_id", "_seg").distinct().count() > 60
    got = {(r.market_id, r.bar_start): (r.rsi_2, r.rsi_5) for r in I.rsi(df, [2, 5]).collect()}
    for m in ("m1", "m2"):
        mr = [r for r in rows if r[0] == m]
        for p, at in ((2, 0), (5, 1)):
            for r, e in zip(mr, _rsi_loop([x[2] for x in mr], p), strict=True):
                g = got[(m, r[1])][at]
                assert (g is None and e is None) or math.isclose(g, e, rel_tol=1e-9, abs_tol=1e-9)


def test_rsi_seeds_across_segments(spark, monkeypatch):
    """Segments shorter than the period: the first moves are spread over several."""
    monkeypatch.setattr(scan, "TARGET_SEGMENT_ROWS", 2)
    rows, df = _bars(spark, n=40, seed=2)
    got = {(r.market_id, r.bar_start): r.rsi_7 for r in I.rsi(df, 7).collect()}
    for m in ("m1", "m2"):
        mr = [r for r in rows if r[0] == m]
        for r, e in zip(mr, _rsi_loop([x[2] for x in mr], 7), strict=True):
            g = got[(m, r[1])]
            assert (g is None and e is None) or math.isclose(g, e, rel_tol=1e-9, abs_tol=1e-9)


def test_segments_are_even(spark, short_segments):
    """A burst (most rows of a key within a minute) is split; quiet keys are one segment."""
    base = dt.datetime(2024, 1, 1)
    rows = [("hot", base + dt.timedelta(days=i)) for i in range(300)]
    rows += [("hot", base + dt.timedelta(days=100, microseconds=20_000 * i)) for i in range(3000)]
    rows += [("quiet", base + dt.timedelta(days=90 * i)) for i in range(9)] + [(None, base)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz")
    seg = scan.with_segments(df, ["k"], "ts")
    sizes = {(r.k, r._seg): r["count"] for r in seg.groupBy("k", "_seg").count().collect()}
    assert max(sizes.values()) <= 3 * 16 and len(sizes) > 100, sorted(sizes.values())[-5:]
    assert sizes[("quiet", 0)] == 9 and sizes[(None, 0)] == 1
    by = {}
    for r in seg.where("k = 'hot'").collect():
        by.setdefault(r._seg, []).append(r.ts)
    edges = [(min(v), max(v)) for _, v in sorted(by.items())]
    assert all(a[1] < b[0] for a, b in zip(edges, edges[1:], strict=False))


def test_many_segments(spark, monkeypatch):
    """Force ~8-row segments: as-of fill, gap-free index and positional
    filters must still equal the loops (carry across many segments)."""
    monkeypatch.setattr(scan, "TARGET_SEGMENT_ROWS", 8)
    test_align_asof_matches_loop(spark)
    base = dt.datetime(2024, 1, 1)
    rows = [("g", base + dt.timedelta(minutes=7 * i)) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, ts timestamp_ntz")
    segs = scan.with_segments(df, ["g"], "ts").select("_seg").distinct().count()
    assert segs > 20
    idx = sorted((r.ts, r.idx) for r in A.gapfree_index(df, ["g"], "ts").collect())
    assert [i for _, i in idx] == list(range(500))
    kept = A.filter_positions(df, ["g"], "ts", start=3, end=-4).count()
    assert kept == 500 - 3 - 3


def _trips_loop(bars):
    """Bars (ts, open, close, entry, exit) in order -> states and trades of the event loop."""
    pos, states, trades, held = 0, [], [], None
    for i, (ts, _, _, entry, leave) in enumerate(bars):
        before = pos
        pos = (1 if entry else 0) if pos == 0 else (0 if leave else 1)
        states.append((before, pos))
        fill = bars[i + 1][:2] if i + 1 < len(bars) else None
        if pos > before and fill:
            held = [ts, *fill, i]
        elif pos < before and held:
            trades.append((*held[:3], ts, *fill, i - held[3]) if fill else (*held[:3], None, None, None, None))
            held = None
    return states, trades + ([(*held[:3], None, None, None, None)] if held else [])


@pytest.mark.parametrize("rows_per_segment", [4, 16, 1 << 16])
def test_rules_match_loop(spark, monkeypatch, rows_per_segment):
    """Positions and trades on short and long segments equal the event loop
    on random signals and prices, sets and toggles."""
    monkeypatch.setattr(scan, "TARGET_SEGMENT_ROWS", rows_per_segment)
    rnd = random.Random(rows_per_segment)
    base = dt.datetime(2024, 1, 1)
    rows = [(m, base + dt.timedelta(minutes=2 * i), float(rnd.randint(1, 9)), float(rnd.randint(1, 9)),
             rnd.random() < p, rnd.random() < p) for m, p in (("a", 0.3), ("b", 0.02), ("c", 0.9)) for i in range(500)]
    df = spark.createDataFrame(rows, "market_id string, bar_start timestamp_ntz, open double, "
                                     "close double, entry boolean, exit boolean")
    pos = R.position_state(df, ["market_id"])
    got = {(r.market_id, r.bar_start): (r.pos_before, r.pos, r.bar_no) for r in pos.collect()}
    trips = R.round_trips(pos, ["market_id"]).collect()
    for m in "abc":
        bars = [r[1:] for r in rows if r[0] == m]
        states, trades = _trips_loop(bars)
        assert [got[(m, b[0])] for b in bars] == [(*s, i + 1) for i, s in enumerate(states)]
        made = sorted((t for t in trips if t.market_id == m), key=lambda t: t.trade_no)
        assert [t.trade_no for t in made] == list(range(1, len(trades) + 1))
        assert [(t.entry_signal_ts, t.entry_ts, t.entry_price, t.exit_signal_ts, t.exit_ts, t.exit_price, t.bars_held) for t in made] == trades


def test_streaks_and_drawdown_match_loop(spark, short_segments):
    from fillbook.operators import perf as P
    rnd = random.Random(8)
    base = dt.datetime(2024, 1, 1)
    rows = [(s, base + dt.timedelta(minutes=i), i, float(rnd.randint(-40, 60)), rnd.random() < p)
            for s, p in (("x", 0.5), ("y", 0.95), ("z", 0.0)) for i in range(400)]
    df = spark.createDataFrame(rows, "series string, ts timestamp_ntz, seq long, value double, win boolean")
    streaks = {r.series: tuple(r)[1:] for r in P.streaks(df, "series", ["ts", "seq"], F.col("win")).collect()}
    report = {r.series: r for r in P.drawdown_report(df).collect()}
    for s in "xyz":
        best, run, peak, since, worst = {True: 0, False: 0}, [None, 0], None, 0, [0, 0.0]
        for _, _, _, v, w in [r for r in rows if r[0] == s]:
            run = [w, run[1] + 1] if w == run[0] else [w, 1]
            best[w] = max(best[w], run[1])
            since = 0 if peak is None or v >= peak else since + 1
            peak = v if peak is None else max(peak, v)
            worst = [max(worst[0], since), max(worst[1], peak - v)]
        assert streaks[s] == (best[True], best[False], run[1] if run[0] else 0, 0 if run[0] else run[1])
        assert (report[s].len, report[s].max_len, report[s].max_moneydown) == (since, *worst)


def test_drawdown_explicit_segment_equals_default(spark):
    from fillbook.operators import perf as P
    rnd = random.Random(4)
    base = dt.datetime(2024, 1, 1)
    rows = [(s, base + dt.timedelta(minutes=i), i, 100.0 + rnd.randint(-30, 30))
            for s in ("x", "y") for i in range(400)]
    eq = spark.createDataFrame(rows, "series string, ts timestamp_ntz, seq long, value double")
    a = P.drawdown(eq)
    b = P.drawdown(eq, segment=F.floor(F.col("seq") / 23))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("n", [1, 2, 5, 30])
def test_sma_segments_equal_window(spark, short_segments, n):
    rows, df = _bars(spark, n=400, seed=13)
    w = Window.partitionBy("market_id").orderBy("bar_start").rowsBetween(-(n - 1), 0)
    a = df.select("market_id", "bar_start", F.when(F.count("close").over(w) == n, F.avg("close").over(w)).alias("s"))
    b = I.sma(df, n, out="s").select("market_id", "bar_start", "s")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_sweep_equals_single_rules(spark, short_segments):
    """All parameter sets in one pass equal each rule on its own."""
    rows, df = _bars(spark, n=300, seed=6)
    grid = [(2, 15, 5), (3, 25, 10)]
    cols = ["market_id", "bar_start", "pos_before", "pos", "trade_no"]
    got = R.rsi_sma_sweep(df, grid)
    for i, (rp, lo, n) in enumerate(grid):
        b = I.sma(I.rsi(df, rp), n)
        ready = F.col(f"rsi_{rp}").isNotNull() & F.col(f"sma_{n}").isNotNull()
        rule = R.Rule(entry=F.col(f"rsi_{rp}") < lo, exit=F.col("close") > F.col(f"sma_{n}"))
        one = R.position_state(R.signal_flags(b, rule, ready), ["market_id"]).select(cols)
        same = got.where(F.col("param_id") == i).select(cols)
        assert one.where("pos > pos_before").count() > 3
        assert one.exceptAll(same).count() == 0 and same.exceptAll(one).count() == 0
