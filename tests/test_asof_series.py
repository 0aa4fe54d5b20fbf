"""Levels, lines, walk-forward slices and ranked windows against brute force at every day."""

import datetime
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidemark.functions.ranked import Ranked
from tidemark.operators import backtest as BT
from tidemark.operators import forecast as FC
from tidemark.operators import levels as LV
from tidemark.operators import order_statistics as OS
from tidemark.operators import serving
from tidemark.operators.recursive import arranged

DAY = datetime.date(2020, 1, 1)


def walk(n, seed, wild=0.02):
    rng = random.Random(seed)
    rows, p = [], 100.0
    for i in range(n):
        p *= 1 + rng.uniform(-wild, wild)
        hi, lo = p * (1 + rng.uniform(0, 0.01)), p * (1 - rng.uniform(0, 0.01))
        rows.append((DAY + datetime.timedelta(days=2 * i), round(p, 2), round(max(hi, p), 2), round(min(lo, p), 2), round(p, 2), rng.randrange(1, 90)))
    return rows


def frame(spark, series):
    rows = [(e, *r) for e, rs in series.items() for r in rs]
    return spark.createDataFrame(rows, "entity long, date date, open double, high double, low double, close double, volume long")


def brute_levels(rows, lookback, touches, tolerance, apart, n=3):
    rows, out = rows[-lookback:], []
    for kind, col, sign in (("resistance", 2, 1), ("support", 3, -1)):
        v = [sign * r[col] for r in rows]
        piv = sorted((i for i in range(n, len(v) - n) if all(v[i] > v[i + k] and v[i] > v[i - k] for k in range(1, n + 1))), key=lambda i: rows[i][col])
        groups = []
        for i in piv:
            x = rows[i][col]
            for g in groups:
                if abs(x - g[0]) / g[0] <= tolerance:
                    g[0] = (g[0] * len(g[1]) + x) / (len(g[1]) + 1)
                    g[1].append(i)
                    break
            else:
                groups.append([x, [i]])
        kept = []
        for x, idx in sorted((g for g in groups if len(g[1]) >= touches), key=lambda g: -len(g[1])):
            if all(abs(k - x) / ((k + x) / 2) >= apart for k in kept):
                kept.append(x)
                out.append((kind, round(x, 6), len(idx), rows[min(idx)][0], rows[max(idx)][0], len(rows) - max(idx) - 1))
    return out


def test_levels_at_every_day(spark):
    series = {1: walk(150, 1), 2: walk(90, 2), 3: walk(4, 3)}
    b = frame(spark, series)
    asks = b.select("entity", F.col("date").alias("asof")).union(spark.createDataFrame([(1, DAY - datetime.timedelta(days=9)), (9, DAY), (2, DAY + datetime.timedelta(days=900)), (None, DAY), (1, None)], "entity long, asof date"))
    got = {}
    for r in LV.levels_at(asks.union(asks.limit(20)), b, lookback=60, touches=2, tolerance=0.03).collect():
        got.setdefault((r.entity, r.asof), []).append((r.kind, round(r.level, 6), r.touches, r.first_seen, r.last_seen, r.recency))
    want = {}
    for e, rows in series.items():
        for i, r in enumerate(rows):
            if found := brute_levels(rows[:i + 1], 60, 2, 0.03, 0.02):
                want[e, r[0]] = found
    if found := brute_levels(series[2], 60, 2, 0.03, 0.02):
        want[2, DAY + datetime.timedelta(days=900)] = found
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()} and len(want) > 150


def test_level_events_follow_the_levels_of_their_day(spark):
    b = frame(spark, {1: walk(160, 5, 0.06)})
    asks = b.select("entity", F.col("date").alias("asof"))
    rows = walk(160, 5, 0.06)
    found = {(r.asof, r.date, r.event_kind, round(r.value, 6)) for r in LV.level_events_at(asks, b, lookback=60, touches=2, tolerance=0.03).collect()}
    want = set()
    for i in range(len(rows)):
        seen = rows[max(0, i - 59):i + 1]
        for kind, level, *_ in brute_levels(rows[:i + 1], 60, 2, 0.03, 0.02):
            up = kind == "resistance"
            broke = [j for j in range(1, len(seen)) if (seen[j - 1][4] <= level and seen[j][4] > level * 1.02 if up else seen[j - 1][4] >= level and seen[j][4] < level * 0.98)]
            want |= {(rows[i][0], seen[j][0], f"{kind}_break", level) for j in broke}
            if up and broke:
                met = [j for j in range(broke[0] + 1, min(broke[0] + 30, len(seen))) if abs(seen[j][3] - level) / level < 0.03]
                if met and all(seen[j][4] >= level for j in range(met[0], min(met[0] + 5, len(seen)))):
                    want.add((rows[i][0], seen[met[0]][0], "level_flip", level))
    assert found == want and {k for _, _, k, _ in want} == {"resistance_break", "support_break", "level_flip"}


def brute_lines(rows, lookback, need, tolerance, span):
    from tidemark.operators.recursive import atr_values

    mid = np.array([(r[2] + r[3]) / 2 for r in rows])
    tr = np.array([r[2] - r[3] if i == 0 else max(r[2] - r[3], abs(r[2] - rows[i - 1][4]), abs(r[3] - rows[i - 1][4])) for i, r in enumerate(rows)])
    atr = atr_values(tr, 14)
    ends, start, ext, way = [], 0, 0, 0
    for i in range(1, len(mid)):
        sign = int(np.sign(mid[i] - mid[ext]))
        if sign and (way == 0 or sign == way):
            way, ext = sign, i
        elif sign and abs(mid[i] - mid[ext]) >= atr[ext] * 0.5:
            ends.append((ext, way))
            start, ext, way = ext, i, sign
    if ext > start:
        ends.append((ext, way))
    out = []
    for kind, w in (("resistance", 1), ("support", -1)):
        at = [i for i, x in ends if x == w and i >= len(rows) - lookback]
        found = []
        for x, a in enumerate(at):
            for b in at[x + 1:]:
                if b - a < span:
                    continue
                slope = (mid[b] - mid[a]) / (b - a)
                touch = [k for k in at[x + 1:] if k == b or (mid[a] + slope * (k - a) > 0 and abs(mid[k] - (mid[a] + slope * (k - a))) / (mid[a] + slope * (k - a)) < tolerance)]
                if len(touch) + 1 >= need:
                    found.append((a, b, slope, 1 + sum(k <= b for k in touch), 1 + len(touch)))
        kept = []
        for ln in sorted(found, key=lambda f: (-f[3], f[0], f[1])):
            if not any(abs(k[2] - ln[2]) < 0.05 * max(abs(k[2]), 1e-9) and abs((rows[k[0]][0] - rows[ln[0]][0]).days) < 5 for k in kept):
                kept.append(ln)
        out += [(kind, rows[a][0], rows[b][0], round(s, 9), n, t) for a, b, s, n, t in kept]
    return out


def test_trendlines_at_every_day(spark):
    rows = walk(170, 11)
    b = frame(spark, {1: rows, 2: rows[:40]})
    got = {}
    for r in LV.trendlines_at(b.select("entity", F.col("date").alias("asof")), b, lookback=120, min_pivots=4, tolerance=0.01, min_span=15).collect():
        if r.entity == 1:
            got.setdefault(r.asof, []).append((r.kind, r.start_date, r.anchor_date, round(r.slope, 9), r.anchors, r.touches))
    want = {r[0]: sorted(f) for i, r in enumerate(rows) if (f := brute_lines(rows[:i + 1], 120, 4, 0.01, 15))}
    assert {k: sorted(v) for k, v in got.items()} == want and len(want) > 60


def test_a_slice_ends_at_its_day(spark):
    b = frame(spark, {1: walk(30, 1)})
    rows = walk(30, 1)
    last_close = lambda view: [(float(view["close"][-1]), len(view["close"]))] if len(view["close"]) else []
    got = {r.asof: (r.x, r.n) for r in serving.walk_forward(b.select("entity", F.col("date").alias("asof")), b, last_close, "x double, n int", lookback=10).collect()}
    assert got == {r[0]: (r[4], min(i + 1, 10)) for i, r in enumerate(rows)}


def test_looking_ahead_fails(spark):
    """What would be tomorrow's close on a whole series is out of reach in a slice, also through the slice's base."""
    b = frame(spark, {1: walk(30, 1)})
    asks = b.select("entity", F.col("date").alias("asof"))

    def cheat(view):
        own = view["close"]
        return [(float((own if own.base is None else own.base)[len(own)]),)]

    with pytest.raises(Exception, match="IndexError"):
        serving.walk_forward(asks, b, cheat, "next double").collect()

    def overwrite(view):
        view["close"][0] = 0.0
        return []

    with pytest.raises(Exception, match="read-only"):
        serving.walk_forward(asks, b, overwrite, "next double").collect()
    # a centred mean gives other rows on slices than on the whole series
    centred = lambda v: float(np.mean(v["close"][-3:]))
    sliced = [r.x for r in serving.walk_forward(asks, b, lambda v: [(centred(v),)], "x double").orderBy("asof").collect()]
    whole = [float(np.mean([r[4] for r in walk(30, 1)][max(0, i - 1):i + 2])) for i in range(30)]
    assert sliced != whole


def test_slices_agree_with_window_columns(spark):
    b = frame(spark, {1: walk(330, 7, 0.03), 2: walk(280, 8)})
    p = FC.every_bar(FC.unadjusted(b)).cache()
    rows = p.select("entity", "date", "px", "c")
    some = {k: BT.FORECASTERS[k] for k in ("baseline", "log_channel", "trend_filter")}
    key = lambda r: (r.entity, r.forecast_date, r.source, r.horizon, r.confidence)
    got = {key(r): (r.lower, r.upper, r.point) for r in BT.issue(b.select("entity", F.col("date").alias("asof")), rows, some).collect()}
    want = {key(r): (r.lower, r.upper, r.point) for fn in (FC.baseline, FC.log_channel, FC.trend_filter) for r in fn(p).collect()}
    assert got.keys() == want.keys() and len(got) > 5000
    assert all(np.allclose(got[k], want[k], rtol=1e-6, atol=2e-4) for k in want)


def test_scores_and_flows_in_slices():
    px = np.exp(np.cumsum(np.full(80, 0.001) * np.resize([1, -1, 2], 80))) * 100
    view = {"px": px, "net_flow": np.resize([5.0, -3.0, 1.0], 80), "margin_balance": np.linspace(100, 180, 80), "s": np.array([np.nan] * 79 + [0.5])}
    low, high = (x[0] for x in ([r for r in BT.scored("s", 0.3, 0.2)(view, (63,), (0.8,))], [r for r in BT.chip(view, (63,), (0.8,))]))
    assert low[4] == pytest.approx(px[-1] * (1 + 0.5 * 0.3 * 63 / 252)) and high[4] < px[-1]
    assert BT.scored("s", 0.3, 0.2)({**view, "s": np.array([0.5] + [np.nan] * 79)}, (63,), (0.8,)) == [] and BT.log_channel(view) == [] and BT.trend_filter({"px": px[:29]}) == []


def test_conformal_against_lists(spark):
    rng = random.Random(3)
    rows = []
    for e in (1, 2):
        for i in range(120):
            mid = rng.uniform(90, 110)
            rows.append((e, DAY + datetime.timedelta(days=i), "m", 21, 0.8, mid - 5, mid + 5, mid, rng.choice([None, rng.uniform(80, 120), 100.0])))
    df = spark.createDataFrame(rows, "entity long, forecast_date date, source string, horizon int, confidence double, lower double, upper double, point double, realized double")
    for strict in (True, False):
        got = {(r.entity, r.forecast_date): (r.q, r.n_past) for r in FC.conformal(df.drop("realized"), df.where("realized is not null"), window=40, min_size=10, strict=strict).collect()}
        want = {}
        for e, day, *_ in rows:
            past = [max(lo - y, y - hi) for e2, d2, _, h, _, lo, hi, _, y in rows if e2 == e and y is not None and (d2 + datetime.timedelta(days=h) <= day if strict else d2 < day)][-40:]
            k = int(np.ceil((len(past) + 1) * 0.8 - 1e-9))
            if len(past) >= 10 and k <= len(past):
                want[e, day] = (sorted(past)[k - 1], len(past))
        assert got == want and max(n for _, n in want.values()) == 40


def test_percentiles_against_lists(spark):
    rng = random.Random(4)
    rows = [(e, DAY + datetime.timedelta(days=rng.randrange(3) + 3 * i), rng.choice([None, 1.0, 2.0, rng.random()])) for e in (1, 2) for i in range(90)]
    df = spark.createDataFrame(rows, "entity long, date date, v double")
    by_rows = {(r.entity, r.date): r.p for r in OS.trailing_percentiles(df, {"p": "v"}, n=20, min_obs=5).collect()}
    by_days = {(r.entity, r.date): r.p for r in OS.trailing_percentiles(df, {"p": "v"}, days=50, strict=True).collect()}
    for e in (1, 2):
        own = [r for r in rows if r[0] == e]
        for i, (_, day, v) in enumerate(own):
            last = [x for *_, x in own[max(0, i - 19):i + 1] if x is not None]
            want = sum(x <= v for x in last) / len(last) if v is not None and len(last) >= 5 else None
            assert by_rows[e, day] == (pytest.approx(want) if want is not None else None)
            near = [x for _, d, x in own[:i + 1] if x is not None and (day - d).days <= 50]
            assert by_days[e, day] == (pytest.approx(100 * sum(x < v for x in near) / len(near)) if v is not None else None)


def test_ranked_windows(monkeypatch):
    import tidemark.functions.ranked as R

    monkeypatch.setattr(R, "BLOCK", 4)
    rng = random.Random(1)
    for _ in range(60):
        w, ref = Ranked(), []
        for _ in range(150):
            if ref and rng.random() < 0.45:
                ref.remove(v := rng.choice(ref))
                w.drop(v)
            else:
                ref.append(v := float(rng.randrange(12)))
                w.add(v)
            ref.sort()
            q = float(rng.randrange(-1, 14))
            assert (w.size, w.below(q), w.below(q, True)) == (len(ref), sum(x < q for x in ref), sum(x <= q for x in ref))
            assert not ref or w.kth(k := rng.randrange(1, len(ref) + 1)) == ref[k - 1]
    with pytest.raises(KeyError):
        w.drop(99.0)
    with pytest.raises(IndexError):
        w.kth(0)


def test_lots_say_what_single_slices_say(spark):
    """Every forecaster over lots against its form for one slice, at every bar of series of different length; a lot is never handed a later row."""
    rng = np.random.default_rng(5)
    rows = []
    for e, n in ((1, 3), (2, 140), (3, 330), (4, 61), (5, 1)):
        px = 100 * np.exp(np.cumsum(rng.normal(0, 0.02, n)))
        rows += [(e, datetime.date(2020, 1, 1) + datetime.timedelta(days=i), float(px[i]), 1.0 + (i > 40), float(rng.integers(-9, 9)), float(rng.integers(0, 40)), None if i < 5 else float(rng.normal()), float(rng.normal())) for i in range(n)]
    df = spark.createDataFrame(rows, "entity int, date date, px double, c double, net_flow double, margin_balance double, fundamental_score double, macro_score double").repartition(3)
    reads = df.columns[2:]
    due = arranged(df.withColumns({"is_due": F.col("entity") + F.dayofmonth("date") != 9, "more": F.col("entity") * 7}))
    key = lambda r: (r.entity, r.forecast_date, r.source, r.horizon, r.confidence)
    found = BT.issue_lots(due, reads, lookback=300).collect()
    got = {key(r): (r.lower, r.upper, r.point) for r in found}
    asks = df.filter(F.col("entity") + F.dayofmonth("date") != 9).select("entity", F.col("date").alias("asof"))
    want = {key(r): (r.lower, r.upper, r.point) for r in BT.issue(asks, df, lookback=300).collect()}
    assert {k[2] for k in want} == set(BT.FORECASTERS) and got.keys() == want.keys() and len(found) == len(got) and all(r.more == r.entity * 7 for r in found)
    # prices are cut to four decimals, so one step apart is rounding
    assert all(abs(a - b) <= 1.01e-4 + 1e-9 * abs(b) for k in got for a, b in zip(got[k], want[k]))
    # small lots cut series apart, never a series
    small = serving.walk_forward_lots(due, ["px"], lambda v: {"n": np.array([[len(x), x[-1]] for x in v["px"]])}, ("n",), 10**6, series=2, cells=150).collect()
    place = {(e, d): (i + 1, p) for e in range(1, 6) for i, (_, d, p, *_) in enumerate(r for r in rows if r[0] == e)}
    assert {(r.entity, r.date): tuple(r.n) for r in small} == {k: v for k, v in place.items() if k[0] + k[1].day != 9}


def test_backtest_shuffles_no_forecast(spark, sf):
    """The query's forecasts stay in the row of their bar until they are summed."""
    plan = entry.queries()["walk_forward_backtest"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange hash" in line and ("forecast_date" in line or "horizon" in line)]
    assert len(moved) == 1 and "source" in moved[0], plan


def test_channels_are_fitted_without_a_frame_per_bar(spark):
    """Lines by array: a price that is missing or not positive is no point, and no window aggregate is planned."""
    days = [(1, DAY + datetime.timedelta(days=i), None if i == 7 else 0.0 if i == 9 else 100.0 + i * i % 17) for i in range(40)]
    p = FC.every_bar(FC.unadjusted(spark.createDataFrame(days, "entity int, date date, close double")))
    df = FC.log_channel(p, (5,), (0.8,), window=20)
    assert "regr" not in df._jdf.queryExecution().executedPlan().toString()
    got = {r.forecast_date: r.point for r in df.collect()}
    assert len(got) == 21
    for i in range(19, 40):
        t, y = zip(*[(k, np.log(days[k][2])) for k in range(i - 19, i + 1) if days[k][2]])
        slope, end = np.polyfit(t, y, 1)
        assert abs(got[days[i][1]] - np.exp(end + slope * (i + 5))) < 1e-3


def test_legs_are_read_as_streams(spark):
    """Series of every length in one partition, cut between batches, against the rule for one series; no call per entity is planned."""
    from tidemark.operators import waves as WV

    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "17")
    try:
        b = frame(spark, {e: walk(n, e, 0.03) for e, n in ((1, 1), (2, 40), (3, 17), (4, 120), (5, 2))})
        df = WV.legs(b)
        assert "FlatMapGroups" not in df._jdf.queryExecution().executedPlan().toString()
        got = {(r.entity, r.wave_no): (r.start_date, r.end_date, r.direction) for r in df.collect()}
        alone = {(r.entity, r.wave_no): (r.start_date, r.end_date, r.direction) for e in range(1, 6) for r in WV.legs(b.filter(F.col("entity") == e)).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert got == alone and len(got) > 30 and {e for e, _ in got} == {2, 3, 4, 5}
    for (e, k), (start, end, way) in got.items():
        # legs meet, and directions alternate
        assert (e, k + 1) not in got or (got[e, k + 1][0], got[e, k + 1][2]) == (end, -way)
