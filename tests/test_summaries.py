"""Summaries and screens against loops over small tables with gaps, ties, repeats and nulls."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import scalars as K
from tidemark.operators import screens as SC
from tidemark.operators import summaries as SM

D = dt.date(2024, 1, 1)
day = lambda n: D + dt.timedelta(days=n)


@pytest.fixture(scope="module")
def asks(spark):
    rows = [(e, day(n)) for e in (1, 2, 3) for n in (-5, 0, 10, 30, 31, 75)] + [(1, day(10)), (None, day(3)), (2, None)]
    return spark.createDataFrame(rows, "entity long, asof date")


def wanted(asks):
    return {(r.entity, r.asof) for r in asks.collect() if r.entity is not None and r.asof is not None}


def test_block_summary_equals_a_loop(spark, asks):
    g = np.random.default_rng(3)
    rows = [(e, day(int(n)), int(v), int(v) * 7, int(v * s), float(s), int(v) * 3) for e in (1, 2) for n, v, s in
            zip(sorted(g.choice(80, 30, replace=False)), g.integers(1, 90, 30), g.choice([0.0, 0.5, 0.8, 1.0], 30))]
    daily = spark.createDataFrame(rows, "entity long, date date, total_volume long, total_money long, matching_volume long, matching_share double, largest_trade long")
    got = {(r.entity, r.asof): r for r in SM.block_summary(asks, daily).collect()}
    assert set(got) == wanted(asks)
    for (e, t), r in got.items():
        seen = [x for x in rows if x[0] == e and t - dt.timedelta(days=30) <= x[1] <= t]
        volume = sum(x[2] for x in seen)
        assert (r.active_days, r.total_volume, r.total_money) == (len(seen), volume, sum(x[3] for x in seen))
        assert r.largest_trade == max((x[6] for x in seen), default=0)
        assert r.spike_days == [x[1] for x in seen if x[5] >= 0.8]
        assert r.matching_share == (pytest.approx(sum(x[4] for x in seen) / volume) if volume else None)


def test_alert_status_picks_the_open_period_announced_last(spark, asks):
    rows = [(1, day(0), day(1), day(12), "warning"), (1, day(0), day(1), day(12), "warning"), (1, day(8), day(9), day(11), "disposition"), (1, day(29), None, None, "unknown"), (2, day(30), day(30), day(31), "cash_only"), (3, day(-70), day(-69), day(90), "warning")]
    alerts = spark.createDataFrame(rows, "entity long, date date, period_start date, period_end date, severity string")
    got = {(r.entity, r.asof): r for r in SM.alert_status(asks, alerts).collect()}
    assert set(got) == wanted(asks)
    for (e, t), r in got.items():
        seen = [x for x in rows if x[0] == e and t - dt.timedelta(days=60) <= x[1] <= t]
        now = max((x[1:] for x in seen if x[2] and x[2] <= t <= x[3]), default=None)
        assert (r.in_period, r.announcements, len(r.history)) == (now is not None, len(seen), len(seen))
        assert r.severity == (now and now[3]) and r.days_remaining == (now and (now[2] - t).days)
        assert [h.date for h in r.history] == sorted((x[1] for x in seen), reverse=True)
    assert got[(1, day(10))].severity == "disposition" and got[(2, day(31))].days_remaining == 0
    assert not got[(3, day(0))].in_period


def test_collateral_and_commodity_take_the_newest_row(spark, asks):
    balances = spark.createDataFrame([(1, day(0), 30, None, 1.5, None, 30, "a", 1.0), (1, day(20), 10, 30, -5.0, 2.0, 40, "b", 0.75), (2, day(5), 0, 0, None, None, 0, None, None)],
                                     "entity long, date date, a long, b long, a_change double, b_change double, total long, dominant string, dominant_ratio double")
    got = {(r.entity, r.asof, r.category): r for r in SM.collateral_summary(asks, balances, ["a", "b"]).collect()}
    assert {k[:2] for k in got} == wanted(asks) and len(got) == 2 * len(wanted(asks))
    assert [got[(1, day(10), c)].balance for c in "ab"] == [30, 0] and got[(1, day(10), "a")].ratio == 1.0
    assert got[(1, day(30), "b")].ratio == 0.75 and got[(1, day(30), "b")].is_concentrated
    assert got[(2, day(10), "a")].ratio is None and not got[(2, day(10), "a")].is_concentrated
    assert got[(3, day(10), "a")].date is None and got[(3, day(10), "a")].balance is None
    macro = spark.createDataFrame([(1, day(0), 5.0, None, None, "neutral", None), (1, day(9), 6.0, 20.0, -2.0, "up", 3)], "entity long, date date, price double, return_pct double, zscore double, momentum string, streak int")
    got = {(r.entity, r.asof): r for r in SM.commodity_summary(asks, macro).collect()}
    assert got[(1, day(0))].streak == 0 and not got[(1, day(0))].is_spike and got[(1, day(10))].is_spike
    assert not got[(1, day(-5))].is_available and not got[(3, day(31))].is_available


def test_trend_is_stale_after_a_week_and_floors_its_band(spark, asks):
    rows = [(e, day(n), h, 101.0, 100.0, u, 0.1, "stable_up") for e in (1, 2) for n in (0, 3) for h, u in (("short", 2.0), ("medium", 0.5), ("long", 0.5), ("ultra_long", 0.5))]
    c = spark.createDataFrame(rows, "entity long, date date, horizon string, close double, smoothed double, uncertainty double, velocity double, regime string")
    got = {(r.entity, r.asof, r.horizon): r for r in SM.trend_at(asks, c).collect()}
    assert len(got) == 4 * len(wanted(asks))
    assert (got[(1, day(10), "medium")].deviation, got[(1, day(10), "medium")].band_high) == (1.0, 101.0)
    assert got[(1, day(10), "short")].deviation == 0.5 and got[(1, day(10), "short")].age_days == 7 and not got[(1, day(10), "short")].is_stale
    assert got[(1, day(30), "long")].is_stale and got[(3, day(30), "long")].is_stale is None
    changes = spark.createDataFrame([(1, "medium", day(-3 * k), f"r{k}", f"r{k - 1}") for k in range(80)] + [(1, "short", day(0), "x", "y")], "entity long, horizon string, date date, from_regime string, to_regime string")
    last = sorted((r.nth, r.date) for r in SM.recent_changes(asks, changes).where((F.col("entity") == 1) & (F.col("asof") == day(10))).collect())
    assert last == [(k + 1, day(-3 * k)) for k in range(5)]


def test_lists_and_triggers_read_the_newest_day(spark):
    r = spark.createDataFrame([(day(m), e, e if e < 5 else None, 4, float(e)) for m in (0, 30) for e in range(1, 6)], "date date, entity long, rank int, universe_size int, metric double")
    days = spark.createDataFrame([(day(-1),), (day(29),), (day(40),)], "asof date")
    got = sorted((x.asof, x.factor, x.date, x.entity) for x in SC.factor_lists({"a": r, "b": r.filter(F.col("date") == day(0))}, days, 2).collect())
    assert got == sorted([(day(29), f, day(0), e) for f in "ab" for e in (1, 2)] + [(day(40), f, d, e) for f, d in (("a", day(30)), ("b", day(0))) for e in (1, 2)])
    t = spark.createDataFrame([(e, day(0), k, y, 0.5) for e, k, y in ((1, "positive", 40.0), (2, "positive", 90.0), (3, "positive", 90.0), (4, "negative", -25.0), (5, "negative", -70.0))], "entity long, date date, trigger_type string, yoy double, net_pct double")
    got = sorted((x.trigger_type, x["rank"], x.entity, x.total) for x in SC.trigger_scan(t, days.filter(F.col("asof") == day(29)), 2).collect())
    assert got == [("negative", 1, 5, 2), ("negative", 2, 4, 2), ("positive", 1, 2, 3), ("positive", 2, 3, 3)]
    assert SC.trigger_scan(t.limit(0), days).count() == 0


def test_phases_and_their_histogram(spark):
    rows = [(1, day(20), 3, -1, "zigzag", day(6)), (2, day(20), 3, -1, "zigzag", day(5)), (3, day(20), 3, 1, "flat_common", day(20)), (4, day(20), 5, 1, "impulse", day(20)), (5, day(20), 5, 1, "triangle", day(1))]
    p = SC.phases(spark.createDataFrame(rows, "entity long, asof date, legs int, direction int, pattern string, end_date date"))
    assert [x.phase for x in p.orderBy("entity").collect()] == ["correction_done_down", "correction_ongoing", "correction_done_up", "impulse_complete", "other"]
    asks = spark.createDataFrame([(e, day(20)) for e in range(1, 9)], "entity long, asof date")
    assert {x.phase: x.n for x in SC.phase_histogram(asks, p).collect()} == {"correction_done_down": 1, "correction_ongoing": 1, "correction_done_up": 1, "impulse_complete": 1, "other": 1, "none": 3}
    setups = spark.createDataFrame([(6, day(20), "daily", 1, 2.5, 0), (7, day(20), "weekly", 1, 3.0, 0)], "entity long, asof date, timeframe string, rank int, rr double, aligned int")
    got = sorted((x.part, x["rank"], x.entity) for x in SC.wave_scan(setups, p, n=3).collect())
    assert got == [("candidate", 1, 6), ("observe", 1, 2), ("observe", 2, 3), ("observe", 3, 4)]


def test_labels_of_ratings_and_structures(spark):
    rows = [(p, K.RATINGS.get(p, "neutral")) for p in (-3, -2, -1, 0, 1, 2, 3, 7, None)]
    r = K.power_rating(F.col("p"))
    got = spark.createDataFrame(rows, "p int, want string").select("p", "want", r.alias("r"), K.rating_strength(r).alias("n"), K.rating_sign(r).alias("s"), K.rating_direction(r).alias("d")).collect()
    for x in got:
        p = x.p if x.p is not None and abs(x.p) <= 3 else 0
        assert (x.r, x.n, x.s) == (x.want, abs(p), (p > 0) - (p < 0)) and x.d == ("bullish" if p > 0 else "bearish" if p < 0 else "neutral")
    labels = [("5-wave from mw27 to mw31", 5), ("no number", 0), ("", 0), (None, 0), ("x 13-wave, 2-wave", 13), ("99999999999-wave", 0)]
    assert all(x.got == x.want for x in spark.createDataFrame(labels, "t string, want int").select("want", K.wave_count(F.col("t")).alias("got")).collect())
