"""Hand-computed and brute-force checks of operators on small fixtures."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import scalars as K
from tidemark.functions.events import Rule, detect, rearmed_touches
from tidemark.functions.ranking import dealt_by_range, group_quantiles, ranked_rows
from tidemark.operators import aggregates as A
from tidemark.operators import detection as D
from tidemark.operators import forecast as FC
from tidemark.operators import fusion as FU
from tidemark.operators import indicators as I
from tidemark.operators import joins as J
from tidemark.operators import pit as P
from tidemark.operators import recursive as R
from tidemark.operators import waves as WV
from tidemark.sources import shaping as S
from tidemark.streaming.incremental import incremental

DAY0 = dt.date(2020, 1, 1)


def day(i):
    return DAY0 + dt.timedelta(days=i)


def make_bars(spark, n=300, entities=(1, 2), seed=1):
    """Random-walk bars."""
    rng = random.Random(seed)
    rows = []
    for e in entities:
        px = 100.0
        for i in range(n):
            o = px
            px = max(1.0, px * (1 + rng.uniform(-0.04, 0.041)))
            rows.append((e, day(i), o, max(o, px) * (1 + rng.uniform(0.001, 0.02)), min(o, px) * (1 - rng.uniform(0.001, 0.02)), px, rng.randint(1, 1000)))
    return spark.createDataFrame(rows, "entity long, date date, open double, high double, low double, close double, volume long")


def series(df, col, entity=1):
    return np.array([r[col] for r in df.filter(F.col("entity") == entity).orderBy("date").select(col).collect()], dtype=float)


def test_ema_and_rsi_match_plain_recursion(spark):
    b = make_bars(spark).cache()
    c = series(b, "close")
    e = [c[0]]
    for x in c[1:]:
        e.append(2 / 21 * x + (1 - 2 / 21) * e[-1])
    assert np.allclose(series(R.exponential_averages(b), "ema"), e)
    d = np.diff(c)
    g, l = np.maximum(d[:14], 0).mean(), np.maximum(-d[:14], 0).mean()
    want = [0.0] * 14 + [100 - 100 / (1 + g / l)]
    for x in d[14:]:
        g, l = (13 * g + max(x, 0)) / 14, (13 * l + max(-x, 0)) / 14
        want.append(100 - 100 / (1 + g / l))
    assert np.allclose(series(R.rsi(b), "rsi"), want)


def test_series_survive_arrow_batch_boundaries(spark):
    b = make_bars(spark, n=120, entities=(1, 2, 3)).cache()
    want = {e: series(R.macd(b), "macd", e) for e in (1, 2, 3)}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        for e in (1, 2, 3):
            assert np.allclose(series(R.macd(b), "macd", e), want[e])
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_results_do_not_depend_on_partitioning_or_the_future(spark):
    b = make_bars(spark).cache()
    cut_day = day(200)
    full = {(r.entity, r.date): r.percent_b for r in I.bollinger(b.repartition(7, "volume")).collect() if r.date <= cut_day}
    early = {(r.entity, r.date): r.percent_b for r in I.bollinger(b.filter(F.col("date") <= cut_day)).collect()}
    assert full.keys() == early.keys()
    assert all(abs(full[k] - early[k]) < 1e-9 for k in full)


def test_refractory_keeps_greedy_events(spark):
    hits = [0, 3, 9, 10, 11, 20, 29, 30]
    s = spark.createDataFrame([(1, day(i), i, i in hits) for i in range(40)], "entity int, date date, idx int, hit boolean")
    got = sorted(r.value for r in detect(s, [Rule("x", "hit", "idx", 10)]).collect())
    want, last = [], -10**6
    for h in hits:
        if h - last >= 10:
            want.append(h)
            last = h
    assert got == want


def test_rearmed_touches_against_state_machine(spark):
    rng = random.Random(5)
    rows = [(1, day(i), rng.random() < 0.3, rng.random() < 0.3) for i in range(300)]
    s = spark.createDataFrame(rows, "entity int, date date, t boolean, r boolean")
    on, want = False, []
    for _, d, t, r in rows:
        if t and not on:
            want.append(d)
            on = True
        elif r:
            on = False
    got = sorted(r.date for r in rearmed_touches(s, "k", "t", "r", "1").collect())
    assert got == want


def test_failure_swings_against_plain_scan(spark):
    rng = random.Random(2)
    v = [0.0] * 14 + [min(95, max(5, 50 + 45 * np.sin(i / 6) + rng.uniform(-15, 15))) for i in range(400)]
    s = spark.createDataFrame([(1, day(i), float(x)) for i, x in enumerate(v)], "entity long, date date, rsi double")
    want, state, low = [], 0, 0.0
    for i, x in enumerate(v):
        if x <= 0:
            continue
        if state == 0:
            state = 1 if x >= 70 else 0
        elif state == 1:
            if x < 70:
                state, low = 2, x
        elif state == 2:
            if x < low:
                low = x
            elif x >= 70:
                state = 1
            elif x > v[i - 1]:
                state = 3
        elif x >= 70:
            state = 1
        elif x < low:
            want.append(day(i))
            state = 0
    got = sorted(r.date for r in D.failure_swings(s).filter("event_kind = 'bearish_failure_swing'").collect())
    assert got == want and want


def test_ranks_with_ties_and_skewed_values(spark):
    rng = random.Random(3)
    rows = [(i, day(i % 3), float(rng.choice([0, 0, 0, 1, 5, rng.random() * 1e6, -rng.random()]))) for i in range(900)]
    df = spark.createDataFrame(rows, "entity long, date date, m double")
    for asc in (True, False):
        got = {(r.date, r.entity): (r.rank, r.universe_size) for r in ranked_rows(df, ["date"], "m", asc).collect()}
        for d in {r[1] for r in rows}:
            group = sorted((r for r in rows if r[1] == d), key=lambda r: (r[2] if asc else -r[2], r[0]))
            for k, r in enumerate(group, 1):
                assert got[(d, r[0])] == (k, len(group))


def test_rank_splits_one_huge_tie(spark):
    df = spark.range(500).select(F.col("id").alias("entity"), F.lit(day(0)).alias("date"), F.lit(7.0).alias("m"))
    assert [r.rank for r in ranked_rows(df, ["date"], "m").orderBy("entity").collect()] == list(range(1, 501))


def test_group_quantiles_match_numpy(spark):
    rng = random.Random(4)
    rows = [(i, i % 4, rng.gauss(0, 100)) for i in range(400)]
    df = spark.createDataFrame(rows, "entity long, g int, v double")
    for r in group_quantiles(df, ["g"], "v", {"a": 0.5, "b": 0.95}).collect():
        v = [x[2] for x in rows if x[1] == r.g]
        assert np.allclose([r.a, r.b], np.quantile(v, [0.5, 0.95]))


def events(spark, rows):
    cols = "entity long, date date, event_type string, before_price double, reference_price double, cash_dividend double, stock_dividend double, subscription_price double, subscription_rate double, volume_factor double"
    return spark.createDataFrame(rows, cols)


def test_adjustment_paths_and_event_bar_stays_raw(spark):
    bars = spark.createDataFrame([(1, day(i), 10.0, 10.0, 10.0, 10.0, 100) for i in range(6)], "entity long, date date, open double, high double, low double, close double, volume long")
    ev = events(spark, [
        (1, day(2), "dividend", None, None, 1.0, 0.0, None, None, None),       # formula: 10 / 9
        (1, day(4), "split", 10.0, 5.0, None, None, None, None, 0.5),            # ratio 2
        (1, day(4), "dividend", 10.0, 10.0, 0.0, 10.0, None, None, None),        # unreliable ratio, formula 10 / (10 / 2) = 2
        (1, day(9), "split", 10.0, 5.0, None, None, None, None, None),           # no bar on that day
    ])
    f = {r.date: (r.af, r.vf) for r in P.adjustment_factors(ev, bars).collect()}
    assert f[day(2)][0] == pytest.approx(10 / 9) and f[day(4)] == pytest.approx((4.0, 0.5))
    got = [r.adj_close for r in P.back_adjusted(bars, P.adjustment_factors(ev, bars)).orderBy("date").collect()]
    assert got == pytest.approx([44.44, 44.44, 40.0, 40.0, 10.0, 10.0])


def test_asof_adjusted_ignores_later_events(spark):
    bars = spark.createDataFrame([(1, day(i), 10.0, 10.0, 10.0, 10.0, 100) for i in range(6)], "entity long, date date, open double, high double, low double, close double, volume long")
    ev = events(spark, [(1, day(0), "split", 10.0, 5.0, None, None, None, None, None), (1, day(2), "split", 10.0, 5.0, None, None, None, None, None), (1, day(4), "split", 10.0, 5.0, None, None, None, None, None)])
    req = spark.createDataFrame([(1, day(3))], "entity long, asof date")
    got = [r.adj_close for r in P.asof_adjusted(req, bars, P.adjustment_factors(ev, bars), 10).orderBy("date").collect()]
    assert got == pytest.approx([20.0, 20.0, 10.0, 10.0])


def test_asof_join_edges(spark):
    rows = spark.createDataFrame([(1, day(0), 5), (1, day(10), None), (1, day(20), 7)], "entity int, date date, v int")
    req = spark.createDataFrame([(1, day(0)), (1, day(15)), (1, day(200)), (2, day(5))], "entity int, asof date")
    get = lambda **kw: {(r.entity, r.asof): r.v for r in P.asof_join(req, rows, ["v"], **kw).collect()}
    assert get()[(1, day(15))] is None and get(skip_null="v")[(1, day(15))] == 5
    assert get()[(1, day(0))] == 5 and get(strict=True)[(1, day(0))] is None
    assert get(tolerance_days=60)[(1, day(200))] is None and get()[(2, day(5))] is None


def test_visibility_and_empty_calendar(spark):
    f = spark.createDataFrame([(1, day(0), day(50)), (2, day(0), None), (3, day(40), None)], "id int, fact_date date, report_date date")
    at = F.lit(day(44))
    assert {r.id for r in f.filter(P.visible_at(at, lag=45)).collect()} == set()
    assert {r.id for r in f.filter(P.visible_at(F.lit(day(45)), lag=45)).collect()} == {2}
    assert {r.id for r in f.filter(P.visible_at(at)).collect()} == {2, 3}
    d = spark.createDataFrame([(day(0),), (None,), (day(1),)], "date date")
    cal = spark.createDataFrame([(day(0),)], "date date")
    assert P.trading_days_only(d, cal).count() == 2
    assert P.trading_days_only(d, cal.limit(0)).count() == 3


def test_argument_checks():
    for kw in ({"entity": " "}, {"lookback": -1}, {"items": []}):
        with pytest.raises(ValueError):
            P.require(**kw)


def test_growth_uses_calendar_periods(spark):
    rev = spark.createDataFrame([(1, dt.date(2020, 1, 1), 100), (1, dt.date(2020, 12, 1), 50), (1, dt.date(2021, 1, 1), 150), (1, dt.date(2021, 3, 1), 10)], "entity int, date date, revenue long")
    got = {r.date: (r.yoy, r.mom) for r in A.period_growth(rev).collect()}
    assert got[dt.date(2021, 1, 1)] == (50.0, 200.0) and got[dt.date(2021, 3, 1)] == (None, None)


def test_upserts(spark):
    a = spark.createDataFrame([(1, "x", 1), (2, "y", 1)], "id int, v string, version int")
    b = spark.createDataFrame([(1, "z", 2)], "id int, v string, version int")
    assert {(r.id, r.v) for r in S.upsert(a, b, ["id"], "version").collect()} == {(1, "z"), (2, "y")}
    c = a.withColumn("resolved_date", F.when(F.col("id") == 1, F.lit(day(0))))
    d = b.union(spark.createDataFrame([(2, "n", 2)], b.schema)).withColumn("resolved_date", F.lit(None).cast("date"))
    assert {(r.id, r.v) for r in S.upsert_forecasts(c, d, ["id"], "version").collect()} == {(1, "x"), (2, "n")}
    assert S.append_new(a, a.union(b.withColumn("id", F.lit(9))), ["id"]).count() == 1


def test_partition_overwrite_is_idempotent(spark, tmp_path):
    b = make_bars(spark, n=500)
    S.write_days(b, str(tmp_path / "t"))
    S.write_days(b.filter("year(date) = 2021").withColumn("volume", F.lit(1).cast("long")), str(tmp_path / "t"))
    t = spark.read.parquet(str(tmp_path / "t"))
    assert t.count() == 1000 and t.filter("year(date) = 2021 and volume <> 1").count() == 0 and t.filter("year(date) = 2020 and volume <> 1").count() > 0


def test_patches(spark):
    ev = spark.createDataFrame([(1, day(0), "dividend", None, None), (1, day(1), "dividend", 3.0, 0.0)], "entity int, date date, event_type string, cash_dividend double, stock_dividend double")
    st = spark.createDataFrame([(1, day(9), day(0), 1.5, 0.5, 20.0)], "entity int, cash_date date, stock_date date, cash_dividend double, stock_dividend double, subscription_price double")
    got = {r.date: (r.cash_dividend, r.stock_dividend) for r in J.patch_mixed(ev, st).collect()}
    assert got == {day(0): (1.5, 0.5), day(1): (3.0, 0.0)}
    assert [r.date for r in J.missing_increases(ev, st).collect()] == [day(0)]


def test_inverse_normal_and_losses(spark):
    r = spark.range(1).select(K.inverse_normal(F.lit(0.975)).alias("z"), K.inverse_normal(F.lit(0.01)).alias("t"), K.interval_pinball(F.lit(12.0), F.lit(8.0), F.lit(10.0), F.lit(0.8)).alias("p")).first()
    assert r.z == pytest.approx(1.959964, abs=1e-6) and r.t == pytest.approx(-2.326348, abs=1e-6)
    assert r.p == pytest.approx((0.1 * 4 + 0.9 * 2) / 2)


def test_interval_fusion_cases(spark):
    rows = [(1, 0.0, 10.0), (1, 5.0, 12.0), (2, 0.0, 2.0), (2, 8.0, 10.0)]
    f = spark.createDataFrame([(e, day(0), "s", 21, 0.8, lo, hi) for e, lo, hi in rows], "entity int, forecast_date date, source string, horizon int, confidence double, lower double, upper double")
    got = {r.entity: (r.lower, r.upper) for r in FC.fuse(f).collect()}
    assert got[1] == (5.0, 10.0)
    half = 1 + np.std([1, 9], ddof=1)
    assert got[2] == pytest.approx((5 - half, 5 + half))


def test_conformal_needs_enough_resolved_history(spark):
    n = 60
    base = [(1, day(i), "s", 5, 0.8, 0.0, 10.0, 5.0) for i in range(n)]
    f = spark.createDataFrame(base, "entity int, forecast_date date, source string, horizon int, confidence double, lower double, upper double, point double")
    st = f.withColumns({"realized": F.lit(12.0), "resolved_date": F.expr("date_add(forecast_date, horizon)")})
    got = {r.forecast_date: (r.q, r.n_past) for r in FC.conformal(f, st).collect()}
    assert min(got) == day(34) and got[day(34)] == (2.0, 30)
    assert min(r.forecast_date for r in FC.conformal(f, st, strict=False).collect()) == day(30)


def test_manual_forecast_is_validated(spark):
    bad = spark.createDataFrame([(1, day(0), 21, 0.8, 5.0, 4.0)], "entity int, forecast_date date, horizon int, confidence double, lower double, upper double")
    with pytest.raises(Exception, match="invalid forecast row"):
        FC.manual_rows(bad).collect()


def test_trend_filter_follows_a_line(spark):
    b = spark.createDataFrame([(1, day(i), 100.0 + i) for i in range(200)], "entity long, date date, close double")
    f = FC.trend_filter(FC.month_ends(FC.unadjusted(I.indexed(b))), (21,), (0.8,)).orderBy(F.desc("forecast_date")).first()
    assert f.point == pytest.approx(299 + 15, abs=0.5) and f.lower < f.point < f.upper


def test_clusters_anchor_on_first_member(spark):
    pts = spark.createDataFrame([(1, p, s) for p, s in [(100.0, "a"), (100.9, "b"), (101.5, "a"), (102.4, "a"), (200.0, "b")]], "entity int, price double, source string")
    got = sorted((r.low, r.high, r.strength, r.members) for r in FU.cluster_levels(pts).collect())
    assert got == [(100.0, 100.9, 2, 2), (101.5, 102.4, 1, 2), (200.0, 200.0, 1, 1)]


def test_stops_and_nearest_level(spark):
    lv = spark.createDataFrame([(1, 90.0), (1, 110.0)], "entity int, level double")
    e = spark.createDataFrame([(1, day(0), 100.0, 3.0)], "entity int, date date, entry double, atr double")
    got = {r.direction: (r.atr_stop, r.atr_target, r.level_stop, r.level_target) for r in FU.stops_and_targets(e, lv).collect()}
    assert got == {"long": (94.0, 112.0, 90.0, 110.0), "short": (106.0, 88.0, 110.0, 90.0)}
    n = J.nearest_level(e.select("entity", F.lit(109.0).alias("price")), lv).first()
    assert (n.level, n.is_near) == (110.0, True)


def test_resonance_levels(spark):
    lines = spark.createDataFrame([(1, day(0), 100.0, 100.0), (1, day(0), 150.0, 100.0)], "entity int, asof date, line double, close double")
    bands = spark.createDataFrame([(1, day(0), h, 90.0, 112.0, 101.0) for h in (21, 63)], "entity int, asof date, horizon int, lower double, upper double, point double")
    tops = spark.createDataFrame([(1, day(0), True)], "entity int, asof date, is_top_n boolean")
    got = {r.line: (r.level, r.tightest_horizon, r.profile_126) for r in FU.resonance(lines, bands, tops).collect()}
    assert got == {100.0: ("strong", 21, "divergence"), 150.0: ("divergence", None, "divergence")}


def test_ranges_are_even_for_narrow_values_and_alike_ids(spark):
    n = 1_000_000
    df = spark.range(n).select(F.lit("2001-01-31").alias("date"), F.concat(F.lit("customer-"), F.format_string("%09d", "id")).alias("entity"), (100 + F.expr("cast(id % 7 as double)") * 0.01).alias("m"))
    sizes = [r["count"] for r in dealt_by_range(df, [F.col("date"), F.col("m").desc(), F.col("entity").asc()]).groupBy("_p").count().collect()]
    assert sum(sizes) == n and max(sizes) < 2 * n / len(sizes) and len(sizes) > 1
    top = ranked_rows(df, ["date"], "m", False).filter("rank in (1, 2, 1000000)").orderBy("rank").collect()
    assert [r.entity for r in top] == ["customer-000000006", "customer-000000013", "customer-000999999"] and top[0].universe_size == n


def test_signs_follow_the_catalogue(spark):
    kinds = ["breakout_up", "breakdown", "zero_cross_positive", "debt_ratio_rising", "eps_turn_positive", "hammer", "doji", "unknown"]
    df = spark.createDataFrame([(k,) for k in kinds], "k string")
    assert [r.s for r in df.select(FU.kind_sign("k").alias("s")).collect()] == [1, -1, 1, -1, 1, 1, 0, 0]
    assert [r.sign for r in D.DONCHIAN_RULES] == [1, -1]


def test_incremental_equals_full(spark):
    b = make_bars(spark).cache()
    part = {(r.entity, r.date): r.upper for r in incremental(I.bollinger, b, str(day(299)), 120, 30).collect()}
    full = {(r.entity, r.date): r.upper for r in I.bollinger(b).collect()}
    assert len(part) == 60 and all(abs(full[k] - v) < 1e-9 for k, v in part.items())
    with pytest.raises(ValueError):
        incremental(I.bollinger, b, str(day(299)), 30, 30)


def test_hot_entity_becomes_an_ordinary_series(spark, tmp_path):
    """A supplier with most raw rows yields one bar per day, with the right open and close."""
    from tidemark.sources import views as V

    hot = spark.range(6000).select(
        F.col("id").alias("l_orderkey"), F.lit(1).cast("long").alias("l_suppkey"), F.lit(1).alias("l_linenumber"), F.lit(1.0).alias("l_quantity"), (F.col("id") + 1).cast("double").alias("l_extendedprice"),
        F.lit(0.0).alias("l_discount"), F.lit("N").alias("l_returnflag"), F.lit("O").alias("l_linestatus"), F.expr("timestamp'2020-01-01' + make_interval(0, 0, 0, cast(id % 10 as int))").alias("l_shipdate"))
    cold = hot.limit(20).withColumn("l_suppkey", F.lit(2).cast("long"))
    hot.union(cold).write.parquet(f"{tmp_path}/lineitem.parquet")
    got = V.bars(spark, str(tmp_path)).filter("entity = 1").orderBy("date").collect()
    assert len(got) == 10 and sum(r.volume for r in got) == 6000
    assert (got[3].open, got[3].close, got[3].high) == (4.0, 5994.0, 5994.0)
