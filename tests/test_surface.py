"""SQL functions, declared warm-ups and declared sources."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import surface
from tidemark.operators import catalogue as C
from tidemark.operators import waves as WV
from tidemark.sources import declared as DC

DAY = dt.date(2022, 1, 1)


@pytest.fixture(scope="module")
def bars(spark):
    g = np.random.default_rng(11)
    rows = []
    for e, n in ((1, 1), (2, 2), (3, 40), (4, 900), (5, 700)):
        c = (50 + np.abs(np.cumsum(g.normal(size=n)))).round(1)
        o = (c + g.normal(size=n)).round(1)
        rows += [(e, DAY + dt.timedelta(days=i), float(a), float(max(a, b) + 0.5), float(min(a, b) - 0.4), float(b), int(v)) for i, (a, b, v) in enumerate(zip(o, c, g.integers(1, 90, n)))]
    rows += [(6, DAY + dt.timedelta(days=i), 10.0, 11.0, 9.0, 10.0, 5) for i in range(30)]
    return spark.createDataFrame(rows, "entity long, date date, open double, high double, low double, close double, volume long").cache()


def test_swing_legs_from_sql_equal_the_operator(spark, bars):
    surface.register(spark)
    got = spark.sql("SELECT * FROM swing_legs(TABLE({b}))", b=bars)
    want = WV.legs(bars)
    key = lambda df: {(r.entity, r.wave_no): (r.start_date, r.end_date, r.direction, r.start_idx, r.end_idx, pytest.approx(r.atr_start), r.start_price, r.end_price) for r in df.collect()}
    assert key(got) == key(want) and {r.entity for r in got.collect()} == {2, 3, 4, 5}
    wide = spark.sql("SELECT * FROM swing_legs(TABLE({b}), reversal => 2.0, atr_period => 5)", b=bars)
    assert key(wide) == key(WV.legs(bars, 2.0, 5)) and wide.count() < got.count()
    with pytest.raises(Exception, match="bars lack high"):
        spark.sql("SELECT * FROM swing_legs(TABLE({b}))", b=bars.drop("high")).collect()
    assert spark.sql("SELECT * FROM swing_legs(TABLE({b}))", b=bars.limit(0)).count() == 0
    gaps = bars.union(bars.select("entity", F.date_add("date", 2000), *[F.lit(None).cast("double")] * 4, "volume"))
    assert key(spark.sql("SELECT * FROM swing_legs(TABLE({b}))", b=gaps)) == key(got)


def test_aggregates_from_sql(spark):
    surface.register(spark)
    g = np.random.default_rng(1)
    rows = [(n, float(v), c) for n, c in ((29, 0.8), (30, 0.8), (100, 0.95), (30, 0.99)) for v in g.integers(-9, 9, n)] + [(30, None, 0.8)]
    got = {(r.g, r.c): r.q for r in spark.createDataFrame(rows, "g int, miss double, c double").groupBy("g", "c").agg(F.expr("cqr_quantile(miss, c)").alias("q")).collect()}
    for (n, c), q in got.items():
        v = sorted(m for a, m, b in rows if (a, b) == (n, c) and m is not None)
        k = int(np.ceil((len(v) + 1) * c - 1e-9))
        assert q == (v[k - 1] if len(v) >= 30 and k <= len(v) else None)
    bands = [("meet", 1.0, 5.0), ("meet", 3.0, 9.0), ("apart", 0.0, 2.0), ("apart", 10.0, 14.0), ("one", 1.0, 2.0), ("one", None, 7.0), ("none", None, 7.0)]
    got = {r.g: r.b for r in spark.createDataFrame(bands, "g string, lo double, hi double").groupBy("g").agg(F.expr("interval_fuse(lo, hi)").alias("b")).collect()}
    half = 2.0 + np.std([1.0, 12.0], ddof=1)
    assert got == {"meet": [3.0, 5.0], "apart": [pytest.approx(6.5 - half), pytest.approx(6.5 + half)], "one": [1.0, 2.0], "none": None}


@pytest.mark.parametrize("name", sorted(C.INDICATORS))
def test_declared_warmup_is_enough(bars, name):
    ind = C.known(name)
    since = str(DAY + dt.timedelta(days=600))
    full = {(r.entity, r.date): r for r in C.compute(name, bars).filter(F.col("date") >= since).collect()}
    part = C.compute(name, bars, since).collect()
    assert len(part) == len(full) == 400
    for r in part:
        for c in ind.columns:
            want = full[(r.entity, r.date)][c]
            assert r[c] == pytest.approx(want, rel=1e-9 if ind.exact else 1e-6, abs=1e-9 if ind.exact else 1e-5), (c, r.date)


def test_series_shorter_than_the_warmup_and_unknown_names(bars):
    since = str(DAY + dt.timedelta(days=20))
    got = {(r.entity, r.date): r.macd for r in C.compute("macd", bars.filter("entity = 3"), since).collect()}
    assert len(got) == 20 and all(v == pytest.approx(r.macd) for r in C.compute("macd", bars.filter("entity = 3")).collect() if (v := got.get((r.entity, r.date))) is not None)
    with pytest.raises(ValueError, match="no indicator"):
        C.compute("nothing", bars)
    with pytest.raises(ValueError, match="no event rules"):
        C.events("coppock", bars)
    assert C.events("bollinger", bars).count() > 0


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("declared"))
    rows = [(i % 3, dt.datetime(2024, 1, 1 + i % 9, 23, 30), i, float(i), f"n{i}") for i in range(27)]
    spark.createDataFrame(rows, "e int, at timestamp, qty int, px double, note string").write.parquet(f"{root}/ticks.parquet")
    return root


TICKS = DC.Source("ticks", "entity bigint, date date, qty bigint, px double, lot int", stored={"entity": "e", "date": "at"}, optional=("lot",))


def test_declared_scan_prunes_and_pushes_down(spark, store):
    df = DC.load(spark, store, TICKS, "2024-01-02", "2024-01-03", [1], ["entity", "date", "qty"])
    assert df.dtypes == [("entity", "bigint"), ("date", "date"), ("qty", "bigint")]
    assert sorted((r.entity, r.date.day, r.qty) for r in df.collect()) == sorted((i % 3, 1 + i % 9, i) for i in range(27) if i % 3 == 1 and 1 + i % 9 in (2, 3))
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = DC.load(spark, store, TICKS, "2024-01-02", "2024-01-03", [1], ["entity", "date", "qty"])._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan.split("PushedFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(at" in pushed and "LessThan(at" in pushed and "EqualTo(e,1)" in pushed
    assert "px" not in plan.split("ReadSchema:")[1]
    assert [r.lot for r in DC.load(spark, store, TICKS).collect()] == [None] * 27
    assert DC.load(spark, store, TICKS, entities=[]).count() == 0


def test_drift_is_reported_and_stops_a_load(spark, store):
    got = {r.field: (r.status, r.declared, r.stored, r.filled) for r in DC.drift(spark, store, {"t": TICKS}).collect()}
    assert got == {"entity": ("widened", "bigint", "int", 27), "date": ("widened", "date", "timestamp", 27), "qty": ("widened", "bigint", "int", 27), "px": ("ok", "double", "double", 27), "lot": ("absent", "int", None, 0), "note": ("novel", None, "string", 27)}
    for ddl, what in (("entity bigint, px int", "px is retyped"), ("entity bigint, gone int", "gone is missing"), ("qty smallint", "qty is retyped"), ("note double", "note is retyped")):
        with pytest.raises(DC.SchemaDrift, match=what):
            DC.load(spark, store, DC.Source("ticks", ddl, None, {"entity": "e"}))
    with pytest.raises(ValueError, match="has no date"):
        DC.load(spark, store, DC.Source("ticks", "qty int", None), since="2024-01-01")
    with pytest.raises(ValueError, match="not declared"):
        DC.load(spark, store, TICKS, columns=["nope"])
