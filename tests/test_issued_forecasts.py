"""Forecasts kept in the row of their bar: same results as the general operators, and no shuffle of forecasts."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidemark.operators import forecast as FC
from tidemark.plans import forecast as PF
from tidemark.sources import views as V

QUERIES = entry.queries()
KEYS = ["entity", "forecast_date", "source", "horizon", "confidence"]


@pytest.fixture(scope="module")
def long(spark, sf):
    return FC.unpack(PF.issued(spark, sf), PF.both()).filter("entity <= 3").cache()


@pytest.fixture(scope="module")
def due(spark, sf, long):
    b = V.bars(spark, sf)
    return FC.settle(long, b, PF.last_day(b)).cache()


def rows(df, *cols):
    return sorted(tuple(r[c] if not isinstance(r[c], float) else round(r[c], 6) for c in (*KEYS, *cols)) for r in df.filter("entity <= 3").collect())


def test_settled_without_a_join(spark, sf, due):
    cols = ("resolved_date", "realized", "hit", "pinball")
    assert rows(PF.settled(spark, sf), *cols) == rows(due, *cols) != []


def test_fused_in_the_row(spark, sf, long):
    got = FC.fuse_cells(PF.issued(spark, sf), [PF.cells(s) for s in PF.SOURCES])
    cols = ("lower", "upper", "point", "n_sources", "intersects")
    assert rows(got, *cols) == rows(FC.fuse(long), *cols) != []


@pytest.mark.parametrize("strict", [True, False])
def test_calibrated_in_the_row(spark, sf, long, due, strict):
    got = FC.conformal_issued(PF.issued(spark, sf, realized=True), PF.both(), strict=strict)
    cols = ("lower", "upper", "q", "n_past")
    assert rows(got, *cols) == rows(FC.conformal(long, due, strict=strict), *cols) != []


@pytest.mark.parametrize("name", ["interval_fusion", "settled_forecasts", "preferred_bands", "conformal_calibration_daily", "conformal_calibration_by_issue"])
def test_forecasts_are_not_shuffled(spark, sf, name):
    plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange" in line and "Scan" not in line]
    assert len(moved) == 2 and not any("horizon" in line for line in moved), plan


def test_missing_prices_are_no_returns(spark):
    """A bar without a price leaves its returns out, as the SQL does."""
    days = spark.range(60).select(F.lit(1).alias("entity"), F.expr("date_add(date'2020-01-01', cast(id as int))").alias("date"),
                                  F.when(F.col("id") != 30, 100.0 + F.col("id")).alias("close"))
    got = FC.baseline(FC.every_bar(FC.unadjusted(days)), (5,), (0.5,))
    assert got.filter("lower is null or isnan(lower)").count() == 0 and got.filter("forecast_date = date'2020-02-25'").count() == 1


@pytest.mark.parametrize("seed", [1, 2])
def test_ranks_by_bits_are_those_of_a_sorted_window(seed):
    g = np.random.default_rng(seed)
    sizes = [1, 7, 64, 200]
    series = np.repeat(np.arange(len(sizes)), sizes)
    values = g.integers(-20, 20, len(series)) / 4.0  # many ties
    starts = np.concatenate([[0], np.cumsum(sizes)])
    first, last, k = [], [], []
    for s in range(len(sizes)):
        for last_ in range(starts[s] + 1, starts[s + 1] + 1):
            first.append(max(starts[s], last_ - 50)), last.append(last_), k.append(g.integers(0, last_ - first[-1]))
    got = FC._smallest(values, series, *(np.array(x) for x in (first, last, k)))
    assert got.tolist() == [sorted(values[a:b])[i] for a, b, i in zip(first, last, k)]


def test_calibration_sends_no_structs_to_python(spark, sf):
    """Cells went to Python and back as structs with their names; now numbers go, and a forecast is a row there."""
    df = FC.conformal_issued(PF.issued(spark, sf, realized=True), PF.both())
    plan = df._jdf.queryExecution().analyzed()
    fields = plan.children().head().schema().toDDL() if plan.nodeName().startswith("MapInArrow") else "STRUCT"
    assert "STRUCT" not in fields and "_lower17 DOUBLE" in fields, fields


def test_windows_of_misses_slide_within_their_series(spark, sf, long, due):
    """A window shorter than a series forgets, whatever batch its rows come in."""
    cols = ("lower", "upper", "q", "n_past")
    was = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "700")
    try:
        got = FC.conformal_issued(PF.issued(spark, sf, realized=True), PF.both(), window=40, min_size=10)
        want = FC.conformal(long, due, window=40, min_size=10)
        assert rows(got, *cols) == rows(want, *cols) != []
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", was)
