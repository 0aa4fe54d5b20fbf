"""The trend view served at request days: the states of the whole filter, and no shuffle of a row per bar and horizon."""

import datetime as dt

from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidemark.operators import recursive as R
from tidemark.operators import summaries as SM
from tidemark.sources import views as V

COLS = ("entity", "asof", "horizon", "date", "regime", "age_days", "is_stale", "smoothed", "deviation", "band_low", "band_high")


def rows(df):
    return sorted((str([round(r[c], 6) if isinstance(r[c], float) else r[c] for c in COLS]) for r in df.collect()))


def test_served_states_are_those_of_the_filter(spark, sf):
    b = V.bars(spark, sf).filter("entity <= 3")
    asks = b.select("entity", F.date_add("date", 2).alias("asof")).unionByName(spark.createDataFrame([(1, dt.date(1950, 1, 1)), (99999, dt.date(2000, 1, 1)), (None, dt.date(2000, 1, 1))], "entity long, asof date"))
    got = rows(SM.trend_of(asks, b))
    assert got == rows(SM.trend_at(asks, R.regimes(R.kalman(b)))) and len(got) > 100


def test_series_are_shuffled_before_horizons(spark, sf):
    plan = entry.queries()["trend_view"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "horizon" not in plan[plan.index("RepartitionByExpression"):]
