"""Prices that equal their mean in whole cents are ties, whatever the order of adding rounds to."""

import datetime
import random

from pyspark.sql import functions as F

from tidemark.functions.events import detect
from tidemark.operators import detection as D
from tidemark.operators import indicators as I

DAY = datetime.date(2020, 1, 1)
SCHEMA = "entity int, date date, open double, high double, low double, close double, volume long"


def bars(spark, series):
    return spark.createDataFrame([(e, DAY + datetime.timedelta(days=i), c, c, c, c, 10 + i % 7) for e, cents in series.items() for i, c in enumerate(x / 100 for x in cents)], SCHEMA)


def test_a_close_equal_to_its_mean_is_flat(spark):
    rng, series = random.Random(3), {}
    for e in range(40):
        cents = [rng.randrange(90_000, 9_000_000) for _ in range(58)]
        last = sum(cents) // 58
        series[e] = [*cents, 59 * last - sum(cents), last]  # the 60 add up to 60 times the last
    got = I.index_trend(bars(spark, series)).filter("idx = 59").select("entity", "trend", (F.col("close") - F.col("ma_long")).alias("off")).collect()
    assert len(got) == 40 and all(r.trend == "flat" for r in got) and any(r.off != 0 for r in got)


def test_a_mean_that_does_not_move_is_no_flip(spark):
    rng, series = random.Random(4), {}
    for e in range(40):
        cents = [rng.randrange(90_000, 9_000_000) for _ in range(24)]
        cents += [cents[4]]  # at 24 the value of 20 days before enters again
        cents += [cents[5] + 5_000_000 * (-1) ** e]  # and at 25 the mean jumps
        series[e] = cents
    df = I.index_trend(bars(spark, series)).drop("slope").withColumns({"macd": F.lit(0.0), "signal": F.lit(0.0), "rsi": F.lit(50.0)})
    assert detect(D.staged(df, **D.INDEX_STAGES), D.INDEX_RULES).filter("event_kind = 'ma20_slope_flip'").filter(F.col("date") == DAY + datetime.timedelta(days=25)).count() == 0
    assert df.count() == 40 * 26
