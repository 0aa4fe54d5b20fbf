"""Rules read each window once, and long extremes from short frames, with the results of the plain windows."""

import random
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidemark.functions import texts as X
from tidemark.functions.events import Rule, candidates
from tidemark.functions.windows import wide_extremes


@pytest.fixture(scope="module")
def series(spark):
    rng = random.Random(5)
    rows = [(e, i, rng.choice([None, float("nan"), -0.0, 0.0, *range(-9, 10)]) if e else float(i)) for e, n in ((0, 400), (1, 600), (2, 7)) for i in range(n)]
    return spark.createDataFrame([(e, i, None if v is None else float(v)) for e, i, v in rows], "entity long, idx int, x double").withColumn("date", F.expr("date_add(date'2020-01-01', idx)"))


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize(("n", "gap"), [(252, 1), (252, 0), (100, 3), (2, 1), (1, 1), (17, 0)])
def test_wide_extremes(series, n, gap):
    w = Window.partitionBy("entity").orderBy("date").rowsBetween(-(n + gap - 1), -gap)
    df = wide_extremes(series, {"hi": ("max", "x", n, gap), "lo": ("min", "x", n, gap)})
    df = df.withColumns({"hi0": F.max("x").over(w), "lo0": F.min("x").over(w)})
    assert df.filter("NOT hi <=> hi0 OR NOT lo <=> lo0").count() == 0


def test_each_window_is_evaluated_once(series):
    high, mean = X.past("max", "x", 252), X.past("avg", "x", 60)
    rules = [Rule("high", f"x > {high}", high), Rule("far", f"abs(x - {mean}) > 3", f"x - {mean}"), Rule("far_high", f"x > {high} AND x > {mean}", "x", 2)]
    found = candidates(series, rules)
    text = plan(found)
    assert len(re.findall(r"avg\(\S+\) windowspecdefinition", text)) == 1
    assert "RowFrame, -252, -1" not in text
    plain = series.select("entity", "date", *[F.when(F.expr(r.when), F.expr(r.value)).alias(r.kind) for r in rules], *[F.expr(f"coalesce({r.when}, false)").alias(f"{r.kind}_hit") for r in rules])
    for r in rules:
        want = {(x.entity, x.date, str(x[r.kind])) for x in plain.filter(f"{r.kind}_hit").collect()}
        assert want and {(x.entity, x.date, str(x.value)) for x in found.filter(F.col("event_kind") == r.kind).collect()} == want


@pytest.mark.parametrize(("name", "frames"), [("foreign_holding_events", 7), ("commodity_events", 3)])  # at most; 15 and 4 before
def test_sliding_frames_are_few_and_short(spark, sf, name, frames):
    sliding = [int(n) for n in re.findall(r"RowFrame, -(\d+), (?:-1\)|currentrow)", plan(entry.queries()[name](spark, sf))) if n != "1"]
    assert len(sliding) <= frames and max(sliding) <= 60
