"""The commit log: stopped runs, resumed runs, changed parameters, half-written attempts."""

import os

import pytest
from pyspark.sql import functions as F

from tidemark.sources.segments import Segments


class Stopped(Exception):
    pass


def job(spark, done, stop_at=None):
    def run(segment):
        if segment == stop_at:
            raise Stopped(segment)
        done.append(segment)
        n = int(segment.split("-")[0])
        return spark.range(n).select(F.lit(segment).alias("segment"), F.col("id").alias("value"), F.lit("extra").alias("unused"))

    return run


SCHEMA = "segment string, value long"
YEARS = ["3-a", "0-b", "5-c/odd name", "2-d"]


def rows(t):
    return sorted(tuple(r) for r in t.read().collect())


def test_a_stopped_run_resumes(spark, tmp_path):
    table, done = Segments(spark, f"{tmp_path}/t", SCHEMA), []
    assert rows(table) == [] and not table.is_completed("3-a")
    with pytest.raises(Stopped):
        table.run(YEARS, job(spark, done, stop_at="5-c/odd name"))
    assert done == ["3-a", "0-b"] and rows(table) == [("3-a", i) for i in range(3)]
    again = Segments(spark, f"{tmp_path}/t", SCHEMA)
    assert again.is_completed("3-a") and again.is_completed("0-b") and again.log()["0-b"]["status"] == "empty"
    assert again.run(YEARS, job(spark, done)) == ["5-c/odd name", "2-d"] and done == YEARS
    assert rows(again) == sorted((y, i) for y in YEARS for i in range(int(y[0])))
    assert again.run(YEARS, job(spark, done)) == [] and sorted(tuple(r) for r in again.read(["2-d", "none"]).collect()) == [("2-d", 0), ("2-d", 1)]


def test_a_failed_write_leaves_nothing_to_see(spark, tmp_path):
    table, done = Segments(spark, f"{tmp_path}/t", SCHEMA), []
    table.run(["3-a"], job(spark, done))
    broken = spark.range(4).select(F.lit("2-d").alias("segment"), F.when(F.col("id") < 3, F.col("id")).otherwise(F.raise_error(F.lit("lost"))).cast("long").alias("value"))
    with pytest.raises(Exception, match="lost"):
        table.run(["2-d"], lambda s: broken)
    # an attempt stopped between the two renames has data that no entry names
    name = next(f for f in os.listdir(tmp_path / "t" / "aside") if f.startswith("2-d"))
    os.rename(tmp_path / "t" / "aside" / name, tmp_path / "t" / "data" / name)
    assert rows(table) == [("3-a", i) for i in range(3)]
    table.run(["2-d"], job(spark, done))
    assert rows(table) == [("2-d", 0), ("2-d", 1), *(("3-a", i) for i in range(3))]
    assert len([f for f in os.listdir(tmp_path / "t" / "data") if f.startswith("2-d")]) == 1


def test_other_parameters_do_a_segment_anew(spark, tmp_path):
    done = []
    Segments(spark, f"{tmp_path}/t", SCHEMA, {"version": 1}).run(["3-a", "2-d"], job(spark, done))
    newer = Segments(spark, f"{tmp_path}/t", SCHEMA, {"version": 2})
    assert newer.run(["3-a"], lambda s: spark.range(1).select(F.lit(s).alias("segment"), F.lit(7).alias("value"))) == ["3-a"]
    assert rows(newer) == [("2-d", 0), ("2-d", 1), ("3-a", 7)] and not newer.is_completed("2-d")
