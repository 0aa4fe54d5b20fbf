"""Forecast rows are computed by methods that the JVM compiles: it runs longer ones as bytecode, several times slower."""

import re

import pytest

import __spark_entry__ as entry

QUERIES = entry.queries()
LIMIT = 8000  # bytes of a method, HotSpot's HugeMethodLimit


@pytest.mark.parametrize("name", ["baseline_forecast", "manual_forecasts", "flow_forecast", "fundamental_forecast", "macro_forecast", "log_channel_forecast", "trend_filter_forecast"])
def test_methods_are_short_enough_to_be_compiled(spark, sf, capsys, name):
    was = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        QUERIES[name](spark, sf).explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", was)
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < LIMIT
