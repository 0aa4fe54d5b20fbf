"""Every registered query against its SQL on DuckDB, on the smallest data set."""

import datetime
import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
# Slow ones are covered by tools/check_oracles.py; here a cross-section of every module.
FAST = [
    "bollinger_bands", "macd", "rsi", "rsi_events", "bollinger_events", "candlestick_patterns", "vwap_band_touches", "risk_alert_events", "keyed_upsert", "block_trade_rollup", "weekly_bars",
    "asof_adjusted_closes", "close_at_or_before", "visible_revenue_periods", "momentum_12_1_ranking", "magic_formula_ranking", "cross_section_rank", "group_quantiles", "baseline_forecast",
    "conformal_calibration", "interval_fusion", "swing_legs", "correction_rules", "entity_health", "price_clusters", "streaming_ema_state", "streaming_restatement", "entity_health_catalogue", "walk_forward_backtest", "eligible_sources", "macd_events", "coppock_events_strict",
    "stops_and_targets", "fib_line_clusters", "kalman_smoother", "block_trade_summary", "alert_status", "commodity_summary", "collateral_summary", "quarterly_screen", "phase_histogram",
    "power_and_wave_labels", "swing_legs_table_function", "bollinger_since", "declared_drift", "market_weight", "series_alignment",
]


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for f in glob.glob(f"{sf}/*.parquet"):
        c.sql(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return c


def norm(v):
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v + 0.0:.6f}"
    return str(v)


def table(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", FAST)
def test_matches_sql(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    want = con.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert table(df.columns, df.collect()) == table(want.columns, want.fetchall())


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1


def test_registry_is_consistent():
    assert set(ORACLES) <= set(QUERIES)
    assert len(QUERIES) > 150
