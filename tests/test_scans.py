"""Scans over blocks must give what a plain loop over the series gives."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import scans as S
from tidemark.operators import recursive as R
from tidemark.operators import scanned as SC


@pytest.fixture(scope="module")
def bars(spark):
    g = np.random.default_rng(5)
    rows = []
    for e, n in ((1, 1), (2, 2), (3, 9), (4, 130), (5, 45)):
        days = sorted(g.choice(400, n, replace=False).tolist())
        c = np.abs(np.cumsum(g.normal(size=n)) + 50).round(2)
        rows += [(e, dt.date(2023, 11, 5) + dt.timedelta(days=d), float(x), float(x) + 1, float(x) - 1.5, float(x)) for d, x in zip(days, c)]
    return spark.createDataFrame(rows, "entity long, date date, open double, high double, low double, close double").cache()


def test_affine_scan_equals_a_loop(bars):
    a, b = (F.dayofmonth("date") % 4) / 3.0 - 0.2, F.col("close") / 10
    got = {(r.entity, r.date): r.y for r in S.affine(bars, a, {"y": b}, {"y": F.lit(2.0)}).collect()}
    state = {}
    for r in sorted(bars.collect(), key=lambda r: (r.entity, r.date)):
        state[r.entity] = ((r.date.day % 4) / 3.0 - 0.2) * state.get(r.entity, 2.0) + r.close / 10
        assert abs(got[(r.entity, r.date)] - state[r.entity]) < 1e-9
    assert len(got) == bars.count()


def test_position_and_row_before_cross_blocks(bars):
    got = S.located(bars, {"was": "close"}).collect()
    by = {}
    for r in sorted(got, key=lambda r: (r.entity, r.date)):
        past = by.setdefault(r.entity, [])
        assert (r.idx, r.was) == (len(past), past[-1] if past else None)
        past.append(r.close)
    assert all(r.n == len(by[r.entity]) for r in got)


@pytest.mark.parametrize("name, cols, days", [("exponential_averages", "ema dema tema", None), ("exponential_averages", "ema dema tema", 7), ("rsi", "rsi", 7),
                                              ("atr", "atr atr_pct", 7), ("kalman", "smoothed uncertainty velocity", 7)])
def test_scanned_indicators_equal_the_walk(bars, name, cols, days):
    keys = ["entity", "date"] + (["horizon"] if name == "kalman" else [])
    block = None if days is None else F.floor(F.unix_date("date") / days)
    read = lambda df: {tuple(r[k] for k in keys): [r[c] for c in cols.split()] for r in df.collect()}
    want, got = read(getattr(R, name)(bars)), read(getattr(SC, name)(bars, block=block, longest=days or 366))
    assert want.keys() == got.keys()
    for k in want:
        assert np.allclose(want[k], got[k], rtol=1e-7, atol=1e-7), (k, want[k], got[k])


def test_a_block_longer_than_stated_is_an_error(bars):
    with pytest.raises(Exception, match="more than 4 rows"):
        S.affine(bars, F.lit(0.5), {"y": F.col("close")}, {"y": F.lit(0.0)}, longest=4).collect()


def test_no_rows_give_no_rows(bars):
    assert SC.rsi(bars.limit(0)).count() == 0 and SC.exponential_averages(bars.filter("entity < 0")).count() == 0


def test_a_bar_is_dealt_to_its_block_once_with_all_horizons(bars, spark):
    """A row per bar and horizon was shuffled and checkpointed; now horizons are laid out after the last shuffle."""
    got = SC.kalman(bars)
    plan = got._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange" in line]
    assert moved and not any("horizon" in line for line in moved), plan
    rows = {(r.entity, r.date): r for r in got.filter("horizon = 'short'").collect()}
    assert len(rows) == bars.count() and got.count() == 4 * len(rows)


def test_a_missing_close_counts_as_none_but_keeps_its_row(spark):
    """Its step goes towards zero, as ever, and has no velocity."""
    days = [(1, dt.date(2024, 1, i), None if i == 3 else 10.0 + i) for i in range(1, 6)]
    got = SC.kalman(spark.createDataFrame(days, "entity long, date date, close double")).filter("horizon = 'short'").sort("date").collect()
    assert [r.velocity is None for r in got] == [False, False, True, False, False] and [r.idx for r in got] == [0, 1, 2, 3, 4]
    assert 0 < got[2].smoothed < got[1].smoothed
