"""Dominance counts against counting rows for every combination."""

import itertools

import numpy as np

from tidemark.operators import waves as WV


def test_counts_equal_brute_force(spark):
    g = np.random.default_rng(3)
    rows = [(int(g.integers(3)), *(None if g.random() < 0.1 else float(v) for v in g.integers(0, 6, 3))) for _ in range(400)] + [(9, None, None, None)]
    df = spark.createDataFrame(rows, "day int, a double, b double, c double")
    axes = {"a_min": ("a", "at_least", [2, 0, 5, 2]), "b_max": ("b", "at_most", [1, 4]), "c_min": ("c", "at_least", [3, 7])}
    got = {tuple(r)[:4]: r.n for r in WV.dominance_counts(df, ["day"], axes).collect()}
    want = {}
    for day, a, b, c in itertools.product({r[0] for r in rows}, {2, 0, 5}, {1, 4}, {3, 7}):
        want[(day, a, b, c)] = sum(r[0] == day and None not in r and r[1] >= a and r[2] <= b and r[3] >= c for r in rows)
    assert got == want


def test_no_rows_give_no_combinations(spark):
    df = spark.createDataFrame([], "day int, a double")
    assert WV.dominance_counts(df, ["day"], {"a_min": ("a", "at_least", [1.0])}).count() == 0
