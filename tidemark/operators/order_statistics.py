"""Percentiles and quantiles over sliding windows, each window kept in order as rows come and go.

Rows are shuffled to their series and sorted by Spark; every partition is read as one stream that holds one window.
"""

from __future__ import annotations

from collections import deque

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.ranked import Ranked, rank_in_window
from tidemark.operators.recursive import per_series


def trailing_percentiles(df: DataFrame, columns: dict[str, str], n: int | None = None, days: int | None = None, strict: bool = False, min_obs: int = 1) -> DataFrame:
    """Share of trailing values at or below the current one, as new columns {name: column}; ``strict``: below, in percent.

    The window is ``n`` rows or, with ``days``, all rows of the last ``days`` days, the current one included. Null where
    the value is null or its window holds fewer than ``min_obs`` values.
    """

    def add(s: dict) -> dict:
        at = np.arange(len(s["date"]))
        if days is None:
            starts = np.maximum(at - n + 1, 0)
        else:
            number = np.array([d.toordinal() for d in s["date"]])
            starts = np.searchsorted(number, number - days)
        out = {}
        for name, c in columns.items():
            v = s[c].astype(float)
            rank, size = rank_in_window(v, starts, inclusive=not strict)
            ok = ~np.isnan(v) & (size >= max(min_obs, 1))
            out[name] = np.where(ok, rank * (100.0 if strict else 1.0) / np.maximum(size, 1), np.nan)
        return out

    df = per_series(df, add, **{name: T.DoubleType() for name in columns})
    return df.withColumns({name: F.when(~F.isnan(name), F.col(name)) for name in columns})


def past_quantile(known: DataFrame, asks: DataFrame, keys: list[str], order: str, value: str, level: str, window: int, min_size: int, asks_first: bool = False) -> DataFrame:
    """For every ask the finite-sample quantile of the last ``window`` values known to its series.

    ``known`` holds keys, ``order`` and ``value``, ``asks`` keys, ``order``, ``level`` and more. With n values known
    ``q`` is the ceil((n + 1) * level)-th smallest; asks with fewer than ``min_size`` values, or whose rank exceeds n,
    give no row. Values of an ask's own day count unless ``asks_first``. Null values are not known.
    """
    rest = [c for c in asks.columns if c not in (*keys, order)]
    rows = known.where(F.col(value).isNotNull()).select(*keys, order, F.lit(int(asks_first)).alias("_side"), F.col(value).alias("_value"))
    rows = rows.unionByName(asks.withColumn("_side", F.lit(1 - int(asks_first))), allowMissingColumns=True).select(*keys, order, "_side", "_value", *rest)
    ask_side = 1 - int(asks_first)
    schema = T.StructType([*asks.schema.fields, T.StructField("q", T.DoubleType()), T.StructField("n_past", T.IntegerType())])
    names = schema.fieldNames()

    def run(batches):
        series, past, ranked = None, deque(), Ranked()
        for pdf in batches:
            q, n_past = np.full(len(pdf), np.nan), np.zeros(len(pdf), np.int32)
            own = list(zip(*(pdf[k].to_numpy() for k in keys)))
            for i, (key, side, v, p) in enumerate(zip(own, pdf["_side"].tolist(), pdf["_value"].tolist(), pdf[level].tolist())):
                if key != series:
                    series, past, ranked = key, deque(), Ranked()
                if side == ask_side:
                    n = ranked.size
                    k = int(np.ceil((n + 1) * p - 1e-9))
                    if n >= min_size and 1 <= k <= n:
                        q[i], n_past[i] = ranked.kth(k), n
                    continue
                past.append(v)
                ranked.add(v)
                if len(past) > window:
                    ranked.drop(past.popleft())
            found = ~np.isnan(q)
            if found.any():
                yield pdf.assign(q=q, n_past=n_past).loc[found, names]

    return rows.repartition(*keys).sortWithinPartitions(*keys, order, "_side").mapInPandas(run, schema)
