"""Functions callable from SQL: swing legs as a table function, interval aggregates.

``register(spark)`` makes them known to a session::

    SELECT * FROM swing_legs(TABLE(bars), reversal => 0.5)
    SELECT source, cqr_quantile(miss, 0.8) FROM settled GROUP BY source
    SELECT entity, interval_fuse(lower, upper) FROM forecasts GROUP BY entity, forecast_date

The table function partitions and orders its input itself and keeps a few numbers per series, however long. The
aggregates see a whole group at once, so their groups must be bounded: the misses of one series and horizon, or a
window frame such as ROWS BETWEEN 500 PRECEDING AND 1 PRECEDING; the sources of one forecast. Without such a bound
use ``operators.forecast``, which needs none.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult, OrderingColumn, PartitioningColumn

NEEDED = ("entity", "date", "high", "low", "close")


class SwingLegs:
    """Legs of the bar midpoints, as ``operators.waves.legs``, from a stream of one entity's bars.

    A leg ends when the price turns by ``reversal`` ATR, measured at its extreme; the open last leg is included.
    Series of one bar or of equal midpoints have no legs; bars without a price are skipped. Bars need entity, date, high, low and close.
    """

    @staticmethod
    def analyze(bars: AnalyzeArgument, reversal: AnalyzeArgument | None = None, atr_period: AnalyzeArgument | None = None) -> AnalyzeResult:
        if not bars.isTable:
            raise ValueError("the first argument must be TABLE(bars)")
        have = {f.name: f.dataType for f in bars.dataType.fields}
        lacking = [c for c in NEEDED if c not in have]
        if lacking:
            raise ValueError(f"bars lack {', '.join(lacking)}")
        out = T.StructType([T.StructField("entity", have["entity"])])
        for name, kind in (("wave_no", T.IntegerType()), ("start_date", have["date"]), ("end_date", have["date"]), ("start_price", T.DoubleType()), ("end_price", T.DoubleType()),
                           ("direction", T.IntegerType()), ("start_idx", T.IntegerType()), ("end_idx", T.IntegerType()), ("atr_start", T.DoubleType())):
            out = out.add(name, kind)
        return AnalyzeResult(schema=out, partitionBy=[PartitioningColumn("entity")], orderBy=[OrderingColumn("date")])

    def __init__(self):
        self.n = self.wave = self.way = 0
        self.atr = self.was = None

    def _point(self, row, mid):
        return (row["date"], mid, self.n, self.atr)

    def _leg(self):
        (d0, p0, i0, a0), (d1, p1, i1, _) = self.start, self.top
        self.wave += 1
        return self.entity, self.wave - 1, d0, d1, p0, p1, self.way, i0, i1, a0

    def eval(self, bars, reversal=0.5, atr_period=14):
        if bars["high"] is None or bars["low"] is None or bars["close"] is None:
            return
        high, low = float(bars["high"]), float(bars["low"])
        span = high - low if self.was is None else max(high - low, abs(high - self.was), abs(low - self.was))
        self.was = float(bars["close"])
        steps = min(self.n + 1, int(atr_period))
        self.atr = span if self.atr is None else self.atr + (span - self.atr) / steps
        here = self._point(bars, (high + low) / 2)
        if self.n == 0:
            self.entity, self.start, self.top = bars["entity"], here, here
        else:
            move = here[1] - self.top[1]
            turn = (move > 0) - (move < 0)
            if turn and (self.way == 0 or turn == self.way):
                self.way, self.top = turn, here
            elif turn and abs(move) >= self.top[3] * float(reversal):
                yield self._leg()
                self.start, self.top, self.way = self.top, here, turn
        self.n += 1

    def terminate(self):
        if self.n and self.top[2] > self.start[2]:
            yield self._leg()


def cqr_quantile(miss: pd.Series, confidence: pd.Series) -> float:
    """The finite-sample quantile of past misses: the ceil((n + 1) * confidence)-th smallest.

    Null below 30 misses or where that rank exceeds them; null misses don't count. The confidence is that of the newest row.
    """
    v = miss.dropna().to_numpy(float)
    if len(v) < 30 or not len(confidence) or pd.isna(confidence.iloc[-1]):
        return None
    k = int(np.ceil((len(v) + 1) * confidence.iloc[-1] - 1e-9))
    return float(np.partition(v, k - 1)[k - 1]) if 1 <= k <= len(v) else None


def known(miss: pd.Series) -> int:
    """How many misses a group holds; a plain count can't stand beside aggregates of this kind."""
    return int(miss.notna().sum())


def interval_fuse(lower: pd.Series, upper: pd.Series) -> list[float]:
    """Lower and upper end of the intersection, or of a widened centroid where intervals don't meet.

    Intervals with a null end don't count; null without any.
    """
    ok = lower.notna() & upper.notna()
    lo, hi = lower[ok].to_numpy(float), upper[ok].to_numpy(float)
    if not len(lo):
        return None
    if hi.min() >= lo.max():
        return [float(lo.max()), float(hi.min())]
    mid = (lo + hi) / 2
    half = ((hi - lo) / 2).max() + (mid.std(ddof=1) if len(mid) > 1 else 0.0)
    return [float(mid.mean() - half), float(mid.mean() + half)]


def register(spark: SparkSession) -> None:
    spark.udtf.register("swing_legs", F.udtf(SwingLegs))
    spark.udf.register("cqr_quantile", F.pandas_udf(cqr_quantile, "double"))
    spark.udf.register("known", F.pandas_udf(known, "long"))
    spark.udf.register("interval_fuse", F.pandas_udf(interval_fuse, "array<double>"))
