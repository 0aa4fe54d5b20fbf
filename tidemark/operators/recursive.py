"""Indicators whose state depends on their own previous output.

Rows are shuffled to their entity and sorted by Spark; ``mapInArrow`` then walks each partition as
a stream of Arrow batches and hands one series at a time (an entity's daily history, at most one row
per calendar day) to a compiled exponential filter.  No per-group Arrow round trip, and memory is
one batch plus one series.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.indicators import indexed, stochastic_raw, true_range

DOUBLE = T.DoubleType()


def _filter(x: np.ndarray, alpha: float, seed: float | None = None) -> np.ndarray:
    """y[t] = alpha*x[t] + (1-alpha)*y[t-1], started at ``x[0]`` or at ``seed`` before ``x[0]``."""
    if seed is None:
        return pd.Series(x).ewm(alpha=alpha, adjust=False).mean().to_numpy()
    return pd.Series(np.concatenate([[seed], x])).ewm(alpha=alpha, adjust=False).mean().to_numpy()[1:]


def ema(x: np.ndarray, p: int) -> np.ndarray:
    return _filter(x, 2.0 / (p + 1.0))


def wilder(x: np.ndarray, p: int, first: int, divisor: int | None = None) -> np.ndarray:
    """Wilder smoothing: zero until ``first``, there the mean of x[1..first], recursive afterwards."""
    out = np.zeros(len(x))
    if len(x) > first:
        seed = x[1:first + 1].sum() / (divisor or first)
        out[first] = seed
        out[first + 1:] = _filter(x[first + 1:], 1.0 / p, seed)
    return out


class _Columns(dict):
    """Columns of an Arrow batch as arrays, each converted when it is first read."""

    def __init__(self, batch):
        super().__init__()
        self.batch = batch

    def __missing__(self, name):
        self[name] = self.batch.column(name).to_pandas().to_numpy()
        return self[name]


class _Slice:
    """Rows ``i`` to ``j`` of such columns."""

    def __init__(self, columns, i, j):
        self.columns, self.i, self.j = columns, i, j

    def __getitem__(self, name):
        return self.columns[name][self.i:self.j]


def arranged(df: DataFrame, keys: tuple[str, ...] = ("entity",)) -> DataFrame:
    """Rows shuffled to their series and sorted by date.

    The number of partitions is stated, so they are not merged by size: few small rows may ask for much work.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts, *keys).sortWithinPartitions(*keys, "date")


def per_series(df: DataFrame, add, keys: tuple[str, ...] = ("entity",), only: str | None = None, in_order: bool = False, **outputs) -> DataFrame:
    """Append columns computed per series: ``add`` maps column arrays in date order to new arrays.

    With ``only`` (a boolean column) just its true rows leave Python. Columns that ``add`` does not read pass through as
    Arrow. ``in_order`` says that the rows of ``df`` are ``arranged`` and since then only got columns, lost rows or went
    through ``per_series``, so they are not shuffled again.
    """
    schema = T.StructType(list(df.schema.fields) + [T.StructField(k, t) for k, t in outputs.items()])

    def complete(batch):
        cols = _Columns(batch)
        starts = [0, *_edges(batch, keys), batch.num_rows]
        new = {k: np.empty(batch.num_rows) for k in outputs}
        for i, j in zip(starts[:-1], starts[1:]):
            for k, v in add(_Slice(cols, i, j)).items():
                new[k][i:j] = v
        out = pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(v, from_pandas=True) for v in new.values()]], names=schema.fieldNames())
        return out.filter(out.column(only)) if only else out

    def run(batches):
        for batch in whole_series(batches, keys):
            yield complete(batch)

    return (df if in_order else arranged(df, keys)).mapInArrow(run, schema)


def whole_series(batches, keys):
    """Batches that end with the last row of a series, from sorted ones."""
    rest = []
    for batch in batches:
        if not batch.num_rows:
            continue
        # the last series may go on in the next batch
        cut = _edges(batch, keys)
        if rest and _edges(pa.concat_batches([rest[-1].slice(rest[-1].num_rows - 1), batch.slice(0, 1)]), keys):
            cut = [0, *cut]
        if cut:
            yield pa.concat_batches([*rest, batch.slice(0, cut[-1])])
            rest = []
        rest.append(batch.slice(cut[-1] if cut else 0))
    if rest:
        yield pa.concat_batches(rest)


def _edges(batch, keys) -> list[int]:
    """Rows at which another series begins, but for the first."""
    edge = np.zeros(max(batch.num_rows - 1, 0), dtype=bool)
    for k in keys:
        c = batch.column(k)
        a, b = c.slice(1), c.slice(0, max(batch.num_rows - 1, 0))
        same = pc.if_else(pc.and_(a.is_null(), b.is_null()), True, pc.fill_null(pc.equal(a, b), False))
        edge |= ~same.to_numpy(zero_copy_only=False).astype(bool)
    return (np.flatnonzero(edge) + 1).tolist()


def exponential_averages(bars: DataFrame, p: int = 20, source: str = "close") -> DataFrame:
    """EMA and its double and triple forms."""

    def add(pdf: dict) -> dict:
        e1 = ema(pdf[source], p)
        e2 = ema(e1, p)
        e3 = ema(e2, p)
        return {"ema": e1, "dema": 2 * e1 - e2, "tema": 3 * e1 - 3 * e2 + e3}

    return per_series(indexed(bars), add, ema=DOUBLE, dema=DOUBLE, tema=DOUBLE)


def macd(bars: DataFrame, fast: int = 12, slow: int = 26, signal: int = 9) -> DataFrame:
    def add(pdf: dict) -> dict:
        c = pdf["close"]
        line = ema(c, fast) - ema(c, slow)
        sig = ema(line, signal)
        return {"macd": line, "signal": sig, "histogram": line - sig}

    return per_series(indexed(bars), add, macd=DOUBLE, signal=DOUBLE, histogram=DOUBLE)


def rsi_values(c: np.ndarray, p: int) -> np.ndarray:
    n = len(c)
    if n < 2:
        return np.zeros(n)
    d = np.diff(c, prepend=c[0])
    first = min(p, n - 1)
    g, l = wilder(np.maximum(d, 0), p, first), wilder(np.maximum(-d, 0), p, first)
    with np.errstate(divide="ignore", invalid="ignore"):
        out = np.where(l < 1e-12, 100.0, 100.0 - 100.0 / (1.0 + g / l))
    out[:first] = 0.0
    return out


def rsi(bars: DataFrame, p: int = 14) -> DataFrame:
    """Wilder RSI; 0 before warm-up, 100 without losses."""
    return per_series(indexed(bars), lambda pdf: {"rsi": rsi_values(pdf["close"], p)}, rsi=DOUBLE)


def kd(bars: DataFrame, p: int = 9, k_smooth: int = 3, d_smooth: int = 3) -> DataFrame:
    """Smoothed stochastic lines, both started at 50."""

    def add(pdf: dict) -> dict:
        k = _filter(pdf["rsv"], 1.0 / k_smooth, 50.0)
        return {"k": k, "d": _filter(k, 1.0 / d_smooth, 50.0)}

    return per_series(stochastic_raw(bars, p), add, k=DOUBLE, d=DOUBLE)


def adx(bars: DataFrame, p: int = 14) -> DataFrame:
    """Directional indicators and their smoothed index, which starts at twice the period."""

    def add(pdf: dict) -> dict:
        h, l, c = pdf["high"], pdf["low"], pdf["close"]
        n = len(c)
        if n < 2:
            return {"plus_di": np.zeros(n), "minus_di": np.zeros(n), "adx": np.zeros(n)}
        up, dn = np.diff(h, prepend=h[0]), -np.diff(l, prepend=l[0])
        pdm = np.where((up > dn) & (up > 0), up, 0.0)
        mdm = np.where((dn > up) & (dn > 0), dn, 0.0)
        was = np.concatenate([[c[0]], c[:-1]])
        tr = np.maximum(h - l, np.maximum(np.abs(h - was), np.abs(l - was)))
        pdm[0] = mdm[0] = tr[0] = 0.0
        first = min(p, n - 1)
        atr_, ps, ms = (wilder(x, p, first, p) for x in (tr, pdm, mdm))
        with np.errstate(divide="ignore", invalid="ignore"):
            plus = np.where(atr_ > 0, 100 * ps / atr_, 0.0)
            minus = np.where(atr_ > 0, 100 * ms / atr_, 0.0)
            dx = np.where(plus + minus > 0, 100 * np.abs(plus - minus) / (plus + minus), 0.0)
        out = np.zeros(n)
        start = min(2 * first, n)
        if first < start < n:
            out[start - 1] = dx[first:start].mean()
            out[start:] = _filter(dx[start:], 1.0 / p, out[start - 1])
        return {"plus_di": plus, "minus_di": minus, "adx": out}

    return per_series(indexed(bars), add, plus_di=DOUBLE, minus_di=DOUBLE, adx=DOUBLE)


def atr_values(tr: np.ndarray, p: int) -> np.ndarray:
    out = np.empty(len(tr))
    w = min(p, len(tr))
    out[:w] = np.cumsum(tr[:w]) / np.arange(1, w + 1)
    if len(tr) > w:
        out[w:] = _filter(tr[w:], 1.0 / p, out[w - 1])
    return out


def atr(bars: DataFrame, p: int = 14) -> DataFrame:
    """Wilder ATR with a growing mean during warm-up, and ATR in percent of the close."""
    df = per_series(true_range(bars), lambda pdf: {"atr": atr_values(pdf["tr"], p)}, atr=DOUBLE)
    return df.withColumn("atr_pct", F.when(F.col("close") > 0, F.col("atr") / F.col("close") * 100).otherwise(0.0))


def keltner(bars: DataFrame, p: int = 20, atr_p: int = 10, k: float = 2.0) -> DataFrame:
    def add(pdf: dict) -> dict:
        m = ema(pdf["close"], p)
        band = k * atr_values(pdf["tr"], atr_p)
        return {"upper": m + band, "middle": m, "lower": m - band}

    return per_series(true_range(bars), add, upper=DOUBLE, middle=DOUBLE, lower=DOUBLE)


# Process noise, velocity threshold (share of price) and shortest regime, per horizon.
KALMAN_HORIZONS = {
    "short": (1e-1, 0.003, 3),
    "medium": (1e-2, 0.002, 5),
    "long": (1e-3, 0.0015, 5),
    "ultra_long": (1e-5, 0.001, 5),
}


def kalman_values(z: np.ndarray, q: float, noise: float = 0.01, expanding: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Smoothed price, uncertainty and velocity of one series."""
    n = len(z)
    mean = np.cumsum(z) / np.arange(1, n + 1) if expanding else np.full(n, z.mean())
    noise2 = ((noise * mean) ** 2).tolist()
    xs, ps = [], []
    x, v = float(z[0]), noise2[0]
    for obs, r in zip(z.tolist(), noise2):
        v += q
        g = v / (v + r)
        x += g * (obs - x)
        v *= 1 - g
        xs.append(x)
        ps.append(v)
    xs = np.array(xs)
    return xs, np.sqrt(ps), np.diff(xs, prepend=xs[0])


def kalman(bars: DataFrame, noise: float = 0.01, expanding: bool = True) -> DataFrame:
    """Local-level Kalman filter per (entity, horizon): smoothed price, uncertainty, velocity.

    The measurement noise is ``noise`` times the mean close, squared.  The mean covers the
    past only; with ``expanding=False`` it covers the whole series, which looks ahead.  Horizons are crossed in,
    so the parallelism is entities times horizons.
    """
    hz = F.explode(F.array(*[F.struct(F.lit(k).alias("horizon"), F.lit(v[0]).alias("q"), F.lit(v[1]).alias("threshold"),
                                      F.lit(v[2]).alias("min_run")) for k, v in KALMAN_HORIZONS.items()]))
    df = indexed(bars).select("entity", "date", "idx", "close", hz.alias("h")).select("entity", "date", "idx", "close", "h.*")

    def add(p: dict) -> dict:
        return dict(zip(("smoothed", "uncertainty", "velocity"), kalman_values(p["close"], float(p["q"][0]), noise, expanding)))

    return per_series(df, add, ("entity", "horizon"), smoothed=DOUBLE, uncertainty=DOUBLE, velocity=DOUBLE)


def regimes(filtered: DataFrame, lookback: int = 20, stable: float = 0.01) -> DataFrame:
    """Five regimes from velocity (share of price) and its change over ``lookback`` bars."""
    from pyspark.sql import Window

    w = Window.partitionBy("entity", "horizon").orderBy("date")
    back = F.coalesce(F.lag("velocity", lookback).over(w), F.first("velocity").over(w))
    df = filtered.withColumns({
        "vel_pct": F.when(F.abs("smoothed") > 0, F.col("velocity") / F.col("smoothed")).otherwise(0.0),
        "accel": F.col("velocity") - back,
    })
    return df.withColumn("regime", regime_of(stable))


def regime_of(stable: float = 0.01) -> Column:
    """The regime of a row with ``vel_pct``, ``accel`` and ``threshold``."""
    return (
        F.when(F.abs("vel_pct") < F.col("threshold"), "sideway")
        .when(F.col("vel_pct") > 0, F.when(F.abs("accel") < stable, "stable_up").when(F.col("accel") > 0, "accelerating").otherwise("decelerating"))
        .otherwise(F.when(F.abs("accel") < stable, "stable_down").when(F.col("accel") > 0, "decelerating").otherwise("stable_down"))
    )


def regime_changes(classified: DataFrame, warmup: int = 60) -> DataFrame:
    """Entries into a new regime after short runs were merged into the run before them.

    Runs are gaps-and-islands windows.  A run that is too short joins the last kept run, so the
    kept runs are those long enough plus the very first one; an event fires where the kept regime
    differs from the kept regime before it.
    """
    from pyspark.sql import Window

    w = Window.partitionBy("entity", "horizon").orderBy("date")
    df = classified.filter(F.col("idx") >= warmup)
    df = df.withColumn("_new", (F.coalesce(F.lag("regime").over(w) != F.col("regime"), F.lit(True))).cast("int"))
    df = df.withColumn("_run", F.sum("_new").over(w))
    runs = df.groupBy("entity", "horizon", "_run").agg(
        F.min("date").alias("date"), F.first("regime").alias("regime"), F.count("*").alias("n"), F.first("min_run").alias("min_run"),
        F.min_by("smoothed", "date").alias("smoothed"))
    by_run = Window.partitionBy("entity", "horizon").orderBy("date")
    kept = runs.filter((F.col("_run") == 1) | (F.col("n") >= F.col("min_run")))
    kept = kept.withColumn("from_regime", F.lag("regime").over(by_run))
    return kept.filter(F.col("from_regime").isNull() | (F.col("from_regime") != F.col("regime"))).select(
        "entity", "horizon", "date", "from_regime", F.col("regime").alias("to_regime"), F.col("smoothed").alias("value"))
