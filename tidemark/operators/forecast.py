"""Interval forecasts for all as-of dates at once, settlement, scoring, calibration and fusion.

A forecast row is (entity, forecast_date, horizon, source, confidence, lower, upper, point).
Price series carry ``px`` (close over the running adjustment factor) and ``c`` (that factor), so
``px * c(T)`` is the series as seen on day T and one window pass serves every T.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import clamp, hit, interval_pinball, two_sided_z
from tidemark.functions.windows import prev, series, trailing
from tidemark.operators.indicators import indexed
from tidemark.operators.order_statistics import past_quantile
from tidemark.operators.pit import asof_join
from tidemark.operators.recursive import _edges, arranged, per_series, whole_series

# Default horizons (calendar days) and interval confidences.
HORIZONS = (21, 63, 126)
CONFIDENCES = (0.5, 0.8, 0.95)
KEYS = ["entity", "source", "horizon", "confidence"]


def unadjusted(bars: DataFrame) -> DataFrame:
    return bars.withColumns({"px": F.col("close"), "c": F.lit(1.0)})


def _grid(name: str, values) -> Column:
    return F.explode(F.array(*[F.lit(v) for v in values])).alias(name)


def _r4(c: Column) -> Column:
    """Four decimals; values too large to have any stay as they are."""
    return F.when(F.abs(c) < 1e14, F.floor(c * 10000 + 0.5) / 10000).otherwise(c)


def _rows(df: DataFrame, source: str, lower: Column, upper: Column, point: Column, *more: str) -> DataFrame:
    return df.select("entity", F.col("date").alias("forecast_date"), F.lit(source).alias("source"), "horizon", "confidence",
                     _r4(lower).alias("lower"), _r4(upper).alias("upper"), _r4(point).alias("point"), *more)


def _cell(source: str, horizon: int, confidence: float, given: Column, lower: Column, upper: Column, point: Column) -> Column:
    """One forecast of a bar as a struct; null where it isn't ``given``."""
    row = F.struct(F.lit(source).alias("source"), F.lit(horizon).alias("horizon"), F.lit(confidence).alias("confidence"),
                   _r4(lower).alias("lower"), _r4(upper).alias("upper"), _r4(point).alias("point"))
    return F.when(given, row)


def unpack(df: DataFrame, cells: list[Column] | Column, *more: str) -> DataFrame:
    """Forecast rows from the cells of every bar: no row of the long form is shuffled or joined."""
    cells = F.array(*cells) if isinstance(cells, list) else cells
    return df.select("entity", F.col("date").alias("forecast_date"), *more, F.inline(cells)).filter(F.col("source").isNotNull())


def _long(df: DataFrame, cells: list[tuple], *shared: str) -> DataFrame:
    """A row per bar and cell (horizon, confidence, named columns), with the bar's ``shared`` columns.

    Cells hold inputs only and the forecast is computed after they are laid out, so its expressions stand in the plan once instead
    of once per cell: code for all cells of a bar in one method is too long for the JVM to compile.
    """
    cells = [F.struct(F.lit(h).alias("horizon"), F.lit(c).alias("confidence"), *more) for h, c, *more in cells]
    return df.select("entity", "date", *shared, F.inline(F.array(*cells)))


def on_grid(rows: DataFrame) -> DataFrame:
    """Forecast rows with prices rounded as all forecasts are."""
    return rows.withColumns({c: _r4(F.col(c)) for c in ("lower", "upper", "point")})


def every_bar(df: DataFrame) -> DataFrame:
    """Forecasts are due at every bar."""
    return df.withColumn("is_due", F.lit(True))


def month_ends(df: DataFrame) -> DataFrame:
    """Mark the last bar of each (entity, month), for readers of one forecast a month."""
    nxt = F.lead("date").over(series())
    return df.withColumn("is_due", nxt.isNull() | (F.trunc(nxt, "month") != F.trunc("date", "month")))


def _past_quantiles(px: np.ndarray, at: np.ndarray, h: int, probs: list[float], lookback: int) -> np.ndarray:
    """Quantiles of the last ``lookback`` returns over ``h`` bars that end by each row of ``at``; NaN below five returns."""
    ret = np.concatenate([np.full(lookback - 1, np.nan), px[h:] / px[:-h] - 1])
    windows = np.lib.stride_tricks.sliding_window_view(ret, lookback)
    out = np.full((len(probs), len(at)), np.nan)
    for first in range(0, len(at), 4096):
        # missing returns are sorted to the end
        r = np.sort(windows[at[first:first + 4096] - h], axis=1)
        n = lookback - np.isnan(r).sum(axis=1)
        ok = np.flatnonzero(n >= 5)
        for row, p in zip(out, probs):
            pos = (n[ok] - 1) * p
            lo = pos.astype(int)
            a, b = r[ok, lo], r[ok, np.minimum(lo + 1, n[ok] - 1)]
            row[first + ok] = a + (b - a) * (pos - lo)
    return out


def _baseline_names(horizons, confidences) -> dict[tuple[int, float], str]:
    probs = sorted({p for c in confidences for p in ((1 - c) / 2, 1 - (1 - c) / 2)})
    return {(h, p): f"q{h}_{i}" for h in horizons for i, p in enumerate(probs)}


def baseline_inputs(prices: DataFrame, horizons=HORIZONS, confidences=CONFIDENCES, trend: int = 20, lookback: int = 252, due: str = "is_due", in_order: bool = False) -> DataFrame:
    """Due rows of ``prices`` with what ``baseline_cells`` reads."""
    name = _baseline_names(horizons, confidences)
    probs = sorted({p for _, p in name})

    def add(s) -> dict:
        px = s["px"].astype(float)
        n = len(px)
        out = {c: np.full(n, np.nan) for c in name.values()}
        at = np.flatnonzero(s[due])
        for h in horizons:
            now = at[at >= max(trend, h)]
            if len(now):
                for p, q in zip(probs, _past_quantiles(px, now, h, probs, lookback)):
                    out[name[h, p]][now] = q
        return out

    df = prices.withColumn("trend", F.avg("px").over(trailing(trend)) * F.col("c"))
    return per_series(df, add, only=due, in_order=in_order, **{c: T.DoubleType() for c in name.values()})


def baseline_cells(horizons=HORIZONS, confidences=CONFIDENCES) -> list[Column]:
    name = _baseline_names(horizons, confidences)
    out = []
    for h in horizons:
        for c in confidences:
            ql, qh = F.col(name[h, (1 - c) / 2]), F.col(name[h, 1 - (1 - c) / 2])
            out.append(_cell("baseline", h, c, ql.isNotNull() & ~F.isnan(ql), F.col("trend") * (1 + ql), F.col("trend") * (1 + qh), F.col("trend")))
    return out


def baseline(prices: DataFrame, horizons=HORIZONS, confidences=CONFIDENCES, trend: int = 20, lookback: int = 252, due: str = "is_due") -> DataFrame:
    """Point: mean of the last ``trend`` closes.  Band: empirical quantiles of the horizon's past returns.

    The horizon counts bars here, as the returns do; at least five returns are needed.  Quantiles are
    taken at due bars only, so they run over one series at a time instead of a frame per row.
    """
    return baseline_rows(baseline_inputs(arranged(prices.select("entity", "date", "px", "c", due)), horizons, confidences, trend, lookback, due, in_order=True), horizons, confidences)


def baseline_rows(df: DataFrame, horizons=HORIZONS, confidences=CONFIDENCES, realized: bool = False) -> DataFrame:
    """Forecast rows of ``baseline_inputs``; with ``realized`` those that ``realized_<h>`` of their bar settles, with that price."""
    name = _baseline_names(horizons, confidences)
    more = {h: [F.col(f"realized_{h}").alias("realized")] if realized else [] for h in horizons}
    rows = _long(df, [(h, c, F.col(name[h, (1 - c) / 2]).alias("_low"), F.col(name[h, 1 - (1 - c) / 2]).alias("_high"), *more[h]) for h in horizons for c in confidences], "trend")
    rows = rows.filter(F.col("_low").isNotNull() & ~F.isnan("_low"))
    if realized:
        rows = rows.filter("realized is not null")
    return _rows(rows, "baseline", F.col("trend") * (1 + F.col("_low")), F.col("trend") * (1 + F.col("_high")), F.col("trend"), *["realized"] * realized)


def baseline_issuer(horizons=HORIZONS, confidences=CONFIDENCES, trend: int = 20, lookback: int = 252) -> tuple:
    """``baseline`` for one series that grows: its cells, how many closes it looks back on, and the bounds at places of an array of closes."""
    name = _baseline_names(horizons, confidences)
    probs = sorted({p for _, p in name})
    cells = [("baseline", h, c) for h in horizons for c in confidences]

    def bounds(px: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # added up in order, as the window of ``baseline_inputs`` does
        windows = np.lib.stride_tricks.sliding_window_view(np.concatenate([np.full(trend - 1, np.nan), px]), trend)[at]
        known, total = ~np.isnan(windows), np.zeros(len(at))
        for i in range(trend):
            total += np.where(known[:, i], windows[:, i], 0.0)
        out = np.full((2, len(at), len(cells)), np.nan)
        with np.errstate(divide="ignore", invalid="ignore"):
            mean = total / known.sum(axis=1)
            for h in horizons:
                due = np.flatnonzero(at >= max(trend, h))
                if len(due):
                    q = dict(zip(probs, _past_quantiles(px, at[due], h, probs, lookback)))
                    for c in confidences:
                        for end, p in zip(out, ((1 - c) / 2, 1 - (1 - c) / 2)):
                            x = mean[due] * (1 + q[p])
                            end[due, cells.index(("baseline", h, c))] = np.where(np.abs(x) < 1e14, np.floor(x * 10000 + 0.5) / 10000, x)
        return out[0], out[1]

    return cells, lookback + max(horizons), bounds


def _lines(y: np.ndarray, at: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slope, last fitted value and sum of squared residuals of the least-squares lines through the ``window`` values up to ``at``; NaN values are no points."""
    windows = np.lib.stride_tricks.sliding_window_view(y, window)
    out, t = np.full((3, len(at)), np.nan), np.arange(window) - (window - 1) / 2
    for first in range(0, len(at), 1024):
        w = windows[at[first:first + 1024] - window + 1]
        known = ~np.isnan(w)
        with np.errstate(divide="ignore", invalid="ignore"):
            n = known.sum(axis=1)
            mt, my = (known @ t) / n, np.where(known, w, 0.0).sum(axis=1) / n
            dt, dy = np.where(known, t - mt[:, None], 0.0), np.where(known, w - my[:, None], 0.0)
            sxy = (dt * dy).sum(axis=1)
            slope = sxy / (dt * dt).sum(axis=1)
            out[:, first:first + 1024] = slope, my + slope * (t[-1] - mt), (dy * dy).sum(axis=1) - slope * sxy
    return out


def log_channel(prices: DataFrame, horizons=HORIZONS, confidences=CONFIDENCES, window: int = 252, due: str = "is_due") -> DataFrame:
    """Least-squares line through log prices; band from the residual deviation (n - 2) times sqrt(h).

    A series' lines are fitted by array, so a bar costs no frame of its own.
    """

    def add(s) -> dict:
        px = s["px"].astype(float)
        out = {k: np.full(len(px), np.nan) for k in ("_slope", "_end", "_rest")}
        at = np.flatnonzero(s[due])
        at = at[at >= window - 1]
        if len(at):
            y = np.log(px, out=np.full(len(px), np.nan), where=px > 0)
            out["_slope"][at], out["_end"][at], out["_rest"][at] = _lines(y, at, window)
        return {**out, "_given": np.arange(len(px)) >= window - 1}

    df = arranged(prices.select("entity", "date", "px", "c", due))
    df = per_series(df, add, only=due, in_order=True, **{k: T.DoubleType() for k in ("_slope", "_end", "_rest", "_given")}).filter("_given = 1")
    sd = F.sqrt(F.greatest(F.col("_rest"), F.lit(0.0)) / (window - 2))
    df = df.withColumns({"_end": F.col("_end") + F.log("c"), "_sd": F.when(F.col("_rest").isNotNull(), sd)})
    cells = [(h, c, (two_sided_z(F.lit(c)) * F.sqrt(F.lit(h))).alias("_width")) for h in horizons for c in confidences]
    rows = _long(df, cells, "_end", "_slope", "_sd")
    mid, half = F.col("_end") + F.col("_slope") * F.col("horizon"), F.col("_sd") * F.col("_width")
    return _rows(rows, "log_channel", F.exp(mid - half), F.exp(mid + half), F.exp(mid))


def realized_volatility(prices: DataFrame, n: int = 60) -> DataFrame:
    r = F.when(prev("px") > 0, F.log(F.col("px") / prev("px")))
    df = indexed(prices).withColumn("_lr", r)
    return df.withColumn("sigma", F.when(F.col("idx") >= n, F.stddev_samp("_lr").over(trailing(n)))).drop("_lr")


def drift_inputs(scored: DataFrame, score: str, fade: float, cap: float, horizons=HORIZONS) -> DataFrame:
    """``scored`` with what ``drift_cells`` reads; expects ``px``, ``c``, ``sigma`` and the score column."""
    price = F.col("px") * F.col("c")
    drift = {f"_drift_{h}": clamp(F.col(score) * fade * F.lit(h) / 252.0, -cap, cap) for h in horizons}
    df = scored.withColumns({"_price": price, **drift})
    given = F.col(score).isNotNull() & (F.col("sigma") > 0)
    return df.withColumns({"_spread": F.col("_price") * F.col("sigma"), **{f"_drift_{h}": F.when(given, F.col("_price") * (1 + F.col(f"_drift_{h}"))) for h in horizons}})


def drift_cells(source: str, horizons=HORIZONS, confidences=CONFIDENCES) -> list[Column]:
    out = []
    for h in horizons:
        point = F.col(f"_drift_{h}")
        for c in confidences:
            half = F.col("_spread") * F.sqrt(F.lit(h)) * two_sided_z(F.lit(c))
            out.append(_cell(source, h, c, point.isNotNull(), F.greatest(point - half, F.col("_price") * 0.01), point + half, point))
    return out


def drift_forecast(scored: DataFrame, source: str, score: str, fade: float, cap: float, horizons=HORIZONS, confidences=CONFIDENCES) -> DataFrame:
    """Score-driven drift with a volatility cone; the lower end stays above 1 % of the price.

    Expects ``px``, ``c``, ``sigma`` and the score column; rows missing either give no forecast.
    """
    df = drift_inputs(scored, score, fade, cap, horizons)
    cells = [(h, c, F.col(f"_drift_{h}").alias("_point"), (F.sqrt(F.lit(h)) * two_sided_z(F.lit(c))).alias("_width")) for h in horizons for c in confidences]
    rows = _long(df.filter(F.col(score).isNotNull() & (F.col("sigma") > 0)), cells, "_price", "_spread").filter(F.col("_point").isNotNull())
    point, half = F.col("_point"), F.col("_spread") * F.col("_width")
    return _rows(rows, source, F.greatest(point - half, F.col("_price") * 0.01), point + half, point)


def chip_score(flows: DataFrame, recent: int = 20, base: int = 60, saturation: float = 2.0, roc: int = 20, roc_limit: float = 0.10,
               w_flow: float = 0.7, w_margin: float = 0.3) -> DataFrame:
    """Net-flow z-score and contrarian balance growth, weights renormalised when one is missing.

    Expects (entity, date, net_flow, margin_balance).
    """
    sd, mean = F.stddev_samp("net_flow").over(trailing(base)), F.avg("net_flow").over(trailing(base))
    z = F.when((F.count("net_flow").over(trailing(base)) >= base) & (sd > 0), (F.avg("net_flow").over(trailing(recent)) - mean) / sd)
    was = prev("margin_balance", roc)
    m = F.when(was > 0, -(F.col("margin_balance") - was) / was / roc_limit)
    df = flows.withColumns({"flow_score": clamp(z / saturation, -1.0, 1.0), "margin_score": clamp(m, -1.0, 1.0)})
    both = F.col("flow_score").isNotNull() & F.col("margin_score").isNotNull()
    # greatest/least skip nulls, so missing inputs are restored here
    df = df.withColumns({"flow_score": F.when(z.isNotNull(), F.col("flow_score")), "margin_score": F.when(m.isNotNull(), F.col("margin_score"))})
    mix = (F.col("flow_score") * w_flow + F.col("margin_score") * w_margin) / (w_flow + w_margin)
    return df.withColumn("score", F.when(both & F.col("flow_score").isNotNull() & F.col("margin_score").isNotNull(), mix).otherwise(F.coalesce("flow_score", "margin_score")))


def fundamental_score(growth: DataFrame, months: int = 3) -> DataFrame:
    """Mean of the latest YoY changes (as fractions) that have a base, by publication date."""
    g = growth.filter(F.col("yoy").isNotNull() & (F.col("revenue") > 0))
    return g.withColumn("score", F.avg(F.col("yoy") / 100).over(trailing(months)))


def macro_score(rates: DataFrame, cycle: DataFrame, lookback: int = 21, saturation: float = 0.02) -> DataFrame:
    """Momentum of the exchange rate averaged with the latest business colour (-2..2, halved).

    ``rates`` (date, rate) and ``cycle`` (date, color_score) are market-wide calendars, one row per day.
    """
    w = Window.partitionBy("entity").orderBy("date")
    was = F.lag("rate", lookback).over(w)
    fx = rates.withColumn("fx_score", F.when(was > 0, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), (F.col("rate") - was) / was / saturation))))
    both = asof_join(fx.select("entity", F.col("date").alias("asof"), "fx_score"), cycle, ["color_score"]).withColumn("cycle_score", F.col("color_score") / 2.0)
    n = F.col("fx_score").isNotNull().cast("int") + F.col("cycle_score").isNotNull().cast("int")
    total = F.coalesce("fx_score", F.lit(0.0)) + F.coalesce("cycle_score", F.lit(0.0))
    return both.select("entity", F.date_add("asof", 1).alias("date"), F.when(n > 0, total / n).alias("score"))


def trend_states(z: np.ndarray, first: np.ndarray, size: np.ndarray, horizons=HORIZONS) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Mean and deviation per horizon of a local-linear-trend filter run over each window ``z[first:first + size]``.

    The noise levels scale with a window's mean. All windows advance together, one vector per step.
    """
    total = np.concatenate([[0.0], np.cumsum(z)])
    m = (total[first + size] - total[first]) / size
    r, ql, qs = np.maximum((0.01 * m) ** 2, 1e-9), np.maximum((0.005 * m) ** 2, 1e-9), np.maximum((0.0005 * m) ** 2, 1e-11)
    lv, sl = z[first].astype(float), np.zeros(len(first))
    p00, p01, p11 = np.maximum(np.abs(lv) * 0.1, 1.0), np.zeros(len(first)), np.maximum(np.abs(lv) * 0.01, 0.01)
    # windows in order of size: those still running are a suffix
    order = np.argsort(size, kind="stable")
    first, done = first[order], size[order]
    lv, sl, p00, p01, p11, r, ql, qs = (x[order] for x in (lv, sl, p00, p01, p11, r, ql, qs))
    for step in range(1, int(size.max(initial=0))):
        on = slice(int(np.searchsorted(done, step, "right")), None)
        v = z[first[on] + step]
        a, b, c = p00[on] + 2 * p01[on] + p11[on] + ql[on], p01[on] + p11[on], p11[on] + qs[on]
        s = a + r[on]
        k0, k1 = a / s, b / s
        e = v - (lv[on] + sl[on])
        lv[on], sl[on] = lv[on] + sl[on] + k0 * e, sl[on] + k1 * e
        p00[on], p01[on], p11[on] = (1 - k0) * a, (1 - k0) * b, c - k1 * b
    back = np.argsort(order)
    out = {}
    for h in horizons:
        n = max(1.0, np.floor(h * 5.0 / 7.0 + 0.5))
        var = p00 + 2 * n * p01 + n * n * p11 + n * ql + qs * ((n - 1) * n * (2 * n - 1)) / 6.0
        out[h] = (lv + n * sl)[back], np.sqrt(np.maximum(var, 1e-12))[back]
    return out


def trend_filter(bars: DataFrame, horizons=HORIZONS, confidences=CONFIDENCES, min_bars: int = 30, lookback: int = 504) -> DataFrame:
    """Local-linear-trend Kalman forecasts at every due bar, one streamed pass per entity.

    Each forecast filters its own look-back (two years of bars) afresh, so it uses its past only; an entity's history
    is bounded by the calendar.
    """
    names = {f"{k}_{h}": T.DoubleType() for h in horizons for k in ("mean", "sd")}

    def add(s: dict) -> dict:
        z = s["px"].astype(float)
        out = {k: np.full(len(z), np.nan) for k in names}
        at = np.flatnonzero(s["is_due"])
        at = at[at + 1 >= min_bars]
        if len(at):
            first = np.maximum(0, at + 1 - lookback)
            for h, (mean, sd) in trend_states(z, first, at + 1 - first, horizons).items():
                out[f"mean_{h}"][at], out[f"sd_{h}"][at] = mean * s["c"][at], sd * s["c"][at]
        return out

    df = per_series(bars.select("entity", "date", "px", "c", "is_due"), add, only="is_due", **names)
    cells = F.array(*[F.struct(F.lit(h).alias("horizon"), F.col(f"mean_{h}").alias("mean"), F.col(f"sd_{h}").alias("sd")) for h in horizons])
    df = df.select("entity", "date", F.inline(cells)).filter(F.col("mean").isNotNull() & ~F.isnan("mean")).select("*", _grid("confidence", confidences))
    half = two_sided_z(F.col("confidence")) * F.col("sd")
    return _rows(df, "trend_filter", F.col("mean") - half, F.col("mean") + half, F.col("mean"))


def settle(forecasts: DataFrame, bars: DataFrame, asof: str, tolerance_days: int = 21) -> DataFrame:
    """Realised price, hit and loss for forecasts due by ``asof``.

    The realised price is the raw close of the last bar within ``tolerance_days`` before the due
    day: as seen on that day no later event applies.
    """
    due = forecasts.withColumn("due", F.expr("date_add(forecast_date, horizon)")).filter(F.col("due") <= F.lit(asof).cast("date"))
    days = due.select("entity", F.col("due").alias("asof")).distinct()
    real = asof_join(days, bars, ["close"], tolerance_days=tolerance_days).select("entity", F.col("asof").alias("due"), _r4(F.col("close")).alias("realized"))
    out = due.join(real, ["entity", "due"]).filter(F.col("realized").isNotNull() & F.col("lower").isNotNull() & F.col("upper").isNotNull())
    y = F.col("realized")
    return out.withColumnRenamed("due", "resolved_date").withColumns({
        "hit": hit(y, F.col("lower"), F.col("upper")), "pinball": interval_pinball(y, F.col("lower"), F.col("upper"), F.col("confidence"))})


def realized_inputs(bars: DataFrame, asof: str, horizons=HORIZONS, tolerance_days: int = 21) -> DataFrame:
    """Bars with ``realized_<h>``: the price that settles forecasts issued at them, as in ``settle``.

    Issue days are bars here, so the last bar by the due day is in a range frame of the same series. Null where
    a forecast is not due by ``asof`` or has no bar in time.
    """
    new = {}
    for h in horizons:
        last = lambda c: F.expr(f"last({c}) OVER (PARTITION BY entity ORDER BY date RANGE BETWEEN CURRENT ROW AND {int(h)} FOLLOWING)")
        due = F.date_add("date", h)
        seen = F.col("entity").isNotNull() & (due <= F.lit(asof).cast("date")) & (F.datediff(due, last("date")) <= tolerance_days)
        new[f"realized_{h}"] = F.when(seen, _r4(last("close")))
    return bars.withColumns(new)


def settle_issued(rows: DataFrame, horizons=HORIZONS) -> DataFrame:
    """Forecast rows that carry ``realized_<h>`` of their bar, settled as by ``settle`` without a join."""
    y = F.coalesce(*[F.when(F.col("horizon") == h, F.col(f"realized_{h}")) for h in horizons])
    return settle_realized(rows.withColumn("realized", y).drop(*[f"realized_{h}" for h in horizons]))


def settle_realized(rows: DataFrame) -> DataFrame:
    """Forecast rows that carry the price that settles them."""
    out = rows.filter(F.col("realized").isNotNull() & F.col("lower").isNotNull() & F.col("upper").isNotNull())
    y = F.col("realized")
    return out.withColumns({
        "resolved_date": F.expr("date_add(forecast_date, horizon)"), "hit": hit(y, F.col("lower"), F.col("upper")),
        "pinball": interval_pinball(y, F.col("lower"), F.col("upper"), F.col("confidence"))})


def score(settled: DataFrame, by: list[list[str]]) -> DataFrame:
    """Mean loss, sharpness and coverage for several groupings: one pass to the finest cells, grouping sets over those."""
    cols = list(dict.fromkeys(c for g in by for c in g))
    parts = {"mean_pinball": F.col("pinball"), "sharpness": F.col("upper") - F.col("lower"), "coverage": F.col("hit").cast("int")}
    fine = settled.groupBy(*cols).agg(F.count("*").alias("n"), *[f(x).alias(f"{c}_{k}") for c, x in parts.items() for k, f in (("s", F.sum), ("n", F.count))])
    return fine.groupingSets([[F.col(c) for c in g] for g in by], *[F.col(c) for c in cols]).agg(
        F.sum("n").alias("n"), *[F.when(F.sum(f"{c}_n") > 0, F.sum(f"{c}_s") / F.sum(f"{c}_n")).alias(c) for c in parts])


def conformal(forecasts: DataFrame, settled: DataFrame, window: int = 500, min_size: int = 30, strict: bool = True) -> DataFrame:
    """Conformalised intervals: widened by a finite-sample quantile of past misses.

    ``strict`` uses only forecasts resolved by the forecast date; otherwise those merely issued
    before it.  A series (entity, source, horizon, confidence) reads its last ``window`` misses.
    """
    day = F.expr("date_add(forecast_date, horizon)") if strict else F.col("forecast_date")
    known = settled.select(*KEYS, day.alias("_t"), F.greatest(F.col("lower") - F.col("realized"), F.col("realized") - F.col("upper")).alias("_e"))
    level = F.col("confidence").alias("_level")
    asks = forecasts.select(*KEYS, F.col("forecast_date").alias("_t"), level, "lower", "upper", "point")
    df = past_quantile(known, asks, KEYS, "_t", "_e", "_level", window, min_size, asks_first=not strict)
    return df.select("entity", F.col("_t").alias("forecast_date"), F.concat("source", F.lit("_cqr")).alias("source"), "horizon", "confidence",
                     (F.col("lower") - F.col("q")).alias("lower"), (F.col("upper") + F.col("q")).alias("upper"), "point", "q", "n_past")


def misses(cells: list[Column], horizons=HORIZONS, confidences=CONFIDENCES) -> list[Column]:
    """By how much each settled cell of a bar missed; null where it isn't settled (``realized_inputs``)."""
    out = []
    for i, x in enumerate(cells):
        y = F.col(f"realized_{horizons[i // len(confidences) % len(horizons)]}")
        out.append(F.greatest(x["lower"] - y, y - x["upper"]))
    return out


def _smallest(values: np.ndarray, series: np.ndarray, first: np.ndarray, last: np.ndarray, k: np.ndarray) -> np.ndarray:
    """The ``k``-th smallest (from 0) of ``values[first:last]`` for each request, by bits of ranks in a series.

    ``series`` numbers the runs of ``values`` and no request leaves its run. At each bit values are dealt into zeros and ones in
    order, so a range stays a range: all requests take as many steps as a rank has bits, however long the ranges are.
    """
    order = np.lexsort((values, series))
    base = np.searchsorted(series, series)
    rank = np.empty(len(values), np.int64)
    rank[order] = np.arange(len(values)) - base
    found, start = np.zeros(len(k), np.int64), base[first]
    for bit in reversed(range(int(rank.max(initial=0)).bit_length())):
        one = (rank >> bit & 1).astype(bool)
        zeros = np.concatenate([[0], np.cumsum(~one)])
        a, b = zeros[first], zeros[last]
        low = k < b - a
        found += np.where(low, 0, 1 << bit)
        first, last, k = np.where(low, a, zeros[-1] + first - a), np.where(low, b, zeros[-1] + last - b), np.where(low, k, k - (b - a))
        rank = np.concatenate([rank[~one], rank[one]])
    return values[order][start + found]


def conformal_issued(df: DataFrame, cells: list[Column], window: int = 500, min_size: int = 30, strict: bool = True, horizons=HORIZONS, confidences=CONFIDENCES,
                     sources: tuple[str, ...] = ("baseline", "chip")) -> DataFrame:
    """``conformal`` for the cells of arranged bars, those of each of ``sources`` in turn: one pass and no shuffle.

    Only numbers go to Python, and a forecast is a row there once it is calibrated. Batches hold whole series and are calibrated a cell at a time.
    """
    grid = [(s, h, c) for s in sources for h in horizons for c in confidences][:len(cells)]
    types = dict(df.dtypes)
    schema = f"entity {types['entity']}, forecast_date {types['date']}, source string, horizon int, confidence double, lower double, upper double, point double, q double, n_past int"

    def calibrate(batch):
        column = lambda c: batch.column(c).to_numpy(zero_copy_only=False).astype(float)
        n = batch.num_rows
        starts = np.array([0, *_edges(batch, ("entity",))])
        at = np.repeat(np.arange(len(starts)), np.diff([*starts, n]))
        # days of one series after those of the series before; bars without a day come first
        day = np.nan_to_num(column("_day"), nan=-2.0 ** 31).astype(np.int64) + at * 2 ** 33
        for i, (source, h, c) in enumerate(grid):
            lower, upper, y = column(f"_lower{i}"), column(f"_upper{i}"), column(f"realized_{h}")
            e = np.fmax(lower - y, y - upper)
            settled = ~np.isnan(e)
            number = np.concatenate([[0], np.cumsum(settled)])
            last = number[np.searchsorted(day + h, day, "right") if strict else np.arange(n)]
            first = np.maximum(number[starts][at], last - window)
            size = last - first
            k = np.ceil((size + 1) * c - 1e-9).astype(np.int64)
            rows = np.flatnonzero(batch.column(f"_given{i}").to_numpy(zero_copy_only=False) & (size >= min_size) & (k >= 1) & (k <= size))
            if not len(rows):
                continue
            q = _smallest(e[settled], at[settled], first[rows], last[rows], k[rows] - 1)
            numbers = [lower[rows] - q, upper[rows] + q, column(f"_point{i}")[rows], q]
            taken = pa.array(rows)
            yield pa.RecordBatch.from_arrays([
                batch.column("entity").take(taken), batch.column("date").take(taken), pa.repeat(f"{source}_cqr", len(rows)), pa.array(np.full(len(rows), h, np.int32)), pa.array(np.full(len(rows), float(c))),
                *[pa.array(x, from_pandas=True) for x in numbers], pa.array(size[rows].astype(np.int32))],
                names=["entity", "forecast_date", "source", "horizon", "confidence", "lower", "upper", "point", "q", "n_past"])

    def run(batches):
        for batch in whole_series(batches, ("entity",)):
            yield from calibrate(batch)

    wide = df.select("entity", "date", F.unix_date("date").alias("_day"), *[f"realized_{h}" for h in horizons],
                     *[x[k].alias(f"_{k}{i}") for i, x in enumerate(cells) for k in ("lower", "upper", "point")], *[x.isNotNull().alias(f"_given{i}") for i, x in enumerate(cells)])
    return wide.mapInArrow(run, schema)


CELL = ["source", "horizon", "confidence"]


def daily_losses(settled: DataFrame) -> DataFrame:
    """Sum and number of losses per (cell, issue day): days times cells, however many rows are settled."""
    return settled.groupBy(*CELL, "forecast_date", "resolved_date").agg(F.sum("pinball").alias("_s"), F.count("*").alias("_n"))


def mean_recent_loss(settled: DataFrame, asof: DataFrame, window: int = 100, min_n: int = 30) -> DataFrame:
    """Mean loss over the latest ``window`` issue days settled by each request of ``asof`` (cell, asof).

    Rows fold to one sum and count per (cell, issue day) before the shuffle.
    """
    return recent_loss(daily_losses(settled), asof, window, min_n)


def recent_loss(per: DataFrame, asof: DataFrame, window: int = 100, min_n: int = 30) -> DataFrame:
    """As above, from ``daily_losses``. The horizon is constant in a cell, so issue days settle in order:
    one rolling frame over issue days, then an as-of join, is linear.
    """
    w = Window.partitionBy(*CELL).orderBy("forecast_date").rowsBetween(-(window - 1), 0)
    key = F.concat_ws("|", *CELL).alias("entity")
    roll = per.select(key, F.col("resolved_date").alias("date"), (F.sum("_s").over(w) / F.sum("_n").over(w)).alias("mean_pinball"), F.sum("_n").over(w).alias("n"))
    out = asof_join(asof.select(key, "asof", *CELL), roll, ["mean_pinball", "n"])
    return out.filter(F.col("n") >= min_n).select("asof", *CELL, "mean_pinball", "n")


def eligible_sources(losses: DataFrame, reference: str = "baseline") -> DataFrame:
    """Sources whose recent loss beats the reference's in the same cell."""
    keys = ["asof", "horizon", "confidence"]
    ref = losses.filter(F.col("source") == reference).select(*keys, F.col("mean_pinball").alias("reference_pinball"))
    return losses.filter(F.col("source") != reference).join(ref, keys).filter(F.col("mean_pinball") < F.col("reference_pinball"))


def fuse(forecasts: DataFrame) -> DataFrame:
    """One interval per cell: the intersection, or a widened centroid where intervals do not meet."""
    mid, half = (F.col("lower") + F.col("upper")) / 2, (F.col("upper") - F.col("lower")) / 2
    g = forecasts.groupBy("entity", "forecast_date", "horizon", "confidence").agg(
        F.max("lower").alias("_lo"), F.min("upper").alias("_hi"), F.avg(mid).alias("_c"), (F.max(half) + F.coalesce(F.stddev_samp(mid), F.lit(0.0))).alias("_h"), F.count("*").alias("n_sources"))
    meet = F.col("_hi") >= F.col("_lo")
    lo = F.when(meet, F.col("_lo")).otherwise(F.col("_c") - F.col("_h"))
    hi = F.when(meet, F.col("_hi")).otherwise(F.col("_c") + F.col("_h"))
    return g.select("entity", "forecast_date", F.lit("fusion").alias("source"), "horizon", "confidence", lo.alias("lower"), hi.alias("upper"), ((lo + hi) / 2).alias("point"), "n_sources", meet.alias("intersects"))


def fuse_cells(df: DataFrame, sources: list[list[Column]]) -> DataFrame:
    """``fuse`` for the forecasts of bars, given as the cells of each source in the same order."""
    names = [f"_s{k}" for k in range(len(sources))]
    rows = df.select("entity", F.col("date").alias("forecast_date"), F.inline(F.array(*[F.struct(*[x.alias(n) for n, x in zip(names, cells)]) for cells in zip(*sources)])))
    first = lambda f: F.coalesce(*[F.col(n)[f] for n in names], F.lit(None))
    each = lambda fn, x: fn(*x, F.lit(None).cast("double"))
    total = lambda x: sum((F.coalesce(v, F.lit(0.0)) for v in x[1:]), F.coalesce(x[0], F.lit(0.0)))
    rows = rows.select("entity", "forecast_date", F.lit("fusion").alias("source"), first("horizon").alias("horizon"), first("confidence").alias("confidence"),
                       each(F.greatest, [F.col(n)["lower"] for n in names]).alias("_lo"), each(F.least, [F.col(n)["upper"] for n in names]).alias("_hi"),
                       each(F.greatest, [(F.col(n)["upper"] - F.col(n)["lower"]) / 2 for n in names]).alias("_half"),
                       sum((F.col(n).isNotNull().cast("long") for n in names), F.lit(0).cast("long")).alias("n_sources"), *[((F.col(n)["lower"] + F.col(n)["upper"]) / 2).alias(n) for n in names])
    rows = rows.filter("n_sources > 0").withColumn("_c", total([F.col(n) for n in names]) / F.col("n_sources"))
    rows = rows.withColumn("_sd", F.when(F.col("n_sources") > 1, F.sqrt(total([(F.col(n) - F.col("_c")) * (F.col(n) - F.col("_c")) for n in names]) / (F.col("n_sources") - 1))).otherwise(0.0))
    meet = F.col("_hi") >= F.col("_lo")
    rows = rows.withColumns({"lower": F.when(meet, F.col("_lo")).otherwise(F.col("_c") - (F.col("_half") + F.col("_sd"))), "upper": F.when(meet, F.col("_hi")).otherwise(F.col("_c") + (F.col("_half") + F.col("_sd"))), "intersects": meet})
    return rows.select("entity", "forecast_date", "source", "horizon", "confidence", "lower", "upper", ((F.col("lower") + F.col("upper")) / 2).alias("point"), "n_sources", "intersects")


def pick_cells(sources: dict[str, list[Column]], preference: list[str]) -> list[Column]:
    """``pick_band`` for the forecasts of one bar: each cell of the first source that has one."""
    return [F.coalesce(*cells) for cells in zip(*[sources[s] for s in preference if s in sources])]


def pick_band(forecasts: DataFrame, preference: list[str]) -> DataFrame:
    """Per cell the interval of the first available source, with its relative width."""
    rank = F.array_position(F.array(*map(F.lit, preference)), F.col("source"))
    df = forecasts.withColumn("_rank", rank).filter(F.col("_rank") > 0)
    best = df.groupBy("entity", "forecast_date", "horizon", "confidence").agg(F.min_by(F.struct("source", "lower", "upper", "point"), "_rank").alias("b"))
    return with_width(best.select("entity", "forecast_date", "horizon", "confidence", "b.*"))


def with_width(bands: DataFrame) -> DataFrame:
    return bands.withColumn("width_ratio", F.when(F.col("point") > 0, (F.col("upper") - F.col("lower")) / F.col("point")))


def manual_rows(df: DataFrame, source: str = "manual") -> DataFrame:
    """Hand-made forecasts: rejects a batch with lower >= upper, confidence outside (0, 1) or horizon <= 0.

    The check is part of the plan (``raise_error``), so nothing is counted on the driver.
    """
    bad = (F.col("lower") >= F.col("upper")) | (F.col("confidence") <= 0) | (F.col("confidence") >= 1) | (F.col("horizon") <= 0)
    checked = F.when(bad, F.raise_error(F.lit("invalid forecast row"))).otherwise(F.lit(source))
    return df.withColumn("source", checked.cast("string"))
