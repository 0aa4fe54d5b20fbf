"""Indicator queries over daily bars."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import texts as X
from tidemark.functions.windows import zscore_before
from tidemark.operators import indicators as I
from tidemark.operators import order_statistics as OS
from tidemark.operators import recursive as R
from tidemark.operators import scanned as SC
from tidemark.plans.ctes import SERIES
from tidemark.plans.registry import query, rnd, rnds, tidy
from tidemark.sources import views as V

ANCHOR = "1997-01-02"
W = X.OVER
MID = "(high + low + close) / 3"


# --- SQL for the indicator columns; each piece adds a CTE on top of the numbered bars ``s`` -------

def wma_sql(c: str, p: int) -> str:
    n = f"least(idx + 1, {p})"
    terms = [f"{c} * {n}"] + [f"coalesce({X.prev(c, k)} * ({n} - {k}), 0)" for k in range(1, p)]
    return f"({' + '.join(terms)}) / ({n} * ({n} + 1) / 2.0)"


def ema_cte(dst: str, src: str, c: str, p: float, out: str, alpha: str | None = None) -> str:
    """Closed form of the exponential filter: a cumulative sum of weighted terms."""
    a = alpha or f"(2.0 / ({p} + 1.0))"
    return (f"{dst} AS (SELECT *, pow(1 - {a}, idx) * (first_value({c}) OVER ({W}) + "
            + X.cum("sum", f"CASE WHEN idx > 0 THEN {a} * {c} * pow(1 - {a}, -idx) ELSE 0 END") + f") AS {out} FROM {src})")


def seeded_sql(c: str, p: int, first: int, seed: str) -> str:
    """Wilder smoothing from bar ``first``, where it equals ``seed``."""
    b = f"(1 - 1.0 / {p})"
    return (f"CASE WHEN idx >= {first} THEN pow({b}, idx - {first}) * ({seed} + "
            + X.cum("sum", f"CASE WHEN idx > {first} THEN {c} / {p}.0 * pow({b}, {first} - idx) ELSE 0 END") + ") ELSE 0 END")


def over_all(agg: str, cond: str) -> str:
    return f"sum(CASE WHEN {cond} THEN {agg} ELSE 0 END) OVER (PARTITION BY entity)"


MA_SQL = SERIES + f""", m1 AS (SELECT *, {X.roll('avg', 'close', 20)} AS sma, {wma_sql('close', 20)} AS wma,
  {wma_sql('close', 10)} AS half FROM s), m2 AS (SELECT *, 2 * half - wma AS raw FROM m1),
 ind AS (SELECT *, {wma_sql('raw', 4)} AS hma FROM m2)"""

EMA_SQL = SERIES + ", " + ", ".join([
    ema_cte("e1", "s", "close", 20, "ema"), ema_cte("e2", "e1", "ema", 20, "ee"), ema_cte("e3", "e2", "ee", 20, "eee"),
    "ind AS (SELECT *, 2 * ema - ee AS dema, 3 * ema - 3 * ee + eee AS tema FROM e3)"])

MACD_TAIL = ", ".join([
    ema_cte("f1", "s", "close", 12, "fast"), ema_cte("f2", "f1", "close", 26, "slow"),
    "f3 AS (SELECT *, fast - slow AS macd FROM f2)", ema_cte("f4", "f3", "macd", 9, "signal"),
    "ind AS (SELECT *, macd - signal AS histogram FROM f4)"])
MACD_SQL = SERIES + ", " + MACD_TAIL

RSI_TAIL = f"""r0 AS (SELECT *, close - {X.prev('close')} AS d FROM s),
 r1 AS (SELECT *, {seeded_sql('greatest(coalesce(d, 0), 0)', 14, 14, over_all('greatest(d, 0)', 'idx BETWEEN 1 AND 14') + ' / 14')} AS ag,
   {seeded_sql('greatest(coalesce(-d, 0), 0)', 14, 14, over_all('greatest(-d, 0)', 'idx BETWEEN 1 AND 14') + ' / 14')} AS al FROM r0),
 ind AS (SELECT *, CASE WHEN idx < 14 THEN 0.0 WHEN al < 1e-12 THEN 100.0 ELSE 100 - 100 / (1 + ag / al) END AS rsi FROM r1)"""
RSI_SQL = SERIES + ", " + RSI_TAIL


def _from_fifty(c: str) -> str:
    b = "(1 - 1.0 / 3)"
    return f"pow({b}, idx + 1) * (50 + {X.cum('sum', f'{c} / 3.0 * pow({b}, -(idx + 1))')})"


KD_SQL = SERIES + f""", k0 AS (SELECT *, {X.roll('max', 'high', 9)} AS hh, {X.roll('min', 'low', 9)} AS ll FROM s),
 k1 AS (SELECT *, CASE WHEN hh - ll > 1e-9 THEN (close - ll) / (hh - ll) * 100 ELSE 50.0 END AS rsv FROM k0),
 k2 AS (SELECT *, {_from_fifty('rsv')} AS k FROM k1), ind AS (SELECT *, {_from_fifty('k')} AS d FROM k2)"""

_TR = f"greatest(high - low, coalesce(abs(high - {X.prev('close')}), 0), coalesce(abs(low - {X.prev('close')}), 0))"


def _sum_first(c):
    return over_all(c, "idx BETWEEN 1 AND 14") + " / 14"


ADX_SQL = SERIES + f""", a0 AS (SELECT *, high - {X.prev('high')} AS up, {X.prev('low')} - low AS dn,
   CASE WHEN idx = 0 THEN 0 ELSE {_TR} END AS tr FROM s),
 a1 AS (SELECT *, CASE WHEN up > dn AND up > 0 THEN up ELSE 0 END AS pdm, CASE WHEN dn > up AND dn > 0 THEN dn ELSE 0 END AS mdm FROM a0),
 a2 AS (SELECT *, {seeded_sql('tr', 14, 14, _sum_first('tr'))} AS satr, {seeded_sql('pdm', 14, 14, _sum_first('pdm'))} AS sp,
   {seeded_sql('mdm', 14, 14, _sum_first('mdm'))} AS sm FROM a1),
 a3 AS (SELECT *, CASE WHEN satr > 0 THEN 100 * sp / satr ELSE 0 END AS plus_di, CASE WHEN satr > 0 THEN 100 * sm / satr ELSE 0 END AS minus_di FROM a2),
 a4 AS (SELECT *, CASE WHEN plus_di + minus_di > 0 THEN 100 * abs(plus_di - minus_di) / (plus_di + minus_di) ELSE 0 END AS dx FROM a3),
 ind AS (SELECT *, {seeded_sql('dx', 14, 27, over_all('dx', 'idx BETWEEN 14 AND 27') + ' / 14')} AS adx FROM a4)"""


def _atr(p: int) -> str:
    seed = over_all("tr", f"idx < {p}") + f" / {p}"
    return f"CASE WHEN idx < {p} THEN {X.cum('avg', 'tr')} ELSE {seeded_sql('tr', p, p - 1, seed)} END"


ATR_SQL = SERIES + f""", t0 AS (SELECT *, {_TR} AS tr FROM s), t1 AS (SELECT *, {_atr(14)} AS atr FROM t0),
 ind AS (SELECT *, CASE WHEN close > 0 THEN atr / close * 100 ELSE 0 END AS atr_pct FROM t1)"""

KELTNER_SQL = SERIES + f""", t0 AS (SELECT *, {_TR} AS tr FROM s), t1 AS (SELECT *, {_atr(10)} AS atr FROM t0), """ + ema_cte(
    "t2", "t1", "close", 20, "middle") + ", ind AS (SELECT *, middle + 2 * atr AS upper, middle - 2 * atr AS lower FROM t2)"

BOLL_SQL = SERIES + f""", b0 AS (SELECT *, {X.roll('avg', 'close', 20)} AS middle, {X.roll('stddev_pop', 'close', 20)} AS sd FROM s),
 b1 AS (SELECT *, middle + 2 * sd AS upper, middle - 2 * sd AS lower FROM b0),
 ind AS (SELECT *, CASE WHEN middle > 0 THEN (upper - lower) / middle ELSE 0 END AS bandwidth,
   CASE WHEN upper - lower > 1e-12 THEN (close - lower) / (upper - lower) ELSE 0.5 END AS percent_b FROM b1)"""

OBV_SQL = SERIES + f""", o0 AS (SELECT *, coalesce(sign(close - {X.prev('close')}) * volume, 0) AS step FROM s),
 o1 AS (SELECT *, CAST({X.cum('sum', 'step')} AS DOUBLE) AS obv FROM o0), ind AS (SELECT *, {X.roll('avg', 'obv', 20)} AS obv_ma FROM o1)"""

CCI_SQL = SERIES + f""", c0 AS (SELECT *, {MID} AS tp FROM s), c1 AS (SELECT *, {X.roll('avg', 'tp', 20)} AS m, {X.roll('list', 'tp', 20)} AS l FROM c0),
 c2 AS (SELECT *, list_avg(list_transform(l, lambda v: abs(v - m))) AS md FROM c1),
 ind AS (SELECT *, CASE WHEN idx >= 19 AND md > 0 THEN (tp - m) / (0.015 * md) ELSE 0 END AS cci FROM c2)"""


def _roc(n):
    return f"CASE WHEN {X.prev('close', n)} = 0 THEN 0 ELSE (close - {X.prev('close', n)}) / {X.prev('close', n)} * 100 END"


COPPOCK_SQL = SERIES + f""", q0 AS (SELECT *, CASE WHEN idx >= 14 THEN {_roc(14)} + {_roc(11)} ELSE 0 END AS roc FROM s),
 ind AS (SELECT *, CASE WHEN idx >= 9 THEN ({' + '.join(['roc * 10'] + [f"{X.prev('roc', k)} * {10 - k}" for k in range(1, 10)])}) / 55.0 ELSE 0 END AS coppock FROM q0)"""

DONCHIAN_SQL = SERIES + f""", ind AS (SELECT *, CASE WHEN idx >= 19 THEN {X.roll('max', 'high', 20)} ELSE high END AS upper,
   CASE WHEN idx >= 19 THEN ({X.roll('max', 'high', 20)} + {X.roll('min', 'low', 20)}) / 2 ELSE close END AS middle,
   CASE WHEN idx >= 19 THEN {X.roll('min', 'low', 20)} ELSE low END AS lower FROM s)"""


def _mid(n):
    return f"CASE WHEN idx >= {n - 1} THEN ({X.roll('max', 'high', n)} + {X.roll('min', 'low', n)}) / 2 ELSE (high + low) / 2 END"


ICHI_SQL = SERIES + f""", i0 AS (SELECT *, {_mid(9)} AS tenkan, {_mid(26)} AS kijun, {_mid(52)} AS b FROM s),
 i1 AS (SELECT *, (tenkan + kijun) / 2 AS a FROM i0),
 i2 AS (SELECT *, coalesce({X.prev('a', 26)}, a) AS senkou_a, coalesce({X.prev('b', 26)}, b) AS senkou_b FROM i1),
 ind AS (SELECT *, CAST(sign(senkou_a - senkou_b) AS INTEGER) AS cloud FROM i2)"""

MFI_SQL = SERIES + f""", g0 AS (SELECT *, {MID} AS tp FROM s), g1 AS (SELECT *, {X.prev('tp')} AS was FROM g0),
 g2 AS (SELECT *, {X.roll('sum', 'CASE WHEN tp > was THEN tp * volume ELSE 0 END', 14)} AS u, {X.roll('sum', 'CASE WHEN tp < was THEN tp * volume ELSE 0 END', 14)} AS w FROM g1),
 ind AS (SELECT *, CASE WHEN idx < 14 THEN 0.0 WHEN w > 0 THEN 100 - 100 / (1 + u / w) WHEN u > 0 THEN 100.0 ELSE 50.0 END AS mfi FROM g2)"""

VWAP_SQL = SERIES + f""", v0 AS (SELECT *, {MID} AS tp, CASE WHEN date >= DATE '{ANCHOR}' THEN volume ELSE 0 END AS v FROM s),
 v1 AS (SELECT *, {X.cum('sum', 'v')} AS cv, {X.cum('sum', 'tp * v')} AS cpv, {X.cum('sum', 'tp * tp * v')} AS cp2v FROM v0),
 v2 AS (SELECT *, CASE WHEN cv > 0 THEN cpv / cv ELSE tp END AS vwap FROM v1),
 ind AS (SELECT *, CASE WHEN cv > 0 THEN sqrt(greatest(cp2v / cv - vwap * vwap, 0)) ELSE 0 END AS sd FROM v2)"""

WILLIAMS_SQL = SERIES + f""", w0 AS (SELECT *, {X.roll('max', 'high', 14)} AS hh, {X.roll('min', 'low', 14)} AS ll FROM s),
 ind AS (SELECT *, CASE WHEN idx >= 13 AND hh > ll THEN (hh - close) / (hh - ll) * -100 ELSE 0 END AS williams_r FROM w0)"""


def series_query(name, covers, sql, build, cols, digits=4):
    @query(name, covers, f"WITH {sql} SELECT entity, date, {rnds(cols, digits)} FROM ind")
    def run(spark, d):
        return tidy(build(V.bars(spark, d)), "entity", "date", *cols.split(), digits=digits)

    return run


series_query("moving_averages", "E6,E7,E9,E10", MA_SQL, I.moving_averages, "sma wma hma")
series_query("exponential_averages", "E8,E9", EMA_SQL, R.exponential_averages, "ema dema tema", 2)
series_query("macd", "E11", MACD_SQL, R.macd, "macd signal histogram", 2)
series_query("rsi", "E12", RSI_SQL, R.rsi, "rsi")
series_query("stochastic_kd", "E13", KD_SQL, R.kd, "rsv k d")
series_query("adx", "E14", ADX_SQL, R.adx, "plus_di minus_di adx")
series_query("atr", "E15", ATR_SQL, R.atr, "tr atr atr_pct", 2)
series_query("keltner_channel", "E22", KELTNER_SQL, R.keltner, "upper middle lower", 2)
series_query("bollinger_bands", "E16", BOLL_SQL, I.bollinger, "upper middle lower bandwidth percent_b")
series_query("on_balance_volume", "E17", OBV_SQL, I.obv, "obv obv_ma")
series_query("commodity_channel_index", "E18", CCI_SQL, I.cci, "cci")
series_query("coppock_curve", "E19", COPPOCK_SQL, I.coppock, "coppock")
series_query("donchian_channel", "E20", DONCHIAN_SQL, I.donchian, "upper middle lower", 3)


@query("ichimoku_cloud", "E21", f"WITH {ICHI_SQL} SELECT entity, date, cloud, {rnds('tenkan kijun senkou_a senkou_b')} FROM ind")
def _ichimoku(spark, d):
    return tidy(I.ichimoku(V.bars(spark, d)), "entity", "date", "cloud", "tenkan", "kijun", "senkou_a", "senkou_b")


series_query("money_flow_index", "E23", MFI_SQL, I.mfi, "mfi")
series_query("anchored_vwap", "E24", VWAP_SQL, lambda b: I.vwap(b, ANCHOR), "vwap sd", 2)
series_query("williams_r", "E25", WILLIAMS_SQL, I.williams_r, "williams_r")
series_query("price_sources", "E10", SERIES + ", ind AS (SELECT *, (high + low) / 2 AS hl2, (high + low + close) / 3 AS hlc3, (open + high + low + close) / 4 AS ohlc4 FROM s)",
             lambda b: b.select("*", *[I.price_source(x).alias(x) for x in ("hl2", "hlc3", "ohlc4")]), "hl2 hlc3 ohlc4")
series_query("lag_percent_change", "E4,I3", SERIES + f", ind AS (SELECT *, CASE WHEN {X.prev('close')} > 0 THEN (close - {X.prev('close')}) / {X.prev('close')} * 100 ELSE 0 END AS change_pct FROM s)",
             lambda b: b.withColumn("change_pct", I.pct_change("close", absent=0.0)), "change_pct")


def _z(c, n):
    avg, sd, cnt = X.past("avg", c, n), X.past("stddev_pop", c, n), X.past("count", c, n)
    return f"CASE WHEN {cnt} >= {n} AND {sd} > 1e-12 THEN ({c} - {avg}) / {sd} END"


series_query("rolling_zscore", "E29", SERIES + f", ind AS (SELECT *, {_z('volume', 60)} AS z FROM s)",
             lambda b: b.withColumn("z", zscore_before("volume", 60, 60)), "z")


@query("trailing_percentile", "E31", f"""WITH {SERIES}, p AS (SELECT *, {X.roll('list', 'close', 252)} AS l FROM s)
 SELECT entity, date, {rnd("len(list_filter(l, lambda v: v <= close)) * 1.0 / len(l)", 'percentile')} FROM p""")
def _trailing_percentile(spark, d):
    return tidy(OS.trailing_percentiles(V.bars(spark, d).select("entity", "date", "close"), {"percentile": "close"}, n=252), "entity", "date", "percentile")


@query("history_percentile", "E32", f"""WITH {SERIES}, p AS (SELECT *, list(close) OVER (PARTITION BY entity ORDER BY date
   RANGE BETWEEN INTERVAL 730 DAYS PRECEDING AND CURRENT ROW) AS l FROM s)
 SELECT entity, date, {rnd("CASE WHEN len(l) >= 10 THEN len(list_filter(l, lambda v: v < close)) * 100.0 / len(l) END", 'percentile')} FROM p""")
def _history_percentile(spark, d):
    df = OS.trailing_percentiles(V.bars(spark, d).select("entity", "date", "close"), {"percentile": "close"}, days=730, strict=True, min_obs=10)
    return tidy(df, "entity", "date", "percentile")


series_query("ratio_momentum", "E33", SERIES + f""", m AS (SELECT *, close / high * 100 AS ratio FROM s),
 ind AS (SELECT *, CASE WHEN idx >= 5 THEN ratio - {X.past('avg', 'ratio', 5)} ELSE 0 END AS momentum FROM m)""",
             lambda b: I.ratio_momentum(b.withColumn("ratio", F.col("close") / F.col("high") * 100), "ratio", 5), "momentum")

TREND_SQL = SERIES + f""", t0 AS (SELECT *, {X.roll('avg', 'close', 20)} AS ma20, {X.roll('avg', 'close', 60)} AS ma_long,
   CASE WHEN idx >= 10 AND {X.past('stddev_pop', 'volume', 60)} > 0 THEN (volume - {X.past('avg', 'volume', 60)}) / {X.past('stddev_pop', 'volume', 60)} ELSE 0 END AS volume_z FROM s),
 ind AS (SELECT *, CASE WHEN abs(close - ma_long) <= abs(ma_long) * 1e-12 THEN 'flat' WHEN close > ma_long THEN 'up' WHEN close < ma_long THEN 'down' ELSE 'flat' END AS trend, ma20 - {X.prev('ma20')} AS slope FROM t0)"""


@query("index_trend_state", "E34", f"WITH {TREND_SQL} SELECT entity, date, trend, {rnds('volume_z ma20 ma_long slope')} FROM ind")
def _index_trend(spark, d):
    return tidy(I.index_trend(V.bars(spark, d)), "entity", "date", "trend", "volume_z", "ma20", "ma_long", "slope")


series_query("return_volatility", "E35,J16", SERIES + f""", r AS (SELECT *, close / {X.prev('close')} - 1 AS ret, ln(close / {X.prev('close')}) AS lret FROM s),
 ind AS (SELECT *, CASE WHEN {X.roll('count', 'ret', 252)} >= 50 THEN {X.roll('stddev_samp', 'ret', 252)} END AS vol,
   CASE WHEN {X.roll('count', 'lret', 60)} >= 10 THEN {X.roll('stddev_samp', 'lret', 60)} END AS log_vol FROM r)""",
             lambda b: I.volatility(I.volatility(b, 252, 50).withColumnRenamed("vol", "_v").drop("ret"), 60, 10, log=True)
             .withColumnRenamed("vol", "log_vol").withColumnRenamed("_v", "vol"), "vol log_vol")


@query("commodity_momentum", "E30", f"""WITH {SERIES}, p AS (SELECT entity, date, idx, CASE WHEN volume > 5 THEN close END AS price FROM s),
 p1 AS (SELECT *, last_value(price IGNORE NULLS) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS was FROM p),
 p2 AS (SELECT *, CASE WHEN was > 0 AND price IS NOT NULL THEN (price - was) / was * 100 END AS return_pct FROM p1),
 p3 AS (SELECT *, CASE WHEN {X.past('count', 'return_pct', 60)} >= 10 AND {X.past('stddev_pop', 'return_pct', 60)} > 1e-12
    THEN (return_pct - {X.past('avg', 'return_pct', 60)}) / {X.past('stddev_pop', 'return_pct', 60)} END AS zscore,
    CASE WHEN return_pct > 0.05 THEN 'up' WHEN return_pct < -0.05 THEN 'down' ELSE 'neutral' END AS momentum FROM p2),
 p4 AS (SELECT *, idx - row_number() OVER (PARTITION BY entity, momentum ORDER BY date) AS island FROM p3)
 SELECT entity, date, momentum, CAST(row_number() OVER (PARTITION BY entity, momentum, island ORDER BY date) AS INTEGER) AS streak,
   {rnds('return_pct zscore')} FROM p4""")
def _commodity(spark, d):
    prices = V.bars(spark, d).select("entity", "date", F.when(F.col("volume") > 5, F.col("close")).alias("price"))
    return tidy(I.commodity_macro(prices), "entity", "date", "momentum", "streak", "return_pct", "zscore")


KALMAN_SQL = SERIES + """, hz(horizon, q, threshold, min_run) AS (VALUES ('short', 0.1, 0.003, 3), ('medium', 0.01, 0.002, 5), ('long', 0.001, 0.0015, 5), ('ultra_long', 0.00001, 0.001, 5)),
 base AS (SELECT entity, date, idx, close, power(0.01 * avg(close) OVER (PARTITION BY entity ORDER BY idx ROWS UNBOUNDED PRECEDING), 2) AS r FROM s),
 k AS (
  WITH RECURSIVE kal AS (
    SELECT entity, date, idx, horizon, q, threshold, min_run, r, close, close AS x, (1 - (r + q) / (r + q + r)) * (r + q) AS p, 0.0::DOUBLE AS velocity FROM base, hz WHERE idx = 0
    UNION ALL
    SELECT b.entity, b.date, b.idx, k.horizon, k.q, k.threshold, k.min_run, b.r, b.close,
      k.x + (k.p + k.q) / (k.p + k.q + b.r) * (b.close - k.x), (1 - (k.p + k.q) / (k.p + k.q + b.r)) * (k.p + k.q),
      (k.p + k.q) / (k.p + k.q + b.r) * (b.close - k.x)
    FROM kal k JOIN base b ON b.entity = k.entity AND b.idx = k.idx + 1)
  SELECT * FROM kal)"""


KALMAN_WHOLE_SQL = KALMAN_SQL.replace("OVER (PARTITION BY entity ORDER BY idx ROWS UNBOUNDED PRECEDING), 2)", "OVER (PARTITION BY entity), 2)")


@query("kalman_smoother_whole_series_noise", "E26", f"WITH {KALMAN_WHOLE_SQL} SELECT entity, date, horizon, {rnd('x', 'smoothed', 2)}, {rnd('sqrt(p)', 'uncertainty', 2)}, {rnd('velocity', digits=2)} FROM k")
def _kalman_whole(spark, d):
    return tidy(R.kalman(V.bars(spark, d), expanding=False), "entity", "date", "horizon", "smoothed", "uncertainty", "velocity", digits=2)


@query("kalman_smoother", "E26", f"WITH {KALMAN_SQL} SELECT entity, date, horizon, {rnd('x', 'smoothed', 2)}, {rnd('sqrt(p)', 'uncertainty', 2)}, {rnd('velocity', digits=2)} FROM k")
def _kalman(spark, d):
    return tidy(R.kalman(V.bars(spark, d)), "entity", "date", "horizon", "smoothed", "uncertainty", "velocity", digits=2)


REGIME_SQL = KALMAN_SQL + """, c0 AS (SELECT *, CASE WHEN abs(x) > 0 THEN velocity / x ELSE 0 END AS vp,
    velocity - coalesce(lag(velocity, 20) OVER w, first_value(velocity) OVER w) AS accel FROM k WINDOW w AS (PARTITION BY entity, horizon ORDER BY date)),
 c AS (SELECT *, CASE WHEN abs(vp) < threshold THEN 'sideway'
   WHEN vp > 0 THEN CASE WHEN abs(accel) < 0.01 THEN 'stable_up' WHEN accel > 0 THEN 'accelerating' ELSE 'decelerating' END
   ELSE CASE WHEN abs(accel) < 0.01 THEN 'stable_down' WHEN accel > 0 THEN 'decelerating' ELSE 'stable_down' END END AS regime FROM c0)"""


@query("regime_classes", "E27", f"WITH {REGIME_SQL} SELECT entity, date, horizon, regime FROM c")
def _regimes(spark, d):
    return R.regimes(R.kalman(V.bars(spark, d))).select("entity", "date", "horizon", "regime")


@query("regime_changes", "E28,F27", f"""WITH {REGIME_SQL},
 u0 AS (SELECT *, row_number() OVER (PARTITION BY entity, horizon ORDER BY date) - row_number() OVER (PARTITION BY entity, horizon, regime ORDER BY date) AS island FROM c WHERE idx >= 60),
 u1 AS (SELECT entity, horizon, regime, island, min(date) AS date, count(*) AS n, any_value(min_run) AS min_run, arg_min(x, date) AS x FROM u0 GROUP BY ALL),
 u2 AS (SELECT *, row_number() OVER (PARTITION BY entity, horizon ORDER BY date) AS rn FROM u1),
 u3 AS (SELECT *, lag(regime) OVER (PARTITION BY entity, horizon ORDER BY date) AS from_regime FROM u2 WHERE rn = 1 OR n >= min_run)
 SELECT entity, horizon, date, from_regime, regime AS to_regime, {rnd('x', 'value', 2)} FROM u3 WHERE from_regime IS DISTINCT FROM regime""")
def _regime_changes(spark, d):
    return tidy(R.regime_changes(R.regimes(R.kalman(V.bars(spark, d)))), digits=2)


# The same recursions as scans over yearly blocks; SQL as above.
series_query("exponential_averages_scan", "E8,E9,M6", EMA_SQL, SC.exponential_averages, "ema dema tema", 2)
series_query("rsi_scan", "E12", RSI_SQL, SC.rsi, "rsi")
series_query("atr_scan", "E15", ATR_SQL, SC.atr, "tr atr atr_pct", 2)


@query("kalman_smoother_scan", "E26", f"WITH {KALMAN_SQL} SELECT entity, date, horizon, {rnd('x', 'smoothed', 2)}, {rnd('sqrt(p)', 'uncertainty', 2)}, {rnd('velocity', digits=2)} FROM k")
def _kalman_scan(spark, d):
    return tidy(SC.kalman(V.bars(spark, d)), "entity", "date", "horizon", "smoothed", "uncertainty", "velocity", digits=2)
