"""Forecast queries: issue at every bar, settle, score, calibrate, gate and fuse."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import scalars as K
from tidemark.functions import texts as X
from tidemark.operators import aggregates as A
from tidemark.operators import backtest as BT
from tidemark.operators import forecast as FC
from tidemark.operators.indicators import indexed
from tidemark.operators.pit import asof_join, report_date
from tidemark.operators.recursive import arranged
from tidemark.plans.ctes import REVENUE, SERIES
from tidemark.plans.events import YOY_SQL
from tidemark.plans.registry import query, rnd, rnds, tidy
from tidemark.session import cut
from tidemark.sources import views as V

GRID = "hz(horizon) AS (VALUES (21), (63), (126)), cf(confidence) AS (VALUES (0.5::DOUBLE), (0.8::DOUBLE), (0.95::DOUBLE))"
MONTH_END = f"({X.nxt('date')} IS NULL OR date_trunc('month', {X.nxt('date')}) <> date_trunc('month', date))"
A_, B_, C_, D_ = K._A, K._B, K._C, K._D


def poly(c, x):
    out = f"({c[0]!r})"
    for v in c[1:]:
        out = f"({out} * {x} + ({v!r}))"
    return out


def z_sql(conf: str) -> str:
    p = f"(0.5::DOUBLE + {conf} / 2)"
    r, hi = f"({p} - 0.5)", f"sqrt(-2 * ln(1 - {p}))"
    return f"(CASE WHEN {p} > 1 - 0.02425 THEN -{poly(C_, hi)} / {poly(D_, hi)} ELSE {poly(A_, f'({r} * {r})')} * {r} / {poly(B_, f'({r} * {r})')} END)".replace("e-", "e-")


def r4(e, name):
    return f"floor(({e}) * 10000 + 0.5) / 10000 AS {name}"


FCOLS = ["entity", "forecast_date", "source", "horizon", "confidence", "lower", "upper", "point"]


def out(df, *more, digits=3):
    return tidy(df, *FCOLS, *more, digits=digits)


FSEL = "entity, forecast_date, source, horizon, confidence, " + rnds("lower upper point", 3)


def prices(spark, d):
    return FC.every_bar(FC.unadjusted(indexed(V.bars(spark, d))))


BASE = f"""d0 AS (SELECT *, {X.roll('avg', 'close', 20)} AS trend, {', '.join(f"close / {X.prev('close', h)} - 1 AS r{h}" for h in FC.HORIZONS)} FROM s),
 d1 AS (SELECT *, {', '.join(f"list_sort(list_filter({X.roll('list', f'r{h}', 252)}, lambda v: v IS NOT NULL)) AS s{h}" for h in FC.HORIZONS)} FROM d0),
 d2 AS (SELECT entity, date, trend, horizon, CASE horizon {' '.join(f'WHEN {h} THEN s{h}' for h in FC.HORIZONS)} END AS l FROM d1, hz WHERE idx >= greatest(20, horizon)),
 d3 AS (SELECT *, (len(l) - 1) * ((1 - confidence) / 2) AS pl, (len(l) - 1) * (1 - (1 - confidence) / 2) AS ph FROM d2, cf WHERE len(l) >= 5),
 d4 AS (SELECT *, l[CAST(floor(pl) AS INTEGER) + 1] + (l[least(CAST(floor(pl) AS INTEGER) + 2, len(l))] - l[CAST(floor(pl) AS INTEGER) + 1]) * (pl - floor(pl)) AS ql,
   l[CAST(floor(ph) AS INTEGER) + 1] + (l[least(CAST(floor(ph) AS INTEGER) + 2, len(l))] - l[CAST(floor(ph) AS INTEGER) + 1]) * (ph - floor(ph)) AS qh FROM d3),
 base AS (SELECT entity, date AS forecast_date, 'baseline' AS source, horizon, confidence, {r4('trend * (1 + ql)', 'lower')}, {r4('trend * (1 + qh)', 'upper')}, {r4('trend', 'point')} FROM d4)"""
BASE_SQL = f"{SERIES}, {GRID}, {BASE}"


@query("baseline_forecast", "J1,J12", f"WITH {BASE_SQL} SELECT {FSEL} FROM base")
def _baseline(spark, d):
    return out(FC.baseline(prices(spark, d)))


LOGC = f"""g0 AS (SELECT *, ln(close) AS y FROM s), g1 AS (SELECT *, {', '.join(f"{f}(y, CAST(idx AS DOUBLE)) OVER ({X.OVER} ROWS BETWEEN 251 PRECEDING AND CURRENT ROW) AS {n}" for f, n in (('regr_slope', 'sl'), ('regr_intercept', 'ic'), ('regr_syy', 'syy'), ('regr_sxy', 'sxy')))} FROM g0),
 g2 AS (SELECT *, sqrt(greatest(syy - sl * sxy, 0) / 250) AS sd FROM g1 WHERE idx >= 251), g3 AS (SELECT *, ic + sl * (idx + horizon) AS mid, {z_sql('confidence')} * sd * sqrt(horizon) AS half FROM g2, hz, cf),
 logc AS (SELECT entity, date AS forecast_date, 'log_channel' AS source, horizon, confidence, {r4('exp(mid - half)', 'lower')}, {r4('exp(mid + half)', 'upper')}, {r4('exp(mid)', 'point')} FROM g3)"""


@query("log_channel_forecast", "J2,I1", f"WITH {SERIES}, {GRID}, {LOGC} SELECT entity, forecast_date, source, horizon, confidence, {rnds('lower point', 2)}, {rnd('ln(upper)', 'log_upper', 2)} FROM logc")
def _log(spark, d):
    """The upper end grows exponentially and is compared as a logarithm."""
    return tidy(FC.log_channel(prices(spark, d)).withColumn("log_upper", F.log("upper")), "entity", "forecast_date", "source", "horizon", "confidence", "lower", "point", "log_upper", digits=2)


SIGMA = f"v0 AS (SELECT *, ln(close / {X.prev('close')}) AS lr FROM s), v1 AS (SELECT *, CASE WHEN idx >= 60 THEN {X.roll('stddev_samp', 'lr', 60)} END AS sigma FROM v0)"


def drift_sql(src, source, fade, cap):
    pt = f"close * (1 + greatest(-{cap}, least({cap}, score * {fade} * horizon / 252.0)))"
    half = f"close * sigma * sqrt(horizon) * {z_sql('confidence')}"
    return f"(SELECT entity, date AS forecast_date, '{source}' AS source, horizon, confidence, {r4(f'greatest({pt} - {half}, close * 0.01)', 'lower')}, {r4(f'{pt} + {half}', 'upper')}, {r4(pt, 'point')} FROM {src}, hz, cf WHERE score IS NOT NULL AND sigma > 0)"


CHIP = f"""{SIGMA}, c0 AS (SELECT *, CASE WHEN close > open THEN volume ELSE -volume END AS nf, {X.roll('sum', 'volume', 20)} AS mb FROM v1),
 c1 AS (SELECT *, CASE WHEN {X.roll('count', 'nf', 60)} >= 60 AND {X.roll('stddev_samp', 'nf', 60)} > 0 THEN ({X.roll('avg', 'nf', 20)} - {X.roll('avg', 'nf', 60)}) / {X.roll('stddev_samp', 'nf', 60)} / 2 END AS z, CASE WHEN {X.prev('mb', 20)} > 0 THEN -(mb - {X.prev('mb', 20)}) / {X.prev('mb', 20)} / 0.1 END AS m FROM c0),
 c2 AS (SELECT *, CASE WHEN z IS NOT NULL THEN greatest(-1, least(1, z)) END AS fs, CASE WHEN m IS NOT NULL THEN greatest(-1, least(1, m)) END AS ms FROM c1),
 c3 AS (SELECT *, CASE WHEN fs IS NOT NULL AND ms IS NOT NULL THEN (fs * 0.7 + ms * 0.3) / (0.7 + 0.3) ELSE coalesce(fs, ms) END AS score FROM c2), chip AS {drift_sql('c3', 'chip', 0.35, 0.18)}"""


@query("flow_forecast", "J3", f"WITH {SERIES}, {GRID}, {CHIP} SELECT {FSEL} FROM chip")
def _chip(spark, d):
    p = FC.realized_volatility(prices(spark, d))
    p = p.withColumns({"net_flow": F.when(F.col("close") > F.col("open"), F.col("volume")).otherwise(-F.col("volume")), "margin_balance": F.expr(X.roll("sum", "volume", 20))})
    return out(FC.drift_forecast(FC.chip_score(p), "chip", "score", 0.35, 0.18))


FUND = f"""{SIGMA}, f0 AS (SELECT entity, coalesce(TRY_CAST(CASE WHEN create_time <> 'pending' THEN create_time END AS DATE), date + 11) AS known, avg(yoy / 100) OVER ({X.OVER} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS score, date AS period FROM ind WHERE yoy IS NOT NULL AND revenue > 0),
 f1 AS (SELECT v.*, f.score FROM v1 v ASOF LEFT JOIN f0 f ON f.entity = v.entity AND v.date >= f.known), fund AS {drift_sql('f1', 'fundamental', 0.3, 0.2)}"""


@query("fundamental_forecast", "J4", f"WITH {SERIES}, {GRID}, {YOY_SQL}, {FUND} SELECT {FSEL} FROM fund")
def _fundamental(spark, d):
    g = FC.fundamental_score(A.period_growth(V.period_revenue(spark, d)))
    g = g.select("entity", F.coalesce(report_date(), F.date_add("date", 11)).alias("date"), "score")
    p = FC.realized_volatility(prices(spark, d)).select("entity", F.col("date").alias("asof"), "px", "c", "sigma")
    return out(FC.drift_forecast(asof_join(p, g, ["score"]).withColumnRenamed("asof", "date"), "fundamental", "score", 0.3, 0.2))


MACRO = f"""{SIGMA}, x0 AS (SELECT date, sum(volume) * 1.0 AS rate FROM s GROUP BY date), x1 AS (SELECT date, lag(rate, 21) OVER (ORDER BY date) AS was, rate FROM x0), x2 AS (SELECT date, CASE WHEN was > 0 THEN greatest(-1.0, least(1.0, (rate - was) / was / 0.02)) END AS fx FROM x1),
 y0 AS (SELECT date, CAST(sum(revenue) % 5 AS INTEGER) - 2 AS color_score FROM period_revenue GROUP BY date), y1 AS (SELECT x2.date, x2.fx, y0.color_score / 2.0 AS cy FROM x2 ASOF LEFT JOIN y0 ON x2.date >= y0.date),
 y2 AS (SELECT date + 1 AS date, CASE WHEN fx IS NULL AND cy IS NULL THEN NULL ELSE (coalesce(fx, 0) + coalesce(cy, 0)) / ((CASE WHEN fx IS NULL THEN 0 ELSE 1 END) + (CASE WHEN cy IS NULL THEN 0 ELSE 1 END)) END AS score FROM y1),
 y3 AS (SELECT v.*, y2.score FROM v1 v ASOF LEFT JOIN y2 ON v.date >= y2.date), macro AS {drift_sql('y3', 'macro', 0.4, 0.15)}"""


def market_scores(spark, d, days):
    """Market-wide score (date, score) known on each day of ``days``."""
    market = F.lit("_market_").alias("entity")
    li = V.table(spark, d, "lineitem")
    rates = li.groupBy(F.to_date("l_shipdate").alias("date")).agg(F.sum("l_quantity").alias("rate")).select(market, "date", "rate")
    cycle = V.period_revenue(spark, d).groupBy("date").agg((F.sum("revenue") % 5 - 2).alias("color_score")).select(market, "date", "color_score")
    asks = days.select(market, F.col("date").alias("asof")).distinct()
    return asof_join(asks, FC.macro_score(rates, cycle), ["score"]).select(F.col("asof").alias("date"), "score")


@query("macro_forecast", "J5", f"WITH {SERIES}, {GRID}, {REVENUE}, {MACRO} SELECT {FSEL} FROM macro")
def _macro(spark, d):
    days = FC.realized_volatility(prices(spark, d))
    return out(FC.drift_forecast(days.join(market_scores(spark, d, days), "date"), "macro", "score", 0.4, 0.15))


#: The filter as a fold over each look-back's closes; the state travels in the elements.
TREND = f"""k0 AS MATERIALIZED (SELECT entity, date, idx, {X.roll('list', 'close', 504)} AS l FROM s),
 k1 AS (SELECT entity, date, l, l[1] AS f, list_avg(l) AS m FROM k0 WHERE idx >= 29),
 k2 AS (SELECT *, greatest((0.01::DOUBLE * m) ** 2, 1e-9) AS r, greatest((0.005::DOUBLE * m) ** 2, 1e-9) AS ql, greatest((0.0005::DOUBLE * m) ** 2, 1e-11) AS qs FROM k1),
 k3 AS (SELECT *, list_reduce(list_prepend({{'v': f, 'lv': f, 'sl': 0.0::DOUBLE, 'a': greatest(abs(f) * 0.1::DOUBLE, 1.0::DOUBLE), 'b': 0.0::DOUBLE, 'c': greatest(abs(f) * 0.01::DOUBLE, 0.01::DOUBLE)}},
     list_transform(l[2:], lambda v: {{'v': v, 'lv': 0.0::DOUBLE, 'sl': 0.0::DOUBLE, 'a': 0.0::DOUBLE, 'b': 0.0::DOUBLE, 'c': 0.0::DOUBLE}})),
   lambda p, x: {{'v': x.v, 'lv': p.lv + p.sl + (p.a + 2 * p.b + p.c + ql) / (p.a + 2 * p.b + p.c + ql + r) * (x.v - (p.lv + p.sl)), 'sl': p.sl + (p.b + p.c) / (p.a + 2 * p.b + p.c + ql + r) * (x.v - (p.lv + p.sl)),
     'a': (1 - (p.a + 2 * p.b + p.c + ql) / (p.a + 2 * p.b + p.c + ql + r)) * (p.a + 2 * p.b + p.c + ql), 'b': (1 - (p.a + 2 * p.b + p.c + ql) / (p.a + 2 * p.b + p.c + ql + r)) * (p.b + p.c),
     'c': p.c + qs - (p.b + p.c) / (p.a + 2 * p.b + p.c + ql + r) * (p.b + p.c)}}) AS z FROM k2),
 k4 AS (SELECT entity, date, horizon, greatest(1.0, floor(horizon * 5.0::DOUBLE / 7.0::DOUBLE + 0.5)) AS n, z, ql, qs FROM k3, hz),
 k5 AS (SELECT entity, date, horizon, z.lv + n * z.sl AS mean, sqrt(greatest(z.a + 2 * n * z.b + n * n * z.c + n * ql + qs * ((n - 1) * n * (2 * n - 1)) / 6.0::DOUBLE, 1e-12)) AS sd FROM k4),
 trend AS (SELECT entity, date AS forecast_date, 'trend_filter' AS source, horizon, confidence, {r4("mean - {z} * sd", 'lower')}, {r4("mean + {z} * sd", 'upper')}, {r4('mean', 'point')} FROM k5, cf)""".replace("{z}", z_sql("confidence"))


@query("trend_filter_forecast", "J6", f"WITH {SERIES}, {GRID}, {TREND} SELECT {FSEL} FROM trend")
def _trend(spark, d):
    return out(FC.trend_filter(prices(spark, d)))


#: Forecasts are settled as of the last bar of the table.
ASOF_SQL = "(SELECT max(date) FROM bars)"


def last_day(bars) -> str:
    return str(bars.agg(F.max("date")).first()[0])


REAL = f"""fc AS (SELECT * FROM base UNION ALL SELECT * FROM chip), due AS (SELECT *, forecast_date + horizon AS resolved_date FROM fc WHERE forecast_date + horizon <= {ASOF_SQL}),
 r0 AS (SELECT due.*, b.date AS bdate, floor(b.close * 10000 + 0.5) / 10000 AS realized FROM due ASOF LEFT JOIN bars b ON b.entity = due.entity AND due.resolved_date >= b.date),
 settled AS (SELECT *, realized >= lower AND realized <= upper AS hit, ((CASE WHEN realized >= lower THEN (1 - confidence) / 2 * (realized - lower) ELSE ((1 - confidence) / 2 - 1) * (realized - lower) END)
   + (CASE WHEN realized >= upper THEN (1 - (1 - confidence) / 2) * (realized - upper) ELSE ((1 - (1 - confidence) / 2) - 1) * (realized - upper) END)) / 2 AS pinball FROM r0 WHERE resolved_date - bdate <= 21)"""
SETTLED_SQL = f"{BASE_SQL}, {CHIP}, {REAL}"


SOURCES = ("baseline", "chip")


def issued(spark, d, monthly=False, realized=False):
    """Bars with the baseline and flow forecasts of each as cells ``baseline_<i>`` and ``chip_<i>``, at every bar or at month ends.

    A bar's forecasts stay in its row, so series are shuffled once and forecasts never.
    """
    b = V.bars(spark, d)
    p = arranged(b)
    if realized:
        p = FC.realized_inputs(p, last_day(b))
    p = FC.unadjusted(indexed(p))
    p = FC.month_ends(p) if monthly else FC.every_bar(p)
    q = FC.realized_volatility(p)
    q = q.withColumns({"net_flow": F.when(F.col("close") > F.col("open"), F.col("volume")).otherwise(-F.col("volume")), "margin_balance": F.expr(X.roll("sum", "volume", 20))})
    keep = [f"realized_{h}" for h in FC.HORIZONS] if realized else []
    q = FC.baseline_inputs(FC.chip_score(q).select("entity", "date", "px", "c", "is_due", "sigma", "score", *keep), in_order=True)
    q = FC.drift_inputs(q, "score", 0.35, 0.18)
    return q.withColumns({f"{s}_{i}": c for s, cells in zip(SOURCES, (FC.baseline_cells(), FC.drift_cells("chip"))) for i, c in enumerate(cells)})


def cells(source) -> list:
    return [F.col(f"{source}_{i}") for i in range(len(FC.HORIZONS) * len(FC.CONFIDENCES))]


def both() -> list:
    return [c for s in SOURCES for c in cells(s)]


def settled(spark, d):
    return FC.settle_issued(FC.unpack(issued(spark, d, realized=True), both(), *[f"realized_{h}" for h in FC.HORIZONS]))


def calibrated(spark, d, monthly=False, strict=True):
    return out(FC.conformal_issued(issued(spark, d, monthly, realized=True), both(), strict=strict), "q", "n_past")


@query("settled_forecasts", "J11,M7,I11,J14", f"WITH {SETTLED_SQL} SELECT entity, forecast_date, source, horizon, confidence, resolved_date, realized, hit, {rnd('pinball', digits=3)} FROM settled")
def _settled(spark, d):
    return tidy(settled(spark, d), "entity", "forecast_date", "source", "horizon", "confidence", "resolved_date", "realized", "hit", "pinball", digits=3)


@query("pending_forecasts", "J14", f"WITH {BASE_SQL} SELECT entity, forecast_date, source, horizon, confidence FROM base WHERE forecast_date + horizon > {ASOF_SQL}")
def _pending(spark, d):
    f = FC.baseline(prices(spark, d))
    return f.filter(F.expr("date_add(forecast_date, horizon)") > last_day(V.bars(spark, d))).select("entity", "forecast_date", "source", "horizon", "confidence")


@query("forecast_scores", "D11", f"""WITH {SETTLED_SQL} SELECT source, horizon, confidence, count(*) AS n, {rnd('avg(pinball)', 'mean_pinball')}, {rnd('avg(upper - lower)', 'sharpness')}, {rnd('avg(CAST(hit AS INTEGER))', 'coverage', 6)} FROM settled
 GROUP BY GROUPING SETS ((source), (source, horizon), (source, confidence))""")
def _scores(spark, d):
    s = FC.score(settled(spark, d), [["source"], ["source", "horizon"], ["source", "confidence"]])
    cols = ["source", "horizon", "confidence", "n"]
    return s.select(*cols, *[(F.floor(F.col(c) * k + 0.50001) / k).alias(c) for c, k in (("mean_pinball", 1e4), ("sharpness", 1e4), ("coverage", 1e6))])


CQR = f"""sc AS (SELECT *, greatest(lower - realized, realized - upper) AS e FROM settled)"""


def cqr_sql(cond: str) -> str:
    monthly = SETTLED_SQL.replace("fc AS (SELECT * FROM base UNION ALL SELECT * FROM chip)", f"me AS (SELECT entity, date AS forecast_date FROM (SELECT entity, date, {MONTH_END} AS last FROM s) WHERE last), fc AS (SELECT f.* FROM (SELECT * FROM base UNION ALL SELECT * FROM chip) f SEMI JOIN me USING (entity, forecast_date))")
    return f"""WITH {monthly}, {CQR}, p0 AS (SELECT f.entity, f.forecast_date, f.source, f.horizon, f.confidence, f.lower, f.upper, f.point, list_sort(list(s.e)) AS l FROM fc f JOIN sc s ON s.entity = f.entity AND s.source = f.source AND s.horizon = f.horizon AND s.confidence = f.confidence AND {cond} GROUP BY ALL),
 p1 AS (SELECT *, len(l) AS n, CAST(ceil((len(l) + 1) * confidence - 1e-9) AS INTEGER) AS k FROM p0 WHERE len(l) >= 30)
 SELECT entity, forecast_date, source || '_cqr' AS source, horizon, confidence, {rnd('lower - l[k]', 'lower', 3)}, {rnd('upper + l[k]', 'upper', 3)}, {rnd('point', digits=3)}, {rnd('l[k]', 'q', 3)}, CAST(n AS INTEGER) AS n_past FROM p1 WHERE k <= n"""


@query("conformal_calibration", "J10", cqr_sql("s.resolved_date <= f.forecast_date"))
def _conformal(spark, d):
    """For readers of one forecast a month."""
    return calibrated(spark, d, monthly=True)


@query("conformal_calibration_by_issue", "J10", cqr_sql("s.forecast_date < f.forecast_date"))
def _conformal_parity(spark, d):
    return calibrated(spark, d, monthly=True, strict=False)


@query("conformal_calibration_daily", "J10", None)
def _conformal_daily(spark, d):
    """Forecasts of every bar, calibrated by all that resolved before; the SQL takes minutes, see the tests."""
    return calibrated(spark, d)


GATE = """days AS (SELECT DISTINCT source, horizon, confidence, CAST(date_trunc('year', resolved_date) AS DATE) + 180 AS day FROM settled), pd AS (SELECT source, horizon, confidence, forecast_date, resolved_date, sum(pinball) AS s, count(*) AS n FROM settled GROUP BY ALL),
 ro AS (SELECT source, horizon, confidence, resolved_date, sum(s) OVER w / sum(n) OVER w AS mp, sum(n) OVER w AS n FROM pd WINDOW w AS (PARTITION BY source, horizon, confidence ORDER BY forecast_date ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)),
 ls AS (SELECT d.day AS "asof", d.source, d.horizon, d.confidence, r.mp FROM days d ASOF JOIN ro r ON r.source = d.source AND r.horizon = d.horizon AND r.confidence = d.confidence AND d.day >= r.resolved_date WHERE r.n >= 30)"""


@query("eligible_sources", "J9", f"""WITH {SETTLED_SQL}, {GATE} SELECT a.asof AS "asof", a.source, a.horizon, a.confidence, {rnd('a.mp', 'mean_pinball', 3)}, {rnd('b.mp', 'reference_pinball', 3)} FROM ls a JOIN ls b ON b.asof = a.asof AND b.horizon = a.horizon AND b.confidence = a.confidence AND b.source = 'baseline' WHERE a.source <> 'baseline' AND a.mp < b.mp""")
def _eligible(spark, d):
    per = cut(FC.daily_losses(settled(spark, d)))
    days = per.select(*FC.CELL, F.date_add(F.trunc("resolved_date", "year"), 180).alias("asof")).distinct()
    return tidy(FC.eligible_sources(FC.recent_loss(per, days)), "asof", "source", "horizon", "confidence", "mean_pinball", "reference_pinball", digits=3)


@query("interval_fusion", "J8,H5", f"""WITH {BASE_SQL}, {CHIP}, fc AS (SELECT * FROM base UNION ALL SELECT * FROM chip), g AS (SELECT entity, forecast_date, horizon, confidence, max(lower) AS lo, min(upper) AS hi, avg((lower + upper) / 2) AS c, max((upper - lower) / 2) + coalesce(stddev_samp((lower + upper) / 2), 0) AS h, count(*) AS n_sources FROM fc GROUP BY 1, 2, 3, 4)
 SELECT entity, forecast_date, 'fusion' AS source, horizon, confidence, {rnd('CASE WHEN hi >= lo THEN lo ELSE c - h END', 'lower', 3)}, {rnd('CASE WHEN hi >= lo THEN hi ELSE c + h END', 'upper', 3)}, {rnd('CASE WHEN hi >= lo THEN (lo + hi) / 2 ELSE c END', 'point', 2)}, n_sources, hi >= lo AS intersects FROM g""")
def _fusion(spark, d):
    f = FC.fuse_cells(issued(spark, d), [cells(s) for s in SOURCES])
    return tidy(f.select(*[c for c in FCOLS if c not in ("lower", "upper", "point")], *[(F.floor(F.col(c) * k + 0.50001) / k).alias(c) for c, k in (("lower", 1e3), ("upper", 1e3), ("point", 1e2))], "n_sources", "intersects"), digits=6)


@query("preferred_bands", "J15", f"""WITH {BASE_SQL}, {CHIP}, fc AS (SELECT *, 1 AS pr FROM chip UNION ALL SELECT *, 2 FROM base) SELECT entity, forecast_date, horizon, confidence, source, {rnds('lower upper point', 3)}, {rnd('CASE WHEN point > 0 THEN (upper - lower) / point END', 'width_ratio')} FROM fc QUALIFY row_number() OVER (PARTITION BY entity, forecast_date, horizon, confidence ORDER BY pr) = 1""")
def _bands(spark, d):
    bands = FC.pick_cells({s: cells(s) for s in SOURCES}, ["fusion_cqr", "chip_cqr", "chip", "baseline"])
    b = FC.with_width(FC.unpack(issued(spark, d), bands))
    return b.select("entity", "forecast_date", "horizon", "confidence", "source", *[(F.floor(F.col(c) * k + 0.50001) / k).alias(c) for c, k in (("lower", 1e3), ("upper", 1e3), ("point", 1e3), ("width_ratio", 1e4))])


@query("manual_forecasts", "J13,A6", f"WITH {BASE_SQL} SELECT entity, forecast_date, 'manual' AS source, horizon, confidence, {rnds('lower upper point', 3)} FROM (SELECT * REPLACE (lower * 0.9 AS lower, upper * 1.1 AS upper) FROM base) WHERE lower < upper")
def _manual(spark, d):
    f = FC.baseline(prices(spark, d)).withColumns({"lower": F.col("lower") * 0.9, "upper": F.col("upper") * 1.1}).filter("lower < upper")
    return out(FC.manual_rows(f))


@query("normal_quantiles", "I1", f"SELECT DISTINCT l_quantity, {rnd(z_sql('((l_quantity - 0.5) / 50.5)'), 'z', 8)} FROM lineitem")
def _z(spark, d):
    q = V.table(spark, d, "lineitem").select("l_quantity").distinct()
    return tidy(q.withColumn("z", K.two_sided_z((F.col("l_quantity") - 0.5) / 50.5)), digits=8)


_SIX = f"{SERIES}, {GRID}, {BASE}, {LOGC}, {CHIP}, {YOY_SQL}, {FUND.replace(SIGMA + ', ', '')}, {MACRO.replace(SIGMA + ', ', '')}"


def series_with_scores(spark, d):
    """Bars as slices need them: prices, flows and the scores published by each day."""
    bars = V.bars(spark, d)
    rows = FC.unadjusted(indexed(bars)).select("entity", "date", "px", "c", F.when(F.col("close") > F.col("open"), F.col("volume")).otherwise(-F.col("volume")).alias("net_flow"), F.expr(X.roll("sum", "volume", 20)).alias("margin_balance"))
    g = FC.fundamental_score(A.period_growth(V.period_revenue(spark, d)))
    g = g.select("entity", F.coalesce(report_date(), F.date_add("date", 11)).alias("date"), F.col("score").alias("fundamental_score"))
    rows = asof_join(rows.withColumnRenamed("date", "asof"), g, ["fundamental_score"]).drop("matched").withColumnRenamed("asof", "date")
    return rows.join(market_scores(spark, d, rows), "date").withColumnRenamed("score", "macro_score")


@query("walk_forward_backtest", "J12", f"""WITH {_SIX}, {TREND}, fc AS (SELECT * FROM base UNION ALL SELECT * FROM logc UNION ALL SELECT * FROM chip UNION ALL SELECT * FROM fund UNION ALL SELECT * FROM macro UNION ALL SELECT * FROM trend), {REAL[REAL.index("due AS"):]}
 SELECT source, horizon, confidence, count(*) AS n, {rnd('ln(avg(pinball))', 'log_mean_pinball', 3)}, {rnd('avg(CAST(hit AS INTEGER))', 'coverage', 3)} FROM settled GROUP BY ALL""")
def _walk_forward(spark, d):
    """All six forecasters at every trading day, each handed only what was known by then; settled and scored.

    The mean loss is given as a logarithm, as the log channel's bands grow exponentially.
    """
    reads = ["px", "c", "net_flow", "margin_balance", "fundamental_score", "macro_score"]
    rows = arranged(FC.every_bar(series_with_scores(spark, d)).select("entity", "date", "is_due", *reads))
    rows = FC.realized_inputs(rows.withColumn("close", F.col("px")), last_day(V.bars(spark, d))).drop("close")
    s = FC.settle_issued(BT.issue_lots(rows, reads))
    g = s.groupBy("source", "horizon", "confidence").agg(F.count("*").alias("n"), F.log(F.avg("pinball")).alias("log_mean_pinball"), F.avg(F.col("hit").cast("int")).alias("coverage"))
    return tidy(g, "source", "horizon", "confidence", "n", "log_mean_pinball", "coverage", digits=3)
