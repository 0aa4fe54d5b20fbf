"""Evidence fusion and audit queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from tidemark.functions import texts as X
from tidemark.functions.events import detect, pivots
from tidemark.functions.windows import trailing
from tidemark.operators import aggregates as A
from tidemark.operators import detection as D
from tidemark.operators import forecast as FC
from tidemark.operators import fusion as FU
from tidemark.operators import indicators as I
from tidemark.operators import joins as J
from tidemark.operators import ranking as RK
from tidemark.operators import recursive as R
from tidemark.operators import snapshots as SN
from tidemark.operators import waves as WV
from tidemark.operators.pit import asof_join
from tidemark.plans import events as E
from tidemark.plans import indicators as P
from tidemark.plans import waves as PW
from tidemark.plans.ctes import FACTS, SERIES
from tidemark.plans.pit import REQUESTS, quarter_requests
from tidemark.functions.signs import FALL, RISE
from tidemark.plans.registry import ORACLES, QUERIES, query, rnd, rnds, tidy
from tidemark.session import cut
from tidemark.sources import views as V

WEEKS = "requests AS (SELECT DISTINCT f.entity, CAST(date_trunc('week', f.fact_date) AS DATE) + 6 AS asof FROM facts f)"
SIGN = "CASE event_kind WHEN 'GoldenCross' THEN 1 WHEN 'DeathCross' THEN -1 ELSE 0 END"
DIMS = {"click": "technical", "view": "chip", "purchase": "fundamental", "error": "valuation"}
COMPONENTS = {"click": "index", "view": "sentiment", "purchase": "business", "error": "margin", "signup": "commodity"}


def week_requests(facts):
    return facts.select("entity", F.date_add(F.to_date(F.date_trunc("week", "fact_date")), 6).alias("asof")).distinct()


def _case(m, col="source"):
    return f"CASE {col} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in m.items()) + " END"


HEALTH = f"""{FACTS}, {WEEKS}, sg AS (SELECT entity, {_case(DIMS)} AS dim, fact_date, {SIGN} AS s FROM facts),
 dd AS (SELECT r.entity, r.asof AS "asof", dim, CAST(trunc(greatest(-100, least(100, sum(s * CAST(floor(20.0::DOUBLE * exp(-(r.asof - fact_date) / 14.0::DOUBLE) * 1e9::DOUBLE + 0.5::DOUBLE) AS BIGINT)) / 1e9::DOUBLE))) AS INTEGER) AS score FROM requests r JOIN sg ON sg.entity = r.entity AND fact_date <= r.asof AND fact_date >= r.asof - 90 WHERE dim IS NOT NULL GROUP BY 1, 2, 3)"""


@query("entity_health", "K7,I2,I10", f"""WITH {HEALTH}, w AS (SELECT entity, "asof", {', '.join(f"coalesce(max(CASE WHEN dim = '{k}' THEN score END), 0) AS {k}" for k in FU.DIMENSION_WEIGHTS)} FROM dd GROUP BY 1, 2)
 SELECT entity, "asof", {', '.join(FU.DIMENSION_WEIGHTS)}, {rnd(' + '.join(f'{k} * {w}::DOUBLE' for k, w in FU.DIMENSION_WEIGHTS.items()), 'overall')} FROM w""")
def _health(spark, d):
    f = V.facts(spark, d)
    h = FU.health(week_requests(f), FU.daily_signs(f, {"GoldenCross": 1, "DeathCross": -1}), DIMS)
    return tidy(h, "entity", "asof", *FU.DIMENSION_WEIGHTS, "overall")


@query("top_signals", "G17", f"""WITH {FACTS}, {WEEKS} SELECT r.entity, r.asof AS "asof", f.event_id, {rnd(f'abs({SIGN}) * exp(-(r.asof - fact_date) / 14.0::DOUBLE)', 'weight')}, CAST(row_number() OVER (PARTITION BY r.entity, r.asof ORDER BY abs({SIGN}) * exp(-(r.asof - fact_date) / 14.0::DOUBLE) DESC, event_id) AS INTEGER) AS signal_rank
 FROM requests r JOIN facts f ON f.entity = r.entity AND f.fact_date <= r.asof AND f.fact_date >= r.asof - 30 QUALIFY signal_rank <= 5""")
def _signals(spark, d):
    f = V.facts(spark, d).withColumn("sign", FU.kind_sign("event_kind", {"GoldenCross": 1, "DeathCross": -1}))
    return tidy(RK.top_signals(week_requests(f), f.select("entity", "fact_date", "event_id", "sign")), "entity", "asof", "event_id", "weight", "signal_rank")


@query("market_climate", "K8,D15", f"""WITH {FACTS}, days AS (SELECT DISTINCT CAST(date_trunc('week', fact_date) AS DATE) + 6 AS asof FROM facts), c0 AS (SELECT d.asof AS "asof", {_case(COMPONENTS)} AS comp, CAST(trunc(greatest(-100, least(100, sum({SIGN} * CAST(floor(25.0::DOUBLE * exp(-(d.asof - fact_date) / 14.0::DOUBLE) * 1e9::DOUBLE + 0.5::DOUBLE) AS BIGINT)) / 1e9::DOUBLE))) AS INTEGER) AS score FROM facts JOIN days d ON fact_date <= d.asof AND fact_date >= d.asof - 60 GROUP BY 1, 2)
 SELECT "asof", {rnd('sum(score * CASE comp ' + ' '.join(f"WHEN '{k}' THEN {w}::DOUBLE" for k, w in FU.CLIMATE_WEIGHTS.items()) + ' END)', 'climate_score')}, count(*) AS components FROM c0 WHERE comp IS NOT NULL GROUP BY 1""")
def _climate(spark, d):
    f = V.facts(spark, d)
    days = f.select(F.date_add(F.to_date(F.date_trunc("week", "fact_date")), 6).alias("asof")).distinct()
    c = FU.climate(days, FU.daily_signs(f, {"GoldenCross": 1, "DeathCross": -1}), COMPONENTS)
    return tidy(c, "asof", "climate_score", "components")


ALERTS = E.ALERT_SQL + """, al AS (SELECT entity, date, 'announced' AS k, period_end FROM n UNION ALL SELECT entity, period_start, 'entered', period_end FROM n WHERE period_start <> date UNION ALL SELECT entity, date, 'escalation', period_end FROM n WHERE c >= 2 AND i >= 2),
 days AS (SELECT DISTINCT CAST(date_trunc('month', l_shipdate) AS DATE) AS asof FROM lineitem)"""


def alert_facts(spark, d):
    a = E.alerts(spark, d)
    ev = D.risk_alert_events(a)
    ends = a.select("entity", "date", "period_start", "period_end")
    ann = ev.filter("event_kind in ('announced', 'escalation')").join(ends.select("entity", "date", "period_end"), ["entity", "date"])
    ent = ends.filter("period_start <> date").select("entity", F.col("period_start").alias("date"), F.lit("entered").alias("event_kind"), F.lit(0.0).alias("value"), "period_end")
    return ann.unionByName(ent)


@query("alert_market_summary", "D10,K8", f"""WITH {ALERTS}, j AS (SELECT d.asof AS "asof", al.* FROM days d JOIN al ON al.date <= d.asof AND al.date >= d.asof - 60)
 SELECT "asof", count(DISTINCT CASE WHEN k = 'entered' AND period_end >= "asof" THEN entity END) AS active, count(DISTINCT CASE WHEN k = 'announced' AND date >= "asof" - 14 THEN entity END) AS announced_14d, count(CASE WHEN k = 'escalation' THEN 1 END) AS escalations FROM j GROUP BY 1""")
def _alert_summary(spark, d):
    days = V.table(spark, d, "lineitem").select(F.trunc("l_shipdate", "month").alias("asof")).distinct()
    return FU.alert_summary(days, alert_facts(spark, d)).select("asof", "active", "announced_14d", "escalations")


@query("market_events_by_severity", "K9", f"WITH {FACTS} SELECT fact_date, severity, count(*) AS n, count(DISTINCT source) AS sources FROM facts GROUP BY 1, 2")
def _severity(spark, d):
    return FU.events_by_severity(V.facts(spark, d))


@query("market_dashboard", "K9,K2", f"WITH {FACTS}, s AS (SELECT source, fact_date AS date, CAST(sum({SIGN}) AS BIGINT) AS net, count(*) AS n FROM facts GROUP BY 1, 2) SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY source ORDER BY date DESC) = 1")
def _dashboard(spark, d):
    f = V.facts(spark, d).withColumn("entity", F.lit("_market_"))
    return FU.dashboard(FU.daily_signs(f, {"GoldenCross": 1, "DeathCross": -1})).select("source", "date", "net", "n")


EV = f"ev AS (SELECT entity, date, 'macd_golden_cross' AS event_kind FROM ind WHERE (macd > signal) AND NOT ({X.prev('macd > signal')}))"


@query("event_rate_audit", "D13", f"""WITH {SERIES}, e AS (SELECT entity, date, CASE WHEN volume >= 40 THEN 'high_volume' ELSE 'low_volume' END AS event_kind FROM s WHERE volume >= 40 OR volume <= 5), p AS (SELECT event_kind, entity, count(*) AS n, min(date) AS a, max(date) AS b FROM e GROUP BY 1, 2),
 g AS (SELECT event_kind, CAST(sum(n) AS BIGINT) AS n_events, count(*) AS n_entities, (max(b) - min(a) + 1) / 365.25::DOUBLE AS y FROM p GROUP BY 1) SELECT event_kind, n_events, n_entities, {rnd('n_events / n_entities / y', 'per_entity_year')}, n_events / n_entities / y <= 12 AS within_limit FROM g""")
def _rates(spark, d):
    b = V.bars(spark, d).filter("volume >= 40 or volume <= 5")
    e = b.select("entity", "date", F.when(F.col("volume") >= 40, "high_volume").otherwise("low_volume").alias("event_kind"))
    return tidy(FU.event_rates(e))


@query("regime_agreement", "D16,K12", f"""WITH {P.REGIME_SQL}, n AS (SELECT entity, date, regime, count(*) AS n FROM c GROUP BY 1, 2, 3) SELECT entity, date, arg_max(regime, (n, regime)) AS majority, max(n) AS support, count(*) = 1 AS all_aligned FROM n GROUP BY 1, 2""")
def _agreement(spark, d):
    return FU.regime_agreement(R.regimes(R.kalman(V.bars(spark, d))))


@query("trend_deviation", "K12", f"WITH {P.KALMAN_SQL} SELECT entity, date, horizon, {rnd('(close - x) / greatest(sqrt(p), x * 0.01)', 'deviation', 3)} FROM k")
def _deviation(spark, d):
    return tidy(FU.trend_view(R.kalman(V.bars(spark, d))), "entity", "date", "horizon", "deviation", digits=3)


@query("indicator_assembly", "K10", f"""WITH {P.RSI_SQL}, w AS (SELECT entity, date, CASE WHEN idx >= 13 AND {X.roll('max', 'high', 14)} > {X.roll('min', 'low', 14)} THEN ({X.roll('max', 'high', 14)} - close) / ({X.roll('max', 'high', 14)} - {X.roll('min', 'low', 14)}) * -100 ELSE 0 END AS v FROM s),
 a AS (SELECT entity, date, 'rsi' AS indicator, rsi AS value FROM ind UNION ALL SELECT entity, date, 'williams_r', v FROM w) SELECT entity, date, indicator, {rnd('value')} FROM a QUALIFY row_number() OVER (PARTITION BY entity, indicator ORDER BY date DESC) <= 30""")
def _assembly(spark, d):
    b = V.bars(spark, d)
    r = R.rsi(b).select("entity", "date", F.lit("rsi").alias("indicator"), F.col("rsi").alias("value"))
    w = I.williams_r(b).select("entity", "date", F.lit("williams_r").alias("indicator"), F.col("williams_r").alias("value"))
    return tidy(FU.last_values(r.unionByName(w), 30))


@query("asof_snapshot", "K1,K11", f"""WITH {FACTS}, {WEEKS}, l AS (SELECT entity, fact_date AS date, avg(value) AS value FROM facts GROUP BY 1, 2)
 SELECT r.entity, r.asof AS "asof", 'facts' AS section, f.source AS item, max(fact_date) AS date, CAST(count(*) AS DOUBLE) AS value FROM requests r JOIN facts f ON f.entity = r.entity AND fact_date <= r.asof AND fact_date >= r.asof - 90 GROUP BY 1, 2, 3, 4
 UNION ALL SELECT r.entity, r.asof, 'mean_value', 'latest', l.date, {rnd('l.value', 'value')} FROM requests r ASOF LEFT JOIN l ON l.entity = r.entity AND r.asof >= l.date""")
def _snapshot(spark, d):
    f = V.facts(spark, d)
    latest = f.groupBy("entity", F.col("fact_date").alias("date")).agg(F.avg("value").alias("value"))
    return tidy(FU.snapshot(week_requests(f), f, {"mean_value": latest}))


@query("entity_window_summary", "K17", f"""WITH {SERIES}, {REQUESTS} SELECT r.entity, r.asof AS "asof", count(*) AS n_bars, CAST(sum(volume) AS BIGINT) AS volume, max(high) AS high, min(low) AS low FROM requests r JOIN s ON s.entity = r.entity AND s.date <= r.asof AND s.date >= r.asof - 30 GROUP BY 1, 2""")
def _summary(spark, d):
    return FU.window_summary(quarter_requests(spark, d), V.bars(spark, d), 30, [F.count("*").alias("n_bars"), F.sum("volume").alias("volume"), F.max("high").alias("high"), F.min("low").alias("low")])


# --- levels --------------------------------------------------------------------------------------------------
PIV = f"""{SERIES}, pv0 AS (SELECT entity, CASE WHEN {E.is_pivot_high('high')} THEN high END AS hi, CASE WHEN {E.is_pivot_low('low')} THEN low END AS lo FROM s),
 pts AS (SELECT entity, hi AS price, 'high' AS source FROM pv0 WHERE hi IS NOT NULL UNION ALL SELECT entity, lo, 'low' FROM pv0 WHERE lo IS NOT NULL),
 dp AS (SELECT entity, price, row_number() OVER (PARTITION BY entity ORDER BY price) AS i FROM (SELECT DISTINCT entity, price FROM pts WHERE price > 0)),
 an AS (WITH RECURSIVE a AS (SELECT entity, i, price, price AS anchor FROM dp WHERE i = 1 UNION ALL SELECT p.entity, p.i, p.price, CASE WHEN (p.price - a.anchor) / a.anchor < 0.01 THEN a.anchor ELSE p.price END FROM a JOIN dp p ON p.entity = a.entity AND p.i = a.i + 1) SELECT * FROM a),
 cl AS (SELECT pts.entity, anchor, avg(pts.price) AS level, min(pts.price) AS low, max(pts.price) AS high, count(DISTINCT source) AS strength, count(*) AS members FROM pts JOIN an ON an.entity = pts.entity AND an.price = pts.price GROUP BY 1, 2)"""


def pivot_points(spark, d):
    return pivots(I.indexed(V.bars(spark, d))).select("entity", "price", F.col("side").alias("source"))


@query("price_clusters", "K3", f"WITH {PIV} SELECT entity, {rnds('level low high', 3)}, CAST(strength AS INTEGER) AS strength, CAST(members AS INTEGER) AS members FROM cl")
def _clusters(spark, d):
    return tidy(FU.cluster_levels(pivot_points(spark, d)), digits=3)


TOPL = PIV + ", kl AS (SELECT * FROM cl QUALIFY row_number() OVER (PARTITION BY entity ORDER BY strength DESC, members DESC, level) <= 20)"


@query("key_levels", "K4", f"WITH {TOPL} SELECT entity, {rnds('level low high', 3)}, CAST(strength AS INTEGER) AS strength, CAST(members AS INTEGER) AS members FROM kl")
def _key_levels(spark, d):
    return tidy(FU.key_levels(pivot_points(spark, d)), digits=3)


EVERY = PIV + ", kl AS (SELECT * FROM cl)"
STOPS = f"""WITH {EVERY.replace(SERIES, P.ATR_SQL)}, en AS (SELECT entity, date, close AS entry, atr FROM ind), x AS (SELECT en.*, dr.direction, CASE WHEN dr.direction = 'long' THEN 1.0::DOUBLE ELSE -1.0 END AS sd, (SELECT max(level) FROM kl WHERE kl.entity = en.entity AND level < entry) AS below, (SELECT min(level) FROM kl WHERE kl.entity = en.entity AND level > entry) AS above FROM en, (VALUES ('long'), ('short')) dr(direction))
 SELECT entity, date, direction, {rnd('entry - sd * 2 * atr', 'atr_stop', 2)}, {rnd('entry + sd * 4 * atr', 'atr_target', 2)}, {rnd("CASE WHEN direction = 'long' THEN below ELSE above END", 'level_stop', 2)}, {rnd("CASE WHEN direction = 'long' THEN above ELSE below END", 'level_target', 2)} FROM x"""


@query("stops_and_targets", "K5", STOPS)
def _stops(spark, d):
    b = V.bars(spark, d)
    e = R.atr(b).select("entity", "date", F.col("close").alias("entry"), "atr")
    return tidy(FU.stops_and_targets(e, FU.cluster_levels(pivot_points(spark, d))), "entity", "date", "direction", "atr_stop", "atr_target", "level_stop", "level_target", digits=2)


_CANDLES = E.rules_sql(SERIES + ", ind AS (SELECT * FROM s)", D.CANDLE_RULES, "ind", [D.CANDLE_STAGE_0, D.CANDLE_STAGES_1, D.CANDLE_STAGES_2])


@query("patterns_near_levels", "K6,C13", f"""WITH {EVERY}, pat AS ({_CANDLES}), ev AS (SELECT p.entity, p.date, p.event_kind, s.close AS price FROM pat p JOIN s ON s.entity = p.entity AND s.date = p.date), x AS (SELECT ev.*, (SELECT arg_min(level, (abs(level - price), level)) FROM kl WHERE kl.entity = ev.entity) AS level FROM ev)
 SELECT entity, date, event_kind, price, {rnd('level', digits=3)}, {rnd('abs(level - price)', 'distance', 3)}, abs(level - price) <= price * 0.02 AS is_near FROM x""")
def _near(spark, d):
    b = I.indexed(V.bars(spark, d))
    staged = D.staged(D.staged(D.staged(b, **D.CANDLE_STAGE_0), **D.CANDLE_STAGES_1), **D.CANDLE_STAGES_2)
    found = detect(staged, D.CANDLE_RULES).select("entity", "date", "event_kind")
    pts = found.join(b.select("entity", "date", F.col("close").alias("price")), ["entity", "date"])
    return tidy(J.nearest_level(pts, FU.cluster_levels(pivot_points(spark, d))), "entity", "date", "event_kind", "price", "level", "distance", "is_near", digits=3)


def fib_lines(spark, d):
    """Clustered fib lines of the primary scenario per (entity, asof), with the close of the day."""
    z = cut(WV.fib_zones(WV.primary_scenario(PW.live(spark, d).filter(~WV.is_invalidated()))).select("entity", "asof", "close", "zone_price"))
    c = FU.cluster_levels(z.select("entity", "asof", F.col("zone_price").alias("price"), F.lit("fib").alias("source")), keys=("entity", "asof"))
    return c.join(z.select("entity", "asof", "close").distinct(), ["entity", "asof"]).withColumnRenamed("level", "line")


LINES = f"""{PW.LIVE}, {PW._RT}, prm AS (SELECT * FROM lv WHERE NOT dead QUALIFY row_number() OVER (PARTITION BY entity, "asof" ORDER BY {PW._ORD}) = 1), zz AS (SELECT entity, "asof", close, {PW._ZP} AS price FROM prm, rt),
 zd AS (SELECT *, row_number() OVER (PARTITION BY entity, "asof" ORDER BY price) AS i FROM zz WHERE price > 0),
 za AS (WITH RECURSIVE a AS (SELECT entity, "asof", i, close, price, price AS anchor FROM zd WHERE i = 1 UNION ALL SELECT p.entity, p.asof, p.i, p.close, p.price, CASE WHEN (p.price - a.anchor) / a.anchor < 0.01 THEN a.anchor ELSE p.price END FROM a JOIN zd p ON p.entity = a.entity AND p.asof = a.asof AND p.i = a.i + 1) SELECT * FROM a),
 lines AS (SELECT entity, "asof", anchor, any_value(close) AS close, avg(price) AS line, min(price) AS low, max(price) AS high, count(*) AS members FROM za GROUP BY 1, 2, 3)"""


@query("fib_line_clusters", "K15", f"""WITH {LINES} SELECT entity, "asof", {rnds('line low high', 2)}, CAST(members AS INTEGER) AS members FROM lines""")
def _fib_lines(spark, d):
    return tidy(fib_lines(spark, d), "entity", "asof", "line", "low", "high", "members", digits=2)


from tidemark.plans import forecast as PF  # noqa: E402
from tidemark.plans import ranking as PR  # noqa: E402

_BANDS = ", ".join(f"max(CASE WHEN horizon = {h} THEN {c} END) AS {c}{h}" for h in FC.HORIZONS for c in ("lower", "upper", "point"))


def _cov(h):
    return f"coalesce((upper{h} - lower{h}) / close <= 3.0 AND lower{h} <= line AND line <= upper{h}, false)"


def _near_mid(h):
    return f"coalesce(abs(point{h} - line) / close < 0.02, false)"


def _profile(h):
    return f"CASE WHEN NOT {_cov(h)} THEN 'divergence' WHEN {_near_mid(h)} THEN 'basic_median_close' ELSE 'basic' END"


_TIGHT = "list_min(list_filter([" + ", ".join(f"CASE WHEN {_cov(h)} THEN {{'w': upper{h} - lower{h}, 'h': {h}}} END" for h in FC.HORIZONS) + "], lambda v: v IS NOT NULL))"


@query("dual_track_resonance", "K16", f"""WITH {LINES}, {PF.GRID}, {PF.BASE},
 bd AS (SELECT entity, forecast_date, {_BANDS} FROM base WHERE confidence = 0.8 GROUP BY 1, 2), lq AS (SELECT DISTINCT entity, "asof" FROM lines),
 la AS (SELECT q.entity, q.asof AS "asof", b.* EXCLUDE (entity) FROM lq q ASOF LEFT JOIN bd b ON b.entity = q.entity AND q.asof >= b.forecast_date), lb AS (SELECT * FROM la WHERE "asof" - forecast_date <= 45),
 {PR.UNIVERSE}, mq AS (SELECT entity, date, ({X.prev('close', 21)} - {X.prev('close', 251)}) / {X.prev('close', 251)} AS metric FROM s), mr AS (SELECT r.entity, r.asof AS "asof", m.metric FROM requests r ASOF LEFT JOIN mq m ON m.entity = r.entity AND r.asof >= m.date),
 mk AS (SELECT mr.entity, mr.asof AS "asof", row_number() OVER (PARTITION BY mr.asof ORDER BY metric DESC, mr.entity) <= 30 AS is_top FROM mr JOIN universe u ON u.entity = mr.entity WHERE u.excluded_reason IS NULL AND metric IS NOT NULL),
 rs AS (SELECT l.entity, l.asof AS "asof", l.line, l.close, lb.* EXCLUDE (entity, "asof", forecast_date), coalesce(mk.is_top, false) AS is_top_n FROM lines l LEFT JOIN lb ON lb.entity = l.entity AND lb.asof = l.asof LEFT JOIN mk ON mk.entity = l.entity AND mk.asof = l.asof),
 rt2 AS (SELECT *, {_cov(63)} AS covers, {_near_mid(63)} AS median_close FROM rs)
 SELECT entity, "asof", {rnds('line close', 2)}, CASE WHEN NOT covers THEN 'divergence' WHEN median_close AND is_top_n THEN 'strong' ELSE 'basic' END AS level, covers, median_close, is_top_n,
   CASE WHEN covers THEN {_TIGHT}['h'] END AS tightest_horizon, {', '.join(f'{_profile(h)} AS profile_{h}' for h in FC.HORIZONS)} FROM rt2""")
def _resonance(spark, d):
    from tidemark.plans.forecast import prices
    from tidemark.plans.ranking import universe

    lines = cut(fib_lines(spark, d).select("entity", "asof", "line", "close"))
    bands = FC.baseline(prices(spark, d), confidences=(0.8,))
    bands = bands.groupBy("entity", "forecast_date").agg(F.first("point").alias("p"), *[F.max(F.when(F.col("horizon") == h, F.struct("lower", "upper", "point"))).alias(f"h{h}") for h in FC.HORIZONS])
    at = asof_join(lines.select("entity", "asof").distinct(), bands.withColumnRenamed("forecast_date", "date"), [f"h{h}" for h in FC.HORIZONS], tolerance_days=45)
    long = at.select("entity", "asof", F.inline(F.array(*[F.struct(F.lit(h).alias("horizon"), F.col(f"h{h}.lower").alias("lower"), F.col(f"h{h}.upper").alias("upper"), F.col(f"h{h}.point").alias("point")) for h in FC.HORIZONS]))).filter("lower is not null")
    req = quarter_requests(spark, d)
    tops = RK.rank_table(RK.momentum_12_1(req, V.bars(spark, d)), universe(spark, d), "metric").select("entity", F.col("date").alias("asof"), "is_top_n")
    r = FU.resonance(lines, long, tops, too_wide=3.0)
    return tidy(r, "entity", "asof", "line", "close", "level", "covers", "median_close", "is_top_n", "tightest_horizon", "profile_21", "profile_63", "profile_126", digits=2)


@query("kind_signs", "I10,I9", f"""WITH {FACTS} SELECT DISTINCT source, event_kind, CASE WHEN contains(lower(event_kind), 'golden') THEN 1 WHEN contains(lower(event_kind), 'death') THEN -1 ELSE 0 END AS sign, count(*) AS n FROM facts GROUP BY ALL""")
def _signs(spark, d):
    f = V.facts(spark, d)
    return f.groupBy("source", "event_kind").agg(F.count("*").alias("n")).withColumn("sign", FU.kind_sign("event_kind", {"GoldenCross": 1, "DeathCross": -1}))


# The library's own events: each dimension reads catalogue queries.
CATALOGUE = {"technical": ("macd_events", "rsi_events"), "chip": ("margin_balance_events",), "fundamental": ("revenue_events",), "valuation": ("valuation_events",)}
_OWN = " UNION ALL ".join(f"SELECT entity, date, event_kind, '{dim}' AS dim FROM ({ORACLES[n]})" for dim, names in CATALOGUE.items() for n in names)
_OWN_SIGN = "CASE WHEN event_kind IN (" + ", ".join(f"'{k}'" for k in RISE) + ") THEN 1 WHEN event_kind IN (" + ", ".join(f"'{k}'" for k in FALL) + ") THEN -1 ELSE 0 END"


def own_facts(spark, d):
    """Events of the catalogue as facts (entity, fact_date, source, event_kind)."""
    parts = [QUERIES[n](spark, d).select("entity", F.col("date").alias("fact_date"), F.lit(dim).alias("source"), "event_kind") for dim, names in CATALOGUE.items() for n in names]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query("entity_health_catalogue", "K7,I10", f"""WITH ev AS MATERIALIZED (SELECT entity, date, dim, {_OWN_SIGN} AS s FROM ({_OWN})), req AS (SELECT DISTINCT entity, last_day(date) AS asof FROM ev),
 dd AS (SELECT r.entity, r.asof AS "asof", dim, CAST(trunc(greatest(-100, least(100, sum(s * CAST(floor(20.0::DOUBLE * exp(-(r.asof - date) / 14.0::DOUBLE) * 1e9::DOUBLE + 0.5::DOUBLE) AS BIGINT)) / 1e9::DOUBLE))) AS INTEGER) AS score, count(*) FILTER (WHERE s > 0) AS up, count(*) FILTER (WHERE s < 0) AS down
  FROM req r JOIN ev ON ev.entity = r.entity AND date <= r.asof AND date >= r.asof - 90 GROUP BY 1, 2, 3),
 tt AS (SELECT *, CASE WHEN up > down * 1.5 THEN 'bullish' WHEN down > up * 1.5 THEN 'bearish' WHEN up + down > 0 THEN 'mixed' ELSE 'quiet' END AS trend FROM dd),
 w AS (SELECT entity, "asof", {', '.join(f"coalesce(max(CASE WHEN dim = '{k}' THEN score END), 0) AS {k}, coalesce(max(CASE WHEN dim = '{k}' THEN trend END), 'quiet') AS {k}_trend" for k in FU.DIMENSION_WEIGHTS)} FROM tt GROUP BY 1, 2)
 SELECT *, {rnd(' + '.join(f'{k} * {w}::DOUBLE' for k, w in FU.DIMENSION_WEIGHTS.items()), 'overall')} FROM w""")
def _own_health(spark, d):
    f = cut(own_facts(spark, d))
    requests = f.select("entity", F.last_day("fact_date").alias("asof")).distinct()
    h = FU.health(requests, FU.daily_signs(f), {k: k for k in CATALOGUE})
    return tidy(h, "entity", "asof", *FU.DIMENSION_WEIGHTS, *[f"{k}_trend" for k in FU.DIMENSION_WEIGHTS], "overall")


# --- snapshot of all sections --------------------------------------------------------------------------------
#: The tables hold no market rows; the first users stand in for the reserved market entities.
RESERVED = {1: "index", 2: "foreign_market", 3: "sentiment", 4: "exchange_rate", 5: "business_cycle"}
_LATEST = f"""lt AS (SELECT entity, 'indicator' AS section, 'close' AS source, 'daily' AS timeframe, date, close AS value FROM s UNION ALL SELECT entity, 'indicator', 'mean_20', 'daily', date, {X.roll('avg', 'close', 20)} FROM s
  UNION ALL SELECT entity, 'indicator', 'close', 'weekly', CAST(date_trunc('week', date) AS DATE) + 6, arg_max(close, date) FROM s GROUP BY 1, 5 UNION ALL SELECT entity, 'indicator', 'close', 'monthly', last_day(date), arg_max(close, date) FROM s GROUP BY 1, 5
  UNION ALL SELECT entity, 'structure', 'pivot_high', 'daily', {X.nxt('date', 3)}, CASE WHEN {E.is_pivot_high('high')} THEN high END FROM s QUALIFY {E.is_pivot_high('high')}
  UNION ALL SELECT entity, 'structure', 'pivot_low', 'daily', {X.nxt('date', 3)}, CASE WHEN {E.is_pivot_low('low')} THEN low END FROM s QUALIFY {E.is_pivot_low('low')})"""


def latest_sections(spark, d):
    """Indicators of three timeframes and structures, dated by the day they became known."""
    b = V.bars(spark, d)
    df = I.indexed(b)
    row = lambda x, section, source, timeframe, date, value: x.select("entity", F.lit(section).alias("section"), F.lit(source).alias("source"), F.lit(timeframe).alias("timeframe"), date.alias("date"), value.alias("value"))
    day, pv = F.col("date"), pivots(df)
    week, month = A.period_bars(b, "week"), A.period_bars(b, "month")
    parts = [
        row(df, "indicator", "close", "daily", day, F.col("close")), row(df, "indicator", "mean_20", "daily", day, F.avg("close").over(trailing(20))),
        row(week, "indicator", "close", "weekly", F.date_add("period", 6), F.col("close")), row(month, "indicator", "close", "monthly", F.last_day("period"), F.col("close")),
        *[row(pv.where(F.col("side") == s), "structure", f"pivot_{s}", "daily", F.col("confirm_date"), F.col("price")) for s in ("high", "low")],
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query("asof_snapshot_sections", "K1,K2,K11", f"""WITH {SERIES}, {FACTS}, {REQUESTS.replace('requests AS', 'quarters AS')}, rq AS MATERIALIZED (SELECT entity, asof FROM quarters UNION SELECT entity, CAST(date_trunc('week', fact_date) AS DATE) + 6 FROM facts), {_LATEST},
 fx AS (SELECT entity, source, timeframe, fact_date, greatest(fact_date, coalesce(report_date, fact_date)) AS vis, CASE timeframe WHEN 'quarterly' THEN 180 ELSE 90 END AS lb FROM facts),
 fa AS (SELECT r.entity, r.asof, source, timeframe, max(fact_date) AS date, CAST(count(*) AS DOUBLE) AS value FROM rq r JOIN fx ON fx.entity = r.entity AND vis <= r.asof AND fact_date >= r.asof - lb GROUP BY ALL),
 ks AS (SELECT DISTINCT entity, section, source, timeframe FROM lt),
 rk AS (SELECT r.entity, r.asof, section, source, timeframe FROM rq r JOIN ks ON ks.entity = r.entity),
 la AS (SELECT k.entity, k.asof, k.section, k.source, k.timeframe, lt.date, lt.value FROM rk k ASOF JOIN lt ON lt.entity = k.entity AND lt.section = k.section AND lt.source = k.source AND lt.timeframe = k.timeframe AND k.asof >= lt.date),
 mk AS (SELECT a.asof, CASE m.entity {' '.join(f"WHEN {k} THEN '{v}'" for k, v in RESERVED.items())} END AS name, source, timeframe, max(fact_date) AS date, CAST(count(*) AS DOUBLE) AS value FROM (SELECT DISTINCT asof FROM rq) a JOIN fx m ON m.entity <= {max(RESERVED)} AND m.entity >= 1 AND vis <= a.asof AND fact_date >= a.asof - lb GROUP BY ALL)
 SELECT entity, asof AS "asof", 'facts' AS section, source, timeframe, date, value FROM fa UNION ALL SELECT entity, asof, section, source, timeframe, date, {rnd('value')} FROM la
 UNION ALL SELECT r.entity, r.asof, 'market:' || name, source, timeframe, date, value FROM rq r JOIN mk ON mk.asof = r.asof""")
def _sections(spark, d):
    """Facts, indicators, structures and market facts of every entity at its quarter ends and fact weeks."""
    f = V.facts(spark, d)
    requests = quarter_requests(spark, d).unionByName(week_requests(f)).distinct()
    return tidy(SN.sections_at(requests, f, latest_sections(spark, d), RESERVED))


# --- climate of the library's own market events ---------------------------------------------------------------
MARKET_EVENTS = {"market_index_events": "index", "cross_market_events": "foreign_market", "sentiment_events": "sentiment", "business_cycle_events": "business", "exchange_rate_events": "exchange_rate", "market_margin_events": "margin", "commodity_events": "commodity"}


def _labels_sql(score: str) -> str:
    return "CASE " + " ".join(f"WHEN {score} >= {limit} THEN '{name}'" for limit, name in FU.CLIMATE_LABELS) + " ELSE 'strong_bear' END"


@query("market_climate_catalogue", "K8,D15", f"""WITH {ALERTS}, ev AS MATERIALIZED ({' UNION ALL '.join(f"SELECT '{c}' AS comp, date, {_OWN_SIGN} AS s FROM ({ORACLES[n]})" for n, c in MARKET_EVENTS.items())}),
 dn AS (SELECT comp, date, sum(s) AS net FROM ev GROUP BY ALL),
 c0 AS (SELECT d.asof AS "asof", comp, CAST(trunc(greatest(-100, least(100, sum(net * CAST(floor(25.0::DOUBLE * exp(-(d.asof - date) / 14.0::DOUBLE) * 1e9::DOUBLE + 0.5::DOUBLE) AS BIGINT)) / 1e9::DOUBLE))) AS INTEGER) AS score FROM dn JOIN days d ON date <= d.asof AND date >= d.asof - 60 GROUP BY 1, 2),
 j AS (SELECT d.asof AS "asof", al.* FROM days d JOIN al ON al.date <= d.asof AND al.date >= d.asof - 60),
 a0 AS (SELECT "asof", count(DISTINCT CASE WHEN k = 'entered' AND period_end >= "asof" THEN entity END) AS active, count(DISTINCT CASE WHEN k = 'announced' AND date >= "asof" - 14 THEN entity END) AS ann, count(CASE WHEN k = 'escalation' THEN 1 END) AS esc FROM j GROUP BY 1),
 u AS (SELECT * FROM c0 UNION ALL SELECT "asof", 'risk_alert', greatest(-100, CASE WHEN active >= 10 THEN -100 WHEN active >= 5 THEN -50 WHEN active >= 1 THEN -15 ELSE 0 END + CASE WHEN esc >= 3 THEN -30 WHEN esc >= 1 THEN -15 ELSE 0 END + CASE WHEN ann >= 5 THEN -15 ELSE 0 END) FROM a0),
 g AS (SELECT "asof", sum(score * CASE comp {' '.join(f"WHEN '{k}' THEN {w}::DOUBLE" for k, w in FU.CLIMATE_WEIGHTS.items())} END) AS cs, count(*) AS components, max(CASE WHEN comp = 'risk_alert' THEN score END) AS risk_alert FROM u GROUP BY 1)
 SELECT "asof", {rnd('cs', 'climate_score')}, components, risk_alert, {_labels_sql('cs')} AS climate FROM g""")
def _own_climate(spark, d):
    """Seven event components and the alerts of each month start, with the label."""
    parts = [QUERIES[n](spark, d).select(F.lit("_market_").alias("entity"), F.col("date").alias("fact_date"), F.lit(c).alias("source"), "event_kind") for n, c in MARKET_EVENTS.items()]
    signs = FU.daily_signs(reduce(lambda a, b: a.unionByName(b), parts))
    days = V.table(spark, d, "lineitem").select(F.trunc("l_shipdate", "month").alias("asof")).distinct()
    return tidy(FU.climate(days, signs, {c: c for c in MARKET_EVENTS.values()}, alert_facts(spark, d)), "asof", "climate_score", "components", "risk_alert", "climate")
