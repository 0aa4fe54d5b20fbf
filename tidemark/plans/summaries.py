"""Queries of entity summaries at quarter ends, and of the screens over all entities."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import scalars as K
from tidemark.operators import aggregates as A
from tidemark.operators import recursive as R
from tidemark.operators import screens as SC
from tidemark.operators import summaries as SM
from tidemark.operators import waves as WV
from tidemark.plans import events as E
from tidemark.plans import indicators as P
from tidemark.plans import waves as PW
from tidemark.plans.pit import REQUESTS, quarter_requests
from tidemark.plans.ranking import nation_requests
from tidemark.plans.registry import ORACLES, QUERIES, query, rnd, rnds, tidy
from tidemark.sources import views as V

ASOF = "FROM requests r ASOF LEFT JOIN {t} m ON m.entity = r.entity AND r.asof >= m.date"


# --- one entity ----------------------------------------------------------------------------------------------
@query("collateral_summary", "K17", f"""WITH {E.LOAN_SQL}, requests AS (SELECT DISTINCT entity, CAST(date_trunc('quarter', date) AS DATE) + 89 AS asof FROM ind),
 a AS (SELECT r.entity AS e, r.asof AS d, m.* {ASOF.format(t='ind')}), p AS ({' UNION ALL '.join(f"SELECT e, d, date, total, dominant, dominant_ratio, '{c}' AS category, CASE WHEN date IS NOT NULL THEN coalesce({c}, 0) END AS balance, {c}_change AS change_pct FROM a" for c in E.CATEGORIES)})
 SELECT e AS entity, d AS asof, date, category, CAST(balance AS BIGINT) AS balance, {rnd('change_pct')}, {rnd('CASE WHEN total > 0 THEN balance * 1.0 / total END', 'ratio')}, CAST(total AS BIGINT) AS total, dominant, {rnd('dominant_ratio', 'concentration')},
   coalesce(dominant_ratio >= 0.3, false) AS is_concentrated FROM p""")
def _collateral(spark, d):
    b = E.loans(spark, d)
    df = SM.collateral_summary(nation_requests(b), b, E.CATEGORIES, 0.3)
    return tidy(df, "entity", "asof", "date", "category", "balance", "change_pct", "ratio", "total", "dominant", "concentration", "is_concentrated")


def trades(spark, d):
    li = V.table(spark, d, "lineitem")
    return li.select(F.col("l_suppkey").alias("entity"), F.to_date("l_shipdate").alias("date"), F.col("l_returnflag").alias("trade_type"), F.col("l_quantity").cast("long").alias("volume"), F.floor("l_extendedprice").cast("long").alias("money"))


@query("block_trade_summary", "K17,D4", f"""WITH {REQUESTS}, t AS (SELECT l_suppkey AS entity, CAST(l_shipdate AS DATE) AS date, l_returnflag AS tt, CAST(l_quantity AS BIGINT) AS v, CAST(floor(l_extendedprice) AS BIGINT) AS m FROM lineitem),
 b AS (SELECT entity, date, sum(v) AS v, sum(m) AS m, sum(CASE WHEN tt = 'A' THEN v ELSE 0 END) AS mv, max(m) AS big FROM t GROUP BY 1, 2),
 j AS (SELECT r.entity, r.asof, b.* EXCLUDE (entity) FROM requests r LEFT JOIN b ON b.entity = r.entity AND b.date <= r.asof AND b.date >= r.asof - 30)
 SELECT entity, asof, count(date) AS active_days, CAST(coalesce(sum(v), 0) AS BIGINT) AS total_volume, CAST(coalesce(sum(m), 0) AS BIGINT) AS total_money, {rnd('sum(mv) / nullif(sum(v), 0)', 'matching_share')}, coalesce(max(big), 0) AS largest_trade,
   coalesce(string_agg(CASE WHEN mv / v >= 0.8 THEN CAST(date AS VARCHAR) END, ',' ORDER BY date), '') AS spike_days FROM j GROUP BY 1, 2""")
def _blocks(spark, d):
    daily = A.block_rollup(trades(spark, d), "A").drop("detail")
    df = SM.block_summary(quarter_requests(spark, d), daily).withColumn("spike_days", F.array_join(F.transform("spike_days", lambda x: x.cast("string")), ","))
    return tidy(df, "entity", "asof", "active_days", "total_volume", "total_money", "matching_share", "largest_trade", "spike_days")


MEASURES = {"cash": "cash_only", "batch": "disposition", "attention": "warning"}
_MEASURE = "CASE WHEN q < 5 THEN 'paid in cash, batch' WHEN q < 25 THEN 'second batch' WHEN q < 45 THEN 'attention' END"


@query("alert_status", "K17,B14", f"""WITH {REQUESTS}, {E.ALERT_SQL}, q AS (SELECT l_suppkey AS entity, CAST(l_shipdate AS DATE) AS date, min(l_quantity) AS q FROM lineitem WHERE l_returnflag = 'R' AND l_discount >= 0.085 GROUP BY 1, 2),
 al AS (SELECT a.*, CASE WHEN q < 5 THEN 'cash_only' WHEN q < 25 THEN 'disposition' WHEN q < 45 THEN 'warning' ELSE 'unknown' END AS severity FROM alerts a JOIN q USING (entity, date)),
 j AS (SELECT r.entity, r.asof, al.* EXCLUDE (entity), period_start <= r.asof AND period_end >= r.asof AS is_open FROM requests r LEFT JOIN al ON al.entity = r.entity AND al.date <= r.asof AND al.date >= r.asof - 60),
 cnt AS (SELECT entity, asof, count(date) AS announcements, max(date) AS newest FROM j GROUP BY 1, 2), o AS (SELECT * FROM j WHERE is_open QUALIFY row_number() OVER (PARTITION BY entity, asof ORDER BY date DESC) = 1)
 SELECT cnt.entity, cnt.asof, o.date IS NOT NULL AS in_period, o.severity, o.period_start, o.period_end, CAST(o.period_end - o.asof AS INTEGER) AS days_remaining, CAST(cnt.announcements AS INTEGER) AS announcements, cnt.newest FROM cnt LEFT JOIN o ON o.entity = cnt.entity AND o.asof = cnt.asof""")
def _alerts(spark, d):
    li = V.table(spark, d, "lineitem").filter("l_returnflag = 'R' AND l_discount >= 0.085")
    texts = li.groupBy(F.col("l_suppkey").alias("entity"), F.to_date("l_shipdate").alias("date")).agg(F.min("l_quantity").alias("q")).select("entity", "date", F.expr(_MEASURE).alias("measure"))
    a = E.alerts(spark, d).join(texts, ["entity", "date"]).withColumn("severity", K.first_match("measure", MEASURES, "unknown"))
    s = SM.alert_status(quarter_requests(spark, d), a.select("entity", "date", "period_start", "period_end", "severity"))
    return s.withColumn("newest", F.try_element_at("history", F.lit(1))["date"]).drop("history")


@query("commodity_summary", "K17,E30", f"""WITH {E.COMMODITY_SQL}, {REQUESTS.replace('span', 'span0')} SELECT r.entity, r.asof, m.date, {rnds('price return_pct zscore', 3)}, momentum, CAST(coalesce(streak, 0) AS INTEGER) AS streak, coalesce(abs(zscore) >= 2, false) AS is_spike, m.date IS NOT NULL AS is_available {ASOF.format(t='ind')}""")
def _commodity(spark, d):
    return tidy(SM.commodity_summary(quarter_requests(spark, d), E.commodity(spark, d)), "entity", "asof", "date", "price", "return_pct", "zscore", "momentum", "streak", "is_spike", "is_available", digits=3)


@query("trend_view", "K12,D16", f"""WITH {P.REGIME_SQL}, {REQUESTS}, h AS (SELECT r.*, hz.horizon FROM requests r, hz), a AS (SELECT h.entity, h.asof, h.horizon, c.date, c.close, c.x, c.p, c.regime FROM h ASOF LEFT JOIN c ON c.entity = h.entity AND c.horizon = h.horizon AND h.asof >= c.date)
 SELECT entity, asof, horizon, date, regime, {rnd('x', 'smoothed', 2)}, {rnd('(close - x) / greatest(sqrt(p), x * 0.01)', 'deviation', 2)}, {rnd('x - greatest(sqrt(p), x * 0.01)', 'band_low', 2)}, {rnd('x + greatest(sqrt(p), x * 0.01)', 'band_high', 2)}, CAST(asof - date AS INTEGER) AS age_days, asof - date > 7 AS is_stale FROM a""")
def _trend(spark, d):
    t = SM.trend_of(quarter_requests(spark, d), V.bars(spark, d))
    return tidy(t, "entity", "asof", "horizon", "date", "regime", "smoothed", "deviation", "band_low", "band_high", "age_days", "is_stale", digits=2)


@query("recent_regime_changes", "K12,E28", f"""WITH {REQUESTS}, ch AS (SELECT entity, date, from_regime, to_regime FROM ({ORACLES['regime_changes']}) WHERE horizon = 'medium')
 SELECT r.entity, r.asof, ch.date, from_regime, to_regime, CAST(row_number() OVER (PARTITION BY r.entity, r.asof ORDER BY ch.date DESC, to_regime) AS INTEGER) AS nth FROM requests r JOIN ch ON ch.entity = r.entity AND ch.date <= r.asof AND ch.date >= r.asof - 180 QUALIFY nth <= 5""")
def _changes(spark, d):
    ch = R.regime_changes(R.regimes(R.kalman(V.bars(spark, d))))
    return SM.recent_changes(quarter_requests(spark, d), ch).select("entity", "asof", "date", "from_regime", "to_regime", "nth")


# --- screens -------------------------------------------------------------------------------------------------
LISTS = {
    "monthly": ["persistent_momentum_ranking", "revenue_momentum_ranking", "institutional_concert_ranking"],
    "quarterly": ["f_score_ranking", "low_volatility_ranking", "industry_adjusted_ranking"],
    "low_risk": ["long_term_low_volatility_ranking", "dividend_yield_ranking", "momentum_12_1_ranking"],
}


def days_sql(n: int) -> str:
    return f"days AS (SELECT DISTINCT asof FROM requests ORDER BY asof DESC LIMIT {n})"


def newest_days(spark, d, n: int = 4):
    return quarter_requests(spark, d).select("asof").distinct().orderBy(F.desc("asof")).limit(n)


def list_sql(name: str) -> str:
    factor = name.removesuffix("_ranking")
    return f"""SELECT a.asof, '{factor}' AS factor, k.date, k.entity, k.rank, k.universe_size, k.metric FROM (SELECT d.asof, max(k.date) AS date FROM days d JOIN k_{factor} k ON k.date <= d.asof AND k.rank IS NOT NULL GROUP BY 1) a JOIN k_{factor} k ON k.date = a.date WHERE k.rank <= 30"""


for _toolkit, _names in LISTS.items():
    _with = ", ".join(f"k_{n.removesuffix('_ranking')} AS MATERIALIZED ({ORACLES[n]})" for n in _names)

    @query(f"{_toolkit}_screen", "G16,G15,G18", f"""WITH {REQUESTS}, {days_sql(4)}, {_with} SELECT asof, factor, date, entity, rank, universe_size, {rnd('metric')} FROM ({' UNION ALL '.join(map(list_sql, _names))})""")
    def _lists(spark, d, names=tuple(_names)):
        rankings = {n.removesuffix("_ranking"): QUERIES[n](spark, d).withColumn("metric", F.col("metric").cast("double")) for n in names}
        return tidy(SC.factor_lists(rankings, newest_days(spark, d)), "asof", "factor", "date", "entity", "rank", "universe_size", "metric")


@query("trigger_scan", "G16,G12", f"""WITH t AS MATERIALIZED ({ORACLES['monthly_trigger_signals']}), days AS (SELECT DISTINCT CAST(date_trunc('quarter', o_orderdate) AS DATE) + 89 AS asof FROM orders),
 a AS (SELECT d.asof, max(t.date) AS date FROM days d JOIN t ON t.date <= d.asof GROUP BY 1), k AS (SELECT a.asof, t.*, CAST(row_number() OVER (PARTITION BY a.asof, trigger_type ORDER BY CASE WHEN trigger_type = 'positive' THEN -yoy ELSE yoy END, entity) AS INTEGER) AS rank,
   count(*) OVER (PARTITION BY a.asof, trigger_type) AS total FROM a JOIN t ON t.date = a.date) SELECT asof, date, trigger_type, entity, yoy, net_pct, rank, total FROM k WHERE rank <= 20""")
def _trigger_scan(spark, d):
    days = V.table(spark, d, "orders").select(F.date_add(F.to_date(F.date_trunc("quarter", "o_orderdate")), 89).alias("asof")).distinct()
    return SC.trigger_scan(QUERIES["monthly_trigger_signals"](spark, d), days)


_PHASE = """CASE WHEN legs = 3 AND "asof" - end_date > 14 THEN 'correction_ongoing' WHEN legs = 3 AND direction < 0 THEN 'correction_done_down' WHEN legs = 3 THEN 'correction_done_up' WHEN pattern = 'impulse' THEN 'impulse_complete' ELSE 'other' END"""
PHASES = f"""WITH {PW.LIVE}, pr AS (SELECT * FROM lv QUALIFY row_number() OVER (PARTITION BY entity, "asof" ORDER BY {PW._ORD}) = 1), ph AS (SELECT entity, asof AS "asof", pattern, power, degree, direction, end_date, close, {_PHASE} AS phase FROM pr)"""


def phases(spark, d):
    return SC.phases(WV.primary_scenario(PW.live(spark, d)))


@query("wave_scan", "G16,G13", f"""{PHASES}, setups AS MATERIALIZED ({ORACLES['wave_setup_screen']}), c AS (SELECT asof AS "asof", entity, 'candidate' AS part, rank, rr, aligned FROM setups WHERE timeframe = 'daily' AND rank <= 30),
 o AS (SELECT asof AS "asof", entity, phase, CAST(row_number() OVER (PARTITION BY "asof" ORDER BY entity) AS INTEGER) AS rank FROM ph WHERE phase <> 'correction_done_down')
 SELECT "asof", entity, part, NULL AS phase, rank, rr, aligned FROM c UNION ALL SELECT "asof", entity, 'observe', phase, rank, NULL, NULL FROM o WHERE rank <= 30""")
def _wave_scan(spark, d):
    return SC.wave_scan(QUERIES["wave_setup_screen"](spark, d), phases(spark, d))


@query("phase_histogram", "G14,D12", f"""{PHASES} SELECT r.asof AS "asof", coalesce(phase, 'none') AS phase, count(*) AS n FROM requests r LEFT JOIN ph ON ph.entity = r.entity AND ph.asof = r.asof GROUP BY 1, 2""")
def _phase_histogram(spark, d):
    return SC.phase_histogram(quarter_requests(spark, d), phases(spark, d))


@query("power_and_wave_labels", "I9", f"""WITH {PW.SCEN}, t AS (SELECT entity, wave_no, legs, pattern, power, concat(legs, '-wave from leg ', wave_no, ' (', pattern, ')') AS label FROM sc)
 SELECT entity, wave_no, pattern, CAST(legs AS INTEGER) AS legs, CASE CAST(power AS INTEGER) WHEN 3 THEN 'strong_bullish' WHEN 2 THEN 'bullish' WHEN 1 THEN 'slight_bullish' WHEN -1 THEN 'slight_bearish' WHEN -2 THEN 'bearish' WHEN -3 THEN 'strong_bearish' ELSE 'neutral' END AS rating,
   CAST(abs(power) AS INTEGER) AS strength, CAST(sign(power) AS INTEGER) AS sign, CASE WHEN power > 0 THEN 'bullish' WHEN power < 0 THEN 'bearish' ELSE 'neutral' END AS direction, CASE WHEN contains(pattern, '_') THEN split_part(pattern, '_', 1) ELSE pattern END AS family, CAST(legs AS INTEGER) AS wave_count FROM t""")
def _labels(spark, d):
    s = PW.found(spark, d)
    s = s.withColumn("label", F.concat(F.col("legs").cast("string"), F.lit("-wave from leg "), F.col("wave_no").cast("string"), F.lit(" ("), F.col("pattern"), F.lit(")"))).withColumn("rating", K.power_rating(F.col("power")))
    r = F.col("rating")
    return s.select("entity", "wave_no", "pattern", F.col("legs").cast("int").alias("legs"), "rating", K.rating_strength(r).alias("strength"), K.rating_sign(r).alias("sign"), K.rating_direction(r).alias("direction"),
                    K.pattern_family(F.col("pattern")).alias("family"), K.wave_count(F.col("label")).alias("wave_count"))
