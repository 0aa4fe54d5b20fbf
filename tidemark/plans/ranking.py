"""Ranking and screening queries at quarter ends."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import texts as X
from tidemark.functions.ranking import group_quantiles, ranked_rows
from tidemark.operators import aggregates as A
from tidemark.operators import ranking as R
from tidemark.plans import events as E
from tidemark.plans.ctes import ADJ, BARS, INFO, INST, SERIES, STATEMENT
from tidemark.plans.pit import REQUESTS, quarter_requests
from tidemark.plans.registry import query, rnd, rnds, tidy
from tidemark.functions import scalars as K
from tidemark.sources import views as V

UNIVERSE = INFO + """, universe AS (SELECT *, CASE WHEN delisting_date IS NOT NULL THEN 'delisted' WHEN contains(industry, 'UNITED') THEN 'financial' END AS excluded_reason FROM entity_info)"""
RULES = {"UNITED": "financial"}


def universe(spark, d):
    i = V.entity_info(spark, d)
    return i.withColumn("excluded_reason", K.exclusion_reason(RULES))


def rank_sql(head: str, metrics: str, cols: str, asc: bool = False, digits: int = 6, plain: str = "") -> str:
    """``metrics``: SELECT giving entity, date, metric, reason and the listed columns."""
    order = "ASC" if asc else "DESC"
    extra = "".join(f", {c}" for c in plain.split())
    return f"""WITH {head}, {UNIVERSE}, met AS ({metrics}), x AS (SELECT m.* EXCLUDE (reason), coalesce(u.excluded_reason, m.reason) AS excluded_reason FROM met m LEFT JOIN universe u ON u.entity = m.entity),
 ok AS (SELECT *, row_number() OVER (PARTITION BY date ORDER BY metric {order}, entity) AS rk, count(*) OVER (PARTITION BY date) AS n FROM x WHERE excluded_reason IS NULL AND metric IS NOT NULL),
 allr AS (SELECT *, CAST(rk AS INTEGER) AS rank, CAST(n AS INTEGER) AS universe_size FROM ok UNION ALL SELECT *, NULL, NULL, NULL, NULL FROM x WHERE excluded_reason IS NOT NULL OR metric IS NULL)
 SELECT entity, date, {rnds(cols, digits)}{extra}, rank, universe_size, coalesce(rank <= 30, false) AS is_top_n, excluded_reason FROM allr"""


def out(df, cols, digits=6, plain=""):
    return tidy(df, "entity", "date", *cols.split(), *plain.split(), "rank", "universe_size", "is_top_n", "excluded_reason", digits=digits)


ASOF = "FROM requests r ASOF LEFT JOIN {t} m ON m.entity = r.entity AND r.asof >= m.date"


@query("momentum_12_1_ranking", "G11,G1,E36", rank_sql(f"{SERIES}, {REQUESTS}, q AS (SELECT entity, date, CASE WHEN {X.prev('close', 251)} > 0 THEN ({X.prev('close', 21)} - {X.prev('close', 251)}) / {X.prev('close', 251)} END AS metric FROM s)",
       f"SELECT r.entity, r.asof AS date, m.metric, CASE WHEN m.metric IS NULL THEN 'insufficient_history' END AS reason {ASOF.format(t='q')}", "metric"))
def _mom(spark, d):
    return out(R.rank_table(R.momentum_12_1(quarter_requests(spark, d), V.bars(spark, d)), universe(spark, d), "metric"), "metric")


def _vol(n, k):
    return rank_sql(f"{SERIES}, {REQUESTS}, q0 AS (SELECT *, close / {X.prev('close')} - 1 AS ret FROM s), q AS (SELECT entity, date, CASE WHEN idx >= {k - 1} THEN {X.roll('stddev_samp', 'ret', n)} END AS metric FROM q0)",
                    f"SELECT r.entity, r.asof AS date, m.metric, CASE WHEN m.metric IS NULL THEN 'insufficient_history' END AS reason {ASOF.format(t='q')}", "metric", asc=True)


@query("low_volatility_ranking", "G7,E35", _vol(252, 50))
def _lowvol(spark, d):
    return out(R.rank_table(R.low_volatility(quarter_requests(spark, d), V.bars(spark, d)), universe(spark, d), "metric", ascending=True), "metric")


@query("long_term_low_volatility_ranking", "G8", _vol(756, 252))
def _lowvol_long(spark, d):
    return out(R.rank_table(R.low_volatility(quarter_requests(spark, d), V.bars(spark, d), 756, 252), universe(spark, d), "metric", ascending=True), "metric")


_MONTHS = " + ".join(f"CASE WHEN {'close' if m == 0 else X.prev('close', 21 * m)} > {X.prev('close', 21 * (m + 1))} THEN 1 ELSE 0 END" for m in range(6))
PERSIST = f"""{SERIES}, {REQUESTS}, q0 AS (SELECT *, close / {X.prev('close')} - 1 AS ret FROM s),
 q AS (SELECT entity, date, idx, close / {X.prev('close', 125)} - 1 AS return_6m, {X.prev('close', 21)} / {X.prev('close', 251)} - 1 AS return_12m_1m, {_MONTHS} AS persistent_months, {X.roll('stddev_samp', 'ret', 126)} AS vol_6m FROM q0)"""


@query("persistent_momentum_ranking", "G3,E37", rank_sql(PERSIST + f""", {UNIVERSE.replace('universe AS', 'uni0 AS').replace('entity_info', 'info0')},
 m0 AS (SELECT r.entity, r.asof AS date, CASE WHEN idx >= 130 THEN return_6m END AS metric, CASE WHEN idx >= 130 THEN return_12m_1m END AS return_12m_1m, CASE WHEN idx >= 130 THEN persistent_months END AS persistent_months, CASE WHEN idx >= 130 THEN vol_6m END AS vol_6m,
   CASE WHEN idx >= 130 THEN NULL ELSE 'insufficient_history' END AS reason {ASOF.format(t='q')}),
 cm AS (SELECT date, avg(vol_6m) AS mv FROM m0 JOIN uni0 USING (entity) WHERE reason IS NULL AND excluded_reason IS NULL AND vol_6m > 0 GROUP BY date)""",
       "SELECT m0.*, CASE WHEN vol_6m > mv * 1.5 THEN 0.5 ELSE 1.0 END AS scale FROM m0 LEFT JOIN cm USING (date)", "metric return_12m_1m vol_6m scale", plain="persistent_months"))
def _persistent(spark, d):
    m = R.persistent_momentum(quarter_requests(spark, d), V.bars(spark, d))
    m = R.with_volatility_scale(m, universe(spark, d)).withColumnRenamed("return_6m", "metric")
    return out(R.rank_table(m, universe(spark, d), "metric"), "metric return_12m_1m vol_6m scale", plain="persistent_months")


GROWTH = E.YOY_SQL + f""", gr AS (SELECT *, least(idx - coalesce({X.cum('max', 'CASE WHEN coalesce(yoy, 0) > 0 THEN NULL ELSE idx END')}, -1), 6) AS run FROM ind)"""


@query("revenue_momentum_ranking", "G4,E39", rank_sql(f"{GROWTH}, {REQUESTS}", f"SELECT r.entity, r.asof AS date, m.yoy AS metric, CAST(m.run AS INTEGER) AS run, CASE WHEN m.run IS NULL THEN 'no_revenue_data' WHEN m.run < 3 THEN 'run_too_short' END AS reason {ASOF.format(t='gr')}", "metric", plain="run"))
def _revenue(spark, d):
    return out(R.rank_table(R.revenue_momentum(quarter_requests(spark, d), A.period_growth(V.period_revenue(spark, d))), universe(spark, d), "metric"), "metric", plain="run")


NATION_REQ = """requests AS (SELECT DISTINCT entity, CAST(date_trunc('quarter', date) AS DATE) + 89 AS asof FROM flows)"""
SHARES = "shares AS (SELECT CAST(c_nationkey AS BIGINT) AS entity, CAST(count(*) * 1000 AS DOUBLE) AS shares FROM customer GROUP BY 1)"


def nation_requests(flows):
    return flows.select("entity", F.date_add(F.to_date(F.date_trunc("quarter", "date")), 89).alias("asof")).distinct()


def shares(spark, d):
    return V.table(spark, d, "customer").groupBy(F.col("c_nationkey").cast("long").alias("entity")).agg((F.count("*") * 1000).cast("double").alias("shares"))


_ONE = "(foreign_net > 0 AND trust_net > 0 AND dealer_net > 0) OR (foreign_net < 0 AND trust_net < 0 AND dealer_net < 0)"


@query("institutional_concert_ranking", "G5", rank_sql(f"{E.FLOW_SQL}, {NATION_REQ}, {SHARES}, q AS (SELECT entity, date, idx, {X.roll('sum', f'CASE WHEN {_ONE} THEN 1 ELSE 0 END', 20)} AS concert_days, CAST({X.roll('sum', 'foreign_net', 20)} AS DOUBLE) AS foreign_cumulative FROM ind)",
       f"SELECT r.entity, r.asof AS date, CAST(m.concert_days AS INTEGER) AS concert_days, m.foreign_cumulative, m.foreign_cumulative / sh.shares AS metric, CASE WHEN coalesce(m.idx + 1 < 5, true) THEN 'insufficient_history' END AS reason {ASOF.format(t='q')} LEFT JOIN shares sh ON sh.entity = r.entity", "metric foreign_cumulative", digits=4, plain="concert_days"))
def _concert(spark, d):
    f = E.flows(spark, d)
    return out(R.rank_table(R.institutional_concert(nation_requests(f), f, shares(spark, d)), universe(spark, d), "metric"), "metric foreign_cumulative", 4, "concert_days")


FQ = STATEMENT + ", " + E.FIN_ITEMS + """, fq AS (SELECT entity, date, inc_o - coalesce(bal_o, 0) AS net_income, cf_f - coalesce(cf_o, 0) AS cfo, bal_f AS total_assets, inc_f AS current_assets, bal_o AS current_liabilities, cf_o AS long_debt, coalesce(inc_f, 0) + coalesce(inc_o, 0) AS revenue, inc_o AS cogs, cf_f AS shares FROM st)"""


def fq(spark, d):
    pick = lambda t, i: F.max(F.when((F.col("statement_type") == t) & (F.col("item") == i), F.col("value")))
    z = lambda c: F.coalesce(c, F.lit(0.0))
    return V.statement_long(spark, d).groupBy("entity", "date").agg(
        (pick("income", "O") - z(pick("balance", "O"))).alias("net_income"), (pick("cashflow", "F") - z(pick("cashflow", "O"))).alias("cfo"), pick("balance", "F").alias("total_assets"), pick("income", "F").alias("current_assets"),
        pick("balance", "O").alias("current_liabilities"), pick("cashflow", "O").alias("long_debt"), (z(pick("income", "F")) + z(pick("income", "O"))).alias("revenue"), pick("income", "O").alias("cogs"), pick("cashflow", "F").alias("shares"))


def _div(a, b):
    return f"CASE WHEN {b} > 0 THEN ({a}) / {b} END"


def _yes(c):
    return f"CASE WHEN {c} THEN 1 ELSE 0 END"


_P = {c: f"p_{c}" for c in ("net_income", "total_assets", "current_assets", "current_liabilities", "long_debt", "revenue", "cogs", "shares")}
FSCORE = FQ + ", fp AS (SELECT *, " + ", ".join(f"{X.prev(c)} AS {p}" for c, p in _P.items()) + f""" FROM fq),
 fs AS (SELECT entity, date, {_yes(_div('net_income', 'total_assets') + ' > 0')} + {_yes('cfo > 0')} + {_yes(_div('net_income', 'total_assets') + ' > ' + _div('p_net_income', 'p_total_assets'))} + {_yes('cfo > net_income')} AS profitability,
   {_yes('long_debt < p_long_debt')} + {_yes(_div('current_assets', 'current_liabilities') + ' > ' + _div('p_current_assets', 'p_current_liabilities'))} + {_yes('shares <= p_shares')} AS leverage,
   {_yes(_div('revenue - cogs', 'revenue') + ' > ' + _div('p_revenue - p_cogs', 'p_revenue'))} + {_yes(_div('revenue', 'total_assets') + ' > ' + _div('p_revenue', 'p_total_assets'))} AS efficiency,
   net_income IS NOT NULL AND total_assets IS NOT NULL AND p_total_assets IS NOT NULL AND revenue IS NOT NULL AND p_revenue IS NOT NULL AS ok FROM fp),
 fz AS (SELECT entity, date, CASE WHEN ok THEN profitability END AS profitability, CASE WHEN ok THEN leverage END AS leverage, CASE WHEN ok THEN efficiency END AS efficiency, CASE WHEN ok THEN profitability + leverage + efficiency END AS f_score FROM fs)"""


@query("f_score_ranking", "G6", rank_sql(f"{FSCORE}, {REQUESTS}", f"SELECT r.entity, r.asof AS date, m.profitability, m.leverage, m.efficiency, m.f_score AS metric, CASE WHEN m.f_score IS NULL THEN 'no_financial_data' WHEN m.f_score < 6 THEN 'score_too_low' END AS reason {ASOF.format(t='fz')}", "metric", plain="profitability leverage efficiency"))
def _fscore(spark, d):
    m = R.f_score_metrics(quarter_requests(spark, d), fq(spark, d)).withColumn("metric", F.col("f_score").cast("double"))
    return out(R.rank_table(m, universe(spark, d), "metric"), "metric", plain="profitability leverage efficiency")


@query("industry_adjusted_ranking", "G9,D8", rank_sql(f"""{FQ}, {REQUESTS}, {UNIVERSE.replace('universe AS', 'uni0 AS').replace('entity_info', 'info0')}, g AS (SELECT r.entity, r.asof AS date, CASE WHEN m.total_assets > 0 THEN (m.revenue - m.cogs) / m.total_assets END AS gp {ASOF.format(t='fq')}),
 g1 AS (SELECT g.*, u.industry, u.excluded_reason FROM g LEFT JOIN uni0 u ON u.entity = g.entity), med AS (SELECT date, industry, quantile_cont(gp, 0.5) AS industry_median FROM g1 WHERE gp IS NOT NULL AND excluded_reason IS NULL GROUP BY 1, 2)""",
       "SELECT g1.entity, g1.date, g1.industry, g1.gp, industry_median, g1.gp - industry_median AS metric, CASE WHEN g1.gp IS NULL THEN 'no_gp_data' END AS reason FROM g1 LEFT JOIN med ON med.date = g1.date AND med.industry = g1.industry", "metric gp industry_median", plain="industry"))
def _industry(spark, d):
    from tidemark.operators.pit import asof_join

    u = universe(spark, d)
    g = asof_join(quarter_requests(spark, d), fq(spark, d), ["revenue", "cogs", "total_assets"]).withColumnRenamed("asof", "date")
    g = g.withColumn("gp", F.when(F.col("total_assets") > 0, (F.col("revenue") - F.col("cogs")) / F.col("total_assets"))).select("entity", "date", "gp")
    g = g.join(u.select("entity", "industry", F.col("excluded_reason").alias("reason")), "entity", "left").withColumn("reason", F.coalesce("reason", F.when(F.col("gp").isNull(), "no_gp_data")))
    return out(R.rank_table(R.industry_adjusted(g), None, "metric"), "metric gp industry_median", plain="industry")


DIV = f"""{ADJ}, bars AS (SELECT entity, date, arg_min(px, seq) AS open, max(px) AS high, min(px) AS low, arg_max(px, seq) AS close, CAST(sum(qty) AS BIGINT) AS volume FROM trades GROUP BY entity, date), {REQUESTS},
 y0 AS (SELECT entity, date, (close - {X.prev('close', 251)}) / {X.prev('close', 251)} * 100 AS return_12m, CASE WHEN volume > 8 THEN 50000 / close END AS y FROM bars),
 y AS (SELECT entity, date, return_12m, last_value(y IGNORE NULLS) OVER ({X.OVER} ROWS UNBOUNDED PRECEDING) AS yield FROM y0),
 pay AS (SELECT r.entity, r.asof, count(DISTINCT year(a.date)) AS payout_years FROM requests r JOIN adj_events a ON a.entity = r.entity AND a.date <= r.asof AND a.date >= r.asof - 1825 AND a.cash_dividend > 0 GROUP BY 1, 2),
 dy AS (SELECT r.entity, r.asof, m.return_12m, m.yield {ASOF.format(t='y')})"""


@query("dividend_yield_ranking", "G10", rank_sql(DIV, """SELECT d.entity, d.asof AS date, d.yield AS metric, d.return_12m, CAST(coalesce(p.payout_years, 0) AS INTEGER) AS payout_years,
   CASE WHEN d.yield IS NULL THEN 'no_yield_data' WHEN d.yield < 3 THEN 'yield_below_threshold' WHEN d.return_12m IS NULL OR d.return_12m < -20 THEN 'falling_knife' WHEN coalesce(p.payout_years, 0) < 3 THEN 'payout_history_insufficient' END AS reason
   FROM dy d LEFT JOIN pay p ON p.entity = d.entity AND p.asof = d.asof""", "metric return_12m", digits=4, plain="payout_years"))
def _dividend(spark, d):
    b = V.bars(spark, d)
    y = b.filter(F.col("volume") > 8).select("entity", "date", (50000 / F.col("close")).alias("yield"))
    m = R.dividend_yield(quarter_requests(spark, d), y, b, V.adj_events(spark, d))
    return out(R.rank_table(m, universe(spark, d), "metric"), "metric return_12m", 4, "payout_years")


CAPS = "caps AS (SELECT b.entity, b.date, CASE WHEN b.volume > 6 THEN b.close * (1000 + floor(i.balance)) / 100 END AS market_cap FROM bars b JOIN (SELECT * FROM universe WHERE balance > -1000) i ON i.entity = b.entity)"
MAGIC = f"""{SERIES}, {FQ}, {REQUESTS}, {UNIVERSE}, {CAPS}, mq AS (SELECT entity, date, CASE WHEN {X.roll('count', 'cfo', 4)} = 4 THEN {X.roll('sum', 'cfo', 4)} END AS ebit_ttm, total_assets, current_liabilities AS total_liab, long_debt AS cash FROM fq),
 m1 AS (SELECT r.entity, r.asof AS asof, m.ebit_ttm, m.total_assets, m.total_liab, m.cash {ASOF.format(t='mq')}),
 m2 AS (SELECT m1.*, CASE WHEN m1.asof - c.date <= 60 THEN c.market_cap END AS market_cap FROM m1 ASOF LEFT JOIN (SELECT * FROM caps WHERE market_cap IS NOT NULL) c ON c.entity = m1.entity AND m1.asof >= c.date),
 m3 AS (SELECT *, market_cap + total_liab - coalesce(cash, 0) AS ev, total_assets - coalesce(cash, 0) AS ic FROM m2),
 m4 AS (SELECT m3.*, coalesce(u.excluded_reason, CASE WHEN ebit_ttm IS NULL THEN 'no_ebit_data' WHEN total_assets IS NULL OR total_liab IS NULL THEN 'no_balance_data' WHEN market_cap IS NULL THEN 'no_market_cap' WHEN ebit_ttm <= 0 OR ev <= 0 OR ic <= 0 THEN 'negative_ebit_or_ev' END) AS excluded_reason FROM m3 LEFT JOIN universe u ON u.entity = m3.entity),
 m5 AS (SELECT *, row_number() OVER (PARTITION BY asof ORDER BY ebit_ttm / ev DESC, entity) AS ey_rank, row_number() OVER (PARTITION BY asof ORDER BY ebit_ttm / ic DESC, entity) AS roic_rank FROM m4 WHERE excluded_reason IS NULL),
 m6 AS (SELECT *, ey_rank + roic_rank AS combined_rank, row_number() OVER (PARTITION BY asof ORDER BY ey_rank + roic_rank, entity) AS rank, count(*) OVER (PARTITION BY asof) AS universe_size FROM m5),
 magic AS (SELECT entity, asof AS date, ebit_ttm / ev AS earnings_yield, ebit_ttm / ic AS roic, CAST(ey_rank AS INTEGER) AS ey_rank, CAST(roic_rank AS INTEGER) AS roic_rank, CAST(combined_rank AS INTEGER) AS combined_rank, CAST(rank AS INTEGER) AS rank, CAST(universe_size AS INTEGER) AS universe_size, rank <= 30 AS is_top_n, excluded_reason FROM m6
  UNION ALL SELECT entity, asof, NULL, NULL, NULL, NULL, NULL, NULL, NULL, false, excluded_reason FROM m4 WHERE excluded_reason IS NOT NULL)"""


def magic(spark, d):
    u, b = universe(spark, d), V.bars(spark, d)
    q = fq(spark, d).select("entity", "date", F.col("cfo").alias("ebit"), "total_assets", F.col("current_liabilities").alias("total_liab"), F.col("long_debt").alias("cash"))
    caps = b.join(u.select("entity", "balance").filter("balance > -1000"), "entity").select("entity", "date", F.when(F.col("volume") > 6, F.col("close") * (1000 + F.floor("balance")) / 100).alias("market_cap"))
    return R.magic_formula(R.magic_inputs(quarter_requests(spark, d), q, caps), u)


_MC = "earnings_yield roic"
_MI = "ey_rank roic_rank combined_rank rank universe_size is_top_n excluded_reason".split()


@query("magic_formula_ranking", "G2", f"WITH {MAGIC} SELECT entity, date, {rnds(_MC, 6)}, {', '.join(_MI)} FROM magic")
def _magic(spark, d):
    return tidy(magic(spark, d), "entity", "date", *_MC.split(), *_MI, digits=6)


@query("magic_formula_membership", "F42", f"""WITH {MAGIC}, t AS (SELECT entity, date, is_top_n, rank, lag(is_top_n) OVER ({X.OVER}) AS was FROM magic)
 SELECT entity, date, CASE WHEN is_top_n THEN 'entered_top' ELSE 'exited_top' END AS event_kind, CAST(rank AS DOUBLE) AS value FROM t WHERE is_top_n <> coalesce(was, false)""")
def _membership(spark, d):
    from tidemark.functions.events import detect
    from tidemark.operators.detection import MEMBERSHIP_RULES
    from tidemark.operators.indicators import indexed

    return detect(indexed(magic(spark, d).select("entity", "date", "is_top_n", "rank")), MEMBERSHIP_RULES)


@query("monthly_trigger_signals", "G12", f"""WITH {E.YOY_SQL}, {INST.replace('inst_long', 'il')}, fl AS (SELECT entity, date, CAST(sum(buy - sell) AS DOUBLE) AS net FROM il GROUP BY 1, 2), f20 AS (SELECT entity, date, {X.roll('sum', 'net', 20)} AS net_20 FROM fl), {SHARES}, {UNIVERSE},
 rq AS (SELECT DISTINCT entity, CAST(date_trunc('quarter', date) AS DATE) + 89 AS asof FROM fl), a AS (SELECT r.entity, r.asof, g.yoy FROM rq r ASOF LEFT JOIN (SELECT * FROM ind WHERE yoy IS NOT NULL) g ON g.entity = r.entity AND r.asof >= g.date),
 b AS (SELECT a.*, f.net_20 FROM a ASOF LEFT JOIN f20 f ON f.entity = a.entity AND a.asof >= f.date), c AS (SELECT b.*, net_20 / shares AS net_pct, CASE WHEN yoy > 30 AND net_20 > 0 THEN 'positive' WHEN yoy < -20 AND net_20 < 0 AND abs(net_20 / shares) > 0.01 THEN 'negative' END AS trigger_type
   FROM b JOIN shares USING (entity) JOIN universe u USING (entity) WHERE u.excluded_reason IS NULL)
 SELECT entity, asof AS date, trigger_type, {rnds('yoy net_pct')} FROM c WHERE trigger_type IS NOT NULL""")
def _triggers(spark, d):
    f = E.flows(spark, d)
    t = R.monthly_triggers(nation_requests(f), A.period_growth(V.period_revenue(spark, d)).select("entity", "date", "yoy"), f, shares(spark, d), universe(spark, d))
    return tidy(t, "entity", "date", "trigger_type", "yoy", "net_pct")


@query("cross_section_rank", "G1", f"WITH {BARS} SELECT entity, date, volume, CAST(row_number() OVER (PARTITION BY date ORDER BY volume DESC, entity) AS INTEGER) AS rank, CAST(count(*) OVER (PARTITION BY date) AS INTEGER) AS universe_size FROM bars")
def _cross_section(spark, d):
    return ranked_rows(V.bars(spark, d).select("entity", "date", "volume"), ["date"], "volume", False)


@query("group_quantiles", "D8,D12", f"WITH {BARS} SELECT date, {rnd('quantile_cont(close, 0.5)', 'median')}, {rnd('quantile_cont(close, 0.95)', 'p95')}, CAST(count(*) AS INTEGER) AS n FROM bars GROUP BY date")
def _quantiles(spark, d):
    return tidy(group_quantiles(V.bars(spark, d).select("entity", "date", "close"), ["date"], "close", {"median": 0.5, "p95": 0.95}))


_MOM_HEAD = f"{SERIES}, {REQUESTS}, {UNIVERSE}, q AS (SELECT entity, date, ({X.prev('close', 21)} - {X.prev('close', 251)}) / {X.prev('close', 251)} AS metric FROM s), v0 AS (SELECT *, close / {X.prev('close')} - 1 AS ret FROM s), v AS (SELECT entity, date, CASE WHEN idx >= 49 THEN {X.roll('stddev_samp', 'ret', 252)} END AS metric FROM v0)"
_TOOL = f"""{_MOM_HEAD}, mr AS (SELECT r.entity, r.asof AS date, m.metric {ASOF.format(t='q')}), vr AS (SELECT r.entity, r.asof AS date, m.metric {ASOF.format(t='v')}),
 mk AS (SELECT x.*, row_number() OVER (PARTITION BY date ORDER BY metric DESC, entity) AS rank FROM mr x JOIN universe u USING (entity) WHERE u.excluded_reason IS NULL AND metric IS NOT NULL),
 vk AS (SELECT x.*, row_number() OVER (PARTITION BY date ORDER BY metric, entity) AS rank FROM vr x JOIN universe u USING (entity) WHERE u.excluded_reason IS NULL AND metric IS NOT NULL)"""


@query("toolkit_screens", "G16,G15,G18", f"""WITH {_TOOL}, last AS (SELECT DISTINCT asof FROM requests ORDER BY asof DESC LIMIT 4)
 SELECT 'monthly' AS toolkit, asof, max_date AS date, entity, CAST(rank AS INTEGER) AS rank, {rnd('metric', digits=6)} FROM (SELECT l.asof, max(mk.date) AS max_date FROM last l JOIN mk ON mk.date <= l.asof GROUP BY 1) a JOIN mk ON mk.date = a.max_date WHERE rank <= 10
 UNION ALL SELECT 'low_risk', asof, max_date, entity, CAST(rank AS INTEGER), {rnd('metric', digits=6)} FROM (SELECT l.asof, max(vk.date) AS max_date FROM last l JOIN vk ON vk.date <= l.asof GROUP BY 1) a JOIN vk ON vk.date = a.max_date WHERE rank <= 10""")
def _toolkit(spark, d):
    req, b, u = quarter_requests(spark, d), V.bars(spark, d), universe(spark, d)
    last = req.select("asof").distinct().orderBy(F.desc("asof")).limit(4)
    m = R.rank_table(R.momentum_12_1(req, b), u, "metric")
    v = R.rank_table(R.low_volatility(req, b), u, "metric", ascending=True)
    parts = [R.top_rows_at(x, last, 10).select(F.lit(n).alias("toolkit"), "asof", "date", "entity", "rank", "metric") for n, x in (("monthly", m), ("low_risk", v))]
    return tidy(parts[0].unionByName(parts[1]), digits=6)
