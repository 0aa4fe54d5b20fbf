"""Queries for point-in-time reads, adjusted prices and joins of keyed tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import scalars as K
from tidemark.operators import joins as J
from tidemark.operators import pit as P
from tidemark.plans.ctes import ADJ, BARS, CALENDAR, FACTS, INFO, INST, REVENUE, SERIES, STATEMENT
from tidemark.plans.registry import query, rnd, rnds, tidy
from tidemark.sources import views as V

AT = "2024-01-20"


@query("trading_day_filter", "B1", f"""WITH {CALENDAR}, t AS (SELECT l_suppkey AS entity, CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS date, l_orderkey FROM lineitem)
 SELECT * FROM t WHERE date IS NULL OR date IN (SELECT date FROM calendar)""")
def _trading_days(spark, d):
    t = V.table(spark, d, "lineitem").select(F.col("l_suppkey").alias("entity"), F.when(F.col("l_linenumber") != 7, F.to_date("l_shipdate")).alias("date"), "l_orderkey")
    return P.trading_days_only(t, V.calendar(spark, d))


@query("visible_facts", "B3", f"""WITH {FACTS} SELECT event_id, entity, fact_date, source FROM facts WHERE fact_date <= DATE '{AT}'
 AND coalesce(report_date, fact_date + CASE WHEN source = 'purchase' THEN 45 ELSE 0 END) <= DATE '{AT}'""")
def _visible(spark, d):
    lag = F.when(F.col("source") == "purchase", P.PUBLICATION_LAG["statement"]).otherwise(0)
    return V.facts(spark, d).filter(P.visible_at(F.lit(AT).cast("date"), lag=lag)).select("event_id", "entity", "fact_date", "source")


def quarter_requests(spark, d):
    """One request per entity and quarter end inside the entity's history."""
    span = V.table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("entity")).agg(F.min("l_shipdate").alias("a"), F.max("l_shipdate").alias("b"))
    q = F.explode(F.expr("sequence(date_trunc('quarter', a) + interval 3 month, date_trunc('quarter', b), interval 3 month)"))
    return span.select("entity", q.alias("q")).select("entity", F.date_sub(F.to_date("q"), 1).alias("asof"))


REQUESTS = """span AS (SELECT l_suppkey AS entity, min(l_shipdate) AS a, max(l_shipdate) AS b FROM lineitem GROUP BY 1),
 requests AS (SELECT entity, CAST(unnest(generate_series(date_trunc('quarter', a) + INTERVAL 3 MONTH, date_trunc('quarter', b)::TIMESTAMP, INTERVAL 3 MONTH)) AS DATE) - 1 AS asof FROM span)"""


@query("visible_revenue_periods", "B4", f"""WITH {REVENUE}, {REQUESTS}, p AS (SELECT entity, date, revenue, CASE WHEN create_time <> 'pending' THEN CAST(create_time AS DATE) END AS report_date FROM period_revenue)
 SELECT r.entity, r.asof, p.date, p.revenue FROM requests r JOIN p ON p.entity = r.entity AND p.date <= r.asof AND p.date >= r.asof - (13 * 31 + 60) AND coalesce(p.report_date, p.date + 11) <= r.asof""")
def _visible_revenue(spark, d):
    rev = V.period_revenue(spark, d).withColumn("report_date", P.report_date()).select("entity", "date", "revenue", "report_date")
    return P.visible_periods(quarter_requests(spark, d), rev, "revenue", 13).select("entity", "asof", "date", "revenue")


@query("visible_statements", "B4", f"""WITH {STATEMENT}, {REQUESTS}, p AS (SELECT entity, date, sum(value) AS total FROM statement_long GROUP BY 1, 2)
 SELECT r.entity, r.asof, p.date, p.total FROM requests r JOIN p ON p.entity = r.entity AND p.date <= r.asof AND p.date >= r.asof - (4 * 92 + 60) AND p.date + 45 <= r.asof""")
def _visible_statements(spark, d):
    st = V.statement_long(spark, d).groupBy("entity", "date").agg(F.sum("value").alias("total")).withColumn("report_date", F.lit(None).cast("date"))
    return P.visible_periods(quarter_requests(spark, d), st, "statement", 4).select("entity", "asof", "date", "total")


@query("timeframe_lookback", "B5", f"""WITH {FACTS} SELECT event_id, entity, fact_date, timeframe FROM facts WHERE fact_date >= DATE '2024-04-15' - CASE timeframe WHEN 'quarterly' THEN 180 ELSE 90 END""")
def _lookback(spark, d):
    return V.facts(spark, d).filter(P.within_lookback(F.lit("2024-04-15").cast("date"))).select("event_id", "entity", "fact_date", "timeframe")


@query("facts_on_day", "B7,I6", f"""WITH {FACTS} SELECT event_id, entity, source, event_kind, value FROM facts WHERE fact_date = DATE '{AT}' AND event_kind = 'GoldenCross' AND coalesce(report_date, fact_date) <= DATE '{AT}'""")
def _facts_on(spark, d):
    f = V.facts(spark, d)
    day = F.lit(AT).cast("date")
    return f.filter((F.col("fact_date") == day) & (F.col("event_kind") == "GoldenCross") & P.visible_at(day)).select("event_id", "entity", "source", "event_kind", "value")


@query("trading_days_between", "B8", f"WITH {CALENDAR} SELECT date FROM calendar WHERE date BETWEEN DATE '1997-03-01' AND DATE '1999-06-30'")
def _days_between(spark, d):
    return V.calendar(spark, d).filter(F.col("date").between("1997-03-01", "1999-06-30"))


@query("exclusion_reason", "B9", f"""WITH {INFO} SELECT entity, CASE WHEN delisting_date IS NOT NULL THEN 'delisted' WHEN contains(industry, 'UNITED') THEN 'financial' WHEN contains(industry, 'AN') THEN 'utility' END AS excluded_reason FROM entity_info""")
def _exclusion(spark, d):
    return V.entity_info(spark, d).select("entity", K.exclusion_reason({"UNITED": "financial", "AN": "utility"}).alias("excluded_reason"))


@query("severity_labels", "B11", f"""WITH {FACTS} SELECT event_id, severity, CASE severity WHEN 1 THEN 'info' WHEN 2 THEN 'notable' WHEN 3 THEN 'warning' ELSE 'critical' END AS label FROM facts""")
def _severity(spark, d):
    return V.facts(spark, d).select("event_id", "severity", K.severity_label(F.col("severity")).alias("label"))


@query("fact_to_event", "B12", f"""SELECT event_id, user_id AS entity, CAST(ts AS DATE) AS date, event_type AS source, coalesce(TRY_CAST(json_extract_string(props, '$.value') AS DOUBLE), TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE)) AS value FROM events""")
def _fact_to_event(spark, d):
    e = V.table(spark, d, "events")
    return e.select("event_id", F.col("user_id").alias("entity"), F.to_date("ts").alias("date"), F.col("event_type").alias("source"), K.event_value(F.parse_json("props"), ["value", "k"]).alias("value"))


@query("internal_rows_hidden", "B13", f"WITH {FACTS} SELECT event_id, entity, source FROM facts WHERE NOT (source = 'error')")
def _internal(spark, d):
    return V.facts(spark, d).withColumn("internal_only", F.col("source") == "error").filter(~F.col("internal_only")).select("event_id", "entity", "source")


@query("status_severity", "B14", """SELECT o_orderkey, CASE WHEN contains(o_orderpriority, 'URGENT') THEN 'cash_only' WHEN contains(o_orderpriority, 'HIGH') THEN 'disposition' WHEN contains(o_orderpriority, 'MEDIUM') THEN 'warning' ELSE 'unknown' END AS severity FROM orders""")
def _status(spark, d):
    o = V.table(spark, d, "orders")
    return o.select("o_orderkey", K.first_match("o_orderpriority", {"URGENT": "cash_only", "HIGH": "disposition", "MEDIUM": "warning"}, "unknown").alias("severity"))


# --- adjusted prices -----------------------------------------------------------------------------------
FACTORS = ADJ + """, bars AS (
  SELECT entity, date, arg_min(px, seq) AS open, max(px) AS high, min(px) AS low, arg_max(px, seq) AS close, CAST(sum(qty) AS BIGINT) AS volume FROM trades GROUP BY entity, date),
 ep AS (SELECT e.*, b.close AS prev_close FROM adj_events e ASOF LEFT JOIN bars b ON e.entity = b.entity AND e.date > b.date),
 ef AS (SELECT *, coalesce(before_price, prev_close) AS base FROM ep),
 eg AS (SELECT *, (base - cash_dividend) / (1 + stock_dividend / 10) AS p_after, (prev_close + subscription_price * subscription_rate / 1000) / (1 + subscription_rate / 1000) AS diluted FROM ef),
 factors AS (SELECT entity, date, product(CASE WHEN before_price > 0 AND reference_price > 0 AND NOT (event_type = 'dividend' AND stock_dividend > 0 AND cash_dividend = 0 AND abs(before_price - reference_price) < 0.0001) THEN before_price / reference_price
    WHEN event_type = 'dividend' AND base > 0 AND (cash_dividend > 0 OR stock_dividend > 0) AND p_after > 0 THEN base / p_after
    WHEN event_type = 'capital_increase' AND subscription_price > 0 AND subscription_rate > 0 AND prev_close > 0 AND diluted > 0 THEN prev_close / diluted ELSE 1.0 END) AS af,
   product(coalesce(volume_factor, 1.0)) AS vf FROM eg GROUP BY entity, date)"""


@query("adjustment_factors", "E2", f"WITH {FACTORS} SELECT entity, date, {rnds('af vf', 8)} FROM factors")
def _factors(spark, d):
    return tidy(P.adjustment_factors(V.adj_events(spark, d), V.bars(spark, d)), digits=8)


@query("back_adjusted_prices", "E1", f"""WITH {FACTORS}, j AS (SELECT b.*, coalesce(f.af, 1) AS af, coalesce(f.vf, 1) AS vf FROM bars b LEFT JOIN factors f ON f.entity = b.entity AND f.date = b.date),
 c AS (SELECT *, coalesce(product(af) OVER w, 1) AS cum_af, coalesce(product(vf) OVER w, 1) AS cum_vf FROM j WINDOW w AS (PARTITION BY entity ORDER BY date DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
 SELECT entity, date, {', '.join(f'floor({x} * cum_af * 100 + 0.5) / 100 AS adj_{x}' for x in ('open', 'high', 'low', 'close'))}, CAST(floor(volume / cum_vf + 0.5) AS BIGINT) AS adj_volume,
   {rnds('cum_af cum_vf', 6)}, abs(cum_af - 1) > 1e-12 OR abs(cum_vf - 1) > 1e-12 AS is_adjusted FROM c""")
def _back_adjusted(spark, d):
    b = V.bars(spark, d)
    df = P.back_adjusted(b, P.adjustment_factors(V.adj_events(spark, d), b))
    return tidy(df.drop("open", "high", "low", "close", "volume"), digits=6)


@query("asof_adjusted_closes", "E3", f"""WITH {FACTORS}, {REQUESTS}, j AS (SELECT b.entity, b.date, b.close, CASE WHEN b.date > min(b.date) OVER (PARTITION BY b.entity) THEN coalesce(f.af, 1) ELSE 1 END AS af FROM bars b LEFT JOIN factors f ON f.entity = b.entity AND f.date = b.date)
 SELECT r.entity, r.asof, a.date, {rnd("floor(a.close * coalesce((SELECT product(x.af) FROM j x WHERE x.entity = r.entity AND x.date > a.date AND x.date <= r.asof), 1) * 10000 + 0.5) / 10000", 'adj_close', 3)}
 FROM requests r JOIN j a ON a.entity = r.entity AND a.date <= r.asof AND a.date >= r.asof - 30""")
def _asof_adjusted(spark, d):
    b = V.bars(spark, d)
    df = P.asof_adjusted(quarter_requests(spark, d), b, P.adjustment_factors(V.adj_events(spark, d), b), 30)
    # the operator itself rounds to 4 decimals; the comparison is made on 3
    return tidy(df, "entity", "asof", "date", "adj_close", digits=3)


# --- joins ------------------------------------------------------------------------------------------------
@query("market_weight", "C1", f"""WITH {BARS}, {INFO}, r AS (SELECT entity, date, close / 500 AS ratio FROM bars), c AS (SELECT entity, date, CASE WHEN volume > 8 THEN close END AS close FROM bars), sh AS (SELECT entity, CASE WHEN balance > 0 THEN 1000 + floor(balance) END AS shares FROM entity_info),
 j AS (SELECT r.*, c.close * sh.shares AS mv FROM r LEFT JOIN c ON c.entity = r.entity AND c.date = r.date LEFT JOIN sh ON sh.entity = r.entity), t AS (SELECT date, sum(mv) AS total FROM j GROUP BY date)
 SELECT j.entity, j.date, {rnd('ratio')}, {rnd('mv', 'market_value', 2)}, {rnd('CASE WHEN total > 0 THEN mv / total END', 'weight', 8)} FROM j LEFT JOIN t ON t.date = j.date""")
def _weight(spark, d):
    b = V.bars(spark, d)
    r = b.select("entity", "date", (F.col("close") / 500).alias("ratio"))
    c = b.select("entity", "date", F.when(F.col("volume") > 8, F.col("close")).alias("close"))
    sh = V.entity_info(spark, d).select("entity", F.when(F.col("balance") > 0, 1000 + F.floor("balance")).alias("shares"))
    w = J.market_weight(r, c, sh)
    return w.select("entity", "date", *[(F.floor(F.col(c) * s + 0.50001) / s).alias(c) for c, s in (("ratio", 1e4), ("market_value", 1e2), ("weight", 1e8))])


@query("day_trade_ratio", "C2", f"""WITH {BARS}, t AS (SELECT entity, date, CASE WHEN volume > 12 THEN volume END AS total FROM bars) SELECT b.entity, b.date, {rnd('CASE WHEN t.total > 0 THEN (b.volume // 2) * 100.0 / t.total END', 'ratio')} FROM bars b LEFT JOIN t ON t.entity = b.entity AND t.date = b.date""")
def _day_trade(spark, d):
    b = V.bars(spark, d)
    part = b.select("entity", "date", F.expr("volume div 2").alias("part"))
    total = b.select("entity", "date", F.when(F.col("volume") > 12, F.col("volume")).alias("total"))
    return tidy(J.share_of_total(part, total, ["entity", "date"]), "entity", "date", "ratio")


@query("outer_merge_balances", "C3,C5", f"""WITH {BARS}, a AS (SELECT entity, date, volume AS margin FROM bars WHERE volume > 12), b AS (SELECT entity, date, close AS lending FROM bars WHERE volume < 40)
 SELECT coalesce(a.entity, b.entity) AS entity, coalesce(a.date, b.date) AS date, margin, lending FROM a FULL JOIN b ON a.entity = b.entity AND a.date = b.date""")
def _outer(spark, d):
    b = V.bars(spark, d)
    return J.outer_merge(b.filter("volume > 12").select("entity", "date", F.col("volume").alias("margin")), b.filter("volume < 40").select("entity", "date", F.col("close").alias("lending")), ["entity", "date"])


@query("outer_merge_pivoted_totals", "C4", f"""WITH {INST}, {REVENUE}, r AS (SELECT date, avg(revenue) / 1000000 AS ratio FROM period_revenue GROUP BY date),
 t AS (SELECT date, CAST(sum(CASE WHEN investor_type = '1-URGENT' THEN buy END) AS BIGINT) AS total_purchase, CAST(sum(CASE WHEN investor_type = '5-LOW' THEN sell END) AS BIGINT) AS total_short FROM inst_long GROUP BY date)
 SELECT coalesce(r.date, t.date) AS date, {rnd('ratio')}, total_purchase, total_short FROM r FULL JOIN t ON r.date = t.date""")
def _outer_pivot(spark, d):
    i = V.inst_long(spark, d)
    r = V.period_revenue(spark, d).groupBy("date").agg((F.avg("revenue") / 1000000).alias("ratio"))
    t = i.groupBy("date").agg(F.sum(F.when(F.col("investor_type") == "1-URGENT", F.col("buy"))).alias("total_purchase"), F.sum(F.when(F.col("investor_type") == "5-LOW", F.col("sell"))).alias("total_short"))
    return tidy(J.outer_merge(r, t, ["date"]), "date", "ratio", "total_purchase", "total_short")


@query("latest_per_key", "C6", f"WITH {FACTS} SELECT entity, source, timeframe, max(fact_date) AS fact_date, CAST(max(event_id) AS BIGINT) AS event_id FROM facts WHERE fact_date <= DATE '{AT}' GROUP BY 1, 2, 3")
def _latest(spark, d):
    f = V.facts(spark, d).filter(F.col("fact_date") <= AT)
    daily = f.groupBy("entity", "source", "timeframe", "fact_date").agg(F.max("event_id").alias("event_id"))
    return P.latest_per_key(daily, ["entity", "source", "timeframe"], "fact_date", ["event_id"])


@query("asof_with_tolerance", "C7", f"""WITH {BARS}, {REQUESTS}, sh AS (SELECT entity, date, CASE WHEN close >= open AND volume >= 40 THEN volume * 100 END AS shares FROM bars),
 a AS (SELECT r.entity, r.asof, s.date AS matched, s.shares FROM requests r ASOF LEFT JOIN (SELECT * FROM sh WHERE shares IS NOT NULL) s ON s.entity = r.entity AND r.asof >= s.date)
 SELECT a.entity, a.asof, CASE WHEN a.asof - a.matched <= 60 THEN a.matched END AS matched, CASE WHEN a.asof - a.matched <= 60 THEN a.shares END AS shares FROM a""")
def _tolerance(spark, d):
    sh = V.bars(spark, d).select("entity", "date", F.when((F.col("close") >= F.col("open")) & (F.col("volume") >= 40), F.col("volume") * 100).alias("shares"))
    return P.asof_join(quarter_requests(spark, d), sh, ["shares"], tolerance_days=60, skip_null="shares")


@query("close_at_or_before", "C8,K18", f"""WITH {SERIES}, {REQUESTS}, p AS (SELECT *, lag(close) OVER (PARTITION BY entity ORDER BY date) AS prev_close FROM s)
 SELECT r.entity, r.asof, p.date AS matched, p.close, p.prev_close, {rnd('(p.close - p.prev_close) / p.prev_close * 100', 'change_pct')} FROM requests r ASOF LEFT JOIN p ON p.entity = r.entity AND r.asof >= p.date""")
def _close_at(spark, d):
    from tidemark.functions.windows import prev

    b = V.bars(spark, d).select("entity", "date", "close", prev("close").alias("prev_close"))
    df = P.asof_join(quarter_requests(spark, d), b, ["close", "prev_close"])
    return tidy(df.withColumn("change_pct", F.when(F.col("prev_close") > 0, (F.col("close") - F.col("prev_close")) / F.col("prev_close") * 100)))


STAGING = """staging AS (SELECT l_suppkey AS entity, CAST(l_shipdate AS DATE) AS cash_date, CASE WHEN l_linenumber % 2 = 0 THEN CAST(l_shipdate AS DATE) + 1 END AS stock_date, l_tax * 100 AS cash_dividend, l_discount * 10 AS stock_dividend,
   CASE WHEN l_linenumber = 3 THEN floor(l_extendedprice) ELSE 0 END AS subscription_price FROM lineitem WHERE l_returnflag = 'A' AND l_discount >= 0.09)"""


def staging(spark, d):
    li = V.table(spark, d, "lineitem").filter("l_returnflag = 'A' AND l_discount >= 0.09")
    day = F.to_date("l_shipdate")
    return li.select(F.col("l_suppkey").alias("entity"), day.alias("cash_date"), F.when(F.col("l_linenumber") % 2 == 0, F.date_add(day, 1)).alias("stock_date"), (F.col("l_tax") * 100).alias("cash_dividend"), (F.col("l_discount") * 10).alias("stock_dividend"),
                     F.when(F.col("l_linenumber") == 3, F.floor("l_extendedprice")).otherwise(0).cast("double").alias("subscription_price"))


MIXED = "mixed AS (SELECT entity, date, 'dividend' AS event_type, CASE WHEN close >= open THEN 1.0 END AS cash_dividend, CASE WHEN close >= open THEN 0.0 END AS stock_dividend FROM bars)"


def mixed_events(spark, d):
    return V.bars(spark, d).select("entity", "date", F.lit("dividend").alias("event_type"), F.when(F.col("close") >= F.col("open"), 1.0).alias("cash_dividend"), F.when(F.col("close") >= F.col("open"), 0.0).alias("stock_dividend"))


@query("mixed_dividend_patch", "C9", f"""WITH {BARS}, {STAGING}, {MIXED}, days AS (SELECT entity, cash_date AS date, cash_dividend AS c, stock_dividend AS s FROM staging UNION ALL SELECT entity, stock_date, cash_dividend, stock_dividend FROM staging WHERE stock_date IS NOT NULL),
 best AS (SELECT * FROM days QUALIFY row_number() OVER (PARTITION BY entity, date ORDER BY c DESC, s DESC) = 1)
 SELECT m.entity, m.date, {rnd('CASE WHEN m.cash_dividend IS NULL AND m.stock_dividend IS NULL THEN b.c ELSE m.cash_dividend END', 'cash_dividend')}, {rnd('CASE WHEN m.cash_dividend IS NULL AND m.stock_dividend IS NULL THEN b.s ELSE m.stock_dividend END', 'stock_dividend')} FROM mixed m LEFT JOIN best b ON b.entity = m.entity AND b.date = m.date""")
def _mixed(spark, d):
    return tidy(J.patch_mixed(mixed_events(spark, d), staging(spark, d)), "entity", "date", "cash_dividend", "stock_dividend")


@query("missing_capital_increases", "C10", f"""WITH {ADJ}, {STAGING}, i AS (SELECT DISTINCT entity, coalesce(stock_date, cash_date) AS date FROM staging WHERE subscription_price > 0)
 SELECT entity, date, 'capital_increase' AS event_type, CAST(1.0 AS DOUBLE) AS volume_factor FROM i WHERE NOT EXISTS (SELECT 1 FROM adj_events a WHERE a.entity = i.entity AND a.date = i.date AND a.event_type = 'capital_increase')""")
def _increases(spark, d):
    return J.missing_increases(V.adj_events(spark, d), staging(spark, d)).select("entity", "date", "event_type", "volume_factor")


@query("stock_dividend_volume_factor", "C11", f"""WITH {ADJ} SELECT entity, date, {rnd("CASE WHEN event_type = 'dividend' AND stock_dividend > 0 AND abs(coalesce(volume_factor, 1.0) - 1) < 0.0001 THEN 1 / (1 + stock_dividend / 10) ELSE coalesce(volume_factor, 1.0) END", 'volume_factor', 6)} FROM adj_events""")
def _sd_factor(spark, d):
    e = V.adj_events(spark, d).withColumn("volume_factor", F.coalesce("volume_factor", F.lit(1.0)))
    return tidy(e.withColumn("volume_factor", J.stock_dividend_volume_factor()), "entity", "date", "volume_factor", digits=6)


@query("entity_dimension_lookup", "C12", f"WITH {REVENUE}, {INFO} SELECT r.entity, r.date, r.revenue, i.name, i.industry FROM period_revenue r LEFT JOIN entity_info i ON i.entity = r.entity")
def _dim(spark, d):
    return V.period_revenue(spark, d).select("entity", "date", "revenue").join(V.entity_info(spark, d).select("entity", "name", "industry"), "entity", "left")


@query("series_alignment", "C14", f"""WITH {BARS}, {REVENUE}, a AS (SELECT entity, date, close AS lead FROM bars), b AS (SELECT entity, date, CAST(revenue AS DOUBLE) AS follow FROM period_revenue)
 SELECT coalesce(a.entity, b.entity) AS entity, coalesce(a.date, b.date) AS date, coalesce("lead", 0.0) AS "lead", coalesce(follow, 0.0) AS follow FROM a FULL JOIN b ON a.entity = b.entity AND a.date = b.date""".replace("AS lead", 'AS "lead"'))
def _align(spark, d):
    lead = V.bars(spark, d).select("entity", "date", F.col("close").alias("lead"))
    follow = V.period_revenue(spark, d).select("entity", "date", F.col("revenue").cast("double").alias("follow"))
    return J.align_on_date(lead, follow, fill=0.0)


@query("statement_alignment", "C15", f"""WITH {STATEMENT} SELECT entity, date, """ + ", ".join(f"sum(CASE WHEN statement_type = '{t}' THEN value END) AS {t}" for t in ("income", "balance", "cashflow")) + " FROM statement_long GROUP BY entity, date")
def _align3(spark, d):
    return V.statement_long(spark, d).groupBy("entity", "date").pivot("statement_type", ["income", "balance", "cashflow"]).agg(F.sum("value"))


@query("changed_keys", "C16,M2", f"WITH {BARS} SELECT DISTINCT entity FROM bars WHERE volume >= 120 OR entity NOT IN (SELECT entity FROM bars WHERE volume >= 45 AND date < DATE '1995-06-01')")
def _changed(spark, d):
    b = V.bars(spark, d)
    return J.changed_keys(b.filter("volume >= 120"), b, b.filter("volume >= 45 AND date < DATE '1995-06-01'"), ["entity"])
