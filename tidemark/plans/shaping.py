"""Queries for scans, ingestion shaping and sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import aggregates as A
from tidemark.operators import pit as P
from tidemark.plans.ctes import ADJ, BARS, FACTS, INFO, INST, LEVELS, REVENUE, SERIES, STATEMENT
from tidemark.plans.events import LOAN_SQL, STATEMENT_SQL, loans, statements
from tidemark.plans.registry import query, rnd, rnds, tidy
from tidemark.sources import shaping as S
from tidemark.session import checkpoint_dir
from tidemark.sources import views as V
from tidemark.sources.segments import Segments

SPLIT = "2000-01-01"


@query("keyed_scan_since", "A1", f"""SELECT CAST(l_shipdate AS DATE) AS date, l_suppkey AS entity, l_quantity AS quantity FROM lineitem
 WHERE CAST(l_shipdate AS DATE) >= DATE '{SPLIT}'""")
def _scan(spark, d):
    li = V.table(spark, d, "lineitem").filter(F.col("l_shipdate") >= F.lit(SPLIT).cast("timestamp"))
    return li.select(F.to_date("l_shipdate").alias("date"), F.col("l_suppkey").alias("entity"), F.col("l_quantity").alias("quantity"))


@query("latest_bars_per_entity", "A2", f"""WITH {BARS} SELECT * FROM bars QUALIFY row_number() OVER (PARTITION BY entity ORDER BY date DESC) <= 120""")
def _last_bars(spark, d):
    return S.last_bars(V.bars(spark, d), 120)


REVENUE_SCHEMA = T.StructType([T.StructField("entity", T.StringType()), T.StructField("date", T.DateType()), T.StructField("revenue", T.DoubleType()),
                               T.StructField("revenue_month", T.ShortType()), T.StructField("note", T.StringType())])


@query("typed_series_loader", "A3", f"WITH {REVENUE} SELECT CAST(entity AS VARCHAR) AS entity, date, CAST(revenue AS DOUBLE) AS revenue, CAST(revenue_month AS SMALLINT) AS revenue_month, CAST(NULL AS VARCHAR) AS note FROM period_revenue")
def _typed(spark, d):
    return S.typed(V.period_revenue(spark, d), REVENUE_SCHEMA)


@query("keyed_upsert", "A4,H1", f"""WITH {BARS}, u AS (SELECT entity, date, close, volume, 1 AS version FROM bars WHERE date < DATE '{SPLIT}'
   UNION ALL SELECT entity, date, close, volume * 2, 2 FROM bars WHERE date >= DATE '{SPLIT}' - 180)
 SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY entity, date ORDER BY version DESC) = 1""")
def _upsert(spark, d):
    b = V.bars(spark, d).select("entity", "date", "close", "volume")
    old = b.filter(F.col("date") < SPLIT).withColumn("version", F.lit(1))
    new = b.filter(F.col("date") >= F.date_sub(F.lit(SPLIT).cast("date"), 180)).select("entity", "date", "close", (F.col("volume") * 2).alias("volume"), F.lit(2).alias("version"))
    return S.upsert(old, new, ["entity", "date"], "version")


@query("append_new_facts", "A5,H2,H4,I8", f"""WITH {FACTS}, f AS (SELECT entity, fact_date, timeframe, source, md5(concat(event_kind, ' on ', CAST(fact_date AS VARCHAR))) AS statement_hash, k FROM facts)
 SELECT DISTINCT entity, fact_date, timeframe, source, statement_hash FROM f
 WHERE (entity, fact_date, timeframe, source, statement_hash) NOT IN (SELECT (entity, fact_date, timeframe, source, statement_hash) FROM f WHERE k < 50)""")
def _append(spark, d):
    keys = ["entity", "fact_date", "timeframe", "source", "statement_hash"]
    f = V.facts(spark, d).withColumn("statement_hash", F.md5(F.concat(F.col("event_kind"), F.lit(" on "), F.col("fact_date").cast("string"))))
    return S.append_new(f.filter("k < 50"), f.select(*keys), keys)


@query("forecast_upsert_immutable", "A6", f"""WITH {SERIES}, o AS (SELECT entity, date AS forecast_date, close AS point, CASE WHEN date < DATE '1999-01-01' THEN date + 30 END AS resolved_date, 1 AS version FROM s),
 n AS (SELECT entity, date AS forecast_date, close * 2 AS point, CAST(NULL AS DATE) AS resolved_date, 2 AS version FROM s)
 SELECT entity, forecast_date, point, resolved_date, version FROM (SELECT * FROM o UNION ALL SELECT * FROM n)
 QUALIFY row_number() OVER (PARTITION BY entity, forecast_date ORDER BY resolved_date IS NOT NULL DESC, version DESC) = 1""")
def _forecast_upsert(spark, d):
    from tidemark.operators.indicators import indexed

    b = indexed(V.bars(spark, d))
    old = b.select("entity", F.col("date").alias("forecast_date"), F.col("close").alias("point"), F.when(F.col("date") < "1999-01-01", F.date_add("date", 30)).alias("resolved_date"), F.lit(1).alias("version"))
    new = b.select("entity", F.col("date").alias("forecast_date"), (F.col("close") * 2).alias("point"), F.lit(None).cast("date").alias("resolved_date"), F.lit(2).alias("version"))
    return S.upsert_forecasts(old, new, ["entity", "forecast_date"], "version")


@query("rename_and_pack", "A7,B2", """SELECT user_id AS entity, ts AS seen_at, event_type AS category, CAST(event_id AS VARCHAR) AS detail_id, 'events' AS market FROM events""")
def _rename(spark, d):
    df = S.rename_and_pack(V.table(spark, d, "events"), {"user_id": "entity", "ts": "seen_at", "event_type": "category", "event_id": "_id", "value": "_value"}, {"market": "events"})
    return df.select("entity", "seen_at", "category", F.col("detail")["id"].alias("detail_id"), "market")


_EXPECTED = ["event_id", "ts", "user_id", "event_type", "currency", "region"]


@query("schema_drift_report", "A8", "SELECT 'event_id' AS field, 'ok' AS status, count(event_id) AS filled FROM events UNION ALL SELECT 'ts', 'ok', count(ts) FROM events UNION ALL SELECT 'user_id', 'ok', count(user_id) FROM events "
       "UNION ALL SELECT 'event_type', 'ok', count(event_type) FROM events UNION ALL SELECT 'value', 'novel', count(value) FROM events UNION ALL SELECT 'props', 'novel', count(props) FROM events "
       "UNION ALL SELECT 'currency', 'missing', count(*) FILTER (false) FROM events UNION ALL SELECT 'region', 'missing', count(*) FILTER (false) FROM events")
def _drift(spark, d):
    return S.drift_report(V.table(spark, d, "events"), _EXPECTED)


@query("volume_factor", "A9", f"""WITH {ADJ} SELECT entity, date, {rnd("CASE WHEN event_type = 'dividend' THEN 1.0 ELSE coalesce(reference_price / nullif(before_price, 0), 1.0) END", 'factor')} FROM (
   SELECT entity, date, CASE WHEN before_price IS NOT NULL THEN 'split' ELSE event_type END AS event_type, before_price, reference_price FROM adj_events)""")
def _volume_factor(spark, d):
    e = V.adj_events(spark, d).withColumn("event_type", F.when(F.col("before_price").isNotNull(), "split").otherwise(F.col("event_type")))
    return tidy(e.withColumn("factor", S.volume_factor()), "entity", "date", "factor")


_SUBTYPE = "CASE WHEN before_price IS NOT NULL THEN 'mixed' WHEN cash_dividend > 0 THEN 'cash' WHEN subscription_price > 0 THEN 'stock' END"


@query("dividend_split", "A10", f"""WITH {ADJ}, t AS (SELECT entity, date, {_SUBTYPE} AS subtype, coalesce(cash_dividend, 0) + coalesce(subscription_rate, 0) AS combined FROM adj_events)
 SELECT entity, date, subtype, {rnd("CASE WHEN subtype = 'cash' THEN combined WHEN subtype = 'stock' THEN 0 END", 'cash_dividend')},
   {rnd("CASE WHEN subtype = 'cash' THEN 0 WHEN subtype = 'stock' THEN combined END", 'stock_dividend')} FROM t""")
def _dividend_split(spark, d):
    e = V.adj_events(spark, d).select("entity", "date", F.expr(_SUBTYPE).alias("subtype"), F.expr("coalesce(cash_dividend, 0) + coalesce(subscription_rate, 0)").alias("combined"))
    return tidy(e.withColumns(S.split_dividend("subtype", "combined")), "entity", "date", "subtype", "cash_dividend", "stock_dividend")


@query("first_per_day", "A11", """SELECT event_type AS category, CAST(ts AS DATE) AS date, min(ts) AS ts, arg_min(value, ts) AS value, arg_min(user_id, ts) AS user_id FROM events GROUP BY 1, 2""")
def _first(spark, d):
    e = V.table(spark, d, "events").select(F.col("event_type").alias("category"), "ts", "value", "user_id")
    return S.first_per_day(e, "category", "ts").select("category", "date", "ts", "value", "user_id")


@query("universe_filter", "A12", f"WITH {BARS}, {INFO} SELECT entity, date, close FROM bars WHERE entity IN (SELECT entity FROM entity_info WHERE delisting_date IS NULL)")
def _universe(spark, d):
    live = V.entity_info(spark, d).filter("delisting_date is null").select("entity")
    return V.bars(spark, d).select("entity", "date", "close").join(live, "entity", "left_semi")


@query("backfill_ranges", "A13", """WITH g AS (SELECT l_suppkey AS entity, CAST(min(l_shipdate) AS DATE) AS a, CAST(max(l_shipdate) AS DATE) AS b FROM lineitem GROUP BY 1),
 r AS (SELECT entity, b, CAST(unnest(generate_series(a, b, INTERVAL 90 DAY)) AS DATE) AS range_start FROM g)
 SELECT entity, range_start, least(range_start + 89, b) AS range_end FROM r""")
def _ranges(spark, d):
    spans = V.table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("entity")).agg(F.to_date(F.min("l_shipdate")).alias("start"), F.to_date(F.max("l_shipdate")).alias("end"))
    return S.day_ranges(spans, 90).select("entity", "range_start", "range_end")


@query("report_date_from_text", "A14,I7", f"""WITH {REVENUE} SELECT entity, date, CASE WHEN regexp_matches(create_time, '^\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN CAST(substr(create_time, 1, 10) AS DATE) END AS report_date FROM period_revenue""")
def _report_date(spark, d):
    return V.period_revenue(spark, d).select("entity", "date", P.report_date().alias("report_date"))


_SHADOW = """e AS (SELECT entity, date, 'split' AS event_type, before_price, reference_price FROM adj_events
   UNION ALL SELECT entity, date, 'par_value_change', before_price, CASE WHEN entity % 2 = 0 THEN reference_price ELSE coalesce(reference_price, 0) + 1 END FROM adj_events)"""


@query("drop_shadowed_events", "A15,H3", f"""WITH {ADJ}, {_SHADOW} SELECT entity, date, event_type, {rnds('before_price reference_price')} FROM e WHERE NOT (event_type = 'split' AND EXISTS (
   SELECT 1 FROM e b WHERE b.event_type = 'par_value_change' AND b.entity = e.entity AND b.date = e.date AND b.before_price IS NOT DISTINCT FROM e.before_price AND b.reference_price IS NOT DISTINCT FROM e.reference_price))""")
def _shadowed(spark, d):
    a = V.adj_events(spark, d).select("entity", "date", "before_price", "reference_price")
    s = a.withColumn("event_type", F.lit("split"))
    p = a.withColumn("event_type", F.lit("par_value_change")).withColumn("reference_price", F.when(F.col("entity") % 2 == 0, F.col("reference_price")).otherwise(F.coalesce("reference_price", F.lit(0.0)) + 1))
    return tidy(S.drop_shadowed(s.unionByName(p), "split", "par_value_change", ["before_price", "reference_price"]), "entity", "date", "event_type", "before_price", "reference_price")


@query("materialise_missing", "A16", f"""WITH {BARS} SELECT entity, date, 'v2' AS version, close FROM bars WHERE date BETWEEN DATE '1998-01-01' AND DATE '2000-12-31' AND NOT (close > open)""")
def _missing(spark, d):
    b = V.bars(spark, d)
    stored = b.filter(F.col("close") > F.col("open")).select("entity", "date", F.lit("v2").alias("version"))
    due = b.filter(F.col("date").between("1998-01-01", "2000-12-31")).select("entity", "date", F.lit("v2").alias("version"), "close")
    return due.join(stored, ["entity", "date", "version"], "left_anti")


PARAMS = {"period": 20, "k": 2.0}


@query("provenance_columns", "A17,I8", f"WITH {REVENUE} SELECT entity, date, revenue, 'revenue' AS source_name, '1.0' AS source_version, '{S.params_hash(PARAMS)}' AS params_hash FROM period_revenue")
def _provenance(spark, d):
    return S.with_provenance(V.period_revenue(spark, d).select("entity", "date", "revenue"), "revenue", "1.0", PARAMS)


@query("universe_and_lag", "A18", f"WITH {BARS}, m AS (SELECT max(date) AS newest FROM bars) SELECT entity, max(date) AS last_date, CAST(max(newest) - max(date) AS INTEGER) AS lag_days FROM bars, m GROUP BY entity")
def _lag(spark, d):
    last = V.table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("entity")).agg(F.to_date(F.max("l_shipdate")).alias("last_date"))
    newest = V.table(spark, d, "lineitem").agg(F.to_date(F.max("l_shipdate")).alias("newest"))
    return last.join(F.broadcast(newest)).select("entity", "last_date", F.datediff("newest", "last_date").alias("lag_days"))


@query("table_health", "A19", """SELECT 'lineitem' AS table_name, count(*) AS n_rows, CAST(max(l_shipdate) AS DATE) AS newest FROM lineitem
 UNION ALL SELECT 'orders', count(*), CAST(max(o_orderdate) AS DATE) FROM orders UNION ALL SELECT 'events', count(*), CAST(max(ts) AS DATE) FROM events UNION ALL SELECT 'supplier', count(*), NULL FROM supplier""")
def _health(spark, d):
    t = lambda n: V.table(spark, d, n)
    return S.table_health({"lineitem": (t("lineitem"), "l_shipdate"), "orders": (t("orders"), "o_orderdate"), "events": (t("events"), "ts"), "supplier": (t("supplier"), None)})


# --- aggregates -----------------------------------------------------------------------------------------
SYNONYMS = {"1-URGENT": "foreign", "2-HIGH": "foreign_self", "3-MEDIUM": "trust", "4-NOT SPECIFIED": "dealer", "5-LOW": "dealer_hedge"}


@query("pivot_categories", "D1", f"WITH {INST} SELECT entity, date, " + ", ".join(f"max(CASE WHEN investor_type = '{k}' THEN {m} END) AS {v}_{m}" for k, v in SYNONYMS.items() for m in ("buy", "sell")) + " FROM inst_long GROUP BY entity, date")
def _pivot(spark, d):
    return A.pivot_categories(V.inst_long(spark, d), SYNONYMS, ["buy", "sell"])


@query("net_sum", "D2", f"WITH {INST} SELECT entity, date, CAST(sum(buy) - sum(sell) AS BIGINT) AS net FROM inst_long GROUP BY entity, date")
def _net(spark, d):
    return A.net_sum(V.inst_long(spark, d))


@query("pack_statement_items", "D3,B10", f"""WITH {STATEMENT} SELECT entity, date, statement_type, max(CASE WHEN item = 'F' THEN value END) AS item_f, max(CASE WHEN item = 'O' THEN value END) AS item_o_per,
   coalesce(max(CASE WHEN item = 'O' THEN value END), max(CASE WHEN item = 'F' THEN value END)) AS first_found, CAST(count(*) AS INTEGER) AS items FROM statement_long GROUP BY 1, 2, 3""")
def _pack(spark, d):
    df = A.pack_items(V.statement_long(spark, d), ["entity", "date", "statement_type"], "item", "value", percent=F.col("item") == "O")
    at = lambda k: F.try_element_at("detail", F.lit(k))
    return df.select("entity", "date", "statement_type", at("F").alias("item_f"), at("O_per").alias("item_o_per"), A.map_first("detail", ["Revenue", "O_per", "F"]).alias("first_found"), F.size("detail").alias("items"))


@query("pack_holding_levels", "D3", f"WITH {LEVELS} SELECT entity, CAST(count(*) AS INTEGER) AS levels, max(CASE WHEN level = 5 THEN people END) AS level5_people, max(CASE WHEN level = 5 THEN unit END) AS level5_unit FROM holding_levels GROUP BY entity")
def _pack_levels(spark, d):
    df = A.pack_structs(V.holding_levels(spark, d), ["entity"], "level", ["people", "unit"])
    five = F.try_element_at("detail", F.lit("5"))
    return df.select("entity", F.size("detail").alias("levels"), five["people"].alias("level5_people"), five["unit"].alias("level5_unit"))


@query("block_trade_rollup", "D4", f"""WITH t AS (SELECT l_suppkey AS entity, CAST(l_shipdate AS DATE) AS date, l_returnflag AS tt, CAST(l_quantity AS BIGINT) AS v, CAST(floor(l_extendedprice) AS BIGINT) AS m FROM lineitem)
 SELECT entity, date, CAST(sum(v) AS BIGINT) AS total_volume, CAST(sum(m) AS BIGINT) AS total_money, CAST(sum(CASE WHEN tt = 'A' THEN v ELSE 0 END) AS BIGINT) AS matching_volume, CAST(sum(CASE WHEN tt = 'A' THEN m ELSE 0 END) AS BIGINT) AS matching_money,
   {rnd("sum(CASE WHEN tt = 'A' THEN v ELSE 0 END) / sum(v)", 'matching_share')}, max(m) AS largest_trade, count(DISTINCT tt) AS trade_types, CAST(sum(CASE WHEN tt = 'N' THEN m END) AS BIGINT) AS money_n FROM t GROUP BY 1, 2""")
def _blocks(spark, d):
    li = V.table(spark, d, "lineitem").select(F.col("l_suppkey").alias("entity"), F.to_date("l_shipdate").alias("date"), F.col("l_returnflag").alias("trade_type"), F.col("l_quantity").cast("long").alias("volume"), F.floor("l_extendedprice").cast("long").alias("money"))
    df = A.block_rollup(li, "A").withColumn("money_n", F.try_element_at("detail", F.lit("N"))["money"]).drop("detail")
    return tidy(df)


def _period_sql(unit):
    return f"""WITH {BARS} SELECT entity, CAST(date_trunc('{unit}', date) AS DATE) AS period, arg_min(open, date) AS open, max(high) AS high, min(low) AS low, arg_max(close, date) AS close, CAST(sum(volume) AS BIGINT) AS volume, count(*) AS days FROM bars GROUP BY 1, 2"""


@query("weekly_bars", "D5,I5", _period_sql("week"))
def _weekly(spark, d):
    return A.period_bars(V.bars(spark, d), "week")


@query("monthly_bars", "D6", _period_sql("month"))
def _monthly(spark, d):
    return A.period_bars(V.bars(spark, d), "month")


@query("loan_totals_dominant", "D7", f"WITH {LOAN_SQL} SELECT entity, date, CAST(total AS BIGINT) AS total, dominant, {rnd('dominant_ratio')} FROM ind")
def _loan_totals(spark, d):
    return tidy(loans(spark, d), "entity", "date", "total", "dominant", "dominant_ratio")


@query("holder_buckets", "D9", f"""WITH {LEVELS} SELECT entity, """ + ", ".join(f"CAST(sum(CASE WHEN level BETWEEN {min(r)} AND {max(r)} THEN {c} ELSE 0 END) AS BIGINT) AS {n}_{c}" for n, r in A.HOLDER_CLASSES.items() for c in ("people", "unit"))
       + f", CAST(sum(people) AS BIGINT) AS total_people, CAST(sum(unit) AS BIGINT) AS total_unit, {rnd('CASE WHEN sum(unit) > 0 THEN sum(CASE WHEN level >= 7 THEN unit ELSE 0 END) / sum(unit) ELSE 0 END', 'concentration', 6)} FROM holding_levels GROUP BY entity")
def _buckets(spark, d):
    return tidy(A.holder_buckets(V.holding_levels(spark, d)), digits=6)


@query("period_growth", "E5", f"""WITH {REVENUE}, g AS (SELECT a.*, CASE WHEN y.revenue > 0 THEN least(greatest((a.revenue - y.revenue) * 100.0 / y.revenue, -999999.9999), 999999.9999) END AS yoy,
   CASE WHEN m.revenue > 0 THEN least(greatest((a.revenue - m.revenue) * 100.0 / m.revenue, -999999.9999), 999999.9999) END AS mom FROM period_revenue a
   LEFT JOIN period_revenue y ON y.entity = a.entity AND y.date = a.date - INTERVAL 1 YEAR LEFT JOIN period_revenue m ON m.entity = a.entity AND m.date = a.date - INTERVAL 1 MONTH)
 SELECT entity, date, revenue, {rnds('yoy mom')} FROM g""")
def _growth(spark, d):
    return tidy(A.period_growth(V.period_revenue(spark, d)), "entity", "date", "revenue", "yoy", "mom")


@query("cumulative_growth", "D14", f"""WITH {REVENUE}, c AS (SELECT *, CAST(sum(revenue) OVER (PARTITION BY entity, revenue_year ORDER BY date) AS BIGINT) AS cumulative FROM period_revenue),
 y AS (SELECT entity, revenue_year, sum(revenue) AS total FROM period_revenue GROUP BY 1, 2)
 SELECT c.entity, c.date, c.cumulative, {rnd('CASE WHEN y.total > 0 THEN (c.cumulative - y.total) * 100.0 / y.total ELSE 0 END', 'cumulative_yoy')} FROM c LEFT JOIN y ON y.entity = c.entity AND y.revenue_year = c.revenue_year - 1""")
def _cumulative(spark, d):
    return tidy(A.cumulative_growth(V.period_revenue(spark, d)), "entity", "date", "cumulative", "cumulative_yoy")


@query("statement_ratios", "E38,C15", f"WITH {STATEMENT_SQL} SELECT entity, date, {rnds('gross_margin debt_ratio free_cash_flow roe roa')} FROM ind")
def _ratios(spark, d):
    return tidy(statements(spark, d), "entity", "date", "gross_margin", "debt_ratio", "free_cash_flow", "roe", "roa")


@query("resumed_segments", "A4,A16,M8", f"""WITH {BARS} SELECT CAST(year(date) AS INTEGER) AS year, entity, date, close, volume FROM bars""")
def _resumed(spark, d):
    """Bars written year by year by a run that is stopped midway and a second one that does the rest."""
    b = V.bars(spark, d)
    span = b.agg(F.min(F.year("date")), F.max(F.year("date"))).first()
    years = [str(y) for y in range(span[0], span[1] + 1)] if span[0] else []
    path = f"{checkpoint_dir(spark)}/segments-{uuid.uuid4().hex}"
    done = []

    def job(year, stop_after=None):
        if stop_after is not None and len(done) == stop_after:
            raise InterruptedError(year)
        done.append(year)
        return b.where(F.year("date") == int(year)).withColumn("year", F.year("date"))

    table = Segments(spark, path, "year int, entity long, date date, close double, volume long")
    try:
        table.run(years, lambda y: job(y, len(years) // 2))
    except InterruptedError:
        Segments(spark, path, "year int, entity long, date date, close double, volume long").run(years, job)
    if done != years:
        raise RuntimeError("a committed segment was done again")
    return table.read()
