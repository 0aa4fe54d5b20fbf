"""Queries through SQL functions, the indicator catalogue and declared sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import surface
from tidemark.operators import catalogue as C
from tidemark.operators import forecast as FC
from tidemark.plans import forecast as PF
from tidemark.plans.registry import ORACLES, query, rnd, tidy
from tidemark.sources import declared as DC
from tidemark.sources import views as V


@query("swing_legs_table_function", "L1,N", ORACLES["swing_legs"])
def _legs(spark, d):
    surface.register(spark)
    return tidy(spark.sql("SELECT * FROM swing_legs(TABLE({bars}))", bars=V.bars(spark, d)), digits=3)


@query("cqr_quantile_aggregate", "J10,N", f"""WITH {PF.SETTLED_SQL}, e AS (SELECT *, greatest(lower - realized, realized - upper) AS miss FROM settled),
 g AS (SELECT entity, source, horizon, confidence, list_sort(list(miss)) AS l, count(miss) AS n FROM e GROUP BY ALL)
 SELECT entity, source, horizon, confidence, {rnd('CASE WHEN n >= 30 THEN l[CAST(ceil((n + 1) * confidence - 1e-9) AS INTEGER)] END', 'q', 2)} FROM g""")
def _cqr(spark, d):
    surface.register(spark)
    grid = [(s, h, c) for s in PF.SOURCES for h in FC.HORIZONS for c in FC.CONFIDENCES]
    missed = PF.issued(spark, d, realized=True).select("entity", *[m.alias(f"m{i}") for i, m in enumerate(FC.misses(PF.both()))])
    # an entity's misses meet in one row per bar, a column for each cell
    calls = ", ".join(f"cqr_quantile(m{i}, {c}D) AS q{i}, known(m{i}) AS n{i}" for i, (_, _, c) in enumerate(grid))
    g = spark.sql(f"SELECT entity, {calls} FROM {{missed}} GROUP BY entity", missed=missed)
    rows = F.array(*[F.struct(F.lit(s).alias("source"), F.lit(h).alias("horizon"), F.lit(c).alias("confidence"), F.col(f"q{i}").alias("q"), F.col(f"n{i}").alias("n")) for i, (s, h, c) in enumerate(grid)])
    return tidy(g.select("entity", F.inline(rows)).filter("n > 0").drop("n"), digits=2)


SINCE = "2000-01-01"
CATALOGUE = {"bollinger": ("bollinger_bands", 4), "donchian": ("donchian_channel", 3), "rsi": ("rsi", 4), "macd": ("macd", 2)}
for _name, (_full, _digits) in CATALOGUE.items():

    @query(f"{_name}_since", "N,M1", f"SELECT * FROM ({ORACLES[_full]}) WHERE date >= DATE '{SINCE}'")
    def _since(spark, d, name=_name, digits=_digits):
        return tidy(C.compute(name, V.bars(spark, d), SINCE), digits=digits)


DECLARED = {
    "trades": DC.Source("lineitem", "entity bigint, date date, volume double, money double, discount double, flag string, venue string", stored={"entity": "l_suppkey", "date": "l_shipdate", "volume": "l_quantity", "money": "l_extendedprice", "discount": "l_discount", "flag": "l_returnflag"}, optional=("venue",)),
    "flows": DC.Source("orders", "entity bigint, date date, amount double, investor_type string, settled_on date", stored={"entity": "o_custkey", "date": "o_orderdate", "amount": "o_totalprice", "investor_type": "o_orderpriority"}),
    "facts": DC.Source("events", "entity bigint, date date, source string, value string, k int", stored={"entity": "user_id", "date": "ts", "source": "event_type"}, optional=("k",)),
}


@query("declared_source_scan", "A3,A1", f"SELECT l_suppkey AS entity, CAST(l_shipdate AS DATE) AS date, CAST(l_quantity AS DOUBLE) AS volume, CAST(l_extendedprice AS DOUBLE) AS money, CAST(NULL AS VARCHAR) AS venue FROM lineitem WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '{SINCE}' AND DATE '2001-06-30'")
def _scan(spark, d):
    return DC.load(spark, d, DECLARED["trades"], SINCE, "2001-06-30", columns=["entity", "date", "volume", "money", "venue"])


def _rows(source: str, table: str, fields: list[tuple]) -> str:
    return " UNION ALL ".join(f"SELECT '{source}' AS source, '{f}' AS field, '{s}' AS status, {f'count({c})' if c else 'count(*) FILTER (false)'} AS filled FROM {table}" for f, s, c in fields)


@query("declared_drift", "A3,A8", " UNION ALL ".join([
    _rows("trades", "lineitem", [("entity", "ok", "l_suppkey"), ("date", "widened", "l_shipdate"), ("volume", "ok", "l_quantity"), ("money", "ok", "l_extendedprice"), ("discount", "ok", "l_discount"), ("flag", "ok", "l_returnflag"), ("venue", "absent", None),
                                 *[(c, "novel", c) for c in ("l_orderkey", "l_partkey", "l_linenumber", "l_tax", "l_linestatus")]]),
    _rows("flows", "orders", [("entity", "ok", "o_custkey"), ("date", "widened", "o_orderdate"), ("amount", "ok", "o_totalprice"), ("investor_type", "ok", "o_orderpriority"), ("settled_on", "missing", None), ("o_orderkey", "novel", "o_orderkey"), ("o_orderstatus", "novel", "o_orderstatus")]),
    _rows("facts", "events", [("entity", "ok", "user_id"), ("date", "widened", "ts"), ("source", "ok", "event_type"), ("value", "retyped", "value"), ("k", "absent", None), ("event_id", "novel", "event_id"), ("props", "novel", "props")])]))
def _drift(spark, d):
    return DC.drift(spark, d, DECLARED).select("source", "field", "status", "filled")
