"""Event queries: the catalogue run over indicator frames and keyed series of the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import texts as X
from tidemark.functions.events import Rule, detect, is_pivot_high, is_pivot_low, pivots, with_divergences
from tidemark.operators import detection as D
from tidemark.operators import indicators as I
from tidemark.operators import order_statistics as OS
from tidemark.operators import recursive as R
from tidemark.plans import indicators as P
from tidemark.plans.ctes import INST, REVENUE, SERIES, STATEMENT
from tidemark.plans.registry import query, rnd, tidy
from tidemark.sources import views as V


def stages_sql(sql: str, stages: list[dict[str, str]], src: str = "ind", start: int = 0) -> tuple[str, str]:
    """Chain of CTEs that add the stage columns; returns (sql, name of the last CTE)."""
    for i, st in enumerate(stages, start):
        cols = ", ".join(f"{e} AS {n}" for n, e in st.items())
        sql += f",\n st{i} AS (SELECT *, {cols} FROM {src})"
        src = f"st{i}"
    return sql, src


def rules_sql(sql: str, rules: list[Rule], src: str = "ind", stages: list[dict[str, str]] = (), extra: str = "", digits: int = 3) -> str:
    sql, src = stages_sql(sql, list(stages), src)
    parts = [
        f"SELECT entity, date, idx, '{r.kind}' AS event_kind, '{r.group or r.kind}' AS grp, {r.spacing} AS spacing, value FROM "
        f"(SELECT entity, date, idx, {r.when} AS hit, CAST({r.value} AS DOUBLE) AS value FROM {src}) WHERE hit" for r in rules]
    sql += ",\n cand AS MATERIALIZED (" + "\n UNION ALL ".join(parts) + ")"
    if any(r.spacing for r in rules):
        sql += """,
 hits AS MATERIALIZED (SELECT DISTINCT entity, grp, idx, max(spacing) OVER (PARTITION BY entity, grp) AS sp FROM cand),
 spaced AS MATERIALIZED (SELECT * FROM hits WHERE sp > 0),
 jump AS MATERIALIZED (SELECT entity, grp, idx, min(idx) OVER (PARTITION BY entity, grp ORDER BY idx RANGE BETWEEN sp FOLLOWING AND UNBOUNDED FOLLOWING) AS later FROM spaced),
 kept AS (SELECT entity, grp, min(idx) AS idx FROM spaced GROUP BY entity, grp
   UNION ALL SELECT j.entity, j.grp, j.later FROM kept k JOIN jump j ON j.entity = k.entity AND j.grp = k.grp AND j.idx = k.idx WHERE j.later IS NOT NULL),
 found AS MATERIALIZED (SELECT c.* FROM cand c SEMI JOIN (SELECT entity, grp, idx FROM kept UNION ALL SELECT entity, grp, idx FROM hits WHERE sp = 0) k USING (entity, grp, idx))"""
    else:
        sql += ",\n found AS (SELECT * FROM cand)"
    return f"WITH RECURSIVE {sql}\n SELECT entity, date, event_kind, {rnd('value', digits=digits)} FROM (SELECT entity, date, event_kind, value FROM found{extra})"


def divergence_sql(src: str, price: str, ind: str, report: str | None = None, skip_zero: bool = True) -> str:
    live = f"abs({ind}) >= 1e-12" if skip_zero else "true"
    val = X.nxt(report, 3) if report else ind
    base = f"SELECT entity, date, idx, {price} AS p, {ind} AS v, {val} AS value, {X.nxt('date', 3)} AS cd, {is_pivot_high(price)} AND {live} AS ph, {is_pivot_low(price)} AND {live} AS pl FROM {src}"
    out = []
    for side, kind, a, b in (("ph", "bearish_divergence", ">", "<"), ("pl", "bullish_divergence", "<", ">")):
        alive = "" if skip_zero else " AND v0 > 0"
        out.append(f" UNION ALL SELECT entity, cd, '{kind}', value FROM (SELECT *, lag(idx) OVER ({X.OVER}) AS i0, lag(p) OVER ({X.OVER}) AS p0, lag(v) OVER ({X.OVER}) AS v0 "
                   f"FROM ({base}) WHERE {side}) WHERE idx - i0 >= 12 AND p {a} p0 AND v {b} v0{alive}")
    return "".join(out)


def events_query(name, covers, sql, frame, rules, stages=(), div=None, digits=3):
    """Register one catalogue entry: ``frame(spark, dir)`` gives the keyed series."""
    stages = list(stages)
    last = f"st{len(stages) - 1}" if stages else "ind"
    extra = divergence_sql(last, **div) if div else ""

    @query(name, covers, rules_sql(sql, rules, "ind", stages, extra, digits))
    def run(spark, d):
        df = frame(spark, d)
        for st in stages:
            df = D.staged(df, **st)
        found = rules
        if div:
            df, extra_rules = with_divergences(df, div["price"], div["ind"], report=div.get("report"), skip_zero=div.get("skip_zero", True))
            found = rules + extra_rules
        out = detect(df, found)
        return tidy(out, "entity", "date", "event_kind", "value", digits=digits)

    return run


def on_bars(build):
    return lambda spark, d: build(V.bars(spark, d))


MA5_SQL = SERIES + f", ind AS (SELECT *, {X.roll('avg', 'close', 5)} AS ma5, {X.roll('avg', 'close', 20)} AS ma20 FROM s)"
events_query("moving_average_events", "F11,F1,F4,F5", MA5_SQL,
             on_bars(lambda b: I.indexed(b).withColumns({"ma5": I.sma("close", 5), "ma20": I.sma("close", 20)})),
             D.ma_rules("ma5", 5) + D.ma_pair_rules("ma5", "ma20"), digits=4)
events_query("macd_events", "F12", P.MACD_SQL, on_bars(R.macd), D.MACD_RULES, [D.MACD_STAGES], {"price": "close", "ind": "macd"}, 2)
events_query("rsi_events", "F13", P.RSI_SQL, on_bars(R.rsi), D.RSI_RULES, div={"price": "close", "ind": "rsi"})
events_query("stochastic_kd_events", "F14", P.KD_SQL, on_bars(R.kd), D.KD_RULES, div={"price": "close", "ind": "k"})
events_query("adx_events", "F15", P.ADX_SQL, on_bars(R.adx), D.adx_rules(strict=False))
events_query("adx_events_strict", "F15", P.ADX_SQL, on_bars(R.adx), D.adx_rules())
events_query("atr_events", "F16,F8", P.ATR_SQL, on_bars(R.atr), D.ATR_RULES, [{"growth": D.ATR_GROWTH}])
events_query("bollinger_events", "F17,F2,F6", P.BOLL_SQL, on_bars(I.bollinger), D.BOLLINGER_RULES)
events_query("obv_events", "F18,F10", P.OBV_SQL, on_bars(I.obv), D.OBV_RULES, [D.OBV_STAGES], {"price": "close", "ind": "oscillator", "report": "obv"})
events_query("cci_events", "F19", P.CCI_SQL, on_bars(I.cci), D.CCI_RULES)
events_query("coppock_events", "F20", P.COPPOCK_SQL, on_bars(I.coppock), D.coppock_rules(strict=False))
events_query("coppock_events_strict", "F20", P.COPPOCK_SQL, on_bars(I.coppock), D.coppock_rules())
events_query("donchian_events", "F21", P.DONCHIAN_SQL, on_bars(I.donchian), D.DONCHIAN_RULES)
events_query("ichimoku_events", "F22", P.ICHI_SQL, on_bars(I.ichimoku), D.ICHIMOKU_RULES)
events_query("keltner_events", "F23", P.KELTNER_SQL, on_bars(R.keltner), D.keltner_rules(6))
events_query("mfi_events", "F24", P.MFI_SQL, on_bars(I.mfi), D.MFI_RULES, div={"price": "tp", "ind": "mfi", "skip_zero": False})
events_query("vwap_events", "F25", P.VWAP_SQL, on_bars(lambda b: I.vwap(b, P.ANCHOR)), D.vwap_rules(P.ANCHOR))
events_query("williams_r_events", "F26", P.WILLIAMS_SQL, on_bars(I.williams_r), D.WILLIAMS_RULES, [D.WILLIAMS_STAGES])
events_query("candlestick_patterns", "F28", SERIES + ", ind AS (SELECT * FROM s)", on_bars(I.indexed), D.CANDLE_RULES, [D.CANDLE_STAGE_0, D.CANDLE_STAGES_1, D.CANDLE_STAGES_2])


@query("vwap_band_touches", "F25,F4", f"""WITH RECURSIVE {P.VWAP_SQL},
 t AS (SELECT entity, date, idx, high, low, close, vwap, sd, row_number() OVER (PARTITION BY entity ORDER BY date) AS n FROM ind WHERE idx > 0 AND date >= DATE '{P.ANCHOR}'),
 walk AS (SELECT entity, n, date, high AS v, high >= vwap + 2 * sd AS fired, high >= vwap + 2 * sd AS armed_off FROM t WHERE n = 1
   UNION ALL SELECT t.entity, t.n, t.date, t.high, t.high >= t.vwap + 2 * t.sd AND NOT w.armed_off,
     CASE WHEN t.high >= t.vwap + 2 * t.sd AND NOT w.armed_off THEN true WHEN t.close < t.vwap + t.sd THEN false ELSE w.armed_off END
   FROM walk w JOIN t ON t.entity = w.entity AND t.n = w.n + 1),
 walk2 AS (SELECT entity, n, date, low AS v, low <= vwap - 2 * sd AS fired, low <= vwap - 2 * sd AS armed_off FROM t WHERE n = 1
   UNION ALL SELECT t.entity, t.n, t.date, t.low, t.low <= t.vwap - 2 * t.sd AND NOT w.armed_off,
     CASE WHEN t.low <= t.vwap - 2 * t.sd AND NOT w.armed_off THEN true WHEN t.close > t.vwap - t.sd THEN false ELSE w.armed_off END
   FROM walk2 w JOIN t ON t.entity = w.entity AND t.n = w.n + 1)
 SELECT entity, date, 'upper_2sd_touch' AS event_kind, {rnd('v', 'value', 3)} FROM walk WHERE fired
 UNION ALL SELECT entity, date, 'lower_2sd_touch', {rnd('v', 'value', 3)} FROM walk2 WHERE fired""")
def _vwap_touches(spark, d):
    return tidy(D.vwap_touches(I.vwap(V.bars(spark, d), P.ANCHOR), P.ANCHOR), digits=3)


@query("rsi_failure_swings", "F13", f"""WITH RECURSIVE {P.RSI_SQL}, sides AS (SELECT entity, date, rsi, rsi AS x, {X.prev('rsi')} AS px, 'bearish_failure_swing' AS kind FROM ind
   UNION ALL SELECT entity, date, rsi, 100 - rsi, 100 - {X.prev('rsi')}, 'bullish_failure_swing' FROM ind),
 t AS (SELECT *, row_number() OVER (PARTITION BY entity, kind ORDER BY date) AS n FROM sides WHERE rsi > 0),
 walk AS (SELECT entity, kind, n, date, rsi, CASE WHEN x >= 70 THEN 1 ELSE 0 END AS step, 0.0::DOUBLE AS ext, false AS fired FROM t WHERE n = 1
   UNION ALL SELECT t.entity, t.kind, t.n, t.date, t.rsi,
     CASE WHEN t.x >= 70 THEN 1 WHEN w.step = 1 THEN 2 WHEN w.step = 2 THEN CASE WHEN t.x >= w.ext AND t.x > t.px THEN 3 ELSE 2 END WHEN w.step = 3 THEN CASE WHEN t.x < w.ext THEN 0 ELSE 3 END ELSE 0 END,
     CASE WHEN t.x < 70 AND (w.step = 1 OR (w.step = 2 AND t.x < w.ext)) THEN t.x ELSE w.ext END, w.step = 3 AND t.x < 70 AND t.x < w.ext
   FROM walk w JOIN t ON t.entity = w.entity AND t.kind = w.kind AND t.n = w.n + 1)
 SELECT entity, date, kind AS event_kind, {rnd('rsi', 'value')} FROM walk WHERE fired""")
def _failure_swings(spark, d):
    return tidy(D.failure_swings(R.rsi(V.bars(spark, d))))


@query("swing_pivots", "F9", f"""WITH {SERIES}, m AS (SELECT entity, date, {X.nxt('date', 3)} AS confirm_date,
   CASE WHEN {is_pivot_high('high')} THEN high END AS hi, CASE WHEN {is_pivot_low('low')} THEN low END AS lo FROM s)
 SELECT entity, date, confirm_date, 'high' AS side, {rnd('hi', 'price')} FROM m WHERE hi IS NOT NULL
 UNION ALL SELECT entity, date, confirm_date, 'low', {rnd('lo', 'price')} FROM m WHERE lo IS NOT NULL""")
def _pivots(spark, d):
    return tidy(pivots(I.indexed(V.bars(spark, d))), "entity", "date", "confirm_date", "side", "price")


LEVELS_AT = [2000, 5000, 10000, 20000]
_LEVELS = [Rule(f"up_through_{lv}", f"{X.prev('close')} < {lv} AND close >= {lv}", "close") for lv in LEVELS_AT]
events_query("level_crossings", "F3", SERIES + ", ind AS (SELECT * FROM s)", on_bars(I.indexed), _LEVELS)
_VOLZ = {"z": P._z("volume", 60)}
events_query("zscore_spikes", "F7", SERIES + ", ind AS (SELECT * FROM s)", on_bars(I.indexed),
             [Rule("volume_spike", f"abs(z) >= 1.5 AND coalesce(abs({X.prev('z')}) < 1.5, true)", "z")], [_VOLZ])
events_query("volume_streaks", "F5,F6", SERIES + ", ind AS (SELECT * FROM s)", on_bars(I.indexed),
             [D.streak_end("high_volume_streak", "volume >= 30", 3), D.streak_reach("high_volume_reached", "volume >= 30", 3)])

# --- chip-style series ------------------------------------------------------------------------------
FLOW_SQL = INST + """, flows AS (SELECT entity, date, CAST(sum(CASE WHEN investor_type IN ('1-URGENT', '2-HIGH') THEN buy - sell ELSE 0 END) AS BIGINT) AS foreign_net,
   CAST(sum(CASE WHEN investor_type = '3-MEDIUM' THEN buy - sell ELSE 0 END) AS BIGINT) AS trust_net,
   CAST(sum(CASE WHEN investor_type NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN buy - sell ELSE 0 END) AS BIGINT) AS dealer_net FROM inst_long GROUP BY 1, 2),
 ind AS (SELECT *, CAST(row_number() OVER (PARTITION BY entity ORDER BY date) - 1 AS INTEGER) AS idx FROM flows)"""


def flows(spark, d):
    net, t = F.col("buy") - F.col("sell"), F.col("investor_type")
    big = t.isin("1-URGENT", "2-HIGH")
    df = V.inst_long(spark, d).groupBy("entity", "date").agg(
        F.sum(F.when(big, net).otherwise(0)).alias("foreign_net"), F.sum(F.when(t == "3-MEDIUM", net).otherwise(0)).alias("trust_net"),
        F.sum(F.when(~big & (t != "3-MEDIUM"), net).otherwise(0)).alias("dealer_net"))
    return I.indexed(df)


events_query("institutional_flow_events", "F31", FLOW_SQL, flows, D.flow_rules(24, 2.0), D.flow_stages(24))
CREDIT_SQL = SERIES + f""", ind AS (SELECT *, CAST({X.roll('sum', 'volume', 20)} AS BIGINT) AS margin_balance, CAST({X.roll('sum', 'volume', 3)} AS BIGINT) AS short_balance,
   CAST(CASE WHEN volume > 4 THEN 135 + volume % 40 END AS DOUBLE) AS maintenance FROM s)"""


def credit(spark, d):
    return D.staged(I.indexed(V.bars(spark, d)), margin_balance=f"cast({X.roll('sum', 'volume', 20)} as bigint)", short_balance=f"cast({X.roll('sum', 'volume', 3)} as bigint)",
                    maintenance="cast(case when volume > 4 then 135 + volume % 40 end as double)")


events_query("margin_balance_events", "F32", CREDIT_SQL, credit, D.MARGIN_RULES, [D.MARGIN_STAGES])
HOLD_SQL = SERIES + f""", h0 AS (SELECT *, {X.roll('avg', 'volume', 20)} AS holding_pct FROM s),
 ind AS (SELECT *, 33.0 AS limit_pct, 33.0 - holding_pct AS remaining_pct, coalesce(holding_pct - {X.prev('holding_pct')}, 0) AS holding_change FROM h0)"""


def holdings(spark, d):
    df = I.indexed(V.bars(spark, d)).withColumn("holding_pct", F.expr(X.roll("avg", "volume", 20)))
    return D.staged(df, limit_pct="33.0D", remaining_pct="33.0D - holding_pct", holding_change=f"coalesce(holding_pct - {X.prev('holding_pct')}, 0)")


events_query("foreign_holding_events", "F33", HOLD_SQL, holdings, D.HOLDING_RULES)
events_query("day_trading_events", "F34", SERIES + ", ind AS (SELECT *, CAST(volume % 50 AS DOUBLE) AS ratio FROM s)",
             on_bars(lambda b: I.indexed(b).withColumn("ratio", (F.col("volume") % 50).cast("double"))), D.DAY_TRADE_RULES)

HOLDERS_SQL = """weekly AS (SELECT l_suppkey AS entity, CAST(date_trunc('month', l_shipdate) AS DATE) AS date,
   count(CASE WHEN l_quantity <= 10 THEN 1 END) AS small_people, sum(CASE WHEN l_quantity > 30 AND l_quantity <= 45 THEN l_quantity ELSE 0 END) * 100 / sum(l_quantity) AS large_pct,
   sum(CASE WHEN l_quantity > 45 THEN l_quantity ELSE 0 END) * 100 / sum(l_quantity) AS super_pct,
   sum(CASE WHEN l_quantity > 30 THEN l_quantity ELSE 0 END) / sum(l_quantity) AS concentration FROM lineitem GROUP BY 1, 2),
 ind AS (SELECT *, CAST(row_number() OVER (PARTITION BY entity ORDER BY date) - 1 AS INTEGER) AS idx FROM weekly)"""


def holders(spark, d):
    li = V.table(spark, d, "lineitem")
    q = F.col("l_quantity")
    df = li.groupBy(F.col("l_suppkey").alias("entity"), F.trunc("l_shipdate", "month").alias("date")).agg(
        F.count(F.when(q <= 10, 1)).alias("small_people"), (F.sum(F.when((q > 30) & (q <= 45), q).otherwise(0.0)) * 100 / F.sum(q)).alias("large_pct"),
        (F.sum(F.when(q > 45, q).otherwise(0.0)) * 100 / F.sum(q)).alias("super_pct"), (F.sum(F.when(q > 30, q).otherwise(0.0)) / F.sum(q)).alias("concentration"))
    return I.indexed(df)


events_query("shareholder_events", "F35", HOLDERS_SQL, holders, D.shareholder_rules(4, 0.5), [D.SHAREHOLDER_STAGES])

CATEGORIES = ["urgent", "high", "medium", "low", "unspecified"]
PRIORITIES = dict(zip(["1-URGENT", "2-HIGH", "3-MEDIUM"], CATEGORIES)) | {"4-NOT SPECIFIED": "unspecified", "5-LOW": "low"}
_SUMS = ", ".join(f"CAST(sum(CASE WHEN investor_type = '{k}' THEN buy + sell END) AS BIGINT) AS {v}" for k, v in PRIORITIES.items())
_TOTAL = " + ".join(f"coalesce({c}, 0)" for c in CATEGORIES)
_BEST = f"greatest({', '.join(f'coalesce({c}, 0)' for c in CATEGORIES)})"
LOAN_SQL = INST + f""", l0 AS (SELECT entity, date, {_SUMS} FROM inst_long GROUP BY 1, 2),
 l1 AS (SELECT *, CAST(row_number() OVER (PARTITION BY entity ORDER BY date) - 1 AS INTEGER) AS idx, {_TOTAL} AS total FROM l0),
 ind AS (SELECT *, CASE WHEN total > 0 THEN CASE {' '.join(f"WHEN {_BEST} = {c} THEN '{c}'" for c in CATEGORIES)} END END AS dominant,
   CASE WHEN total > 0 THEN {_BEST} * 1.0 / total END AS dominant_ratio, {', '.join(f"CASE WHEN {X.prev(c)} > 0 THEN ({c} - {X.prev(c)}) * 100.0 / {X.prev(c)} END AS {c}_change" for c in CATEGORIES)} FROM l1)"""


def loans(spark, d):
    from tidemark.operators.aggregates import dominant_category

    df = V.inst_long(spark, d).groupBy("entity", "date").agg(*[
        F.sum(F.when(F.col("investor_type") == k, F.col("buy") + F.col("sell"))).alias(v) for k, v in PRIORITIES.items()])
    df = dominant_category(I.indexed(df), CATEGORIES)
    return D.staged(df, **{f"{c}_change": f"case when {X.prev(c)} > 0 then ({c} - {X.prev(c)}) * 100.0D / {X.prev(c)} end" for c in CATEGORIES})


events_query("loan_collateral_events", "F36", LOAN_SQL, loans, D.collateral_rules(CATEGORIES, 60.0, 0.5))

BLOCK_SQL = """b0 AS (SELECT l_suppkey AS entity, CAST(l_shipdate AS DATE) AS date, CAST(sum(l_quantity) AS BIGINT) AS total_volume, CAST(sum(floor(l_extendedprice)) AS BIGINT) AS total_money,
   sum(CASE WHEN l_returnflag = 'A' THEN floor(l_extendedprice) ELSE 0 END) AS matching FROM lineitem GROUP BY 1, 2),
 b1 AS (SELECT *, CASE WHEN total_money > 0 THEN matching / total_money END AS matching_share, CAST(row_number() OVER (PARTITION BY entity ORDER BY date) - 1 AS INTEGER) AS idx FROM b0),
 ind AS (SELECT *, CASE WHEN """ + f"""{X.past('count', 'total_money', 60)} = 60 AND {X.past('stddev_pop', 'total_money', 60)} > 2.3e-16 THEN (total_money - {X.past('avg', 'total_money', 60)}) / {X.past('stddev_pop', 'total_money', 60)} END AS z FROM b1)"""


def blocks(spark, d):
    li = V.table(spark, d, "lineitem")
    m = F.floor("l_extendedprice")
    df = li.groupBy(F.col("l_suppkey").alias("entity"), F.to_date("l_shipdate").alias("date")).agg(
        F.sum(F.col("l_quantity").cast("long")).alias("total_volume"), F.sum(m).cast("long").alias("total_money"),
        F.sum(F.when(F.col("l_returnflag") == "A", m).otherwise(0)).cast("double").alias("matching"))
    df = I.indexed(df).withColumn("matching_share", F.when(F.col("total_money") > 0, F.col("matching") / F.col("total_money")))
    return df.withColumn("z", F.expr(P._z("total_money", 60)))


events_query("block_trade_events", "F37", BLOCK_SQL, blocks, D.block_rules(60_000, 2.5, 3, 0.8))

ALERT_SQL = """alerts AS (SELECT l_suppkey AS entity, CAST(l_shipdate AS DATE) AS date, CAST(l_shipdate AS DATE) + CAST(min(l_quantity) AS INTEGER) % 3 AS period_start,
   CAST(l_shipdate AS DATE) + 10 AS period_end, count(*) AS count FROM lineitem WHERE l_returnflag = 'R' AND l_discount >= 0.085 GROUP BY 1, 2, l_shipdate),
 n AS (SELECT *, count(*) OVER (PARTITION BY entity ORDER BY date RANGE BETWEEN INTERVAL 60 DAYS PRECEDING AND CURRENT ROW) AS c, row_number() OVER (PARTITION BY entity ORDER BY date) AS i FROM alerts)"""


def alerts(spark, d):
    li = V.table(spark, d, "lineitem").filter("l_returnflag = 'R' AND l_discount >= 0.085")
    return li.groupBy(F.col("l_suppkey").alias("entity"), F.to_date("l_shipdate").alias("date")).agg(F.min("l_quantity").alias("q"), F.count("*").alias("count")).select(
        "entity", "date", F.expr("date_add(date, cast(q as int) % 3)").alias("period_start"), F.date_add("date", 10).alias("period_end"), "count")


@query("risk_alert_events", "F38", f"""WITH {ALERT_SQL}
 SELECT entity, date, 'announced' AS event_kind, CAST(count AS DOUBLE) AS value FROM n
 UNION ALL SELECT entity, period_start, 'entered', count FROM n WHERE period_start <> date
 UNION ALL SELECT entity, period_end + 1, 'exited', count FROM n
 UNION ALL SELECT entity, date, 'escalation', c FROM n WHERE c >= 2 AND i >= 2""")
def _risk(spark, d):
    return D.risk_alert_events(alerts(spark, d)).select("entity", "date", "event_kind", "value")


# --- fundamentals -------------------------------------------------------------------------------------
YOY_SQL = REVENUE + """, g AS (SELECT a.*, CASE WHEN y.revenue > 0 THEN least(greatest((a.revenue - y.revenue) * 100.0 / y.revenue, -999999.9999), 999999.9999) END AS yoy,
   CASE WHEN m.revenue > 0 THEN least(greatest((a.revenue - m.revenue) * 100.0 / m.revenue, -999999.9999), 999999.9999) END AS mom
  FROM period_revenue a LEFT JOIN period_revenue y ON y.entity = a.entity AND y.date = a.date - INTERVAL 1 YEAR
  LEFT JOIN period_revenue m ON m.entity = a.entity AND m.date = a.date - INTERVAL 1 MONTH),
 ind AS (SELECT *, CAST(row_number() OVER (PARTITION BY entity ORDER BY date) - 1 AS INTEGER) AS idx FROM g)"""


def revenue_growth(spark, d):
    from tidemark.operators.aggregates import period_growth

    return I.indexed(period_growth(V.period_revenue(spark, d)))


events_query("revenue_events", "F39,E5", YOY_SQL, revenue_growth, D.REVENUE_RULES)

VAL_SQL = SERIES + ", v0 AS (SELECT *, CASE WHEN volume > 4 THEN close / 500 END AS per, close / 5000 AS pbr, CASE WHEN close > 0 THEN 50000 / close END AS yield FROM s)," + """
 v1 AS (SELECT *, """ + ", ".join(f"list({c}) FILTER ({c} IS NOT NULL) OVER (PARTITION BY entity ORDER BY date RANGE BETWEEN INTERVAL 1825 DAYS PRECEDING AND CURRENT ROW) AS l_{c}" for c in ("per", "pbr", "yield")) + " FROM v0)," + """
 ind AS (SELECT *, """ + ", ".join(f"CASE WHEN {c} IS NOT NULL AND len(l_{c}) >= 10 THEN len(list_filter(l_{c}, lambda v: v < {c})) * 100.0 / len(l_{c}) END AS {c}_pct" for c in ("per", "pbr", "yield")) + " FROM v1)"


def valuation(spark, d):
    df = I.indexed(V.bars(spark, d)).withColumns({"per": F.when(F.col("volume") > 4, F.col("close") / 500), "pbr": F.col("close") / 5000, "yield": F.when(F.col("close") > 0, 50000 / F.col("close"))})
    return OS.trailing_percentiles(df, {f"{c}_pct": c for c in ("per", "pbr", "yield")}, days=1825, strict=True, min_obs=10)


events_query("valuation_events", "F40", VAL_SQL, valuation, D.VALUATION_RULES)

FIN_ITEMS = """st AS (SELECT entity, date, max(CASE WHEN statement_type = 'income' AND item = 'F' THEN value END) AS inc_f, max(CASE WHEN statement_type = 'income' AND item = 'O' THEN value END) AS inc_o,
   max(CASE WHEN statement_type = 'balance' AND item = 'F' THEN value END) AS bal_f, max(CASE WHEN statement_type = 'balance' AND item = 'O' THEN value END) AS bal_o,
   max(CASE WHEN statement_type = 'cashflow' AND item = 'F' THEN value END) AS cf_f, max(CASE WHEN statement_type = 'cashflow' AND item = 'O' THEN value END) AS cf_o FROM statement_long GROUP BY 1, 2)"""
STATEMENT_SQL = STATEMENT + ", " + FIN_ITEMS + """, f0 AS (SELECT entity, date, coalesce(inc_f, 0) AS revenue, coalesce(inc_o, 0) AS gross_profit, coalesce(inc_o, 0) - coalesce(bal_o, 0) AS net_income,
   coalesce(bal_f, 0) AS total_assets, coalesce(bal_o, 0) AS total_liabilities, coalesce(bal_f, 0) - coalesce(bal_o, 0) AS total_equity,
   coalesce(cf_f, 0) - coalesce(cf_o, 0) AS operating_cash_flow, -coalesce(cf_o, 0) AS investing_cash_flow, (coalesce(inc_o, 0) - coalesce(bal_o, 0)) / 1000 AS eps FROM st),
 f1 AS (SELECT *, CAST(row_number() OVER (PARTITION BY entity ORDER BY date) - 1 AS INTEGER) AS idx FROM f0),
 f2 AS (SELECT *, CASE WHEN idx >= 3 THEN """ + X.roll("sum", "net_income", 4) + """ ELSE net_income * 4 END AS ttm FROM f1),
 ind AS (SELECT *, CASE WHEN revenue > 0 THEN gross_profit / revenue * 100 ELSE 0 END AS gross_margin, CASE WHEN total_assets > 0 THEN total_liabilities / total_assets * 100 ELSE 0 END AS debt_ratio,
   operating_cash_flow + investing_cash_flow AS free_cash_flow, CASE WHEN total_equity > 0 THEN ttm / total_equity * 100 ELSE 0 END AS roe, CASE WHEN total_assets > 0 THEN ttm / total_assets * 100 ELSE 0 END AS roa FROM f2)"""


def statements(spark, d):
    from tidemark.operators.aggregates import statement_ratios

    pick = lambda t, i: F.coalesce(F.max(F.when((F.col("statement_type") == t) & (F.col("item") == i), F.col("value"))), F.lit(0.0))
    wide = V.statement_long(spark, d).groupBy("entity", "date").agg(
        pick("income", "F").alias("revenue"), pick("income", "O").alias("gross_profit"), (pick("income", "O") - pick("balance", "O")).alias("net_income"),
        pick("balance", "F").alias("total_assets"), pick("balance", "O").alias("total_liabilities"), (pick("balance", "F") - pick("balance", "O")).alias("total_equity"),
        (pick("cashflow", "F") - pick("cashflow", "O")).alias("operating_cash_flow"), (-pick("cashflow", "O")).alias("investing_cash_flow"),
        ((pick("income", "O") - pick("balance", "O")) / 1000).alias("eps"))
    return statement_ratios(wide)


events_query("financial_statement_events", "F41,E38", STATEMENT_SQL, statements, D.STATEMENT_RULES)

# --- market-wide series ---------------------------------------------------------------------------------
INDEX_SQL = SERIES + ", " + P.MACD_TAIL.replace("ind AS (", "mac AS (") + ", " + P.RSI_TAIL.replace("FROM s)", "FROM mac)").replace("ind AS (", "rs AS (") + f""",
 ind AS (SELECT *, {X.roll('avg', 'close', 20)} AS ma20, {X.roll('avg', 'close', 60)} AS ma_long,
   CASE WHEN idx >= 10 AND {X.past('stddev_pop', 'volume', 60)} > 0 THEN (volume - {X.past('avg', 'volume', 60)}) / {X.past('stddev_pop', 'volume', 60)} ELSE 0 END AS volume_z FROM rs)"""
events_query("market_index_events", "F43", INDEX_SQL, on_bars(lambda b: I.index_trend(R.per_series(R.macd(b), lambda p: {"rsi": R.rsi_values(p["close"], 14)}, rsi=R.DOUBLE)).drop("slope")),
             D.INDEX_RULES, [D.INDEX_STAGES], digits=2)
RSV = P.KD_SQL.split(" k2 AS")[0].rstrip(",\n ")
events_query("sentiment_events", "F44", RSV + ", ind AS (SELECT *, rsv AS value FROM k1)", on_bars(lambda b: I.stochastic_raw(b).withColumn("value", F.col("rsv"))),
             D.SENTIMENT_RULES, [D.SENTIMENT_STAGES, D.SENTIMENT_STAGES_2])
events_query("market_margin_events", "F44", RSV + f", ind AS (SELECT *, 120 + rsv / 2 AS ratio, CAST({X.roll('sum', 'volume', 60)} AS BIGINT) AS balance FROM k1)",
             on_bars(lambda b: D.staged(I.stochastic_raw(b), ratio="120 + rsv / 2", balance=f"cast({X.roll('sum', 'volume', 60)} as bigint)")), D.MAINTENANCE_RULES, [D.MAINTENANCE_STAGES])
events_query("exchange_rate_events", "F44,F3", SERIES + ", ind AS (SELECT *, close / 1000 AS rate FROM s)", on_bars(lambda b: I.indexed(b).withColumn("rate", F.col("close") / 1000)),
             D.rate_rules([10.0, 20.0, 30.0], 50.0, 4), [D.RATE_STAGES])
events_query("cross_market_events", "F44", RSV.replace("k1 AS (SELECT *,", "k1 AS (SELECT * EXCLUDE (hh, ll),") + ", " + P.MACD_TAIL.replace("FROM s)", "FROM k1)").replace("ind AS (", "mm AS (") + ", ind AS (SELECT *, close AS lead_close, rsv / 2 AS fear_close FROM mm)",
             on_bars(lambda b: R.macd(I.stochastic_raw(b)).withColumns({"lead_close": F.col("close"), "fear_close": F.col("rsv") / 2})), D.CROSS_MARKET_RULES, [D.CROSS_MARKET_STAGES], digits=2)
CYCLE_SQL = REVENUE + """, ind AS (SELECT entity, date, CAST(revenue AS DOUBLE) AS lead_value, CASE revenue % 3 WHEN 0 THEN 'red' WHEN 1 THEN 'green' ELSE 'blue' END AS color,
   CAST(row_number() OVER (PARTITION BY entity ORDER BY date) - 1 AS INTEGER) AS idx FROM period_revenue)"""
events_query("business_cycle_events", "F44", CYCLE_SQL,
             lambda s, d: I.indexed(V.period_revenue(s, d).select("entity", "date", F.col("revenue").cast("double").alias("lead_value"), F.expr("case revenue % 3 when 0 then 'red' when 1 then 'green' else 'blue' end").alias("color"))),
             D.CYCLE_RULES, [D.CYCLE_STAGES, D.CYCLE_STAGES_2, D.CYCLE_STAGES_3])


def commodity(spark, d):
    return I.commodity_macro(V.bars(spark, d).select("entity", "date", F.when(F.col("volume") > 5, F.col("close")).alias("price")))


COMMODITY_SQL = SERIES + f""", p AS (SELECT entity, date, idx, CASE WHEN volume > 5 THEN close END AS price FROM s),
 p1 AS (SELECT *, last_value(price IGNORE NULLS) OVER ({X.OVER} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS was FROM p),
 p2 AS (SELECT *, CASE WHEN was > 0 AND price IS NOT NULL THEN (price - was) / was * 100 END AS return_pct FROM p1),
 p3 AS (SELECT *, CASE WHEN {X.past('count', 'return_pct', 60)} >= 10 AND {X.past('stddev_pop', 'return_pct', 60)} > 1e-12
    THEN (return_pct - {X.past('avg', 'return_pct', 60)}) / {X.past('stddev_pop', 'return_pct', 60)} END AS zscore,
    CASE WHEN return_pct > 0.05 THEN 'up' WHEN return_pct < -0.05 THEN 'down' ELSE 'neutral' END AS momentum FROM p2),
 p4 AS (SELECT *, idx - row_number() OVER (PARTITION BY entity, momentum ORDER BY date) AS island FROM p3),
 ind AS (SELECT *, row_number() OVER (PARTITION BY entity, momentum, island ORDER BY date) AS streak FROM p4)"""
events_query("commodity_events", "F44", COMMODITY_SQL, commodity, D.commodity_momentum_rules(2))


@query("commodity_regime_breaks", "F44", f"""WITH {COMMODITY_SQL}, m AS (SELECT entity, date, momentum, lag(momentum) OVER ({X.OVER}) AS k0, lag(date) OVER ({X.OVER}) AS d0 FROM ind WHERE streak = 2 AND momentum <> 'neutral')
 SELECT entity, date, 'regime_break' AS event_kind, CAST(date - d0 AS DOUBLE) AS value FROM m WHERE k0 <> momentum AND date - d0 <= 10""")
def _regime_breaks(spark, d):
    return D.regime_breaks(detect(commodity(spark, d), D.commodity_momentum_rules(2))).select("entity", "date", "event_kind", "value")
