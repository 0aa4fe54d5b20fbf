"""Cross-sectional rankings and screens.

All share one shape: exclusion reason, metric, rank 1..n among eligible rows per date, universe
size and a top-n flag.  Metrics come for all request dates at once from per-entity windows and
as-of joins; the rank itself never gathers a whole cross-section in one task (see
``tidemark.functions.ranking``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.ranking import group_quantiles, ranked_rows
from tidemark.functions.windows import prev, run_length, series, trailing
from tidemark.operators.indicators import indexed
from tidemark.operators.pit import asof_join, range_join
from tidemark.session import cut

TOP_N = 30


def rank_table(metrics: DataFrame, info: DataFrame | None, metric: str, ascending: bool = False, top_n: int = TOP_N, by: str = "date") -> DataFrame:
    """Ranked output with excluded rows kept: rank, universe_size, is_top_n, excluded_reason.

    ``metrics`` may carry its own ``reason``; the universe's reason takes precedence.
    """
    df = metrics if "reason" in metrics.columns else metrics.withColumn("reason", F.lit(None).cast("string"))
    if info is not None:
        df = df.join(info.select("entity", F.col("excluded_reason").alias("_x")), "entity", "left").withColumn("reason", F.coalesce("_x", "reason")).drop("_x")
    df = cut(df.withColumnRenamed("reason", "excluded_reason"))
    ok = F.col("excluded_reason").isNull() & F.col(metric).isNotNull()
    ranked = ranked_rows(df.filter(ok), [by], metric, ascending)
    rest = df.filter(~ok).withColumns({"rank": F.lit(None).cast("int"), "universe_size": F.lit(None).cast("int")})
    return ranked.unionByName(rest).withColumn("is_top_n", F.coalesce(F.col("rank") <= top_n, F.lit(False)))


def _at(requests: DataFrame, rows: DataFrame, cols: list[str], **kw) -> DataFrame:
    return asof_join(requests, rows, cols, **kw).withColumnRenamed("asof", "date")


def momentum_12_1(requests: DataFrame, bars: DataFrame, skip: int = 21, span: int = 252) -> DataFrame:
    """Return from ``span`` closes ago to ``skip`` closes ago, by position."""
    far = prev("close", span - 1)
    m = bars.select("entity", "date", F.when(far > 0, (prev("close", skip) - far) / far).alias("metric"))
    return _at(requests, m, ["metric"]).withColumn("reason", F.when(F.col("metric").isNull(), "insufficient_history"))


def low_volatility(requests: DataFrame, bars: DataFrame, span: int = 252, min_closes: int = 50) -> DataFrame:
    """Sample standard deviation of simple returns over the last ``span`` returns."""
    was = prev("close")
    df = indexed(bars).withColumn("ret", F.when(was > 0, F.col("close") / was - 1))
    m = df.select("entity", "date", F.when(F.col("idx") >= min_closes - 1, F.stddev_samp("ret").over(trailing(span))).alias("metric"))
    return _at(requests, m, ["metric"]).withColumn("reason", F.when(F.col("metric").isNull(), "insufficient_history"))


def persistent_momentum(requests: DataFrame, bars: DataFrame, half: int = 126, year: int = 252, month: int = 21) -> DataFrame:
    """Half-year return, 12-1 return, positive months out of six and half-year volatility."""
    far, base = prev("close", year - 1), prev("close", half - 1)
    ups = sum((F.when(prev("close", 21 * m) > prev("close", 21 * (m + 1)), 1).otherwise(0) for m in range(1, 6)),
              F.when(F.col("close") > prev("close", 21), 1).otherwise(0))
    df = indexed(bars).withColumn("ret", F.when(prev("close") > 0, F.col("close") / prev("close") - 1))
    df = df.select("entity", "date", "idx", ((F.col("close") - base) / base).alias("return_6m"), ((prev("close", month) - far) / far).alias("return_12m_1m"),
                   ups.alias("persistent_months"), F.stddev_samp("ret").over(trailing(half)).alias("vol_6m"))
    out = _at(requests, df, ["idx", "return_6m", "return_12m_1m", "persistent_months", "vol_6m"])
    enough = F.col("idx") >= half + 4
    out = out.withColumn("reason", F.when(~F.coalesce(enough, F.lit(False)), "insufficient_history"))
    for c in ("return_6m", "return_12m_1m", "persistent_months", "vol_6m"):
        out = out.withColumn(c, F.when(enough, F.col(c)))
    return out.drop("idx")


def with_volatility_scale(metrics: DataFrame, info: DataFrame, vol_limit: float = 1.5) -> DataFrame:
    """Half weight where the volatility exceeds ``vol_limit`` times the eligible cross mean."""
    x = info.select("entity", F.col("excluded_reason").alias("_x"))
    df = metrics.join(x, "entity", "left")
    mean = df.filter("_x is null and reason is null and vol_6m > 0").groupBy("date").agg(F.avg("vol_6m").alias("cross_mean_vol"))
    return df.drop("_x").join(mean, "date", "left").withColumn("scale", F.when(F.col("vol_6m") > F.col("cross_mean_vol") * vol_limit, 0.5).otherwise(1.0))


def revenue_momentum(requests: DataFrame, growth: DataFrame, months: int = 6, min_run: int = 3) -> DataFrame:
    """Latest YoY growth of entities with a run of at least ``min_run`` positive months (of six)."""
    df = indexed(growth).withColumn("run", F.least(run_length(F.coalesce(F.col("yoy") > 0, F.lit(False))), F.lit(months)).cast("int"))
    out = _at(requests, df.select("entity", "date", F.col("yoy").alias("metric"), "run"), ["metric", "run"])
    return out.withColumn("reason", F.when(F.col("run").isNull(), "no_revenue_data").when(F.col("run") < min_run, "run_too_short"))


def institutional_concert(requests: DataFrame, flows: DataFrame, shares: DataFrame, n: int = 20, min_obs: int = 5) -> DataFrame:
    """Rows in which all three groups trade in one direction; cumulative first-group flow over shares."""
    one_way = ((F.col("foreign_net") > 0) & (F.col("trust_net") > 0) & (F.col("dealer_net") > 0)) | ((F.col("foreign_net") < 0) & (F.col("trust_net") < 0) & (F.col("dealer_net") < 0))
    df = indexed(flows).select("entity", "date", "idx", F.sum(F.when(one_way, 1).otherwise(0)).over(trailing(n)).cast("int").alias("concert_days"),
                               F.sum("foreign_net").over(trailing(n)).cast("double").alias("foreign_cumulative"))
    out = _at(requests, df, ["idx", "concert_days", "foreign_cumulative"]).join(shares, "entity", "left")
    out = out.withColumn("metric", F.when(F.col("shares") > 0, F.col("foreign_cumulative") / F.col("shares")))
    return out.withColumn("reason", F.when(F.coalesce(F.col("idx") + 1 < min_obs, F.lit(True)), "insufficient_history")).drop("idx")


SIGNALS = {"profitability": 4, "leverage": 3, "efficiency": 2}


def f_score(quarters: DataFrame) -> DataFrame:
    """Nine accounting signals per (entity, quarter) against the quarter before it."""
    c, p = F.col, prev

    def ratio(a, b):
        return F.when(b > 0, a / b)

    now = lambda x: F.coalesce(x, F.lit(False)).cast("int")
    roa0, roa1 = ratio(c("net_income"), c("total_assets")), ratio(p("net_income"), p("total_assets"))
    cur0, cur1 = ratio(c("current_assets"), c("current_liabilities")), ratio(p("current_assets"), p("current_liabilities"))
    gm0, gm1 = ratio(c("revenue") - c("cogs"), c("revenue")), ratio(p("revenue") - p("cogs"), p("revenue"))
    at0, at1 = ratio(c("revenue"), c("total_assets")), ratio(p("revenue"), p("total_assets"))
    needed = c("net_income").isNotNull() & c("total_assets").isNotNull() & p("total_assets").isNotNull() & c("revenue").isNotNull() & p("revenue").isNotNull()
    df = quarters.select(
        "entity", "date", needed.alias("_ok"),
        (now(roa0 > 0) + now(c("cfo") > 0) + now(roa0 > roa1) + now(c("cfo") > c("net_income"))).alias("profitability"),
        (now(c("long_debt") < p("long_debt")) + now(cur0 > cur1) + now(c("shares") <= p("shares"))).alias("leverage"),
        (now(gm0 > gm1) + now(at0 > at1)).alias("efficiency"))
    total = c("profitability") + c("leverage") + c("efficiency")
    return df.select("entity", "date", *[F.when(c("_ok"), c(k)).alias(k) for k in SIGNALS], F.when(c("_ok"), total).alias("f_score"))


def f_score_metrics(requests: DataFrame, quarters: DataFrame, min_score: int = 6) -> DataFrame:
    out = _at(requests, f_score(quarters), [*SIGNALS, "f_score"])
    return out.withColumn("reason", F.when(F.col("f_score").isNull(), "no_financial_data").when(F.col("f_score") < min_score, "score_too_low"))


def industry_adjusted(metrics: DataFrame, value: str = "gp") -> DataFrame:
    """Metric minus its exact (date, industry) median among eligible rows."""
    base = cut(metrics)
    med = group_quantiles(base.filter(F.col(value).isNotNull() & F.col("reason").isNull()), ["date", "industry"], value, {"industry_median": 0.5})
    return base.join(med.drop("n"), ["date", "industry"], "left").withColumn("metric", F.col(value) - F.col("industry_median"))


def dividend_yield(requests: DataFrame, yields: DataFrame, bars: DataFrame, payouts: DataFrame, min_yield: float = 3.0, max_drop: float = -20.0,
                   min_years: int = 3) -> DataFrame:
    """Latest yield with the falling-knife and payout-history gates."""
    far = prev("close", 251)
    y = bars.select("entity", "date", F.when(far > 0, (F.col("close") - far) / far * 100).alias("return_12m")).join(yields, ["entity", "date"], "left")
    y = y.withColumn("yield", F.last("yield", ignorenulls=True).over(series().rowsBetween(Window.unboundedPreceding, 0)))
    out = asof_join(requests, y, ["return_12m", "yield"])
    paid = payouts.filter("cash_dividend > 0").groupBy("entity", F.trunc("date", "year").alias("y"), "date").count().select("entity", "date")
    years = range_join(requests, paid, 365 * 5).groupBy("entity", "asof").agg(F.countDistinct(F.year("date")).cast("int").alias("payout_years"))
    out = out.join(years, ["entity", "asof"], "left").withColumn("payout_years", F.coalesce("payout_years", F.lit(0)))
    reason = (F.when(F.col("yield").isNull(), "no_yield_data").when(F.col("yield") < min_yield, "yield_below_threshold")
              .when(F.col("return_12m").isNull() | (F.col("return_12m") < max_drop), "falling_knife").when(F.col("payout_years") < min_years, "payout_history_insufficient"))
    return out.withColumnRenamed("asof", "date").withColumn("metric", F.col("yield")).withColumn("reason", reason)


def magic_inputs(requests: DataFrame, quarters: DataFrame, caps: DataFrame, lag_days: int = 0) -> DataFrame:
    """Four-quarter operating profit and the balance at each request, with the day's market value."""
    known = quarters.withColumn("date", F.date_add("date", lag_days))
    n = F.count("ebit").over(trailing(4))
    q = known.select("entity", "date", F.when(n == 4, F.sum("ebit").over(trailing(4))).alias("ebit_ttm"), "total_assets", "total_liab", "cash")
    out = asof_join(requests, q, ["ebit_ttm", "total_assets", "total_liab", "cash"]).drop("matched")
    out = asof_join(out, caps, ["market_cap"], tolerance_days=60, skip_null="market_cap").drop("matched").withColumnRenamed("asof", "date")
    ev = F.col("market_cap") + F.col("total_liab") - F.coalesce("cash", F.lit(0.0))
    ic = F.col("total_assets") - F.coalesce("cash", F.lit(0.0))
    out = out.withColumns({"enterprise_value": ev, "invested_capital": ic})
    reason = (F.when(F.col("ebit_ttm").isNull(), "no_ebit_data").when(F.col("total_assets").isNull() | F.col("total_liab").isNull(), "no_balance_data").when(F.col("market_cap").isNull(), "no_market_cap")
              .when((F.col("ebit_ttm") <= 0) | (F.col("enterprise_value") <= 0) | (F.col("invested_capital") <= 0), "negative_ebit_or_ev"))
    out = out.withColumn("reason", reason)
    ok = F.col("reason").isNull()
    return out.withColumns({"earnings_yield": F.when(ok, F.col("ebit_ttm") / F.col("enterprise_value")), "roic": F.when(ok, F.col("ebit_ttm") / F.col("invested_capital"))})


def magic_formula(inputs: DataFrame, info: DataFrame, top_n: int = TOP_N) -> DataFrame:
    """Sum of the earnings-yield rank and the return-on-capital rank, ranked again."""
    x = info.select("entity", F.col("excluded_reason").alias("_x"))
    df = cut(inputs.join(x, "entity", "left").withColumn("excluded_reason", F.coalesce("_x", "reason")).drop("_x", "reason"))
    ok = df.filter("excluded_reason is null")
    r = ranked_rows(ok, ["date"], "earnings_yield", False, rank_col="ey_rank").drop("universe_size")
    r = ranked_rows(r, ["date"], "roic", False, rank_col="roic_rank").drop("universe_size")
    r = r.withColumn("combined_rank", F.col("ey_rank") + F.col("roic_rank"))
    r = ranked_rows(r, ["date"], "combined_rank", True, rank_col="rank")
    rest = df.filter("excluded_reason is not null").drop("earnings_yield", "roic")
    return r.unionByName(rest, allowMissingColumns=True).withColumn("is_top_n", F.coalesce(F.col("rank") <= top_n, F.lit(False)))


def monthly_triggers(requests: DataFrame, growth: DataFrame, flows: DataFrame, shares: DataFrame, info: DataFrame) -> DataFrame:
    """Positive: strong growth and net buying; negative: weak growth and net selling above 1 % of shares."""
    out = asof_join(requests, growth, ["yoy"], skip_null="yoy").drop("matched")
    net = flows.select("entity", "date", F.sum(F.col("foreign_net") + F.col("trust_net") + F.col("dealer_net")).over(trailing(20)).cast("double").alias("net_20"))
    out = asof_join(out, net, ["net_20"]).drop("matched").join(shares.filter("shares > 0"), "entity")
    out = out.join(info.filter("excluded_reason is null").select("entity"), "entity", "left_semi").withColumn("net_pct", F.col("net_20") / F.col("shares"))
    kind = (F.when((F.col("yoy") > 30) & (F.col("net_20") > 0), "positive").when((F.col("yoy") < -20) & (F.col("net_20") < 0) & (F.abs("net_pct") > 0.01), "negative"))
    return out.withColumnRenamed("asof", "date").withColumn("trigger_type", kind).filter(F.col("trigger_type").isNotNull())


def top_rows_at(ranked: DataFrame, requests: DataFrame, n: int) -> DataFrame:
    """Top ``n`` of the newest ranking at or before each request date (requests have ``asof`` only)."""
    one = F.lit(0).alias("entity")  # a single series: the days that have a ranking
    days = ranked.select(one, "date").distinct()
    newest = asof_join(requests.select(one, "asof").distinct(), days, []).select("asof", F.col("matched").alias("date"))
    return ranked.filter(F.col("rank") <= n).join(newest, "date")


def top_signals(requests: DataFrame, signals: DataFrame, n: int = 5, lookback: int = 30, scale: float = 14.0) -> DataFrame:
    """Strongest signals per (entity, asof) by age-decayed weight.

    Signals of one day share their age, so each (entity, day) is limited to its ``n`` best first; the
    limit runs ahead of the shuffle and bounds what meets the requests.
    """
    day = Window.partitionBy("entity", "fact_date").orderBy(F.desc(F.abs("sign")), "event_id")
    best = signals.withColumn("_rn", F.row_number().over(day)).filter(F.col("_rn") <= n).drop("_rn")
    df = range_join(requests, best, lookback, row_time="fact_date")
    df = df.withColumn("weight", F.abs("sign") * F.exp(-F.datediff("asof", "fact_date") / scale))
    rn = F.row_number().over(Window.partitionBy("entity", "asof").orderBy(F.desc("weight"), "event_id"))
    return df.withColumn("signal_rank", rn).filter(F.col("signal_rank") <= n)
