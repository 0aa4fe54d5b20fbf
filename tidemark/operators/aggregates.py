"""Grouped shaping and roll-ups: pivots, packing, bars from finer rows, totals, growth, ratios."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.windows import trailing
from tidemark.operators.indicators import indexed

CLIP = 999999.9999


def pivot_categories(long: DataFrame, synonyms: dict[str, str], measures: list[str], order_by: str | None = None) -> DataFrame:
    """Long category rows to one wide row per (entity, date): ``<category>_<measure>`` columns.

    Category spellings are mapped through ``synonyms``; unknown ones are dropped.  With
    ``order_by`` the last value wins, otherwise the largest.
    """
    label = F.create_map(*[x for k, v in synonyms.items() for x in (F.lit(k), F.lit(v))])
    df = long.withColumn("_cat", label[F.col("investor_type")]).filter(F.col("_cat").isNotNull())
    pick = (lambda c, m: F.max_by(F.when(c, F.col(m)), F.when(c, F.col(order_by)))) if order_by else (lambda c, m: F.max(F.when(c, F.col(m))))
    cats = list(dict.fromkeys(synonyms.values()))
    return df.groupBy("entity", "date").agg(*[pick(F.col("_cat") == c, m).alias(f"{c}_{m}") for c in cats for m in measures])


def net_sum(long: DataFrame) -> DataFrame:
    """Net amount (buy minus sell, missing as 0) per key."""
    z = F.lit(0)
    return long.groupBy("entity", "date").agg((F.sum(F.coalesce("buy", z)) - F.sum(F.coalesce("sell", z))).alias("net"))


def pack_items(long: DataFrame, keys: list[str], item: str, value: str, suffix: str = "_per", percent: Column | None = None) -> DataFrame:
    """Rows to one ``map<string,double>`` per key; percent rows get ``suffix`` on their item name.

    Items are deduplicated first, so a map holds one entry per item name of the chart of accounts.
    """
    name = F.col(item) if percent is None else F.when(percent, F.concat(F.col(item), F.lit(suffix))).otherwise(F.col(item))
    one = long.groupBy(*keys, name.alias("_k")).agg(F.max(value).alias("_v"))
    return one.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("_k", "_v")))).alias("detail"))


def pack_structs(long: DataFrame, keys: list[str], item: str, fields: list[str]) -> DataFrame:
    one = long.groupBy(*keys, F.col(item).cast("string").alias("_k")).agg(*[F.sum(f).alias(f) for f in fields])
    return one.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("_k", F.struct(*fields).alias("_v"))))).alias("detail"))


def map_first(detail: str, names: list[str]) -> Column:
    """First present and castable value among synonymous map keys."""
    return F.coalesce(*[F.expr(f"try_cast({detail}['{n}'] as double)") for n in names])


def block_rollup(trades: DataFrame, matching: str) -> DataFrame:
    """Per (entity, date): totals, volume share of the ``matching`` type, largest trade, breakdown.

    Two levels: per trade type first (map-side combined), then over the few types.
    """
    by_type = trades.groupBy("entity", "date", "trade_type").agg(F.sum("volume").alias("volume"), F.sum("money").alias("money"), F.max("money").alias("largest"))
    is_m = F.col("trade_type") == matching
    m = F.sum(F.when(is_m, F.col("volume")).otherwise(0))
    return by_type.groupBy("entity", "date").agg(
        F.sum("volume").alias("total_volume"), F.sum("money").alias("total_money"), m.alias("matching_volume"),
        F.sum(F.when(is_m, F.col("money")).otherwise(0)).alias("matching_money"),
        F.when(F.sum("volume") > 0, m / F.sum("volume")).alias("matching_share"), F.max("largest").alias("largest_trade"),
        F.count("*").alias("trade_types"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("trade_type", F.struct("volume", "money"))))).alias("detail"))


def period_bars(bars: DataFrame, unit: str) -> DataFrame:
    """Weekly (ISO, keyed by Monday) or monthly bars from daily bars."""
    return bars.groupBy("entity", F.to_date(F.date_trunc(unit, "date")).alias("period")).agg(
        F.min_by("open", "date").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"),
        F.max_by("close", "date").alias("close"), F.sum("volume").alias("volume"), F.count("*").alias("days"))


def dominant_category(df: DataFrame, categories: list[str]) -> DataFrame:
    """Row total, the largest category (the first one listed wins ties) and its share."""
    vals = [F.coalesce(F.col(c), F.lit(0)) for c in categories]
    total = sum(vals[1:], vals[0])
    best = F.array_max(F.array(*[F.struct(v.alias("v"), F.lit(-i).alias("i"), F.lit(c).alias("c")) for i, (c, v) in enumerate(zip(categories, vals))]))
    df = df.withColumns({"total": total, "_best": best})
    return df.withColumns({"dominant": F.when(F.col("total") > 0, F.col("_best.c")), "dominant_ratio": F.when(F.col("total") > 0, F.col("_best.v") / F.col("total"))}).drop("_best")


def period_growth(rev: DataFrame) -> DataFrame:
    """YoY and MoM in percent by calendar month; gaps give null, not the nearest row.

    The previous period is found with a range frame on the month number of the same sorted series,
    so no self join is needed.
    """
    from pyspark.sql import Window

    df = rev.withColumn("_m", F.year("date") * 12 + F.month("date"))

    def back(n: int) -> Column:
        w = Window.partitionBy("entity").orderBy("_m").rangeBetween(-n, -n)
        was = F.max("revenue").over(w)
        pct = (F.col("revenue") - was) * 100.0 / was
        return F.when(was > 0, F.least(F.greatest(pct, F.lit(-CLIP)), F.lit(CLIP)))

    return df.withColumns({"yoy": back(12), "mom": back(1)}).drop("_m")


def cumulative_growth(rev: DataFrame) -> DataFrame:
    """Year-to-date total and its growth over the previous year's latest running total."""
    from pyspark.sql import Window

    year = Window.partitionBy("entity", "revenue_year").orderBy("date")
    df = rev.withColumn("cumulative", F.sum("revenue").over(year))
    totals = Window.partitionBy("entity").orderBy("revenue_year").rangeBetween(-1, -1)
    df = df.withColumn("_prev", F.sum("revenue").over(totals))
    return df.withColumn("cumulative_yoy", F.when(F.col("_prev") > 0, (F.col("cumulative") - F.col("_prev")) * 100.0 / F.col("_prev")).otherwise(0.0)).drop("_prev")


def statement_ratios(wide: DataFrame) -> DataFrame:
    """Margins, leverage, free cash flow and trailing four-quarter returns (x4 with less history)."""
    df = indexed(wide)
    ttm = F.when(F.col("idx") >= 3, F.sum("net_income").over(trailing(4))).otherwise(F.col("net_income") * 4)
    pct = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b) * 100).otherwise(0.0)
    df = df.withColumn("ttm", ttm)
    return df.withColumns({
        "gross_margin": pct("gross_profit", "revenue"), "debt_ratio": pct("total_liabilities", "total_assets"),
        "free_cash_flow": F.col("operating_cash_flow") + F.col("investing_cash_flow"), "roe": pct("ttm", "total_equity"), "roa": pct("ttm", "total_assets")})


# Holder classes by level number.
HOLDER_CLASSES = {"small": range(1, 4), "mid": range(4, 7), "large": range(7, 10), "super": range(10, 16)}


def holder_buckets(levels: DataFrame, classes: dict | None = None) -> DataFrame:
    """Holders and units per class and the share of large plus super holders."""
    classes = classes or HOLDER_CLASSES
    lv = F.col("level")
    aggs = []
    for name, r in classes.items():
        inside = lv.between(min(r), max(r))
        aggs += [F.sum(F.when(inside, F.col("people")).otherwise(0)).alias(f"{name}_people"), F.sum(F.when(inside, F.col("unit")).otherwise(0)).alias(f"{name}_unit")]
    keys = [c for c in ("entity", "date") if c in levels.columns]
    df = levels.groupBy(*keys).agg(*aggs, F.sum("people").alias("total_people"), F.sum("unit").alias("total_unit"))
    return df.withColumn("concentration", F.when(F.col("total_unit") > 0, (F.col("large_unit") + F.col("super_unit")) / F.col("total_unit")).otherwise(0.0))
