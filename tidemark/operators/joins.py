"""Joins of keyed tables: weights, ratios, outer merges, event patches, nearest levels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def market_weight(ratios: DataFrame, closes: DataFrame, shares: DataFrame) -> DataFrame:
    """Market value and its share of the day's total; null where an input is missing.

    The total comes from a map-side-combined count per day; there is one row per day to join back.
    """
    df = ratios.join(closes, ["entity", "date"], "left").join(shares, "entity", "left")
    df = df.withColumn("market_value", F.col("close") * F.col("shares"))
    totals = df.groupBy("date").agg(F.sum("market_value").alias("total_value"))
    out = df.join(totals, "date", "left")
    return out.withColumn("weight", F.when(F.col("total_value") > 0, F.col("market_value") / F.col("total_value")))


def share_of_total(part: DataFrame, total: DataFrame, keys: list[str]) -> DataFrame:
    """100 * part / total by key, null when the total is missing or not positive."""
    return part.join(total, keys, "left").withColumn("ratio", F.when(F.col("total") > 0, F.col("part") * 100.0 / F.col("total")))


def outer_merge(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer merge on the keys: rows found on one side only keep nulls for the other side."""
    return a.join(b, keys, "full_outer")


def align_on_date(lead: DataFrame, follow: DataFrame, fill: float | None = None) -> DataFrame:
    """Two series on their common calendar.  ``fill=0.0`` mimics sources that write missing days as 0."""
    df = lead.join(follow, ["entity", "date"], "full_outer")
    return df if fill is None else df.fillna(fill)


def patch_mixed(events: DataFrame, staging: DataFrame) -> DataFrame:
    """Fill missing dividend parts from staging rows whose cash or stock date equals the event date.

    The date alternative becomes an equi-join by unpivoting both staging dates.
    """
    days = staging.select("entity", F.explode(F.array_distinct(F.array("cash_date", "stock_date"))).alias("date"),
                          F.col("cash_dividend").alias("_c"), F.col("stock_dividend").alias("_s")).filter("date is not null")
    days = days.groupBy("entity", "date").agg(F.max(F.struct("_c", "_s")).alias("_p")).select("entity", "date", "_p.*")
    df = events.join(days, ["entity", "date"], "left")
    mixed = (F.col("event_type") == "dividend") & F.col("cash_dividend").isNull() & F.col("stock_dividend").isNull()
    return df.withColumns({"cash_dividend": F.when(mixed, F.col("_c")).otherwise(F.col("cash_dividend")),
                           "stock_dividend": F.when(mixed, F.col("_s")).otherwise(F.col("stock_dividend"))}).drop("_c", "_s")


def missing_increases(events: DataFrame, staging: DataFrame) -> DataFrame:
    """Capital-increase events implied by staging rows without an event on that day."""
    implied = staging.filter("subscription_price > 0").select(
        "entity", F.coalesce("stock_date", "cash_date").alias("date"), F.lit("capital_increase").alias("event_type"),
        "subscription_price", F.lit(1.0).alias("volume_factor")).filter("date is not null")
    implied = implied.dropDuplicates(["entity", "date"])
    return implied.join(events.select("entity", "date", "event_type"), ["entity", "date", "event_type"], "left_anti")


def stock_dividend_volume_factor() -> Column:
    """1 / (1 + stock / 10) where a stock dividend still carries the neutral factor."""
    due = (F.col("event_type") == "dividend") & (F.coalesce("stock_dividend", F.lit(0.0)) > 0) & (F.abs(F.col("volume_factor") - 1) < 0.0001)
    return F.when(due, 1 / (1 + F.col("stock_dividend") / 10)).otherwise(F.col("volume_factor"))


def nearest_level(points: DataFrame, levels: DataFrame, near: float = 0.02) -> DataFrame:
    """Nearest level of the entity for each point and whether it lies within ``near``.

    The few levels of an entity are packed into one array first (levels are capped per entity by
    the level builder), so no point-by-level rows are shuffled.
    """
    packed = levels.groupBy("entity").agg(F.sort_array(F.collect_set("level")).alias("_lv"))
    df = points.join(packed, "entity", "left")
    best = F.array_min(F.transform("_lv", lambda v: F.struct(F.abs(v - F.col("price")).alias("dist"), v.alias("level"))))
    df = df.withColumn("_b", best)
    return df.select(*points.columns, F.col("_b.level").alias("level"), F.col("_b.dist").alias("distance"),
                     (F.col("_b.dist") <= F.col("price") * near).alias("is_near"))


def changed_keys(dirty: DataFrame, raw: DataFrame, derived: DataFrame, keys: list[str]) -> DataFrame:
    """Keys to recompute: flagged ones and those present raw but absent derived."""
    return dirty.select(*keys).union(raw.select(*keys).join(derived.select(*keys), keys, "left_anti")).distinct()
