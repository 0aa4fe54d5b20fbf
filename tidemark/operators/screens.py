"""Screens over all entities as of a day: lists of several rankings, triggers, wave setups and phases.

Days are rows (asof); each screen reads the newest ranking at or before its day. Lists are top-k reports, so their limits
are part of the result; the totals beside them count everything.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.ranking import TOP_N, top_rows_at


def factor_lists(rankings: dict[str, DataFrame], days: DataFrame, n: int = TOP_N) -> DataFrame:
    """The best ``n`` of every named ranking (date, entity, rank, universe_size, metric), with the ranking's own date.

    A ranking without a day that has ranked rows by then contributes nothing.
    """
    cols = ["date", "entity", "rank", "universe_size", "metric"]
    parts = [top_rows_at(r.filter(F.col("rank").isNotNull()).select(*cols), days, n).select("asof", F.lit(name).alias("factor"), *cols) for name, r in rankings.items()]
    return reduce(DataFrame.unionByName, parts)


def trigger_scan(triggers: DataFrame, days: DataFrame, n: int = 20) -> DataFrame:
    """Triggers of the newest signal day: the strongest growth first among positive ones, the weakest among negative.

    ``total`` counts all triggers of the type; ties go to the smaller entity. Numbers are given per signal day and type
    before days are joined, so no trigger is copied beyond the listed ones.
    """
    by = Window.partitionBy("date", "trigger_type")
    order = F.when(F.col("trigger_type") == "positive", -F.col("yoy")).otherwise(F.col("yoy"))
    total = triggers.groupBy("date", "trigger_type").agg(F.count("*").alias("total"))
    ranked = triggers.withColumn("rank", F.row_number().over(by.orderBy(order, "entity"))).filter(F.col("rank") <= n).join(total, ["date", "trigger_type"])
    return top_rows_at(ranked, days, n).select("asof", "date", "trigger_type", "entity", "yoy", "net_pct", "rank", "total")


def phases(primary: DataFrame, recent_days: int = 14) -> DataFrame:
    """What the primary scenario of an entity says of its day: a correction under way or done, an impulse complete, other."""
    old = F.datediff("asof", "end_date") > recent_days
    phase = (F.when(F.col("legs") == 3, F.when(old, "correction_ongoing").when(F.col("direction") < 0, "correction_done_down").otherwise("correction_done_up"))
             .when(F.col("pattern") == "impulse", "impulse_complete").otherwise("other"))
    return primary.withColumn("phase", phase)


def wave_scan(setups: DataFrame, phased: DataFrame, timeframe: str = "daily", n: int = TOP_N) -> DataFrame:
    """Ranked setups of one timeframe as candidates and, beside them, entities in a phase to observe, by entity."""
    best = setups.filter((F.col("timeframe") == timeframe) & (F.col("rank") <= n))
    best = best.select("asof", "entity", F.lit("candidate").alias("part"), F.lit(None).cast("string").alias("phase"), "rank", "rr", "aligned")
    seen = phased.filter(F.col("phase") != "correction_done_down").withColumn("rank", F.row_number().over(Window.partitionBy("asof").orderBy("entity"))).filter(F.col("rank") <= n)
    return best.unionByName(seen.select("asof", "entity", F.lit("observe").alias("part"), "phase", "rank"), allowMissingColumns=True)


def phase_histogram(requests: DataFrame, phased: DataFrame) -> DataFrame:
    """Entities asked for per day and phase; those without a scenario count as ``none``."""
    df = requests.select("entity", "asof").distinct().join(phased.select("entity", "asof", "phase"), ["entity", "asof"], "left")
    return df.groupBy("asof", F.coalesce("phase", F.lit("none")).alias("phase")).agg(F.count("*").alias("n"))
