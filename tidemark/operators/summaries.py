"""What is known about one entity on a day: collateral, block trades, alerts, commodity state, trend.

Requests are rows (entity, asof); every request is answered, those without rows by nulls and zero counts. Repeated
requests are answered once, null entities or days are no requests.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.fusion import trend_view
from tidemark.operators.pit import asof_join, range_join
from tidemark.operators.recursive import KALMAN_HORIZONS, kalman_values, regime_of
from tidemark.operators.serving import serve

# Limits at which a summary raises its flag, and look-backs in days.
CONCENTRATED, MATCHING_SPIKE, PRICE_SPIKE = 0.70, 0.80, 2.0
BLOCK_DAYS, ALERT_DAYS, CHANGE_DAYS, STALE_DAYS = 30, 60, 180, 7
TREND = "horizon string, threshold double, date date, close double, smoothed double, uncertainty double, velocity double, back double"


def asked(requests: DataFrame) -> DataFrame:
    return requests.filter(F.col("entity").isNotNull() & F.col("asof").isNotNull()).select("entity", "asof").distinct()


def over_lookback(requests: DataFrame, rows: DataFrame, days: int, aggs: dict[str, Column]) -> DataFrame:
    """Requests with plain aggregates of the rows dated within ``days`` before them.

    Requests are merged into the series as rows without values and read a range frame, so one shuffle by entity
    serves all of them and no row is copied per request.
    """
    ask = asked(requests).select("entity", F.col("asof").alias("date"), F.lit(True).alias("_ask"))
    w = Window.partitionBy("entity").orderBy(F.unix_date("date")).rangeBetween(-days, 0)
    merged = rows.withColumn("_row", F.lit(True)).unionByName(ask, allowMissingColumns=True)
    out = merged.select("entity", F.col("date").alias("asof"), "_ask", *[a.over(w).alias(n) for n, a in aggs.items()])
    return out.filter("_ask").drop("_ask")


def collateral_summary(requests: DataFrame, balances: DataFrame, categories: list[str], concentrated: float = CONCENTRATED) -> DataFrame:
    """One row per category: its balance, change and share, with the total, the largest category and its flag.

    ``balances`` carry a column per category, ``<category>_change``, total, dominant and dominant_ratio. A missing balance is 0.
    """
    cols = [*categories, *[f"{c}_change" for c in categories], "total", "dominant", "dominant_ratio"]
    at = asof_join(asked(requests), balances, cols)
    known = F.col("matched").isNotNull()
    parts = F.array(*[F.struct(F.lit(c).alias("category"), F.when(known, F.coalesce(F.col(c), F.lit(0))).alias("balance"), F.col(f"{c}_change").alias("change_pct")) for c in categories])
    df = at.select("entity", "asof", F.col("matched").alias("date"), "total", "dominant", F.col("dominant_ratio").alias("concentration"), F.inline(parts))
    return df.withColumns({"ratio": F.when(F.col("total") > 0, F.col("balance") / F.col("total")), "is_concentrated": F.coalesce(F.col("concentration") >= concentrated, F.lit(False))})


def block_summary(requests: DataFrame, daily: DataFrame, days: int = BLOCK_DAYS, spike: float = MATCHING_SPIKE) -> DataFrame:
    """Active days, volume, money, share of matched volume, largest trade and the days of matching spikes."""
    df = over_lookback(requests, daily, days, {
        "active_days": F.count("_row"), "total_volume": F.sum("total_volume"), "total_money": F.sum("total_money"), "matching_volume": F.sum("matching_volume"),
        "largest_trade": F.max("largest_trade"), "spike_days": F.collect_list(F.when(F.col("matching_share") >= spike, F.col("date")))})
    df = df.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("total_volume", "total_money", "matching_volume", "largest_trade")})
    share = F.when(F.col("total_volume") > 0, F.col("matching_volume") / F.col("total_volume"))
    return df.withColumns({"matching_share": share, "spike_days": F.sort_array("spike_days")})


def alert_status(requests: DataFrame, alerts: DataFrame, days: int = ALERT_DAYS) -> DataFrame:
    """Whether an alert period is open, its severity and remaining days, and the announcements within ``days``.

    Of several open periods the one announced last counts, then the one that starts, then the one that ends last.
    ``alerts`` carry date (announced), period_start, period_end and severity; ``history`` lists them newest first.
    """
    row = F.struct("date", "period_start", "period_end", "severity")
    df = over_lookback(requests, alerts, days, {"history": F.collect_list(F.when(F.col("_row"), row))})
    is_open = lambda a: (a["period_start"] <= F.col("asof")) & (a["period_end"] >= F.col("asof"))
    df = df.withColumn("_now", F.array_max(F.filter("history", is_open)))
    return df.select("entity", "asof", F.col("_now").isNotNull().alias("in_period"), *[F.col(f"_now.{c}").alias(c) for c in ("severity", "period_start", "period_end")],
                     F.datediff("_now.period_end", "asof").alias("days_remaining"), F.size("history").alias("announcements"), F.sort_array("history", asc=False).alias("history"))


def commodity_summary(requests: DataFrame, macro: DataFrame, spike: float = PRICE_SPIKE) -> DataFrame:
    """The newest state of a commodity: price, return, z-score, momentum and its streak, flagged on a spike."""
    df = asof_join(asked(requests), macro, ["price", "return_pct", "zscore", "momentum", "streak"]).withColumnRenamed("matched", "date")
    return df.withColumns({"streak": F.coalesce("streak", F.lit(0)), "is_spike": F.coalesce(F.abs("zscore") >= spike, F.lit(False)), "is_available": F.col("date").isNotNull()})


def trend_at(requests: DataFrame, classified: DataFrame, stale_after: int = STALE_DAYS) -> DataFrame:
    """Per horizon the newest filter state: band, deviation in units of uncertainty, regime, age in days."""
    ask = asked(requests).withColumn("horizon", F.explode(F.array(*map(F.lit, KALMAN_HORIZONS))))
    key = F.struct("entity", "horizon").alias("entity")
    cols = ["close", "smoothed", "uncertainty", "velocity", "regime"]
    df = asof_join(ask.select(key, "asof"), classified.select(key, "date", *cols), cols)
    return _aged(df.select("entity.*", "asof", F.col("matched").alias("date"), *cols), stale_after)


def trend_of(requests: DataFrame, bars: DataFrame, noise: float = 0.01, lookback: int = 20, stale_after: int = STALE_DAYS) -> DataFrame:
    """``trend_at`` of the Kalman filter of ``bars``: states leave the series at request days only.

    Bars are shuffled once with their requests and filtered for all horizons in that pass, so no row per bar and horizon is made.
    """

    def answer(c: dict, cuts: np.ndarray) -> dict:
        z, day = c["close"].astype(float), c["date"]
        last, out = cuts - 1, []
        for horizon, (q, threshold, _) in KALMAN_HORIZONS.items():
            x, sd, v = kalman_values(z, q, noise) if len(z) else (z, z, z)
            out += [(k, horizon, threshold, *((day[i], z[i], x[i], sd[i], v[i], v[max(i - lookback, 0)]) if i >= 0 else [None] * 6)) for k, i in enumerate(last.tolist())]
        return dict(zip(["request", *(f.split()[0] for f in TREND.split(", "))], zip(*out)))

    df = serve(asked(requests), bars.select("entity", "date", "close"), answer, TREND)
    df = df.withColumns({"vel_pct": F.when(F.abs("smoothed") > 0, F.col("velocity") / F.col("smoothed")).otherwise(0.0), "accel": F.col("velocity") - F.col("back")})
    return _aged(df.withColumn("regime", F.when(F.col("date").isNotNull(), regime_of())), stale_after)


def _aged(df: DataFrame, stale_after: int) -> DataFrame:
    df = trend_view(df)
    age, half = F.datediff("asof", "date"), F.greatest("uncertainty", F.col("smoothed") * 0.01)
    return df.withColumns({"band_low": F.col("smoothed") - half, "band_high": F.col("smoothed") + half, "age_days": age, "is_stale": age > stale_after})


def recent_changes(requests: DataFrame, changes: DataFrame, horizon: str = "medium", n: int = 5, days: int = CHANGE_DAYS) -> DataFrame:
    """The newest ``n`` regime changes of one horizon within ``days`` of each request, numbered from the newest."""
    df = range_join(asked(requests), changes.filter(F.col("horizon") == horizon), days)
    rn = F.row_number().over(Window.partitionBy("entity", "asof").orderBy(F.desc("date"), "to_regime"))
    return df.withColumn("nth", rn).filter(F.col("nth") <= n)
