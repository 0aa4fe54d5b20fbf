"""Point-in-time operators: as-of joins, visibility rules, adjusted prices.

Requests are a DataFrame of (entity, asof), so one or a million requests run through one plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.windows import series

# Days from the period's date to its usual publication.
PUBLICATION_LAG = {"revenue": 11, "business_cycle": 27, "statement": 45}
# Days an event stays relevant, by timeframe.
LOOKBACK_DAYS = {"daily": 90, "monthly": 90, "quarterly": 180}


def require(entity: str | None = None, lookback: int | None = None, items: list | None = None) -> None:
    """Argument checks shared by the read operators."""
    if entity is not None and not str(entity).strip():
        raise ValueError("entity must not be blank")
    if lookback is not None and lookback < 0:
        raise ValueError("lookback must not be negative")
    if items is not None and len(items) == 0:
        raise ValueError("the list must not be empty")


def trading_days_only(df: DataFrame, calendar: DataFrame, date: str = "date") -> DataFrame:
    """Keep rows on calendar days; rows without a date stay, and an empty calendar filters nothing.

    The calendar holds one row per day; only the one-row answer whether it has any is always broadcast.
    """
    days = calendar.select(F.col("date").alias("_day")).distinct().withColumn("_open", F.lit(True))
    known = calendar.agg((F.count("*") > 0).alias("_any"))
    out = df.join(days, df[date] == F.col("_day"), "left").join(F.broadcast(known))
    return out.filter(F.col("_open") | F.col(date).isNull() | ~F.col("_any")).select(*[df[c] for c in df.columns])


def visible_at(asof: Column, date: str = "fact_date", report: str = "report_date", lag: Column | int = 0) -> Column:
    """Known on ``asof``: dated by then and published by then (``lag`` days when unpublished dates)."""
    lag = lag if isinstance(lag, Column) else F.lit(lag)
    published = F.coalesce(F.col(report), F.date_add(F.col(date), lag.cast("int")))
    return (F.col(date) <= asof) & (published <= asof)


def within_lookback(asof: Column, date: str = "fact_date", timeframe: str = "timeframe") -> Column:
    days = F.create_map(*[F.lit(x) for kv in LOOKBACK_DAYS.items() for x in kv])
    return F.col(date).isNull() | (F.col(date) >= F.date_sub(asof, days[F.col(timeframe)]))


def latest_per_key(df: DataFrame, keys: list[str], date: str, value_cols: list[str]) -> DataFrame:
    """Newest row per key with ``max_by``, which combines map-side; no sort of whole groups."""
    row = F.max_by(F.struct(date, *value_cols), F.col(date)).alias("_r")
    return df.groupBy(*keys).agg(row).select(*keys, "_r.*")


def asof_join(requests: DataFrame, rows: DataFrame, value_cols: list[str], request_time: str = "asof", row_time: str = "date",
              tolerance_days: int | None = None, strict: bool = False, skip_null: str | None = None) -> DataFrame:
    """Latest row at or before each request (before it when ``strict``), per entity.

    Rows and requests are merged into one sorted series and the last row seen is carried forward:
    one shuffle, no range comparison.  Rows should be unique per (entity, day).
    """
    src = rows.filter(F.col(skip_null).isNotNull()) if skip_null else rows
    payload = F.struct(F.col(row_time).alias("matched"), *value_cols)
    right = src.select("entity", F.col(row_time).alias("_t"), F.lit(1 if strict else 0).alias("_side"), payload.alias("_row"))
    extra = [c for c in requests.columns if c not in ("entity", request_time)]
    left = requests.select("entity", F.col(request_time).alias("_t"), F.lit(0 if strict else 1).alias("_side"),
                           F.struct(F.lit(1).alias("_req"), *extra).alias("_keep"))
    merged = right.unionByName(left, allowMissingColumns=True)
    w = Window.partitionBy("entity").orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, 0)
    out = merged.withColumn("_row", F.last("_row", ignorenulls=True).over(w)).filter(F.col("_keep").isNotNull())
    if tolerance_days is not None:
        out = out.withColumn("_row", F.when(F.datediff("_t", "_row.matched") <= tolerance_days, F.col("_row")))
    return out.select("entity", F.col("_t").alias(request_time), *[F.col(f"_keep.{c}") for c in extra], "_row.*")


def range_join(requests: DataFrame, rows: DataFrame, lookback_days: int, row_time: str = "date", request_time: str = "asof") -> DataFrame:
    """All rows in [asof - lookback, asof] per request: equi-join on covered months, then filter.

    A request covers ``lookback / 28 + 2`` months at most.  Hot entities are split by AQE's skew
    join, since the join key is (entity, month).
    """
    from_day = F.date_sub(request_time, lookback_days)
    req = requests.withColumn("_m", F.explode(F.sequence(F.trunc(from_day, "month"), F.trunc(request_time, "month"), F.expr("interval 1 month"))))
    src = rows.withColumn("_m", F.trunc(row_time, "month"))
    out = req.join(src, ["entity", "_m"]).filter((F.col(row_time) <= F.col(request_time)) & (F.col(row_time) >= from_day))
    return out.drop("_m")


def visible_periods(requests: DataFrame, periods: DataFrame, kind: str, months: int) -> DataFrame:
    """Period rows (revenue, statement, ...) published by each request date, within ``months``.

    ``periods`` carries ``report_date`` (null when unknown: date plus the kind's usual lag).
    """
    lag = PUBLICATION_LAG[kind]
    days = months * 31 + 60 if kind != "statement" else months * 92 + 60
    joined = range_join(requests, periods, days)
    return joined.filter(F.coalesce("report_date", F.date_add("date", lag)) <= F.col("asof"))


def report_date(created: str = "create_time") -> Column:
    """Publication day from a text that starts with an ISO date, else null."""
    return F.when(F.col(created).rlike(r"^\d{4}-\d{2}-\d{2}"), F.to_date(F.substring(created, 1, 10)))


def adjustment_factors(events: DataFrame, bars: DataFrame) -> DataFrame:
    """Price and volume factor per (entity, date): factors of one day multiply.

    Price factor: before / reference where both are usable; otherwise the dividend formula, or for
    capital increases the dilution formula, from the raw close ahead of the event.
    """
    prev = asof_join(events.withColumnRenamed("date", "asof"), bars, ["close"], strict=True).withColumnRenamed("asof", "date")
    bp, rp = F.col("before_price"), F.col("reference_price")
    cash, stock = F.coalesce("cash_dividend", F.lit(0.0)), F.coalesce("stock_dividend", F.lit(0.0))
    dividend, increase = F.col("event_type") == "dividend", F.col("event_type") == "capital_increase"
    unreliable = dividend & (stock > 0) & (cash == 0) & (F.abs(bp - rp) < 0.0001)
    base = F.coalesce(bp, F.col("close"))
    after = (base - cash) / (1 + stock / 10)
    rate = F.col("subscription_rate") / 1000
    diluted = (F.col("close") + F.col("subscription_price") * rate) / (1 + rate)
    af = (
        F.when((bp > 0) & (rp > 0) & ~unreliable, bp / rp)
        .when(dividend & (base > 0) & ((cash > 0) | (stock > 0)) & (after > 0), base / after)
        .when(increase & (F.col("subscription_price") > 0) & (rate > 0) & (F.col("close") > 0) & (diluted > 0), F.col("close") / diluted)
        .otherwise(1.0)
    )
    per_event = prev.select("entity", "date", af.alias("af"), F.coalesce("volume_factor", F.lit(1.0)).alias("vf"))
    return per_event.groupBy("entity", "date").agg(F.product("af").alias("af"), F.product("vf").alias("vf"))


def _with_factors(bars: DataFrame, factors: DataFrame) -> DataFrame:
    df = bars.join(factors, ["entity", "date"], "left")
    return df.withColumns({"af": F.coalesce("af", F.lit(1.0)), "vf": F.coalesce("vf", F.lit(1.0))})


def back_adjusted(bars: DataFrame, factors: DataFrame) -> DataFrame:
    """Prices as of now: each bar is scaled by all factors dated after it (2 decimals).

    Factors on days without a bar are dropped.  Not for back-tests; see ``asof_adjusted``.
    """
    later = Window.partitionBy("entity").orderBy(F.desc("date")).rowsBetween(Window.unboundedPreceding, -1)
    df = _with_factors(bars, factors).withColumns({
        "cum_af": F.coalesce(F.product("af").over(later), F.lit(1.0)), "cum_vf": F.coalesce(F.product("vf").over(later), F.lit(1.0))})
    cents = lambda c: (F.floor(F.col(c) * F.col("cum_af") * 100 + 0.5) / 100).alias(f"adj_{c}")
    return df.select(
        *bars.columns, *[cents(c) for c in ("open", "high", "low", "close")],
        F.floor(F.col("volume") / F.col("cum_vf") + 0.5).cast("long").alias("adj_volume"), "cum_af", "cum_vf",
        ((F.abs(F.col("cum_af") - 1) > 1e-12) | (F.abs(F.col("cum_vf") - 1) > 1e-12)).alias("is_adjusted"))


def cumulative_factor(bars: DataFrame, factors: DataFrame) -> DataFrame:
    """Running product C(t) of the factors after the first bar; serves every as-of date at once."""
    w = series().rowsBetween(Window.unboundedPreceding, 0)
    first = F.min("date").over(Window.partitionBy("entity"))
    df = _with_factors(bars, factors)
    return df.withColumn("c", F.product(F.when(F.col("date") > first, F.col("af")).otherwise(1.0)).over(w)).drop("af", "vf")


def asof_adjusted(requests: DataFrame, bars: DataFrame, factors: DataFrame, lookback_days: int) -> DataFrame:
    """Adjusted closes as seen on each request date: raw(d) * C(asof) / C(d), 4 decimals.

    Events after the request date have no influence.
    """
    base = cumulative_factor(bars, factors)
    at = asof_join(requests, base, ["c"]).select("entity", "asof", F.col("c").alias("c_asof"))
    rows = range_join(at, base.select("entity", "date", "close", "c"), lookback_days)
    return rows.select("entity", "asof", "date", "close", (F.floor(F.col("close") * F.col("c_asof") / F.col("c") * 10000 + 0.5) / 10000).alias("adj_close"))
