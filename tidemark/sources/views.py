"""Adapter views: the keyed shapes of FIXTURES.md derived from the driver tables.

All of them aggregate raw rows to a bounded number of rows per entity (one per day, month or
quarter) with map-side combine, so a raw key holding a third of the table costs nothing special.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lineitem_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as trades: unit price in whole cents, unique intraday order key."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("entity"),
        F.to_date("l_shipdate").alias("date"),
        (F.floor(F.col("l_extendedprice") * 100 / F.col("l_quantity")) / 100.0).alias("px"),
        F.col("l_quantity").alias("qty"),
        "l_discount", "l_returnflag", "l_linestatus", "l_extendedprice",
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("seq"),
    )


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars (entity, date, open, high, low, close, volume)."""
    return (
        _lineitem_prices(spark, sf_dir).groupBy("entity", "date").agg(
            F.min_by("px", "seq").alias("open"), F.max("px").alias("high"), F.min("px").alias("low"),
            F.max_by("px", "seq").alias("close"), F.sum(F.col("qty").cast("long")).alias("volume"))
    )


def adj_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse corporate-action events: the first qualifying return per (entity, quarter)."""
    r = _lineitem_prices(spark, sf_dir).filter("l_returnflag = 'R' AND l_discount >= 0.085")
    return (
        r.groupBy("entity", F.date_trunc("quarter", "date").alias("quarter"))
        .agg(F.min_by(F.struct("date", "px", "l_discount", "seq"), F.struct("date", "seq")).alias("e"))
        .select(
            "entity", F.col("e.date").alias("date"),
            F.when(F.col("e.seq") % 3 == 0, F.lit("capital_increase")).otherwise(F.lit("dividend")).alias("event_type"),
            F.when(F.col("e.seq") % 3 == 2, F.col("e.px")).alias("before_price"),
            F.when(F.col("e.seq") % 3 == 2, F.col("e.px") * (1 - F.col("e.l_discount"))).alias("reference_price"),
            F.when(F.col("e.seq") % 3 == 1, F.col("e.px") * F.col("e.l_discount")).otherwise(0.0).alias("cash_dividend"),
            F.when(F.col("e.seq") % 3 == 1, F.col("e.l_discount") * 10).otherwise(0.0).alias("stock_dividend"),
            F.when(F.col("e.seq") % 3 == 0, F.col("e.px") * 0.8).alias("subscription_price"),
            F.when(F.col("e.seq") % 3 == 0, F.col("e.l_discount") * 1000).alias("subscription_rate"),
            F.when(F.col("e.seq") % 3 == 2, F.lit(1.02)).alias("volume_factor"),
        )
    )


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trading days: the distinct ship dates, Mondays to Fridays."""
    return (
        table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("date")).distinct()
        .filter(F.dayofweek("date").between(2, 6))
    )


def entity_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, n = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    return s.join(n, s.s_nationkey == n.n_nationkey).select(
        F.col("s_suppkey").alias("entity"), F.col("s_name").alias("name"), F.col("n_name").alias("industry"),
        F.when(F.col("s_acctbal") < 0, F.lit("2000-01-01").cast("date")).alias("delisting_date"),
        F.col("s_acctbal").alias("balance"),
    )


def inst_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long category rows (entity, date, investor_type, buy, sell): orders by nation and month.

    Orders are summed per customer and month before the join, so a hot customer joins as a few rows.
    """
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    amount = F.round("o_totalprice").cast("long")
    month = F.trunc("o_orderdate", "month")
    per_customer = o.groupBy("o_custkey", month.alias("date"), F.col("o_orderpriority").alias("investor_type")).agg(
        F.sum(F.when(F.col("o_orderstatus") == "F", amount).otherwise(0)).alias("buy"), F.sum(F.when(F.col("o_orderstatus") != "F", amount).otherwise(0)).alias("sell"))
    joined = per_customer.join(c.select("c_custkey", F.col("c_nationkey").cast("long").alias("entity")), F.col("o_custkey") == F.col("c_custkey"))
    return joined.groupBy("entity", "date", "investor_type").agg(F.sum("buy").alias("buy"), F.sum("sell").alias("sell"))


def period_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly revenue per entity, in whole units, published on the 10th of the next month."""
    li = table(spark, sf_dir, "lineitem")
    m = F.trunc("l_shipdate", "month")
    return (
        li.groupBy(F.col("l_suppkey").alias("entity"), m.alias("date"))
        .agg(F.sum(F.floor("l_extendedprice")).cast("long").alias("revenue"))
        .select("entity", "date", "revenue", F.year("date").alias("revenue_year"), F.month("date").alias("revenue_month"),
                F.when(F.pmod(F.col("entity") + F.month("date"), F.lit(4)) != 0,
                       F.date_format(F.date_add(F.add_months("date", 1), 9), "yyyy-MM-dd"))
                .otherwise(F.lit("pending")).alias("create_time"))
    )


def statement_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarterly statement lines: return flag picks the statement, line status the item."""
    li = table(spark, sf_dir, "lineitem")
    return (
        li.groupBy(F.col("l_suppkey").alias("entity"), F.to_date(F.date_trunc("quarter", "l_shipdate")).alias("date"),
                   F.col("l_returnflag").alias("statement_type"), F.col("l_linestatus").alias("item"))
        .agg(F.sum(F.floor("l_extendedprice")).cast("double").alias("value"))
        .withColumn("statement_type", F.expr("case statement_type when 'A' then 'income' when 'N' then 'balance' else 'cashflow' end"))
    )


def holding_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return (
        c.groupBy(F.col("c_nationkey").cast("long").alias("entity"), (F.floor((F.col("c_acctbal") + 1000) / 1000) + 1).cast("int").alias("level"))
        .agg(F.count("*").alias("people"), F.sum(F.floor("c_acctbal") + 1000).cast("long").alias("unit"))
    )


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event facts: user as entity, event type as source, kind and severity from the metadata."""
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    return e.select(
        F.col("user_id").alias("entity"), F.to_date("ts").alias("fact_date"),
        F.element_at(F.array(*map(F.lit, ("daily", "monthly", "quarterly"))), (k % 3 + 1)).alias("timeframe"),
        F.col("event_type").alias("source"),
        F.when(k % 3 == 0, "GoldenCross").when(k % 3 == 1, "DeathCross").otherwise("VolumeSpike").alias("event_kind"),
        F.col("value"), (k % 4 + 1).cast("smallint").alias("severity"), k.alias("k"), "event_id",
        F.when(k % 5 == 0, F.date_add(F.to_date("ts"), k % 40)).alias("report_date"),
    )
