"""Ingestion shaping: conforming, renaming, packing, keyed upserts and idempotent appends."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scan(df: DataFrame, since: str | None = None, entities: list | None = None, date: str = "date") -> DataFrame:
    """Keyed scan; both conditions are plain comparisons that reach the parquet reader."""
    if since is not None:
        df = df.filter(F.col(date) >= F.lit(since).cast("date"))
    return df.filter(F.col("entity").isin(entities)) if entities else df


def last_bars(bars: DataFrame, n: int) -> DataFrame:
    """Complete bars only, the newest ``n`` per entity."""
    full = bars.dropna(subset=["open", "high", "low", "close"])
    rn = F.row_number().over(Window.partitionBy("entity").orderBy(F.desc("date")))
    return full.withColumn("_rn", rn).filter(F.col("_rn") <= n).drop("_rn")


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to a declared schema with casts; columns the source lacks become null."""
    have = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


def drift_report(df: DataFrame, expected: list[str]) -> DataFrame:
    """One row per field: status (ok, missing, novel) and how many rows carry a value."""
    have = df.columns
    entries = [(c, "ok" if c in expected else "novel", F.count(c)) for c in have] + [(c, "missing", F.lit(0).cast("long")) for c in expected if c not in have]
    one = df.agg(*[e[2].alias(f"c{i}") for i, e in enumerate(entries)])
    return one.select(F.inline(F.array(*[F.struct(F.lit(n).alias("field"), F.lit(s).alias("status"), F.col(f"c{i}").alias("filled")) for i, (n, s, _) in enumerate(entries)])))


def rename_and_pack(df: DataFrame, rename: dict[str, str], constants: dict[str, str] | None = None) -> DataFrame:
    """Rename fields; targets that start with ``_`` move into the ``detail`` map (as text)."""
    plain = [F.col(k).alias(v) for k, v in rename.items() if not v.startswith("_")]
    packed = [x for k, v in rename.items() if v.startswith("_") for x in (F.lit(v[1:]), F.col(k).cast("string"))]
    detail = [F.create_map(*packed).alias("detail")] if packed else []
    return df.select(*plain, *detail, *[F.lit(v).alias(k) for k, v in (constants or {}).items()])


def upsert(existing: DataFrame, incoming: DataFrame, keys: list[str], version: str) -> DataFrame:
    """Latest version per key wins.  ``max_by`` combines map-side; a key has few versions."""
    both = existing.unionByName(incoming, allowMissingColumns=True)
    rest = [c for c in both.columns if c not in keys]
    return both.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(version)).alias("_r")).select(*keys, "_r.*")


def append_new(existing: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``incoming`` whose key is not stored yet, once each (do nothing on conflict)."""
    return incoming.dropDuplicates(keys).join(existing.select(*keys).distinct(), keys, "left_anti")


def upsert_forecasts(existing: DataFrame, incoming: DataFrame, keys: list[str], version: str) -> DataFrame:
    """Upsert in which settled rows never change."""
    both = existing.unionByName(incoming, allowMissingColumns=True)
    rest = [c for c in both.columns if c not in keys]
    order = F.struct(F.col("resolved_date").isNotNull(), F.when(F.col("resolved_date").isNotNull(), -F.col(version)).otherwise(F.col(version)))
    return both.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_r")).select(*keys, "_r.*")


def write_days(df: DataFrame, path: str, unit: str = "year") -> None:
    """Idempotent sink: overwrite only the partitions present in ``df``."""
    part = F.year("date") if unit == "year" else F.date_format("date", "yyyy-MM")
    (df.withColumn("part", part).repartition("part", "entity").sortWithinPartitions("entity", "date")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(path))


def params_hash(params: dict) -> str:
    """Hash of the canonical JSON of a parameter set."""
    return hashlib.sha256(json.dumps(params, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def with_provenance(df: DataFrame, source: str, version: str, params: dict) -> DataFrame:
    return df.withColumns({"source_name": F.lit(source), "source_version": F.lit(version), "params_hash": F.lit(params_hash(params))})


def volume_factor() -> Column:
    """1 for dividends, otherwise reference / before (1 when the price before is missing or 0)."""
    ratio = F.col("reference_price") / F.nullif(F.col("before_price"), F.lit(0.0))
    return F.when(F.col("event_type") == "dividend", 1.0).otherwise(F.coalesce(ratio, F.lit(1.0)))


def split_dividend(subtype: str, combined: str) -> dict[str, Column]:
    """Cash and stock parts from the event subtype; mixed and unknown subtypes stay null."""
    s, v = F.col(subtype), F.coalesce(F.col(combined), F.lit(0.0))
    return {"cash_dividend": F.when(s == "cash", v).when(s == "stock", 0.0), "stock_dividend": F.when(s == "cash", 0.0).when(s == "stock", v)}


def first_per_day(ticks: DataFrame, key: str, ts: str, default_key: str | None = None) -> DataFrame:
    """Earliest row per (key, day)."""
    k = F.coalesce(F.col(key), F.lit(default_key)) if default_key else F.col(key)
    rest = [c for c in ticks.columns if c not in (key, ts)]
    return ticks.groupBy(k.alias(key), F.to_date(ts).alias("date")).agg(F.min_by(F.struct(ts, *rest), F.col(ts)).alias("_r")).select(key, "date", "_r.*")


def day_ranges(spans: DataFrame, days: int) -> DataFrame:
    """Split [start, end] into consecutive ranges of at most ``days`` days."""
    starts = F.explode(F.sequence("start", "end", F.expr(f"interval {days} day")))
    df = spans.withColumn("range_start", starts)
    return df.withColumn("range_end", F.least(F.date_add("range_start", days - 1), F.col("end")))


def drop_shadowed(events: DataFrame, shadowed: str, by: str, measures: list[str]) -> DataFrame:
    """Remove ``shadowed`` events that have a sibling of type ``by`` with equal measures (null-safe)."""
    sib = events.filter(F.col("event_type") == by).select("entity", "date", *measures, F.lit(shadowed).alias("event_type")).alias("b")
    a = events.alias("a")
    on = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in ("entity", "date", "event_type")] + [F.col(f"a.{m}").eqNullSafe(F.col(f"b.{m}")) for m in measures]
    return a.join(sib, on, "left_anti")


def table_health(tables: dict[str, tuple[DataFrame, str | None]]) -> DataFrame:
    """Row count and newest date per table, one aggregate each."""
    out = None
    for name, (df, date) in tables.items():
        newest = F.max(F.to_date(date)) if date else F.lit(None).cast("date")
        one = df.agg(F.count("*").alias("n_rows"), newest.alias("newest")).select(F.lit(name).alias("table_name"), "n_rows", "newest")
        out = one if out is None else out.unionByName(one)
    return out
