"""Evidence fusion: price levels, stops, health and climate scores, resonance, snapshots, audits.

Requests are (entity, asof) rows.  Facts are pre-aggregated to (entity, day, kind) counts before any
per-entity work, so an entity holding a third of all facts costs its number of days, not of facts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import decay, label_by_limits
from tidemark.functions.signs import SIGNS
from tidemark.operators.pit import asof_join, latest_per_key, range_join
from tidemark.operators.recursive import _edges, whole_series

# Score weights, decay and labels.
DIMENSION_WEIGHTS = {"technical": 0.30, "chip": 0.25, "valuation": 0.20, "fundamental": 0.25}
CLIMATE_WEIGHTS = {"index": 0.22, "foreign_market": 0.17, "sentiment": 0.13, "business": 0.17, "exchange_rate": 0.08, "margin": 0.08, "commodity": 0.05, "risk_alert": 0.10}
CLIMATE_LABELS = [(50.0, "strong_bull"), (15.0, "bull"), (-15.0, "neutral"), (-50.0, "bear")]


def kind_sign(kind: str, explicit: dict[str, int] | None = None) -> Column:
    """+1, -1 or 0 by the table of the catalogue's kinds; ``explicit`` adds or replaces kinds."""
    table = F.create_map(*[F.lit(x) for kv in (SIGNS | (explicit or {})).items() for x in kv])
    return F.coalesce(F.try_element_at(table, F.col(kind)), F.lit(0))


def daily_signs(facts: DataFrame, explicit: dict[str, int] | None = None, group: str = "source") -> DataFrame:
    """Net sign and counts per (entity, group, day): the compact input of all decayed scores."""
    s = kind_sign("event_kind", explicit)
    return facts.withColumn("_s", s).groupBy("entity", group, F.col("fact_date").alias("date")).agg(
        F.sum("_s").alias("net"), F.count_if(F.col("_s") > 0).alias("bull"), F.count_if(F.col("_s") < 0).alias("bear"), F.count("*").alias("n"))


def decayed_sum(net: str, per_fact: float, age: Column) -> Column:
    """Sum of net * per_fact * exp(-age / 14), each fact's share in whole billionths: no order of adding changes it."""
    return F.sum(F.col(net) * F.floor(per_fact * decay(age) * 1e9 + 0.5)) / 1e9


def decayed_scores(requests: DataFrame, signs: DataFrame, per_fact: float, lookback: int, group: str = "source") -> DataFrame:
    """Sum of sign * per_fact * exp(-age / 14), clamped to +-100, per (request, group)."""
    j = range_join(requests, signs, lookback)
    raw = decayed_sum("net", per_fact, F.datediff("asof", "date"))
    out = j.groupBy("entity", "asof", group).agg(raw.alias("_raw"), F.sum("bull").alias("bull"), F.sum("bear").alias("bear"), F.sum("n").alias("n_facts"))
    return out.withColumn("score", F.greatest(F.lit(-100.0), F.least(F.lit(100.0), F.col("_raw")))).drop("_raw")


def health(requests: DataFrame, signs: DataFrame, dimension_of: dict[str, str], lookback: int = 90) -> DataFrame:
    """Four dimension scores (whole points), the trend of each and the weighted overall score."""
    dim = F.create_map(*[F.lit(x) for kv in dimension_of.items() for x in kv])
    d = signs.withColumn("dimension", dim[F.col("source")]).filter("dimension is not null").groupBy("entity", "dimension", "date").agg(*[F.sum(c).alias(c) for c in ("net", "bull", "bear", "n")])
    s = decayed_scores(requests, d, 20.0, lookback, "dimension").withColumn("score", F.col("score").cast("int"))
    trend = (F.when(F.col("bull") > F.col("bear") * 1.5, "bullish").when(F.col("bear") > F.col("bull") * 1.5, "bearish").when(F.col("bull") + F.col("bear") > 0, "mixed").otherwise("quiet"))
    s = s.withColumn("trend", trend)
    aggs = [F.coalesce(F.max(F.when(F.col("dimension") == k, F.col("score"))), F.lit(0)).alias(k) for k in DIMENSION_WEIGHTS]
    aggs += [F.coalesce(F.max(F.when(F.col("dimension") == k, F.col("trend"))), F.lit("quiet")).alias(f"{k}_trend") for k in DIMENSION_WEIGHTS]
    out = s.groupBy("entity", "asof").agg(*aggs)
    return out.withColumn("overall", sum((F.col(k) * w for k, w in DIMENSION_WEIGHTS.items()), F.lit(0.0)))


def on_recent_days(rows: DataFrame, days: DataFrame, lookback: int) -> DataFrame:
    """Rows of the last ``lookback`` days per as-of day: a hash join on covered months, then the exact cut.

    ``days`` (asof) is a calendar, one row per day at most.
    """
    months = F.explode(F.sequence(F.trunc(F.date_sub("asof", lookback), "month"), F.trunc("asof", "month"), F.expr("interval 1 month")))
    near = rows.withColumn("_m", F.trunc("date", "month")).join(days.select("asof", months.alias("_m")), "_m")
    return near.filter((F.col("date") <= F.col("asof")) & (F.col("date") >= F.date_sub("asof", lookback))).drop("_m")


def alert_summary(days: DataFrame, alerts: DataFrame, lookback: int = 60) -> DataFrame:
    """Market-wide alert counts per as-of day: active entities, announced in 14 d, escalations in 60 d.

    Alerts are first reduced to one row per (entity, day, kind); ``days`` is a short calendar list.
    """
    a = alerts.groupBy("entity", "date", "event_kind").agg(F.max("period_end").alias("period_end"), F.count("*").alias("n"))
    j = on_recent_days(a, days, lookback)
    is_ = lambda k: F.col("event_kind") == k
    return j.groupBy("asof").agg(
        F.countDistinct(F.when(is_("entered") & (F.col("period_end") >= F.col("asof")), F.col("entity"))).alias("active"),
        F.countDistinct(F.when(is_("announced") & (F.col("date") >= F.date_sub("asof", 14)), F.col("entity"))).alias("announced_14d"),
        F.coalesce(F.sum(F.when(is_("escalation"), F.col("n"))), F.lit(0)).alias("escalations"))


def alert_score() -> Column:
    active = F.when(F.col("active") >= 10, -100).when(F.col("active") >= 5, -50).when(F.col("active") >= 1, -15).otherwise(0)
    esc = F.when(F.col("escalations") >= 3, -30).when(F.col("escalations") >= 1, -15).otherwise(0)
    ann = F.when(F.col("announced_14d") >= 5, -15).otherwise(0)
    return F.greatest(F.lit(-100), active + esc + ann)


def climate(days: DataFrame, signs: DataFrame, component_of: dict[str, str], alerts: DataFrame | None = None, lookback: int = 60) -> DataFrame:
    """Weighted market score per as-of day and its label.  ``signs`` holds market-level daily signs."""
    comp = F.create_map(*[F.lit(x) for kv in component_of.items() for x in kv])
    d = signs.withColumn("component", comp[F.col("source")]).filter("component is not null").groupBy("component", "date").agg(F.sum("net").alias("net"))
    j = on_recent_days(d, days, lookback)
    s = j.groupBy("asof", "component").agg(F.greatest(F.lit(-100.0), F.least(F.lit(100.0), decayed_sum("net", 25.0, F.datediff("asof", "date")))).cast("int").alias("score"))
    if alerts is not None:
        s = s.unionByName(alert_summary(days, alerts, lookback).select("asof", F.lit("risk_alert").alias("component"), alert_score().alias("score")))
    w = F.create_map(*[F.lit(x) for kv in CLIMATE_WEIGHTS.items() for x in kv])
    out = s.groupBy("asof").agg(F.sum(F.col("score") * w[F.col("component")]).alias("climate_score"), F.count("*").alias("components"),
                               F.max(F.when(F.col("component") == "risk_alert", F.col("score"))).alias("risk_alert"))
    return out.withColumn("climate", label_by_limits(F.col("climate_score"), CLIMATE_LABELS, "strong_bear"))


# --- levels ---------------------------------------------------------------------------------------------
def cluster_levels(points: DataFrame, width: float = 0.01, keys: tuple[str, ...] = ("entity",), top_n: int | None = None) -> DataFrame:
    """Greedy price clusters: a point joins while it lies within ``width`` of the cluster's first member.

    Points are shuffled once to their keys, sorted by price and read as streams, so no task keeps a table of points;
    ``top_n`` leaves the strongest clusters of each key.
    """
    given = points.filter("price > 0").dropna(subset=list(keys)).select(*keys, F.col("price").cast("double").alias("price"), "source")
    names = [*keys, "level", "low", "high", "strength", "members"]
    kinds = {f.name: f.dataType for f in given.schema.fields} | dict.fromkeys(("level", "low", "high"), T.DoubleType()) | dict.fromkeys(("strength", "members"), T.IntegerType())

    def run(batches):
        for batch in whole_series(batches, keys):
            price = batch.column("price").to_numpy(zero_copy_only=False)
            opens = np.zeros(len(price), bool)
            opens[[0, *_edges(batch, keys)]] = True
            key, same = np.cumsum(opens), np.concatenate([[False], (price[1:] == price[:-1]) | (np.isnan(price[1:]) & np.isnan(price[:-1]))])
            first = 0.0
            for i, (v, new, again) in enumerate(zip(price.tolist(), opens.tolist(), same.tolist())):
                if new or not (again or (v - first) / first < width):
                    opens[i], first = True, v
            at = np.flatnonzero(opens)
            n = np.diff([*at, len(price)])
            source = batch.column("source").dictionary_encode()
            known = ~source.is_null().to_numpy(zero_copy_only=False)
            pairs = np.unique(np.stack([np.cumsum(opens)[known] - 1, source.indices.drop_null().to_numpy()]), axis=1)
            out = {"level": np.add.reduceat(price, at) / n, "low": price[at], "high": price[at + n - 1], "strength": np.bincount(pairs[0], minlength=len(at)), "members": n}
            if top_n is not None:
                order = np.lexsort((out["level"], -out["members"], -out["strength"], key[at]))
                in_order = key[at][order]
                order = order[np.arange(len(order)) - np.searchsorted(in_order, in_order) < top_n]
                at, out = at[order], {k: v[order] for k, v in out.items()}
            out = {k: pa.array(v, pa.float64() if kinds[k] == T.DoubleType() else pa.int32()) for k, v in out.items()}
            yield pa.RecordBatch.from_arrays([*[batch.column(k).take(pa.array(at)) for k in keys], *out.values()], names=names)

    parts = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return given.repartition(parts, *keys).sortWithinPartitions(*keys, "price").mapInArrow(run, T.StructType([T.StructField(c, kinds[c]) for c in names]))


def key_levels(points: DataFrame, top_n: int = 20, width: float = 0.01, keys: tuple[str, ...] = ("entity",)) -> DataFrame:
    """The ``top_n`` strongest clusters per entity (strength, members, then lower price)."""
    return cluster_levels(points, width, keys, top_n)


def stops_and_targets(entries: DataFrame, levels: DataFrame, atr_mult: float = 2.0, reward: float = 2.0) -> DataFrame:
    """ATR-based and level-based stop and target for both directions.

    ``entries`` (entity, date, entry, atr); the few levels of an entity travel as one array.
    """
    lv = levels.groupBy("entity").agg(F.collect_set("level").alias("_lv"))
    df = entries.join(lv, "entity", "left")
    below = F.array_max(F.filter("_lv", lambda v: v < F.col("entry")))
    above = F.array_min(F.filter("_lv", lambda v: v > F.col("entry")))
    df = df.withColumns({"below": below, "above": above})
    df = df.withColumn("direction", F.explode(F.array(F.lit("long"), F.lit("short"))))
    side = F.when(F.col("direction") == "long", 1.0).otherwise(-1.0)
    long = F.col("direction") == "long"
    return df.select(*entries.columns, "direction", (F.col("entry") - side * atr_mult * F.col("atr")).alias("atr_stop"), (F.col("entry") + side * atr_mult * reward * F.col("atr")).alias("atr_target"),
                     F.when(long, F.col("below")).otherwise(F.col("above")).alias("level_stop"), F.when(long, F.col("above")).otherwise(F.col("below")).alias("level_target"))


def resonance(lines: DataFrame, bands: DataFrame, tops: DataFrame, primary: int = 63, tolerance: float = 0.02, too_wide: float = 0.30) -> DataFrame:
    """Agreement of price lines with forecast bands per (entity, asof, line).

    ``bands`` (entity, asof, horizon, lower, upper, point); ``tops`` (entity, asof, is_top_n).  Bands
    come to the lines packed per request (one struct per horizon), so no line-by-band rows arise.
    """
    packed = bands.groupBy("entity", "asof").agg(F.map_from_entries(F.collect_list(F.struct("horizon", F.struct("lower", "upper", "point")))).alias("b"))
    df = lines.join(packed, ["entity", "asof"], "left").join(tops, ["entity", "asof"], "left").withColumn("is_top_n", F.coalesce("is_top_n", F.lit(False)))
    pr = F.col("line")
    base = F.when(F.col("close") > 0, F.col("close")).otherwise(pr)

    def band(h):
        return F.try_element_at("b", F.lit(h))

    def covers(b):
        wide = (b["upper"] - b["lower"]) / base > too_wide
        return F.coalesce(~wide & (b["lower"] <= pr) & (pr <= b["upper"]), F.lit(False))

    def close_by(b):
        return F.coalesce(F.abs(b["point"] - pr) / base < tolerance, F.lit(False))

    p = band(primary)
    df = df.withColumns({"covers": covers(p), "median_close": close_by(p)})
    level = F.when(~F.col("covers"), "divergence").when(F.col("median_close") & F.col("is_top_n"), "strong").otherwise("basic")
    df = df.withColumn("level", level)
    hs = (21, 63, 126)
    for h in hs:
        df = df.withColumn(f"profile_{h}", F.when(~covers(band(h)), "divergence").when(close_by(band(h)), "basic_median_close").otherwise("basic"))
    widths = F.array_compact(F.array(*[F.when(covers(band(h)), F.struct((band(h)["upper"] - band(h)["lower"]).alias("w"), F.lit(h).alias("h"))) for h in hs]))
    return df.withColumn("tightest_horizon", F.when(F.col("level") != "divergence", F.array_min(widths)["h"])).drop("b")


# --- reads and audits -------------------------------------------------------------------------------------
def snapshot(requests: DataFrame, facts: DataFrame, sections: dict[str, DataFrame], lookback: int = 90) -> DataFrame:
    """As-of snapshot as tidy rows: one per (entity, asof, section, item) with its date and value.

    Fact counts come from daily aggregates; each further section is a keyed series whose latest row
    at or before the request is taken.  Rows rather than one nested document, so none is unbounded.
    """
    daily = facts.groupBy("entity", F.col("fact_date").alias("date"), "source").agg(F.count("*").alias("n"))
    f = range_join(requests, daily, lookback).groupBy("entity", "asof", "source").agg(F.max("date").alias("date"), F.sum("n").cast("double").alias("value"))
    out = f.select("entity", "asof", F.lit("facts").alias("section"), F.col("source").alias("item"), "date", "value")
    for name, df in sections.items():
        a = asof_join(requests, df, ["value"])
        out = out.unionByName(a.select("entity", "asof", F.lit(name).alias("section"), F.lit("latest").alias("item"), F.col("matched").alias("date"), F.col("value").cast("double").alias("value")))
    return out


def event_rates(events: DataFrame, limit: float = 12.0) -> DataFrame:
    """Events per entity and year by kind, and whether they exceed ``limit``."""
    per = events.groupBy("event_kind", "entity").agg(F.count("*").alias("n"), F.min("date").alias("a"), F.max("date").alias("b"))
    g = per.groupBy("event_kind").agg(F.sum("n").alias("n_events"), F.count("*").alias("n_entities"), F.min("a").alias("a"), F.max("b").alias("b"))
    years = F.greatest((F.datediff("b", "a") + 1) / 365.25, F.lit(1e-9))
    rate = F.col("n_events") / F.col("n_entities") / years
    return g.select("event_kind", "n_events", "n_entities", rate.alias("per_entity_year"), (rate <= limit).alias("within_limit"))


def events_by_severity(facts: DataFrame) -> DataFrame:
    return facts.groupBy("fact_date", "severity").agg(F.count("*").alias("n"), F.countDistinct("source").alias("sources"))


def dashboard(signs: DataFrame) -> DataFrame:
    """Latest point per component."""
    return latest_per_key(signs, ["source"], "date", ["net", "n"])


def regime_agreement(regimes: DataFrame) -> DataFrame:
    """Majority regime over the horizons of a day, its support and whether all agree."""
    c = regimes.groupBy("entity", "date", "regime").agg(F.count("*").alias("n"))
    return c.groupBy("entity", "date").agg(F.max_by("regime", F.struct("n", "regime")).alias("majority"), F.max("n").alias("support"), (F.count("*") == 1).alias("all_aligned"))


def trend_view(filtered: DataFrame) -> DataFrame:
    """Deviation of the close from the smoothed price in units of uncertainty (floored at 1 % of price)."""
    floor = F.greatest("uncertainty", F.col("smoothed") * 0.01)
    return filtered.withColumn("deviation", (F.col("close") - F.col("smoothed")) / floor)


def last_values(series: DataFrame, n: int) -> DataFrame:
    """Indicator assembly: the newest ``n`` points per (entity, indicator)."""
    rn = F.row_number().over(Window.partitionBy("entity", "indicator").orderBy(F.desc("date")))
    return series.withColumn("_rn", rn).filter(F.col("_rn") <= n).drop("_rn")


def window_summary(requests: DataFrame, rows: DataFrame, lookback: int, aggs: list[Column]) -> DataFrame:
    """Per-request roll-up of a keyed series over its look-back."""
    return range_join(requests, rows, lookback).groupBy("entity", "asof").agg(*aggs)
