"""Swing legs and wave tables: segmentation, leg windows, rule columns, zones, triggers, screens."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.ranking import group_quantiles, ranked_rows
from tidemark.operators.indicators import true_range
from tidemark.operators.pit import asof_join, range_join
from tidemark.operators.recursive import _edges, arranged, atr_values

# Projection ratios, retracement limits by power, horizons by degree.
FIB_RATIOS = (0.236, 0.382, 0.5, 0.618, 0.786, 1.0, 1.272, 1.618, 2.0, 2.618)
ZONE_WIDTH = 0.04
MAX_RETRACEMENT = {3: 0.65, 2: 0.80, 1: 0.90}
POWER = {"impulse": 3, "zigzag": 0, "triangle": 0, "running_correction": -3, "flat_common": 0, "flat_b_failure": 0, "flat_c_failure": -1, "flat_double_failure": -2,
         "flat_irregular": -1, "flat_irregular_strong_b": -1, "flat_irregular_failure": -2, "flat_elongated": 1}
DEGREES = [(1.0, "sub_minuette", 1), (3.0, "minute", 3), (10.0, "minor", 5), (30.0, "primary", 7), (100.0, "cycle", 8)]
DEGREE_HORIZON = {"sub_minuette": 21, "minute": 21, "minor": 63, "primary": 126, "cycle": 126, "supercycle": 126}
LEG = "wave_no int, start_date date, end_date date, start_price double, end_price double, direction int, start_idx int, end_idx int, atr_start double"


def _legs_of(mid: list[float], atr: list[float], reversal: float) -> list[tuple[int, int, int]]:
    """Legs as (start, end, direction) of one series."""
    found, start, ext, way = [], 0, 0, 0
    top = mid[0]
    for i, v in enumerate(mid):
        if top != top:  # nothing known so far
            start, ext, top = i, i, v
        if v == top or v != v:
            continue
        sign = 1 if v > top else -1
        if way == 0 or sign == way:
            way, ext, top = sign, i, v
        elif abs(v - top) >= atr[ext] * reversal:
            found.append((start, ext, way))
            start, ext, top, way = ext, i, v, sign
    if ext > start:
        found.append((start, ext, way))
    return found


def legs(bars: DataFrame, reversal: float = 0.5, atr_period: int = 14) -> DataFrame:
    """Swing legs of the bar midpoints: a leg ends when price reverses by ``reversal`` ATR (the ATR
    at the extreme).  The open last leg is included.  Sequential per entity; sorted partitions are read as
    streams, so an entity costs no call of its own."""
    key = dict(bars.dtypes)["entity"]
    out = T.StructType.fromDDL(f"entity {key}, {LEG}")

    def of(batch):
        edges = [0, *_edges(batch, ("entity",)), batch.num_rows]
        high, low, tr = (batch.column(c).to_pandas().to_numpy().astype(float) for c in ("high", "low", "tr"))
        mid, wave, at = (high + low) / 2, [], []
        atr = np.empty(len(mid))
        for i, j in zip(edges[:-1], edges[1:]):
            atr[i:j] = atr_values(tr[i:j], atr_period)
            found = _legs_of(mid[i:j].tolist(), atr[i:j].tolist(), reversal)
            wave += range(len(found))
            at += [(s + i, e + i, way, i) for s, e, way in found]
        s, e, way, first = np.array(at, dtype=int).reshape(-1, 4).T
        places = [pa.array(x) for x in (s, e)]
        values = {"entity": batch.column("entity").take(places[0]), "wave_no": wave, "start_date": batch.column("date").take(places[0]), "end_date": batch.column("date").take(places[1]),
                  "start_price": mid[s], "end_price": mid[e], "direction": way, "start_idx": s - first, "end_idx": e - first, "atr_start": atr[s]}
        arrays = [v if isinstance(v, pa.Array) else pa.array(v, pa.float64() if f.dataType == T.DoubleType() else pa.int32()) for f in out.fields for v in [values[f.name]]]
        return pa.RecordBatch.from_arrays(arrays, names=out.fieldNames())

    def run(batches):
        rest = []
        for batch in batches:
            if not batch.num_rows:
                continue
            rest.append(batch)
            whole = pa.concat_batches(rest)
            cut = _edges(whole, ("entity",))
            if cut:  # the last series may go on in the next batch
                yield of(whole.slice(0, cut[-1]))
            rest = [whole.slice(cut[-1] if cut else 0)]
        if rest:
            yield of(rest[0])

    # the window keeps the order of its arranged rows
    return true_range(arranged(bars.select("entity", "date", "high", "low", "close"))).select("entity", "date", "high", "low", "tr").mapInArrow(run, out)


def leg_metrics(df: DataFrame, neutral_atr: float = 1.0) -> DataFrame:
    """Magnitude, duration, ATR-relative size and slope; legs below ``neutral_atr`` ATR are neutral."""
    mag = F.abs(F.col("end_price") - F.col("start_price"))
    rel = F.when(F.col("atr_start") > 0, mag / F.col("atr_start")).otherwise(0.0)
    bars = F.col("end_idx") - F.col("start_idx")
    neutral = (F.col("atr_start") <= 0) | (mag < F.col("atr_start") * neutral_atr)
    return df.withColumns({"magnitude": mag, "duration": bars, "atr_relative": rel, "slope": F.when(bars > 0, rel / bars).otherwise(0.0), "is_neutral": neutral})


def _lead_legs(metrics: DataFrame, n: int) -> DataFrame:
    """Directional legs with the ``n - 1`` legs after them; null past the end of the series."""
    w = Window.partitionBy("entity").orderBy("wave_no")
    df = metrics.filter(~F.col("is_neutral")).select("entity", "wave_no", F.struct("start_date", "end_date", "start_price", "end_price", "direction", "magnitude").alias("w1"))
    return df.withColumns({f"w{k + 1}": F.lead("w1", k).over(w) for k in range(1, n)}).withColumn("direction", F.col("w1.direction"))


def _alternates(n: int) -> Column:
    """The first ``n`` legs are there and turn at each step."""
    turns = F.col(f"w{n}").isNotNull()
    for k in range(1, n):
        turns = turns & (F.col(f"w{k}.direction") != F.col(f"w{k + 1}.direction"))
    return turns


def leg_windows(metrics: DataFrame, n: int) -> DataFrame:
    """Windows of ``n`` consecutive directional legs with alternating direction, one row each."""
    return _lead_legs(metrics, n).filter(_alternates(n))


def _beyond(a: str, b: str) -> Column:
    """``a`` lies past ``b`` against the wave's direction."""
    return (F.col(a) - F.col(b)) * F.col("direction") < 0


def five_leg_rules(df: DataFrame) -> DataFrame:
    """Impulse rules, overlap and triangle rules as boolean columns, with the number passed."""
    m = lambda k: F.col(f"w{k}.magnitude")
    rules = {
        "same_direction": (F.col("w1.direction") == F.col("w3.direction")) & (F.col("w3.direction") == F.col("w5.direction")),
        "w2_holds_start": ~_beyond("w2.end_price", "w1.start_price"), "w3_exceeds_w2": m(3) > m(2), "w4_holds_w3": ~_beyond("w4.end_price", "w3.start_price"),
        "w5_long_enough": m(5) >= 0.382 * 0.96 * m(4), "w3_not_shortest": m(3) >= F.least(m(1), m(5)), "no_overlap": ~_beyond("w4.end_price", "w2.end_price"),
    }
    ratio = F.when(m(1) > 1e-12, m(2) / m(1))
    shrink = (m(1) > m(3)) & (m(3) > m(5)) & (m(2) > m(4))
    grow = (m(1) < m(3)) & (m(3) < m(5)) & (m(2) < m(4))
    df = df.withColumns(rules)
    passed = sum((F.col(r).cast("int") for r in list(rules)[1:]), F.col("same_direction").cast("int"))
    return df.withColumns({"rules_passed": passed, "triangle_b_range": F.coalesce(ratio.between(0.382 * 0.96, 2.618 * 1.04) & ~ratio.between(0.96, 1.04), F.lit(False)), "triangle_legs": shrink | grow})


def three_leg_rules(df: DataFrame) -> DataFrame:
    """Zigzag and flat ratio rules, flat kind and running correction for three-leg windows."""
    a, b, c = (F.col(f"w{k}.magnitude") for k in (1, 2, 3))
    ba, ca = F.when(a > 1e-12, b / a), F.when(a > 1e-12, c / a)
    cb = F.when(b > 0, c / b).otherwise(0.0)
    kind = (F.when((ba > 1.382) & (ca > 1.0), "flat_elongated").when(ba < 0.618, None)
            .when(ba < 0.81, F.when(cb >= 1.0, "flat_b_failure").otherwise("flat_double_failure")).when(ba <= 1.0, F.when(cb >= 1.0, "flat_common").otherwise("flat_c_failure"))
            .when(ba <= 1.236, "flat_irregular").when(ba <= 1.382, "flat_irregular_strong_b").otherwise(F.when(cb < 1.0, "flat_irregular_failure").otherwise("flat_irregular_strong_b")))
    no = F.lit(False)
    return df.withColumns({"zigzag_b": F.coalesce(ba <= 0.618 * 1.04, no), "flat_b": F.coalesce(ba >= 0.618 * 0.96, no), "flat_c": F.coalesce(ca >= 0.382 * 0.96, no),
                           "flat_kind": kind, "is_running": F.coalesce((ba > 1.0) & (ca < 1.0), no)})


def degree(years: Column) -> Column:
    out = F.lit("supercycle")
    for limit, name, _ in reversed(DEGREES):
        out = F.when(years < limit, name).otherwise(out)
    return out


def degree_rank(name: Column) -> Column:
    pairs = [(n, r) for _, n, r in DEGREES] + [("supercycle", 9)]
    return F.coalesce(F.create_map(*[F.lit(x) for p in pairs for x in p])[name], F.lit(0))


def scenarios(metrics: DataFrame) -> DataFrame:
    """Patterns found in the leg windows: impulses, triangles, zigzags, flats, running corrections.

    Each row carries its legs, signed power (towards the trend it implies), degree by span, the
    invalidating price (start of the first leg) and the weakening price (end of the second).
    """
    df = three_leg_rules(five_leg_rules(_lead_legs(metrics, 5)))
    p5 = F.when(F.col("rules_passed") == 7, "impulse").when(F.col("triangle_b_range") & F.col("triangle_legs"), "triangle")
    p3 = F.when(F.col("is_running") & F.col("flat_c"), "running_correction").when(F.col("flat_b") & F.col("flat_c"), F.col("flat_kind")).when(F.col("zigzag_b"), "zigzag")
    n3 = F.col("zigzag_b").cast("int") + F.col("flat_b").cast("int") + F.col("flat_c").cast("int")

    def pick(pattern: Column, n: Column, last: int) -> Column:
        row = F.struct(pattern.alias("pattern"), "direction", n.alias("rules_passed"), F.lit(last).alias("legs"), F.col("w1.start_date").alias("start_date"), F.col(f"w{last}.end_date").alias("end_date"),
                       F.col("w1.start_price").alias("first_start"), F.col("w1.end_price").alias("first_end"), F.col("w2.end_price").alias("second_end"), F.col(f"w{last}.end_price").alias("last_price"))
        return F.when(_alternates(last) & pattern.isNotNull(), row)

    both = F.array_compact(F.array(pick(p5, F.col("rules_passed"), 5), pick(p3, n3, 3)))  # legs are read once for both lengths
    df = df.select("entity", "wave_no", F.inline(both))
    power = F.create_map(*[F.lit(x) for kv in POWER.items() for x in kv])[F.col("pattern")] * F.col("direction")
    df = df.withColumn("power", power.cast("int")).withColumn("span_years", F.datediff("end_date", "start_date") / 365.25)
    limit = F.create_map(*[F.lit(x) for kv in MAX_RETRACEMENT.items() for x in kv])[F.abs("power")]
    return df.withColumns({"degree": degree(F.col("span_years")), "max_retracement": limit, "invalid_price": F.col("first_start"), "weak_price": F.col("second_end")}).drop("span_years")


def fib_zones(df: DataFrame) -> DataFrame:
    """Ten price zones per scenario projected from its first leg (retracements below 1, extensions above)."""
    size = F.abs(F.col("first_end") - F.col("first_start"))
    way = F.when(F.col("first_end") > F.col("first_start"), 1.0).otherwise(-1.0)
    z = df.filter(size > 1e-12).withColumn("ratio", F.explode(F.array(*[F.lit(r) for r in FIB_RATIOS])))
    price = F.when(F.col("ratio") < 1, F.col("first_end") - way * size * F.col("ratio")).otherwise(F.col("first_end") + way * size * F.col("ratio"))
    z = z.withColumn("zone_price", price)
    half = F.abs("zone_price") * ZONE_WIDTH / 2
    return z.withColumns({"low": F.col("zone_price") - half, "high": F.col("zone_price") + half})


def triggers(df: DataFrame) -> DataFrame:
    """Price breaks that invalidate or weaken a scenario: below for rising patterns, above for falling."""
    side = F.when(F.col("direction") > 0, "below").otherwise("above")
    two = F.array(F.struct(F.lit("invalidate").alias("action"), F.col("invalid_price").alias("price")), F.struct(F.lit("weaken").alias("action"), F.col("weak_price").alias("price")))
    return df.select("entity", "wave_no", "legs", "pattern", "end_date", side.alias("side"), F.inline(two))


def is_invalidated(price: str = "close") -> Column:
    """Direction-aware: only a bullish scenario fails below, only a bearish one above its threshold."""
    return F.coalesce(F.when(F.col("power") > 0, (F.col("direction") > 0) & (F.col(price) < F.col("invalid_price")))
                      .when(F.col("power") < 0, (F.col("direction") < 0) & (F.col(price) > F.col("invalid_price"))), F.lit(False))


def primary_scenario(live: DataFrame) -> DataFrame:
    """Per (entity, asof): highest degree, then power strength, then rules passed, then newest."""
    order = F.struct(degree_rank(F.col("degree")), F.abs("power"), "rules_passed", "end_date", "legs", "wave_no")
    rest = [c for c in live.columns if c not in ("entity", "asof")]
    return live.groupBy("entity", "asof").agg(F.max_by(F.struct(*rest), order).alias("s")).select("entity", "asof", "s.*")


def scenarios_at(requests: DataFrame, found: DataFrame, bars: DataFrame, recent_days: int) -> DataFrame:
    """Scenarios that ended within ``recent_days`` before each request, with the close on that day."""
    live = range_join(requests, found, recent_days, row_time="end_date")
    close = asof_join(requests, bars, ["close"]).select("entity", "asof", "close")
    return live.join(close, ["entity", "asof"], "left")


def wave_targets(live: DataFrame, stale_days: int = 7) -> DataFrame:
    """One internal forecast row per (entity, asof): the envelope of the primary scenario's zones."""
    ok = live.filter(~is_invalidated() & (F.datediff("asof", "end_date") <= stale_days))
    z = fib_zones(primary_scenario(ok))
    h = F.create_map(*[F.lit(x) for kv in DEGREE_HORIZON.items() for x in kv])[F.first("degree")]
    return z.groupBy("entity", "asof").agg(F.min("low").alias("lower"), F.max("high").alias("upper"), F.avg("zone_price").alias("point"), F.coalesce(h, F.lit(63)).alias("horizon")).withColumn("internal_only", F.lit(True))


DEFAULTS = {"recent_days": 14, "rr_min": 1.5, "rr_max": 20.0, "max_upside": 2.0, "buffer": 0.05, "min_upside": 0.03}


def setup_rows(live: DataFrame, params: dict | None = None) -> DataFrame:
    """Wave setups: entry, stop, target and reward/risk of recently finished three-leg corrections.

    Thresholds are columns when ``live`` already carries them (a sweep), otherwise literals.
    """
    p = DEFAULTS | (params or {})
    df = live.filter("legs = 3")
    df = df.withColumns({k: F.lit(v) for k, v in p.items() if k not in live.columns})
    pr = F.col("close")
    size, floor = F.abs(F.col("first_end") - F.col("first_start")), F.least("first_start", "first_end")
    zones = F.array(*[floor + size * r for r in FIB_RATIOS])
    ahead = F.filter(zones, lambda v: (v > pr) & (v <= pr * F.col("max_upside")))
    df = df.withColumns({"entry": pr, "stop": F.least("last_price", "first_end", "first_start") * (1 - F.col("buffer")), "target": F.array_max(ahead)})
    rr = (F.col("target") - pr) / F.nullif(pr - F.col("stop"), F.lit(0.0))
    df = df.withColumn("rr", F.when(F.col("stop") < pr, rr))
    reason = (F.when(pr.isNull(), "no_current_price").when(F.datediff("asof", "end_date") > F.col("recent_days"), "not_recent").when(F.col("direction") > 0, "rising_correction")
              .when(F.col("target").isNull(), "no_target").when(F.col("stop") >= pr, "stop_above_current").when((F.col("target") - pr) / pr < F.col("min_upside"), "upside_too_small")
              .when(F.col("rr") < F.col("rr_min"), "rr_below_threshold").when(F.col("rr") > F.col("rr_max"), "rr_above_cap"))
    return df.withColumn("excluded_reason", reason)


def setup_screen(daily: DataFrame, weekly: DataFrame, params: dict | None = None, top_n: int = 30) -> DataFrame:
    """Best setup per (entity, asof, timeframe), ranked by agreement of timeframes, reward/risk, power."""
    def best(live, tf):
        s = setup_rows(live, params).filter("excluded_reason is null")
        b = s.groupBy("entity", "asof").agg(F.max_by(F.struct("pattern", "power", "rr", "entry", "stop", "target"), F.struct("rr", "wave_no")).alias("s"))
        return b.select("entity", "asof", F.lit(tf).alias("timeframe"), "s.*")

    both = best(daily, "daily").unionByName(best(weekly, "weekly"))
    n = F.count("*").over(Window.partitionBy("entity", "asof"))
    both = both.withColumn("aligned", (n > 1).cast("int")).withColumn("key", F.col("aligned") * 1e6 + F.round("rr", 4) * 100 + F.abs("power"))
    ranked = ranked_rows(both, ["asof", "timeframe"], "key", False)
    return ranked.withColumn("is_top_n", F.col("rank") <= top_n).drop("key")


def threshold_sweep(live: DataFrame, axes: dict[str, list[float]]) -> DataFrame:
    """Setups under every combination of thresholds; combinations are exploded as columns, not joined."""
    df = live
    for k, vals in axes.items():
        df = df.withColumn(k, F.explode(F.array(*[F.lit(v) for v in vals])))
    return setup_rows(df)


def sweep_metrics(swept: DataFrame, axes: list[str]) -> DataFrame:
    """Per combination and date: candidates, reward/risk median and p95, extremes, commonest reason."""
    keys = [*axes, "asof"]
    n = swept.groupBy(*keys).agg(F.count("*").alias("n_rows"), F.count_if(F.col("excluded_reason").isNull()).alias("n_candidates"), F.count_if(F.col("rr") > 20).alias("n_outliers"))
    cand = swept.filter("excluded_reason is null").select(*keys, "entity", "wave_no", "rr")
    q = group_quantiles(cand.withColumn("tie", F.col("entity") * 100000 + F.col("wave_no")), keys, "rr", {"rr_p50": 0.5, "rr_p95": 0.95}, tie="tie").drop("n")
    r = swept.filter("excluded_reason is not null").groupBy(*keys, "excluded_reason").agg(F.count("*").alias("c"))
    top = r.groupBy(*keys).agg(F.max_by("excluded_reason", F.struct("c", "excluded_reason")).alias("top_reason"))
    return n.join(q, keys, "left").join(top, keys, "left")


def dominance_counts(rows: DataFrame, by: list[str], axes: dict[str, tuple[str, str, list[float]]]) -> DataFrame:
    """Rows per ``by`` that meet every threshold of a combination, for all combinations of the axes.

    An axis is name -> (column, "at_least" or "at_most", thresholds).  A row meets a prefix of an axis'
    thresholds in order of strictness, so it falls into one cell of a histogram; the count of a
    combination is the sum of the cells at least as strict on every axis.  Sums run along one axis at a
    time, so after one aggregation of the rows the cost follows cells, not rows times combinations.
    Nulls meet nothing; combinations that no row meets have count 0; repeated thresholds count once.
    """
    steps = {k: sorted(set(v), reverse=how == "at_most") for k, (_, how, v) in axes.items()}
    met = {k: sum((F.coalesce((F.col(c) >= t) if how == "at_least" else (F.col(c) <= t), F.lit(False)).cast("int") for t in steps[k]), F.lit(0)) - 1
           for k, (c, how, _) in axes.items()}
    cells = rows.select(*by, *[m.alias(f"_{k}") for k, m in met.items()]).groupBy(*by, *[f"_{k}" for k in axes]).agg(F.count("*").alias("n"))
    groups = cells.select(*by).distinct()
    for k in axes:
        cells = cells.filter(F.col(f"_{k}") >= 0).withColumn(f"_{k}", F.explode(F.sequence(F.lit(0), F.col(f"_{k}"))))
        cells = cells.groupBy(*by, *[f"_{a}" for a in axes]).agg(F.sum("n").alias("n"))
    for k in axes:  # every combination, met or not
        groups = groups.select("*", F.posexplode(F.array(*[F.lit(float(t)) for t in steps[k]])).alias(f"_{k}", k))
    on = [*by, *[f"_{k}" for k in axes]]
    return groups.join(cells, on, "left").select(*by, *axes, F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def sweep_candidates(live: DataFrame, buffers: list[float], axes: dict[str, list[float]]) -> DataFrame:
    """Setups per date and combination of thresholds (recent_days, rr_min, rr_max, min_upside) and stop buffers.

    The buffer moves the stop and so the reward/risk itself, so rows are laid out once per buffer; all else is counted by dominance.
    """
    df = setup_rows(live.withColumn("buffer", F.explode(F.array(*[F.lit(float(b)) for b in buffers]))))
    can = (F.col("direction") <= 0) & F.col("target").isNotNull() & (F.col("stop") < F.col("close"))
    df = df.select("asof", "buffer", F.when(can, F.datediff("asof", "end_date")).alias("age"), F.when(can, F.col("rr")).alias("rr"), ((F.col("target") - F.col("close")) / F.col("close")).alias("upside"))
    of = {"recent_days": ("age", "at_most"), "rr_min": ("rr", "at_least"), "rr_max": ("rr", "at_most"), "min_upside": ("upside", "at_least")}
    return dominance_counts(df, ["asof", "buffer"], {k: (*of[k], v) for k, v in axes.items()}).withColumnRenamed("n", "n_candidates")
