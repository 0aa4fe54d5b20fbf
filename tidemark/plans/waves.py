"""Wave, level and trendline queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import aggregates as A
from tidemark.operators import waves as WV
from tidemark.plans.indicators import ATR_SQL
from tidemark.plans.pit import REQUESTS, quarter_requests
from tidemark.plans.registry import query, rnd, rnds, tidy
from tidemark.sources import views as V

LEGS = ATR_SQL + """, b AS (SELECT entity, idx, date, (high + low) / 2 AS mid, atr FROM ind),
 wk AS (WITH RECURSIVE walk AS (
   SELECT entity, idx AS i, 0 AS st, 0 AS ex, 0 AS way, mid AS ex_mid, atr AS ex_atr, 0 AS done, 0 AS d_st, 0 AS d_ex, 0 AS d_way FROM b WHERE idx = 0
   UNION ALL
   SELECT entity, i, CASE WHEN act = 2 THEN ex ELSE st END, CASE WHEN act > 0 THEN i ELSE ex END, CASE WHEN act > 0 THEN sg ELSE way END, CASE WHEN act > 0 THEN mid ELSE ex_mid END, CASE WHEN act > 0 THEN atr ELSE ex_atr END,
     CASE WHEN act = 2 THEN 1 ELSE 0 END, st, ex, way
   FROM (SELECT w.entity, b.idx AS i, w.st, w.ex, w.way, w.ex_mid, w.ex_atr, b.mid, b.atr, CAST(sign(b.mid - w.ex_mid) AS INTEGER) AS sg,
       CASE WHEN b.mid = w.ex_mid THEN 0 WHEN w.way = 0 OR CAST(sign(b.mid - w.ex_mid) AS INTEGER) = w.way THEN 1 WHEN abs(b.mid - w.ex_mid) >= w.ex_atr * 0.5 THEN 2 ELSE 0 END AS act
     FROM walk w JOIN b ON b.entity = w.entity AND b.idx = w.i + 1))
  SELECT * FROM walk),
 lg0 AS (SELECT entity, d_st AS st, d_ex AS ex, d_way AS way FROM wk WHERE done = 1 UNION ALL SELECT entity, st, ex, way FROM wk WHERE ex > st QUALIFY row_number() OVER (PARTITION BY entity ORDER BY i DESC) = 1),
 legs AS (SELECT l.entity, CAST(row_number() OVER (PARTITION BY l.entity ORDER BY l.st) - 1 AS INTEGER) AS wave_no, s1.date AS start_date, e1.date AS end_date, s1.mid AS start_price, e1.mid AS end_price, l.way AS direction, l.st AS start_idx, l.ex AS end_idx, s1.atr AS atr_start
   FROM lg0 l JOIN b s1 ON s1.entity = l.entity AND s1.idx = l.st JOIN b e1 ON e1.entity = l.entity AND e1.idx = l.ex)"""
METRICS = LEGS + """, met0 AS (SELECT *, abs(end_price - start_price) AS magnitude, end_idx - start_idx AS duration FROM legs),
 met AS (SELECT *, CASE WHEN atr_start > 0 THEN magnitude / atr_start ELSE 0 END AS atr_relative, atr_start <= 0 OR magnitude < atr_start AS is_neutral FROM met0)"""
_C = ["start_date", "end_date", "start_price", "end_price", "direction", "magnitude"]


def windows_sql(n: int, name: str) -> str:
    cols = ", ".join(f"lead({c}, {k}) OVER w AS {c}{k + 1}" for k in range(n) for c in _C)
    alt = " AND ".join([f"direction{k} <> direction{k + 1}" for k in range(1, n)])
    return f"{name}0 AS (SELECT entity, wave_no, {cols} FROM met WHERE NOT is_neutral WINDOW w AS (PARTITION BY entity ORDER BY wave_no)), {name} AS (SELECT *, direction1 AS way FROM {name}0 WHERE direction{n} IS NOT NULL AND {alt})"


def legs(spark, d):
    return WV.legs(V.bars(spark, d))


def metrics(spark, d):
    return WV.leg_metrics(legs(spark, d))


@query("swing_legs", "L1", f"WITH {LEGS} SELECT entity, wave_no, start_date, end_date, direction, start_idx, end_idx, {rnds('start_price end_price atr_start', 3)} FROM legs")
def _legs(spark, d):
    return tidy(legs(spark, d), digits=3)


@query("leg_metrics", "L2,L3", f"WITH {METRICS} SELECT entity, wave_no, is_neutral, CAST(duration AS INTEGER) AS duration, {rnds('magnitude atr_relative', 3)}, {rnd('CASE WHEN duration > 0 THEN atr_relative / duration ELSE 0 END', 'slope', 3)} FROM met")
def _metrics(spark, d):
    return tidy(metrics(spark, d), "entity", "wave_no", "is_neutral", "duration", "magnitude", "atr_relative", "slope", digits=3)


@query("leg_windows", "L4", f"WITH {METRICS}, {windows_sql(3, 'w3')}, {windows_sql(5, 'w5')} SELECT entity, wave_no, 3 AS legs, way AS direction, start_date1 AS start_date, end_date3 AS end_date FROM w3 UNION ALL SELECT entity, wave_no, 5, way, start_date1, end_date5 FROM w5")
def _windows(spark, d):
    m = metrics(spark, d)
    parts = [WV.leg_windows(m, n).select("entity", "wave_no", F.lit(n).alias("legs"), "direction", F.col("w1.start_date").alias("start_date"), F.col(f"w{n}.end_date").alias("end_date")) for n in (3, 5)]
    return parts[0].unionByName(parts[1])


_R5 = {"w2_holds_start": "NOT ((end_price2 - start_price1) * way < 0)", "w3_exceeds_w2": "magnitude3 > magnitude2", "w4_holds_w3": "NOT ((end_price4 - start_price3) * way < 0)",
       "w5_long_enough": "magnitude5 >= 0.382 * 0.96 * magnitude4", "w3_not_shortest": "magnitude3 >= least(magnitude1, magnitude5)", "no_overlap": "NOT ((end_price4 - end_price2) * way < 0)"}
_SUM = " + ".join(f"CAST({c} AS INTEGER)" for c in _R5)
FIVE = windows_sql(5, "w5") + f""", r5 AS (SELECT *, direction1 = direction3 AND direction3 = direction5 AS same_direction, {', '.join(f'{e} AS {c}' for c, e in _R5.items())},
   (magnitude2 / magnitude1 BETWEEN 0.382 * 0.96::DOUBLE AND 2.618 * 1.04::DOUBLE) AND NOT (magnitude2 / magnitude1 BETWEEN 0.96 AND 1.04) AS triangle_b_range,
   (magnitude1 > magnitude3 AND magnitude3 > magnitude5 AND magnitude2 > magnitude4) OR (magnitude1 < magnitude3 AND magnitude3 < magnitude5 AND magnitude2 < magnitude4) AS triangle_legs FROM w5),
 r5s AS (SELECT *, CAST(same_direction AS INTEGER) + {_SUM} AS rules_passed FROM r5)"""
THREE = windows_sql(3, "w3") + """, r3a AS (SELECT *, magnitude2 / magnitude1 AS ba, magnitude3 / magnitude1 AS ca, CASE WHEN magnitude2 > 0 THEN magnitude3 / magnitude2 ELSE 0 END AS cb FROM w3),
 r3 AS (SELECT *, ba <= 0.618 * 1.04 AS zigzag_b, ba >= 0.618 * 0.96 AS flat_b, ca >= 0.382 * 0.96 AS flat_c, ba > 1.0 AND ca < 1.0 AS is_running,
   CASE WHEN ba > 1.382 AND ca > 1.0 THEN 'flat_elongated' WHEN ba < 0.618 THEN NULL WHEN ba < 0.81 THEN CASE WHEN cb >= 1.0 THEN 'flat_b_failure' ELSE 'flat_double_failure' END
     WHEN ba <= 1.0 THEN CASE WHEN cb >= 1.0 THEN 'flat_common' ELSE 'flat_c_failure' END WHEN ba <= 1.236 THEN 'flat_irregular' WHEN ba <= 1.382 THEN 'flat_irregular_strong_b' WHEN cb < 1.0 THEN 'flat_irregular_failure' ELSE 'flat_irregular_strong_b' END AS flat_kind FROM r3a)"""


@query("impulse_rules", "L5,L6", f"WITH {METRICS}, {FIVE} SELECT entity, wave_no, same_direction, {', '.join(_R5)}, rules_passed, triangle_b_range, triangle_legs FROM r5s")
def _impulse(spark, d):
    return WV.five_leg_rules(WV.leg_windows(metrics(spark, d), 5)).select("entity", "wave_no", "same_direction", *_R5, "rules_passed", "triangle_b_range", "triangle_legs")


@query("correction_rules", "L6,L7", f"WITH {METRICS}, {THREE} SELECT entity, wave_no, zigzag_b, flat_b, flat_c, flat_kind, is_running FROM r3")
def _correction(spark, d):
    return WV.three_leg_rules(WV.leg_windows(metrics(spark, d), 3)).select("entity", "wave_no", "zigzag_b", "flat_b", "flat_c", "flat_kind", "is_running")


_POW = " ".join(f"WHEN '{k}' THEN {v}" for k, v in WV.POWER.items())
SCEN = f"""{METRICS}, {FIVE}, {THREE}, sc0 AS (
 SELECT entity, wave_no, CASE WHEN rules_passed = 7 THEN 'impulse' WHEN triangle_b_range AND triangle_legs THEN 'triangle' END AS pattern, way AS direction, rules_passed, 5 AS legs, start_date1 AS start_date, end_date5 AS end_date, start_price1 AS first_start, end_price1 AS first_end, end_price2 AS second_end, end_price5 AS last_price FROM r5s
 UNION ALL SELECT entity, wave_no, CASE WHEN is_running AND flat_c THEN 'running_correction' WHEN flat_b AND flat_c THEN flat_kind WHEN zigzag_b THEN 'zigzag' END, way, CAST(zigzag_b AS INTEGER) + CAST(flat_b AS INTEGER) + CAST(flat_c AS INTEGER), 3, start_date1, end_date3, start_price1, end_price1, end_price2, end_price3 FROM r3),
 sc AS (SELECT *, CASE pattern {_POW} END * direction AS power, CASE WHEN (end_date - start_date) / 365.25 < 1 THEN 'sub_minuette' WHEN (end_date - start_date) / 365.25 < 3 THEN 'minute' WHEN (end_date - start_date) / 365.25 < 10 THEN 'minor' ELSE 'primary' END AS degree FROM sc0 WHERE pattern IS NOT NULL)"""


def found(spark, d):
    return WV.scenarios(metrics(spark, d))


@query("wave_scenarios", "L9,L11", f"WITH {SCEN} SELECT entity, wave_no, legs, pattern, direction, rules_passed, start_date, end_date, CAST(power AS INTEGER) AS power, degree, {rnd('CASE abs(power) WHEN 3 THEN 0.65 WHEN 2 THEN 0.80 WHEN 1 THEN 0.90 END', 'max_retracement')} FROM sc")
def _scenarios(spark, d):
    return tidy(found(spark, d), "entity", "wave_no", "legs", "pattern", "direction", "rules_passed", "start_date", "end_date", "power", "degree", "max_retracement")


@query("fib_zones", "L8", f"WITH {SCEN}, rt(ratio) AS (VALUES {', '.join(f'({r}::DOUBLE)' for r in WV.FIB_RATIOS)}), z AS (SELECT *, CASE WHEN ratio < 1 THEN first_end - sign(first_end - first_start) * abs(first_end - first_start) * ratio ELSE first_end + sign(first_end - first_start) * abs(first_end - first_start) * ratio END AS zp FROM sc, rt) SELECT entity, wave_no, legs, ratio, {rnd('zp', 'zone_price', 2)}, {rnd('zp - abs(zp) * 0.04 / 2', 'low', 2)}, {rnd('zp + abs(zp) * 0.04 / 2', 'high', 2)} FROM z")
def _zones(spark, d):
    z = WV.fib_zones(found(spark, d))
    return z.select("entity", "wave_no", "legs", "ratio", *[(F.floor(F.col(c) * 100 + 0.50001) / 100).alias(c) for c in ("zone_price", "low", "high")])


@query("invalidation_triggers", "L10", f"WITH {SCEN} SELECT entity, wave_no, legs, pattern, end_date, CASE WHEN direction > 0 THEN 'below' ELSE 'above' END AS side, 'invalidate' AS action, {rnd('first_start', 'price', 3)} FROM sc UNION ALL SELECT entity, wave_no, legs, pattern, end_date, CASE WHEN direction > 0 THEN 'below' ELSE 'above' END, 'weaken', {rnd('second_end', 'price', 3)} FROM sc")
def _triggers(spark, d):
    return tidy(WV.triggers(found(spark, d)), digits=3)


def live(spark, d, days=60):
    b, req = V.bars(spark, d), quarter_requests(spark, d)
    return WV.scenarios_at(req, WV.scenarios(WV.leg_metrics(WV.legs(b))), b, days)


LIVE = f"""{SCEN}, {REQUESTS}, cl AS (SELECT r.entity, r.asof, m.close FROM requests r ASOF LEFT JOIN bars m ON m.entity = r.entity AND r.asof >= m.date),
 lv AS (SELECT sc.*, r.asof AS "asof", c.close, coalesce(CASE WHEN power > 0 THEN direction > 0 AND c.close < first_start WHEN power < 0 THEN direction < 0 AND c.close > first_start END, false) AS dead FROM requests r JOIN sc ON sc.entity = r.entity AND sc.end_date <= r.asof AND sc.end_date >= r.asof - 60 JOIN cl c ON c.entity = r.entity AND c.asof = r.asof)"""
_ORD = "CASE degree WHEN 'sub_minuette' THEN 1 WHEN 'minute' THEN 3 WHEN 'minor' THEN 5 WHEN 'primary' THEN 7 ELSE 0 END DESC, abs(power) DESC, rules_passed DESC, end_date DESC, legs DESC, wave_no DESC"


@query("primary_scenario", "K13", f"""WITH {LIVE} SELECT entity, asof AS "asof", pattern, CAST(power AS INTEGER) AS power, degree, rules_passed, end_date FROM lv QUALIFY row_number() OVER (PARTITION BY entity, "asof" ORDER BY {_ORD}) = 1""")
def _primary(spark, d):
    return WV.primary_scenario(live(spark, d)).select("entity", "asof", "pattern", "power", "degree", "rules_passed", "end_date")


@query("invalidation_gate", "K14", f"""WITH {LIVE} SELECT entity, asof AS "asof", count(*) AS n_scenarios, count(*) FILTER (dead) AS n_invalidated, bool_and(dead) AS track_closed FROM lv GROUP BY entity, "asof" """)
def _gate(spark, d):
    dead = WV.is_invalidated()
    return live(spark, d).groupBy("entity", "asof").agg(F.count("*").alias("n_scenarios"), F.count_if(dead).alias("n_invalidated"), F.bool_and(dead).alias("track_closed"))


_RT = "rt(ratio) AS (VALUES " + ", ".join(f"({r}::DOUBLE)" for r in WV.FIB_RATIOS) + ")"
_ZP = "CASE WHEN ratio < 1 THEN first_end - sign(first_end - first_start) * abs(first_end - first_start) * ratio ELSE first_end + sign(first_end - first_start) * abs(first_end - first_start) * ratio END"


@query("wave_target_forecast", "J7", f"""WITH {LIVE}, {_RT}, pr AS (SELECT * FROM lv WHERE NOT dead AND "asof" - end_date <= 7 QUALIFY row_number() OVER (PARTITION BY entity, "asof" ORDER BY {_ORD}) = 1),
 z AS (SELECT entity, "asof", degree, {_ZP} AS zp FROM pr, rt) SELECT entity, "asof", CASE any_value(degree) WHEN 'sub_minuette' THEN 21 WHEN 'minute' THEN 21 WHEN 'minor' THEN 63 ELSE 126 END AS horizon, {rnd('min(zp - abs(zp) * 0.02)', 'lower', 2)}, {rnd('max(zp + abs(zp) * 0.02)', 'upper', 2)}, {rnd('avg(zp)', 'point', 2)}, true AS internal_only FROM z GROUP BY 1, 2""")
def _targets(spark, d):
    return tidy(WV.wave_targets(live(spark, d)), "entity", "asof", "horizon", "lower", "upper", "point", "internal_only", digits=2)


def _best_setup(live_sql: str, timeframe: str) -> str:
    """Best setup per (entity, asof) under the default thresholds."""
    return f"""WITH {live_sql.replace('r.asof - 60', 'r.asof - 14')}, q0 AS (SELECT *, abs(first_end - first_start) AS sz, least(first_start, first_end) AS fl, least(last_price, first_end, first_start) * 0.95::DOUBLE AS stop FROM lv WHERE legs = 3),
 q1 AS (SELECT *, list_max(list_filter([{', '.join(f'fl + sz * {r}::DOUBLE' for r in WV.FIB_RATIOS)}], lambda v: v > close AND v <= close * 2.0::DOUBLE)) AS target FROM q0), q2 AS (SELECT *, CASE WHEN stop < close THEN (target - close) / (close - stop) END AS rr FROM q1)
 SELECT entity, "asof", '{timeframe}' AS timeframe, pattern, power, rr, close AS entry, stop, target FROM q2 WHERE direction < 0 AND target IS NOT NULL AND stop < close AND (target - close) / close >= 0.03 AND rr >= 1.5 AND rr <= 20
 QUALIFY row_number() OVER (PARTITION BY entity, "asof" ORDER BY rr DESC, wave_no DESC) = 1"""


_WEEKLY = LIVE.replace("FROM bars)", "FROM weeks)", 1).replace(", s AS (", """, weeks AS (SELECT entity, CAST(date_trunc('week', date) AS DATE) + 6 AS date, arg_min(open, date) AS open, max(high) AS high, min(low) AS low, arg_max(close, date) AS close, CAST(sum(volume) AS BIGINT) AS volume FROM bars GROUP BY 1, 2), s AS (""", 1)


@query("wave_setup_screen", "G13", f"""WITH dl AS ({_best_setup(LIVE, 'daily')}), wl AS ({_best_setup(_WEEKLY, 'weekly')}), u AS (SELECT * FROM dl UNION ALL SELECT * FROM wl), a AS (SELECT *, CASE WHEN count(*) OVER (PARTITION BY entity, "asof") > 1 THEN 1 ELSE 0 END AS aligned FROM u),
 k AS (SELECT *, row_number() OVER (PARTITION BY "asof", timeframe ORDER BY aligned * 1000000.0::DOUBLE + round(rr, 4) * 100 + abs(power) DESC, entity) AS rank, count(*) OVER (PARTITION BY "asof", timeframe) AS n FROM a)
 SELECT entity, "asof", timeframe, pattern, CAST(power AS INTEGER) AS power, {rnds('rr entry stop target', 3)}, aligned, CAST(rank AS INTEGER) AS rank, CAST(n AS INTEGER) AS universe_size, rank <= 30 AS is_top_n FROM k""")
def _screen(spark, d):
    req, b = quarter_requests(spark, d), V.bars(spark, d)
    week = A.period_bars(b, "week").withColumnRenamed("period", "date").withColumn("date", F.date_add("date", 6))
    daily = WV.scenarios_at(req, WV.scenarios(WV.leg_metrics(WV.legs(b))), b, 14)
    weekly = WV.scenarios_at(req, WV.scenarios(WV.leg_metrics(WV.legs(week))), b, 14)
    return tidy(WV.setup_screen(daily, weekly), digits=3)


AXES = {"rr_min": [1.0, 1.5], "buffer": [0.03, 0.05, 0.10]}


@query("threshold_sweep_metrics", "G14,D12", f"""WITH {LIVE}, ax AS (SELECT rr_min, buffer FROM (VALUES {', '.join(f'({v}::DOUBLE)' for v in AXES['rr_min'])}) a(rr_min), (VALUES {', '.join(f'({v}::DOUBLE)' for v in AXES['buffer'])}) b(buffer)),
 q0 AS (SELECT lv.*, ax.*, abs(first_end - first_start) AS sz, least(first_start, first_end) AS fl, least(last_price, first_end, first_start) * (1 - buffer) AS stop FROM lv, ax WHERE legs = 3),
 q1 AS (SELECT *, list_max(list_filter([{', '.join(f'fl + sz * {r}::DOUBLE' for r in WV.FIB_RATIOS)}], lambda v: v > close AND v <= close * 2.0::DOUBLE)) AS target FROM q0), q2 AS (SELECT *, CASE WHEN stop < close THEN (target - close) / (close - stop) END AS rr FROM q1),
 q3 AS (SELECT *, CASE WHEN close IS NULL THEN 'no_current_price' WHEN "asof" - end_date > 14 THEN 'not_recent' WHEN direction > 0 THEN 'rising_correction' WHEN target IS NULL THEN 'no_target' WHEN stop >= close THEN 'stop_above_current'
   WHEN (target - close) / close < 0.03 THEN 'upside_too_small' WHEN rr < rr_min THEN 'rr_below_threshold' WHEN rr > 20 THEN 'rr_above_cap' END AS why FROM q2),
 tr0 AS (SELECT rr_min, buffer, "asof", why, count(*) AS c FROM q3 WHERE why IS NOT NULL GROUP BY 1, 2, 3, 4), tr AS (SELECT * FROM tr0 QUALIFY row_number() OVER (PARTITION BY rr_min, buffer, "asof" ORDER BY c DESC, why DESC) = 1),
 g AS (SELECT rr_min, buffer, "asof", count(*) AS n_rows, count(*) FILTER (why IS NULL) AS n_candidates, count(*) FILTER (rr > 20) AS n_outliers, quantile_cont(CASE WHEN why IS NULL THEN rr END, 0.5) AS rr_p50, quantile_cont(CASE WHEN why IS NULL THEN rr END, 0.95) AS rr_p95 FROM q3 GROUP BY 1, 2, 3)
 SELECT {rnd('g.rr_min', 'rr_min', 3)}, {rnd('g.buffer', 'buffer', 3)}, g.asof AS "asof", n_rows, n_candidates, n_outliers, {rnd('rr_p50', digits=3)}, {rnd('rr_p95', digits=3)}, tr.why AS top_reason FROM g LEFT JOIN tr ON tr.rr_min = g.rr_min AND tr.buffer = g.buffer AND tr.asof = g.asof""")
def _sweep(spark, d):
    from tidemark.session import cut

    swept = cut(WV.threshold_sweep(live(spark, d), AXES))
    return tidy(WV.sweep_metrics(swept, list(AXES)), digits=3)


@query("nested_size_audit", "D17", f"""WITH {LIVE}, n AS (SELECT entity, asof AS "asof", count(*) AS size FROM lv GROUP BY 1, 2) SELECT asof AS "asof", {rnd('quantile_cont(size, 0.5)', 'p50')}, {rnd('quantile_cont(size, 0.95)', 'p95')}, {rnd('quantile_cont(size, 0.99)', 'p99')}, {rnd('max(size)', 'largest')}, CAST(count(*) AS INTEGER) AS n FROM n GROUP BY 1""")
def _sizes(spark, d):
    from tidemark.functions.ranking import group_quantiles

    n = live(spark, d).groupBy("entity", "asof").agg(F.count("*").cast("double").alias("size"))
    return tidy(group_quantiles(n, ["asof"], "size", {"p50": 0.5, "p95": 0.95, "p99": 0.99, "largest": 1.0}))


GRID_AXES = {"recent_days": [3, 7, 14], "rr_min": [1.0, 1.5, 2.0, 3.0], "rr_max": [5.0, 10.0, 20.0], "min_upside": [0.0, 0.03, 0.1]}


@query("threshold_grid_counts", "G14,D12", f"""WITH {LIVE}, q0 AS (SELECT lv.*, buffer, abs(first_end - first_start) AS sz, least(first_start, first_end) AS fl, least(last_price, first_end, first_start) * (1 - buffer) AS stop
   FROM lv, (VALUES {', '.join(f'({v}::DOUBLE)' for v in AXES['buffer'])}) b(buffer) WHERE legs = 3),
 q1 AS (SELECT *, list_max(list_filter([{', '.join(f'fl + sz * {r}::DOUBLE' for r in WV.FIB_RATIOS)}], lambda v: v > close AND v <= close * 2.0::DOUBLE)) AS target FROM q0),
 q2 AS (SELECT asof AS "asof", buffer, CASE WHEN direction <= 0 AND stop < close THEN "asof" - end_date END AS age, CASE WHEN stop < close THEN (target - close) / (close - stop) END AS rr, (target - close) / close AS upside FROM q1),
 ax AS (SELECT * FROM {', '.join(f"(VALUES {', '.join(f'({v}::DOUBLE)' for v in t)}) x_{k}({k})" for k, t in GRID_AXES.items())})
 SELECT q2.asof AS "asof", {rnd('buffer', digits=3)}, recent_days, rr_min, rr_max, min_upside, count(*) FILTER (age <= recent_days AND rr >= rr_min AND rr <= rr_max AND upside >= min_upside) AS n_candidates
 FROM q2, ax GROUP BY ALL""")
def _grid(spark, d):
    n = WV.sweep_candidates(live(spark, d), AXES["buffer"], GRID_AXES)
    return n.withColumn("buffer", F.floor(F.col("buffer") * 1000 + 0.50001) / 1000)
