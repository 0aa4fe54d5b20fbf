"""Queries on levels and lines as of request days."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import events as E
from tidemark.operators import fusion as FU
from tidemark.operators import levels as LV
from tidemark.operators import waves as WV
from tidemark.plans import waves as PW
from tidemark.plans.ctes import SERIES
from tidemark.plans.pit import REQUESTS, quarter_requests
from tidemark.plans.registry import query, rnd, rnds, tidy
from tidemark.sources import views as V

SWINGS = f"""pv0 AS (SELECT entity, idx, date, volume, CASE WHEN {E.is_pivot_high('high')} THEN high END AS hi, CASE WHEN {E.is_pivot_low('low')} THEN low END AS lo FROM s),
 pv AS MATERIALIZED (SELECT entity, idx, date, volume, 'resistance' AS kind, hi AS price FROM pv0 WHERE hi IS NOT NULL UNION ALL SELECT entity, idx, date, volume, 'support', lo FROM pv0 WHERE lo IS NOT NULL)"""


def levels_sql(requests: str) -> str:
    """Levels for requests (entity, asof, t), ``t`` being the last bar's number: each window clustered anew."""
    return f"""wp AS MATERIALIZED (SELECT r.entity, r.asof, t, pv.kind, pv.idx, pv.date, pv.volume, pv.price, row_number() OVER (PARTITION BY r.entity, r.asof, pv.kind ORDER BY pv.price, pv.idx) AS k
   FROM {requests} r JOIN pv ON pv.entity = r.entity AND pv.idx BETWEEN greatest(0, t - 119) + 3 AND t - 3),
 wl AS (SELECT entity, asof, kind, list_reduce(list({{'c': price, 'n': 1::BIGINT, 'done': []::STRUCT(c DOUBLE, n BIGINT)[]}} ORDER BY k),
   lambda a, x: CASE WHEN abs(x.c - a.c) / a.c <= 0.01::DOUBLE THEN {{'c': (a.c * a.n + x.c) / (a.n + 1), 'n': a.n + 1, 'done': a.done}} ELSE {{'c': x.c, 'n': 1::BIGINT, 'done': list_append(a.done, {{'c': a.c, 'n': a.n}})}} END) AS z FROM wp GROUP BY ALL),
 wc AS (SELECT entity, asof, kind, unnest(list_append(z.done, {{'c': z.c, 'n': z.n}})) AS g, unnest(range(1, len(z.done) + 2)) AS j FROM wl),
 wn AS (SELECT entity, asof, kind, j, g.c AS c, g.n AS n, coalesce(sum(g.n) OVER (PARTITION BY entity, asof, kind ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead FROM wc),
 wkeep AS (SELECT entity, asof, kind, list_reduce(list({{'c': c, 'kept': [c]}} ORDER BY n DESC, j), lambda a, x: CASE WHEN len(list_filter(a.kept, lambda v: abs(v - x.c) / ((v + x.c) / 2) < 0.02::DOUBLE)) = 0 THEN {{'c': x.c, 'kept': list_append(a.kept, x.c)}} ELSE a END).kept AS kept
   FROM wn WHERE n >= 3 GROUP BY ALL),
 lvl AS MATERIALIZED (SELECT wn.entity, wn.asof, wn.kind, c AS level, n, min(date) AS first_seen, max(date) AS last_seen, t - max(idx) AS recency, max(idx) - min(idx) AS span, avg(volume) AS avg_volume
   FROM wn JOIN wkeep USING (entity, asof, kind) JOIN wp ON wp.entity = wn.entity AND wp.asof = wn.asof AND wp.kind = wn.kind AND wp.k > ahead AND wp.k <= ahead + n WHERE n >= 3 AND list_contains(kept, c) GROUP BY wn.entity, wn.asof, wn.kind, t, j, c, n)"""


QUARTERS = f"""{REQUESTS}, rq AS MATERIALIZED (SELECT r.entity, r.asof, max(idx) AS t FROM requests r JOIN s ON s.entity = r.entity AND s.date <= r.asof GROUP BY ALL)"""


@query("support_resistance_levels", "F29", f"""WITH {SERIES}, {SWINGS}, rq AS (SELECT entity, date AS asof, idx AS t FROM s), {levels_sql('rq')}
 SELECT entity, asof AS "asof", kind, {rnd('level')}, CAST(n AS INTEGER) AS touches, first_seen, last_seen, CAST(recency AS INTEGER) AS recency, CAST(span AS INTEGER) AS span, {rnd('avg_volume')} FROM lvl""")
def _levels(spark, d):
    """Levels as of every trading day of every entity."""
    b = V.bars(spark, d)
    return tidy(LV.levels_at(b.select("entity", F.col("date").alias("asof")), b))


@query("support_resistance_events", "F29", f"""WITH {SERIES}, {SWINGS}, {QUARTERS}, {levels_sql('rq')},
 w AS (SELECT rq.entity, rq.asof, rq.t, s.idx, s.date, s.low, s.close, CASE WHEN s.idx > greatest(0, rq.t - 119) THEN lag(s.close) OVER (PARTITION BY rq.entity, rq.asof ORDER BY s.idx) END AS was FROM rq JOIN s ON s.entity = rq.entity AND s.idx BETWEEN greatest(0, rq.t - 119) AND rq.t),
 j AS MATERIALIZED (SELECT w.*, kind, level, CASE kind WHEN 'resistance' THEN was <= level AND close > level * 1.02::DOUBLE ELSE was >= level AND close < level * 0.98::DOUBLE END AS broke FROM w JOIN lvl ON lvl.entity = w.entity AND lvl.asof = w.asof),
 b AS (SELECT entity, asof, level, min(idx) AS b FROM j WHERE broke AND kind = 'resistance' GROUP BY ALL),
 r AS (SELECT b.*, min(idx) AS r FROM b JOIN j ON j.entity = b.entity AND j.asof = b.asof AND j.level = b.level AND kind = 'resistance' AND idx > b AND idx < b + 30 AND abs(low - j.level) / j.level < 0.01::DOUBLE GROUP BY ALL),
 f AS (SELECT r.entity, r.asof, r.level, r.r, bool_and(close >= r.level) AS holds FROM r JOIN j ON j.entity = r.entity AND j.asof = r.asof AND j.level = r.level AND kind = 'resistance' AND idx >= r.r AND idx < r.r + 5 GROUP BY ALL)
 SELECT entity, asof AS "asof", date, kind || '_break' AS event_kind, {rnd('level', 'value')} FROM j WHERE broke
 UNION ALL SELECT f.entity, f.asof, s.date, 'level_flip', {rnd('level', 'value')} FROM f JOIN s ON s.entity = f.entity AND s.idx = f.r WHERE holds""")
def _events(spark, d):
    """Breaks and flips in the window of every quarter end; the windows overlap and cover the whole history."""
    return tidy(LV.level_events_at(quarter_requests(spark, d), V.bars(spark, d)))


#: Ends of legs known at a request: those reversed by then, and the open leg's extreme.
_ENDS = """ke AS MATERIALIZED (SELECT entity, d_ex AS loc, d_way AS way, i AS seen FROM wk WHERE done = 1),
 rp AS MATERIALIZED (SELECT r.entity, r.asof, r.t, ke.loc, ke.way FROM rq r JOIN ke ON ke.entity = r.entity AND ke.seen <= r.t UNION ALL SELECT r.entity, r.asof, r.t, wk.ex, wk.way FROM rq r JOIN wk ON wk.entity = r.entity AND wk.i = r.t AND wk.ex > wk.st),
 rv AS MATERIALIZED (SELECT rp.*, s.date, (s.high + s.low) / 2 AS p FROM rp JOIN s ON s.entity = rp.entity AND s.idx = rp.loc WHERE loc >= greatest(0, t - 249))"""


def lines_sql(min_pivots: int, tolerance: float) -> str:
    return f"""{_ENDS},
 pr AS (SELECT a.entity, a.asof, a.t, a.way, a.loc AS a, b.loc AS b, a.p AS p0, (b.p - a.p) / (b.loc - a.loc) AS slope, a.date AS da, b.date AS db FROM rv a JOIN rv b ON b.entity = a.entity AND b.asof = a.asof AND b.way = a.way AND b.loc >= a.loc + 30),
 tc AS (SELECT pr.*, 1 + count(*) AS n, 1 + count(*) FILTER (k.loc <= b) AS anchors, max(k.date) AS last_touch FROM pr JOIN rv k ON k.entity = pr.entity AND k.asof = pr.asof AND k.way = pr.way AND k.loc > a
   AND (k.loc = b OR (p0 + slope * (k.loc - a) > 0 AND abs(k.p - (p0 + slope * (k.loc - a))) / (p0 + slope * (k.loc - a)) < {tolerance}::DOUBLE)) GROUP BY ALL HAVING 1 + count(*) >= {min_pivots}),
 kp AS (SELECT entity, asof, way, list_reduce(list({{'x': {{'a': a, 'b': b, 's': slope, 'd': da}}, 'kept': [{{'a': a, 'b': b, 's': slope, 'd': da}}]}} ORDER BY anchors DESC, a, b),
   lambda u, v: CASE WHEN len(list_filter(u.kept, lambda o: abs(o.s - v.x.s) < 0.05::DOUBLE * greatest(abs(o.s), 1e-9::DOUBLE) AND abs(o.d - v.x.d) < 5)) = 0 THEN {{'x': v.x, 'kept': list_append(u.kept, v.x)}} ELSE u END).kept AS kept FROM tc GROUP BY ALL),
 tl AS MATERIALIZED (SELECT tc.*, CASE tc.way WHEN 1 THEN 'resistance' ELSE 'support' END AS kind, p0 + slope * (t - a) AS price_now,
   (SELECT min(s.date) FROM s WHERE s.entity = tc.entity AND s.idx > a AND s.idx <= t AND p0 + slope * (s.idx - a) > 0 AND CASE tc.way WHEN 1 THEN s.close > (p0 + slope * (s.idx - a)) * 1.02::DOUBLE ELSE s.close < (p0 + slope * (s.idx - a)) * 0.98::DOUBLE END) AS broken_at
   FROM (SELECT entity, asof, way, unnest(kept) AS x FROM kp) k JOIN tc ON tc.entity = k.entity AND tc.asof = k.asof AND tc.way = k.way AND tc.a = k.x.a AND tc.b = k.x.b)"""


MIN_PIVOTS, TOLERANCE = 5, 0.005


@query("trendlines", "F30", f"""WITH {PW.LEGS}, {QUARTERS}, {lines_sql(MIN_PIVOTS, TOLERANCE)}
 SELECT entity, asof AS "asof", kind, da AS start_date, db AS anchor_date, {rnd('p0', 'start_price', 3)}, {rnd('slope', digits=3)}, CAST(anchors AS INTEGER) AS anchors, CAST(n AS INTEGER) AS touches, last_touch, {rnd('price_now', digits=3)}, broken_at FROM tl""")
def _lines(spark, d):
    """Trendlines as of every quarter end."""
    return tidy(LV.trendlines_at(quarter_requests(spark, d), V.bars(spark, d), min_pivots=MIN_PIVOTS, tolerance=TOLERANCE), digits=3)


COMBINED = f"""WITH {PW.LIVE}, {SWINGS}, rq AS MATERIALIZED (SELECT r.entity, r.asof, max(idx) AS t FROM requests r JOIN s ON s.entity = r.entity AND s.date <= r.asof GROUP BY ALL), {levels_sql('rq')}, {lines_sql(MIN_PIVOTS, TOLERANCE)}, {PW._RT},
 pts AS (SELECT entity, asof AS d, 'sr_' || kind AS source, level AS price FROM lvl UNION ALL SELECT entity, asof, CASE WHEN broken_at IS NULL THEN 'trendline' ELSE 'trendline_historical' END, price_now FROM tl UNION ALL SELECT entity, "asof", 'fib', {PW._ZP} FROM lv, rt),
 ps AS (SELECT entity, d, list_reduce(list({{'a': price, 'out': [{{'p': price, 'a': price}}]}} ORDER BY price), lambda u, v: CASE WHEN (v.a - u.a) / u.a < 0.01::DOUBLE THEN {{'a': u.a, 'out': list_append(u.out, {{'p': v.a, 'a': u.a}})}} ELSE {{'a': v.a, 'out': list_append(u.out, {{'p': v.a, 'a': v.a}})}} END).out AS o FROM (SELECT DISTINCT entity, d, price FROM pts WHERE price > 0) GROUP BY ALL),
 an AS (SELECT entity, d, unnest(o) AS x FROM ps),
 cl2 AS (SELECT pts.entity, pts.d, x.a, avg(price) AS level, min(price) AS low, max(price) AS high, count(DISTINCT source) AS strength, count(*) AS members FROM pts JOIN an ON an.entity = pts.entity AND an.d = pts.d AND x.p = price GROUP BY ALL),
 kl AS (SELECT * FROM cl2 QUALIFY row_number() OVER (PARTITION BY entity, d ORDER BY strength DESC, members DESC, level) <= 20)
 SELECT entity, d AS "asof", {rnds('level low high', 2)}, CAST(strength AS INTEGER) AS strength, CAST(members AS INTEGER) AS members FROM kl"""


@query("combined_key_levels", "K4", COMBINED)
def _combined(spark, d):
    """Levels, lines and projection zones known at every quarter end, clustered by price."""
    b, at = V.bars(spark, d), quarter_requests(spark, d)
    sr = LV.levels_at(at, b).select("entity", "asof", F.col("level").alias("price"), F.concat(F.lit("sr_"), "kind").alias("source"))
    tl = LV.trendlines_at(at, b, min_pivots=MIN_PIVOTS, tolerance=TOLERANCE).select("entity", "asof", F.col("price_now").alias("price"), F.when(F.col("broken_at").isNull(), "trendline").otherwise("trendline_historical").alias("source"))
    z = WV.fib_zones(PW.live(spark, d)).select("entity", "asof", F.col("zone_price").alias("price"), F.lit("fib").alias("source"))
    return tidy(FU.key_levels(sr.unionByName(tl).unionByName(z), keys=("entity", "asof")), digits=2)
