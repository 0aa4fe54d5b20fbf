"""Streaming and incremental queries, run to the end of the available data."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark.operators import forecast as FC
from tidemark.operators import indicators as I
from tidemark.plans import indicators as P
from tidemark.plans.forecast import BASE_SQL, REAL, last_day
from tidemark.plans.pit import FACTORS
from tidemark.plans.registry import query, rnd, rnds, tidy
from tidemark.session import checkpoint_dir
from tidemark.sources import views as V
from tidemark.streaming import flows as S
from tidemark.streaming import timers as TM
from tidemark.streaming.incremental import incremental

LAST = "(SELECT max(date) FROM ind)"


@query("incremental_window", "M1", f"WITH {P.BOLL_SQL} SELECT entity, date, {rnds('upper middle lower')} FROM ind WHERE date > {LAST} - 30")
def _incremental(spark, d):
    b = V.bars(spark, d)
    return tidy(incremental(I.bollinger, b, last_day(b), 365, 30), "entity", "date", "upper", "middle", "lower")


def _base(spark) -> str:
    return f"{checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"


def in_turn(spark, rows, conditions, base, sink) -> None:
    """Deliver the table in parts; after each the stream resumes from its checkpoint."""
    for i, cond in enumerate(conditions):
        rows.filter(cond).write.parquet(f"{base}/in/part={i}")
        s = spark.readStream.schema(rows.schema).option("recursiveFileLookup", "true").parquet(f"{base}/in")
        S.run_to_end(s, f"{base}/cp", sink=sink)


def ticks(spark, d):
    """The events table as a file stream."""
    schema = V.table(spark, d, "events").schema
    s = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)
    return s.select(F.col("user_id").alias("entity"), F.col("ts").cast("timestamp").alias("ts"), "value", "event_type")


TICK_BARS = """lim AS (SELECT max(ts) - INTERVAL 1 HOUR AS t FROM events), tb AS (SELECT user_id AS entity, CAST(ts AS DATE) AS date, arg_min(value, ts) AS open, max(value) AS high, min(value) AS low, arg_max(value, ts) AS close, count(*) AS n FROM events GROUP BY 1, 2),
 closed AS (SELECT tb.* FROM tb, lim WHERE date + INTERVAL 1 DAY <= t)"""


def stream_bars(spark, d):
    base = _base(spark)
    S.run_to_end(S.tick_bars(ticks(spark, d)), f"{base}/cp", f"{base}/bars")
    return base, spark.read.parquet(f"{base}/bars")


@query("streaming_tick_bars", "M4,M8", f"WITH {TICK_BARS} SELECT * FROM closed")
def _tick_bars(spark, d):
    return stream_bars(spark, d)[1]


@query("streaming_dedupe", "M5", "SELECT DISTINCT user_id AS entity, event_type, CAST(ts AS DATE) AS day FROM events")
def _dedupe(spark, d):
    base = _base(spark)
    s = S.dedupe(ticks(spark, d).withColumn("day", F.to_date("ts")), ["entity", "event_type", "day"])
    S.run_to_end(s.select("entity", "event_type", "day"), f"{base}/cp", f"{base}/out")
    return spark.read.parquet(f"{base}/out")


EMA_TICKS = f"""{TICK_BARS}, s AS (SELECT entity, date, close, CAST(row_number() OVER (PARTITION BY entity ORDER BY date) - 1 AS INTEGER) AS idx FROM closed), """ + P.ema_cte("e", "s", "close", 5, "ema")


@query("streaming_ema_state", "M6", f"WITH {EMA_TICKS} SELECT entity, date, close, {rnd('ema')} FROM e")
def _ema_state(spark, d):
    base, bars = stream_bars(spark, d)
    s = spark.readStream.schema(bars.schema).parquet(f"{base}/bars").select("entity", "date", "close")
    S.run_to_end(S.ema_crosses(s), f"{base}/cp2", f"{base}/ema")
    return tidy(spark.read.parquet(f"{base}/ema"), "entity", "date", "close", "ema")


@query("streaming_restatement", "M2,M3", f"""WITH {FACTORS}, j AS (SELECT b.*, coalesce(f.af, 1) AS af FROM bars b LEFT JOIN factors f ON f.entity = b.entity AND f.date = b.date WHERE b.entity IN (SELECT entity FROM adj_events)),
 c AS (SELECT *, coalesce(product(af) OVER (PARTITION BY entity ORDER BY date DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1) AS cum_af FROM j) SELECT entity, date, floor(close * cum_af * 100 + 0.5) / 100 AS adj_close, {rnd('cum_af', digits=6)} FROM c""")
def _restatement(spark, d):
    base = _base(spark)
    ev = V.adj_events(spark, d)
    sink = S.restate(V.bars(spark, d), f"{base}/events", f"{base}/adjusted")
    in_turn(spark, ev, ["year(date) < 1998", "year(date) >= 1998"], base, sink)
    return tidy(S.versioned(spark, f"{base}/adjusted"), "entity", "date", "adj_close", "cum_af", digits=6)


SETTLEMENT = f"WITH {BASE_SQL}, " + REAL.replace("SELECT * FROM base UNION ALL SELECT * FROM chip", "SELECT * FROM base") + f" SELECT entity, forecast_date, horizon, confidence, resolved_date, realized, hit, {rnd('pinball', digits=3)} FROM settled"


#: What the queries read, so all that is written.
SETTLED = ["entity", "forecast_date", "horizon", "confidence", "resolved_date", "realized", "hit", "pinball"]


@query("streaming_settlement", "M7,J11", SETTLEMENT)
def _settlement(spark, d):
    base = _base(spark)
    b = V.bars(spark, d).select("entity", "date", "close")
    issue = lambda bars: FC.baseline_rows(FC.baseline_inputs(FC.unadjusted(bars), in_order=True), realized=True)
    # bars without a day come first, as in every series
    in_turn(spark, b, ["date is null or year(date) < 1999", "year(date) >= 1999"], base, S.settle_on_arrival(issue, f"{base}/bars", f"{base}/settled", SETTLED))
    out = spark.read.option("basePath", f"{base}/settled").parquet(f"{base}/settled/batch=*")
    return tidy(out, *SETTLED, digits=3)


@query("streaming_settlement_timers", "M6,M7,J11", SETTLEMENT)
def _settlement_timers(spark, d):
    """As above by keyed state and timers; the second part resumes from the state of the first."""
    base = _base(spark)
    rows = TM.bar_feed(V.bars(spark, d))
    # up to 1998, from 1999
    for i, part in enumerate(("day is null or day < 10592", "day >= 10592")):
        rows.filter(part).write.parquet(f"{base}/in/part={i}")
        s = spark.readStream.schema(rows.schema).option("recursiveFileLookup", "true").parquet(f"{base}/in")
        S.run_to_end(TM.settle_at_timers(s, issue=FC.baseline_issuer()).select(*SETTLED), f"{base}/cp", f"{base}/settled")
    return tidy(spark.read.parquet(f"{base}/settled"), *SETTLED, digits=3)
