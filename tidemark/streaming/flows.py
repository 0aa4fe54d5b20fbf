"""Streaming operators over file (or any other) sources.

Stateful steps keep one small state per key.  Raw ticks are reduced to bars by a windowed
aggregation (partial aggregation ahead of the shuffle) before any per-entity recursion, so a key
with a third of all ticks is spread like every other.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.operators import forecast as FC
from tidemark.operators import pit
from tidemark.operators.recursive import arranged


def tick_bars(ticks: DataFrame, delay: str = "1 hour", width: str = "1 day") -> DataFrame:
    """Tumbling-window bars (entity, start, open, high, low, close, n) in append mode."""
    return (
        ticks.withWatermark("ts", delay).groupBy("entity", F.window("ts", width).alias("w"))
        .agg(F.min_by("value", "ts").alias("open"), F.max("value").alias("high"), F.min("value").alias("low"), F.max_by("value", "ts").alias("close"), F.count("*").alias("n"))
        .select("entity", F.to_date("w.start").alias("date"), "open", "high", "low", "close", "n")
    )


def dedupe(rows: DataFrame, keys: list[str], ts: str = "ts", delay: str = "1 day") -> DataFrame:
    """Drop repeats of a key that arrive within the watermark delay."""
    return rows.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def ema_crosses(bars: DataFrame, p: int = 5, spacing: int = 3) -> DataFrame:
    """Running EMA and its spaced upward crosses by the close, with state (ema, side, last fired, n).

    ``bars`` is a stream of (entity, date, close) in date order per entity.
    """
    alpha = 2.0 / (p + 1.0)

    def step(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        ema, above, fired, n = state.get if state.exists else (0.0, False, -(10 ** 6), 0)
        out = []
        for b in sorted_rows(batches):
            ema = b.close if n == 0 else alpha * b.close + (1 - alpha) * ema
            now = b.close > ema
            cross = n > 0 and now and not above and n - fired >= spacing
            fired = n if cross else fired
            above, n = now, n + 1
            out.append((key[0], b.date, b.close, ema, cross))
        state.update((ema, above, fired, n))
        yield pd.DataFrame(out, columns=["entity", "date", "close", "ema", "is_cross"])

    def sorted_rows(batches):
        return pd.concat(list(batches)).sort_values("date").itertuples(index=False)

    kt = dict(bars.dtypes)["entity"]
    return bars.groupBy("entity").applyInPandasWithState(
        step, f"entity {kt}, date date, close double, ema double, is_cross boolean", "ema double, above boolean, fired long, n long", "append", GroupStateTimeout.NoTimeout)


def versioned(spark: SparkSession, path: str, key: str = "entity") -> DataFrame:
    """Newest version of every entity from an append-only table written per micro-batch."""
    t = spark.read.option("basePath", path).parquet(f"{path}/batch=*")
    newest = t.groupBy(key).agg(F.max("batch").alias("batch"))
    return t.join(newest, [key, "batch"], "left_semi").drop("batch")


def restate(bars: DataFrame, events_log: str, output: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` sink: an entity with a new adjustment event gets its whole history recomputed.

    Both tables are written per batch id, so a replayed batch overwrites itself only.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{events_log}/batch={batch_id}")
        known = spark.read.option("basePath", events_log).parquet(f"{events_log}/batch=*").filter(F.col("batch") <= batch_id).drop("batch")
        touched = spark.read.parquet(f"{events_log}/batch={batch_id}").select("entity").distinct()
        b = bars.join(touched, "entity", "left_semi")
        factors = pit.adjustment_factors(known.join(touched, "entity", "left_semi"), b)
        pit.back_adjusted(b, factors).write.mode("overwrite").parquet(f"{output}/batch={batch_id}")

    return sink


def settle_on_arrival(issue: Callable[[DataFrame], DataFrame], bars_log: str, output: str, columns: list[str] | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` sink on a bar stream in date order: settle forecasts as they fall due.

    ``issue`` maps arranged bars with ``is_due`` and the price that settles each horizon (``realized_<h>``) to forecast rows with
    ``realized``, and looks back only. So the bars that have arrived are shuffled once a batch, and forecasts never. ``columns`` are written, all by default.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{bars_log}/batch={batch_id}")
        seen = spark.read.option("basePath", bars_log).parquet(f"{bars_log}/batch=*").filter(F.col("batch") <= batch_id)
        newest = seen.groupBy("batch").agg(F.max("date").alias("d")).filter("d is not null").collect()  # one row per batch
        today = max((r["d"] for r in newest), default=dt.date.min)
        before = max((r["d"] for r in newest if r["batch"] < batch_id), default=None)
        bars = FC.realized_inputs(arranged(seen.drop("batch")), str(today))
        if before is not None:
            bars = bars.withColumns({f"realized_{h}": F.when(F.date_add("date", h) > F.lit(before), F.col(f"realized_{h}")) for h in FC.HORIZONS})
        # forecasts are computed where one of them falls due
        bars = bars.withColumn("is_due", F.coalesce(*[F.col(f"realized_{h}") for h in FC.HORIZONS]).isNotNull())
        out = FC.settle_realized(issue(bars))
        out.select(*columns or out.columns).write.mode("overwrite").parquet(f"{output}/batch={batch_id}")

    return sink


def run_to_end(stream: DataFrame, checkpoint: str, path: str | None = None, sink: Callable | None = None, mode: str = "append") -> None:
    """Process everything available now, then stop; restarts resume from ``checkpoint``."""
    w = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    q = w.foreachBatch(sink).start() if sink else w.format("parquet").option("path", path).start()
    q.awaitTermination()
