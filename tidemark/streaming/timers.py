"""Forecasts settled by keyed state and event-time timers.

State per entity is its newest bar and the forecasts not yet due, 24 bytes each, so a batch costs what it brings:
no earlier batch is read again and nothing is collected.  The state is bounded by the forecasts
issued within the longest horizon; where forecasts are issued here too, it also holds the closes they look back on.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.operators.forecast import hit, interval_pinball

DAY_MS = 86_400_000
CELL = ["source", "horizon", "confidence"]
OUTPUT = "entity {key}, forecast_date int, source string, horizon int, confidence double, lower double, upper double, due int, close double"
# a forecast not yet due: its day of issue, the place of its cell in the state's list, its bounds
PENDING = np.dtype([("day", "<i4"), ("cell", "<i4"), ("lower", "<f8"), ("upper", "<f8")])
NO_DAY = -(2 ** 31)


def feed(forecasts: DataFrame, bars: DataFrame) -> DataFrame:
    """One table of both inputs: bars by their day, forecasts by the day of issue (``day`` in days since 1970).

    Forecasts of one entity and day share a row: ``grid`` names their cells, ``lower`` and ``upper`` hold the bounds in that order.
    """
    cell = F.struct("source", F.col("horizon").cast("int").alias("horizon"), F.col("confidence").cast("double").alias("confidence"),
                    F.col("lower").cast("double").alias("lower"), F.col("upper").cast("double").alias("upper"))
    f = forecasts.groupBy("entity", F.unix_date("forecast_date").alias("day")).agg(F.array_sort(F.collect_list(cell)).alias("_cells"))
    f = f.select("entity", "day", F.lit(None).cast("double").alias("close"), *_columns(F.col("_cells")))
    return f.unionByName(bars.select("entity", F.unix_date("date").alias("day"), F.col("close").cast("double").alias("close")).filter("close is not null"), allowMissingColumns=True)


def bar_feed(bars: DataFrame) -> DataFrame:
    """Bars alone, for ``settle_at_timers(issue=...)``. A bar without a day comes first in its series; one without a close is a bar, but settles nothing."""
    return bars.select("entity", F.unix_date("date").alias("day"), F.col("close").cast("double").alias("close"))


def _columns(cells: Column) -> list[Column]:
    names = F.to_json(F.transform(cells, lambda x: F.array(x["source"], x["horizon"].cast("string"), x["confidence"].cast("string"))))
    return [names.alias("grid"), cells.getField("lower").alias("lower"), cells.getField("upper").alias("upper")]


def settle_at_timers(rows: DataFrame, tolerance_days: int = 21, delay: str = "0 seconds", issue: tuple | None = None) -> DataFrame:
    """Settle a stream shaped like ``feed`` that arrives in order of day but for ``delay``.

    With ``issue`` (cells, number of closes to remember, bounds) it is a ``bar_feed`` in order of day, and forecasts are issued at each
    bar from the closes in the state, so none is written or shuffled: ``bounds(closes, at)`` gives the lower and upper ends, a row per place of ``at``.

    A forecast is settled once the watermark has passed the end of its due day, or its entity has a
    later bar, at the close of the last bar within ``tolerance_days`` before the due day; without such
    a bar or without bounds it is dropped.  A forecast that never falls due stays in the state.
    """
    key = dict(rows.dtypes)["entity"]
    # a row counts at the end of its day, a timer rings an hour before the end of the due day
    timed = rows.withColumn("ts", F.timestamp_seconds(F.col("day").cast("long") * 86_400 + 86_340)).withWatermark("ts", delay)

    def step(entity, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last_day, last_close, text, packed, past = state.get if state.exists else (None, None, "[]", b"", b"")
        cells = [tuple(c) for c in json.loads(text)]
        place = {c: i for i, c in enumerate(cells)}
        pending = [np.frombuffer(packed, PENDING)]
        days, closes = ([], []) if last_day is None else ([np.array([last_day])], [np.array([last_close])])
        if not state.hasTimedOut:
            arrived = []
            for pdf in batches:
                day, close = pdf["day"].fillna(NO_DAY).to_numpy(int), pdf["close"].to_numpy(float)
                is_bar = ~np.isnan(close) & (day != NO_DAY)
                days.append(day[is_bar])
                closes.append(close[is_bar])
                arrived.append((day, close))
                for grid, asked in pdf.groupby("grid", sort=False) if issue is None else ():
                    named = np.array([place.setdefault((s, int(h), float(c)), len(place)) for s, h, c in json.loads(grid)])
                    new = np.empty(len(asked) * len(named), PENDING)
                    new["day"], new["cell"] = np.repeat(asked["day"].to_numpy(), len(named)), np.tile(named, len(asked))
                    new["lower"], new["upper"] = np.concatenate(asked["lower"].tolist()), np.concatenate(asked["upper"].tolist())
                    pending.append(new[~(np.isnan(new["lower"]) | np.isnan(new["upper"]))])
            if issue is not None:
                grid, memory, bounds = issue
                day, close = (np.concatenate(x) for x in zip(*arrived))
                order = np.argsort(day, kind="stable")
                day, known = day[order], np.concatenate([np.frombuffer(past), close[order]])
                named = np.array([place.setdefault(c, len(place)) for c in grid])
                lower, upper = bounds(known, np.arange(len(known) - len(day), len(known)))
                at, cell = np.nonzero(~(np.isnan(lower) | np.isnan(upper)) & (day != NO_DAY)[:, None])
                new = np.empty(len(at), PENDING)
                new["day"], new["cell"], new["lower"], new["upper"] = day[at], named[cell], lower[at, cell], upper[at, cell]
                pending.append(new)
                past = known[-memory:].tobytes()
        cells, pending = list(place), np.concatenate(pending)
        day, close = (np.concatenate(x) if x else np.array([]) for x in (days, closes))
        order = np.lexsort((close, day))
        day, close = day[order], close[order]
        due = pending["day"] + np.array([h for _, h, _ in cells], dtype=int)[pending["cell"]]
        passed = state.getCurrentWatermarkMs() // DAY_MS - 1 if state.getCurrentWatermarkMs() % DAY_MS < 86_340_000 else state.getCurrentWatermarkMs() // DAY_MS
        closed = max(passed, int(day[-1]) - 1 if len(day) else passed)
        now, later = due <= closed, due > closed
        state.update((int(day[-1]) if len(day) else None, float(close[-1]) if len(day) else None, json.dumps(cells), pending[later].tobytes(), past))
        if later.any():
            ring = int(due[later].min()) * DAY_MS + 82_800_000
            state.setTimeoutTimestamp(max(ring, state.getCurrentWatermarkMs() + 1))
        if now.any() and len(day):
            asks, due = pending[now], due[now]
            at = np.searchsorted(day, due, "right") - 1
            found = (at >= 0) & (due - day[np.maximum(at, 0)] <= tolerance_days)
            asks, due, at = asks[found], due[found], at[found]
            named = pd.DataFrame(cells, columns=CELL).iloc[asks["cell"]].reset_index(drop=True)
            if len(asks):
                yield pd.DataFrame({"entity": entity[0], "forecast_date": asks["day"], **{c: named[c] for c in CELL}, "lower": asks["lower"], "upper": asks["upper"], "due": due, "close": close[at]})

    settled = timed.groupBy("entity").applyInPandasWithState(step, OUTPUT.format(key=key), "last_day int, last_close double, cells string, pending binary, past binary", "append", GroupStateTimeout.EventTimeTimeout)
    y = F.floor(F.col("close") * 10000 + 0.5) / 10000
    return settled.select("entity", F.date_from_unix_date("forecast_date").alias("forecast_date"), "source", "horizon", "confidence", "lower", "upper",
                          F.date_from_unix_date("due").alias("resolved_date"), y.alias("realized")).withColumns({
        "hit": hit(F.col("realized"), F.col("lower"), F.col("upper")), "pinball": interval_pinball(F.col("realized"), F.col("lower"), F.col("upper"), F.col("confidence"))})
