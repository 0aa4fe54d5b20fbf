"""Snapshots of many keyed series as of any day, in one merge of all sections.

Rows of all sections and the requests of an entity are one sorted stream; a map (section, source, timeframe) to its
latest row is carried along it, and facts are counted in sliding windows of their timeframe's look-back. One shuffle
serves any number of sections, where a join for each would shuffle the requests once per section.

Facts fold to counts per (entity, day known, day, source, timeframe) before the merge, so a hot entity costs its days.
"""

from __future__ import annotations

from collections import deque

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.pit import LOOKBACK_DAYS
from tidemark.operators.serving import serve

SECTION = "section string, source string, timeframe string, date date, value double"


def sections_at(requests: DataFrame, facts: DataFrame, latest: DataFrame, reserved: dict | None = None, lookback: dict[str, int] = LOOKBACK_DAYS) -> DataFrame:
    """Tidy snapshot rows (entity, asof, section, source, timeframe, date, value) for each request (entity, asof).

    ``facts`` hold entity, fact_date, report_date, source, timeframe; a fact is known from the later of its two days
    (its own if unreported) and counts while its day lies in the look-back of its timeframe: ``value`` is the number of
    such facts, ``date`` the latest of their days. ``latest`` holds entity, section, source, timeframe, date, value;
    the newest row of each (section, source, timeframe) at or before the request is given, null values included.
    ``reserved`` names entities whose facts concern the market: each request also gets their facts, as section
    ``market:<name>``. Facts of unknown timeframe or without a day are left out; ties of one day keep the largest value.
    """
    known = F.greatest("fact_date", F.coalesce("report_date", "fact_date"))
    counts = facts.where(F.col("fact_date").isNotNull() & F.col("timeframe").isin(sorted(lookback))).groupBy("entity", known.alias("date"), "source", "timeframe", F.col("fact_date").alias("day")).agg(F.count(F.lit(1)).cast("double").alias("value"))
    rows = counts.withColumn("section", F.lit("facts")).unionByName(
        latest.select("entity", "date", "source", "timeframe", F.col("date").alias("day"), F.col("value").cast("double").alias("value"), "section").where("date is not null"))
    asks = requests.select("entity", "asof").distinct()
    if reserved:
        of_market = F.explode(F.array(*[F.lit(e) for e in reserved])).alias("entity")
        asks = asks.unionByName(requests.select("asof").distinct().select(of_market, "asof")).distinct()
    found = serve(asks, rows, _answer(lookback), SECTION)
    own = found.join(requests.select("entity", "asof").distinct(), ["entity", "asof"], "leftsemi") if reserved else found
    if not reserved:
        return own
    names = F.create_map(*[F.lit(x) for kv in reserved.items() for x in kv])
    market = found.where(F.col("entity").isin(list(reserved)) & (F.col("section") == "facts")).withColumn("section", F.concat(F.lit("market:"), names[F.col("entity")])).drop("entity")
    return own.unionByName(requests.select("entity", "asof").distinct().join(market, "asof"))


def _answer(lookback: dict[str, int]):
    def answer(c: dict, cuts: np.ndarray) -> dict:
        newest: dict[tuple, tuple] = {}
        windows: dict[tuple, deque] = {}
        totals: dict[tuple, float] = {}
        out = {k: [] for k in ("request", "section", "source", "timeframe", "date", "value")}

        def put(k, key, date, value):
            for name, x in zip(out, (k, *key, date, value)):
                out[name].append(x)

        at, asofs = 0, c["_asof"]
        for k, (n, asof) in enumerate(zip(cuts.tolist(), asofs)):
            for i in range(at, n):
                key = (c["section"][i], c["source"][i], c["timeframe"][i])
                if key[0] == "facts":
                    # kept in order of their own day, which reports may deliver late
                    insert_by_day(windows.setdefault(key, deque()), (c["day"][i], c["value"][i]))
                    totals[key] = totals.get(key, 0.0) + c["value"][i]
                else:
                    v = None if np.isnan(c["value"][i]) else float(c["value"][i])
                    was = newest.get(key)
                    if was is None or was[0] < c["date"][i] or v is not None and (was[1] is None or v > was[1]):
                        newest[key] = (c["date"][i], v)
            at = n
            for key, (day, v) in newest.items():
                put(k, key, day, v)
            for key, window in windows.items():
                while window and (asof - window[0][0]).days > lookback[key[2]]:
                    totals[key] -= window.popleft()[1]
                if window:
                    put(k, key, window[-1][0], totals[key])
        return out

    return answer


def insert_by_day(window: deque, item: tuple) -> None:
    """Into a deque in order of days; late items are few days late, so the search runs from the end."""
    later = []
    while window and window[-1][0] > item[0]:
        later.append(window.pop())
    window.append(item)
    window.extend(reversed(later))
