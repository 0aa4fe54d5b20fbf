"""Answers about a series at many request days, each from the rows up to that day only.

Requests (entity, asof) are merged into the sorted series of their entity, as in ``pit.asof_join``, and the partitions
are read as streams, one series at a time. A function sees the series once with the number of rows known at each of its
request days, so work that neighbouring days share is done once; ``walk_forward`` narrows that to read-only slices that
end at the request day, which no function can look past.

Defined results: requests before the first row get empty slices; repeated requests are answered once; requests of
entities without rows are answered with empty slices; null entities or days are no requests.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.recursive import _edges


def _series_of(batches):
    """One frame per entity from sorted batches."""
    rest = None
    for pdf in batches:
        pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
        if not len(pdf):
            continue
        ends = np.flatnonzero(pdf["entity"].to_numpy()[1:] != pdf["entity"].to_numpy()[:-1]) + 1
        for a, b in zip([0, *ends[:-1]], ends):
            yield pdf.iloc[a:b]
        rest = pdf.iloc[ends[-1] if len(ends) else 0:]
    if rest is not None and len(rest):
        yield rest


def serve(requests: DataFrame, rows: DataFrame, answer: Callable[[dict, np.ndarray], dict], schema: str) -> DataFrame:
    """``entity, asof`` and the columns of ``schema``: what ``answer`` says at each request day.

    ``rows`` hold entity, date and numbers, texts or days. ``answer(columns, cuts)`` takes the columns as arrays in order
    of ``date``, with the request days as ``_asof``, and the ascending numbers of rows known at those; it returns arrays of ``schema``'s
    names and ``request``, the place of the request in ``cuts`` each output row belongs to.
    """
    ask = requests.where(F.col("entity").isNotNull() & F.col("asof").isNotNull()).select("entity", F.col("asof").alias("date")).distinct()
    merged = rows.withColumn("_ask", F.lit(0)).unionByName(ask.withColumn("_ask", F.lit(1)), allowMissingColumns=True)
    kind = dict(rows.dtypes)["entity"]
    out = T.StructType.fromDDL(f"entity {kind}, asof date, {schema}")
    names = [f.name for f in out.fields]

    def run(batches):
        lot, size = [], 0
        for pdf in _series_of(batches):
            asks = pdf["_ask"].to_numpy() == 1
            if not asks.any():
                continue
            columns = {c: pdf[c].to_numpy()[~asks] for c in pdf.columns if c not in ("entity", "_ask")}
            cuts, days = np.cumsum(~asks)[asks], pdf["date"].to_numpy()[asks]
            found = answer({**columns, "_asof": days}, cuts)
            at = np.asarray(found["request"], int)
            if len(at):
                lot.append(pd.DataFrame({"entity": pdf["entity"].iloc[0], "asof": days[at], **{c: found[c] for c in names[2:]}})[names])
                size += len(at)
            if size >= 10000:
                yield pd.concat(lot, ignore_index=True)
                lot, size = [], 0
        if lot:
            yield pd.concat(lot, ignore_index=True)

    # a stated number of partitions is not merged by size: few small rows may ask for much work
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return merged.repartition(parts, "entity").sortWithinPartitions("entity", "date", "_ask").mapInPandas(run, out)


def walk_forward(requests: DataFrame, rows: DataFrame, forecast: Callable[[dict], list[tuple]], schema: str, lookback: int | None = None) -> DataFrame:
    """What ``forecast`` says at each request day when it is handed the rows up to that day and nothing else.

    ``forecast`` gets read-only slices of the columns, at most ``lookback`` rows long, that end with the last row at or
    before the request day; it returns rows of ``schema``. A function that asks for more than it is given gets an
    IndexError or a shorter slice, so one that looks ahead can't give the same rows here as on the whole series.
    """
    names = [f.name for f in T.StructType.fromDDL(schema).fields]

    def answer(columns: dict, cuts: np.ndarray) -> dict:
        at, found = [], []
        for k, n in enumerate(cuts.tolist()):
            first = 0 if lookback is None else max(0, n - lookback)
            view = {}
            for c, v in columns.items():
                if c == "_asof":
                    continue
                # a plain slice refers to its base, through which later rows could be reached
                view[c] = v[first:n].copy()
                view[c].flags.writeable = False
            said = forecast(view)
            found += said
            at += [k] * len(said)
        return {"request": at, **{c: [r[i] for r in found] for i, c in enumerate(names)}}

    return serve(requests, rows, answer, schema)


def walk_forward_lots(rows: DataFrame, reads: list[str], forecast: Callable[[dict], dict], names: tuple[str, ...], lookback: int, series: int = 256, cells: int = 200_000) -> DataFrame:
    """Due rows of ``rows`` with arrays ``names``: what ``forecast`` says there when it is handed the rows up to that one and nothing else.

    ``rows`` are ``recursive.arranged`` and hold ``is_due`` and the numbers ``reads``. The n-th rows of up to ``series`` series are
    answered together: ``forecast`` gets read-only arrays of (slices, rows), one slice per series, each at most ``lookback`` long
    and ended by its series' n-th row, and returns arrays of (slices, any width). A lot has at most ``cells`` places, filled or not.
    """
    out = T.StructType([*[f for f in rows.schema.fields if f.name not in reads], *[T.StructField(k, T.ArrayType(T.DoubleType())) for k in names]])
    kept = [f.name for f in out.fields if f.name not in names]

    def answer(batch):
        edges = np.array([0, *_edges(batch, ("entity",)), batch.num_rows])
        columns = {c: batch.column(c).to_pandas().to_numpy().astype(float) for c in reads}
        due = batch.column("is_due").to_pandas().to_numpy().astype(bool)
        size = max(1, min(series, cells // int(np.diff(edges).max())))
        for first in range(0, len(edges) - 1, size):
            start, stop = edges[:-1][first:first + size], edges[1:][first:first + size]
            length = stop - start
            # the series of a lot side by side, the place of row n of series i at [i, n]
            place = np.minimum(start[:, None] + np.arange(length.max()), batch.num_rows - 1)
            found = {k: None for k in names}
            for n in range(1, int(length.max()) + 1):
                at = np.flatnonzero(length >= n)
                at = at[due[place[at, n - 1]]]
                if not len(at):
                    continue
                seen = place[at, max(0, n - lookback):n]
                view = {c: v[seen] for c, v in columns.items()}
                for v in view.values():
                    v.flags.writeable = False
                for k, v in forecast(view).items():
                    if found[k] is None:
                        found[k] = np.full((int(stop[-1] - start[0]), v.shape[1]), np.nan)
                    found[k][place[at, n - 1] - start[0]] = v
            lot = batch.slice(int(start[0]), int(stop[-1] - start[0]))
            told = np.flatnonzero(due[start[0]:stop[-1]])
            for i in range(0, len(told), 4096):
                rows_ = told[i:i + 4096]
                arrays = []
                for k in names:
                    v = found[k][rows_]
                    arrays.append(pa.ListArray.from_arrays(pa.array(np.arange(len(v) + 1, dtype=np.int32) * v.shape[1]), pa.array(v.ravel())))
                yield pa.RecordBatch.from_arrays([*[lot.column(c).take(pa.array(rows_)) for c in kept], *arrays], names=[*kept, *names])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            held, size = [*held, batch] if batch.num_rows else held, size + batch.num_rows
            if size >= cells:
                whole = pa.concat_batches(held)
                edges = _edges(whole, ("entity",))
                if edges:  # the last series may go on in the next batch
                    yield from answer(whole.slice(0, edges[-1]))
                    whole = whole.slice(edges[-1])
                held, size = [whole], whole.num_rows
        if held:
            yield from answer(pa.concat_batches(held))

    return rows.mapInArrow(run, out)
