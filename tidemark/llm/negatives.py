"""Hard negatives by a secondary-sort shuffle.

Every (anchor, row) score travels under one packed key: the anchor, the score in descending order, a mark that puts
positives first among equal scores, and the row's id, all big-endian with the sign bit flipped so that bytes sort as
numbers do. Rows are partitioned by anchor and sorted inside partitions by that key (``repartition`` and
``sortWithinPartitions``, the DataFrame form of ``repartitionAndSortWithinPartitions``); an iterator then reads each
partition as one stream. It opens a window at each positive and hands following rows to the open windows until these
are full or passed, so it holds one anchor's windows and never an anchor's rows.

Scores come from blocks: rows are dealt evenly over blocks of at most ``block_rows``, each block is held once as a
matrix while all anchors stream past it. Of a block only what can be in the result is shuffled, so keys are few: first
the block's best ``positives`` rows of the anchor's label; then, the anchors' windows being known, its best
``per_positive`` rows of each window. Both merges are the same sorted stream.

Scores are integer inner products of ``floor(scale * x)``. They are exact while they fit 53 bits, else they are summed
in 64-bit integers and wrap beyond; components beyond 64 bits saturate at the last double below.

Defined results: rows with a null id, label or vector, or with a null or non-finite component, take no part. A vec_id
counts once, with its smallest (label, vector), so a repeated row is no positive of itself and a hot id stays one
anchor. Vectors of unequal length meet as if padded by zeros; empty ones score 0. Anchors without positives, or windows
without negatives, give no rows; a window needs ``lo * p <= 100 * n <= hi * p``, so a negative positive score opens none.
Further columns of the input are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import cut

SIGN = np.uint64(1 << 63)
KEYED = "anchor long, key binary"
MINED = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
#: A key's bytes: anchor, score (inverted), mark (0 positive, 1 negative), id.
PACKED = np.dtype([("anchor", ">u8"), ("score", ">u8"), ("mark", "u1"), ("id", ">u8")])


def pack(anchor: np.ndarray, score: np.ndarray, mark: int, ids: np.ndarray) -> np.ndarray:
    out = np.empty(len(ids), PACKED)
    out["anchor"] = anchor.astype(np.int64).view(np.uint64) ^ SIGN
    out["score"] = ~(score.astype(np.int64).view(np.uint64) ^ SIGN)
    out["mark"] = mark
    out["id"] = ids.astype(np.int64).view(np.uint64) ^ SIGN
    return out


def unpack(keys: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    raw = np.frombuffer(b"".join(keys.to_pylist()), PACKED)
    signed = lambda x: (x.astype(np.uint64) ^ SIGN).view(np.int64)
    return signed(raw["anchor"]), (~raw["score"].astype(np.uint64) ^ SIGN).view(np.int64), raw["mark"], signed(raw["id"])


def _keyed(keys: np.ndarray, anchor: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(anchor, pa.int64()), pa.array([k.tobytes() for k in keys], pa.binary())], ["anchor", "key"])


def usable(rows: DataFrame, label: Column) -> DataFrame:
    """``vec_id, label, vec`` of the rows that take part, one row per vec_id."""
    vec = F.col("embedding").cast("array<double>")
    rows = rows.select("vec_id", label.cast("long").alias("label"), vec.alias("vec"))
    whole = F.forall("vec", lambda x: x.isNotNull() & (F.abs(x) < F.lit(math.inf)))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull()).where(whole)
    return rows.groupBy("vec_id").agg(F.min(F.struct("label", "vec")).alias("r")).select("vec_id", "r.label", "r.vec")


class _Matrix:
    """Rows of whole numbers, exact products of 53 bits by floats and longer ones by integers."""

    def __init__(self, vectors: pa.ChunkedArray | pa.Array, scale: int):
        vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
        lengths = np.diff(vectors.offsets.to_numpy())
        flat = np.floor(scale * vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
        self.x = np.zeros((len(vectors), int(lengths.max(initial=0))))
        self.x[np.arange(self.x.shape[1]) < lengths[:, None]] = flat
        self.top = float(np.abs(self.x).max(initial=0))

    def times(self, other: _Matrix, a: slice, b: slice) -> np.ndarray:
        d = min(self.x.shape[1], other.x.shape[1])
        p, q = self.x[a, :d], other.x[b, :d].T
        if self.top * other.top * max(d, 1) < 2**53:
            return (p @ q).astype(np.int64)
        whole = lambda m: np.clip(m, -(2.0**63), 2.0**63 - 1024).astype(np.int64)
        return whole(p) @ whole(q)


def _best(score: np.ndarray, ids: np.ndarray, fits: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of each row's best ``k`` columns that fit: higher scores first, ties by smaller id."""
    floor = np.iinfo(np.int64).min
    if score.shape[1] > k:
        masked = np.where(fits, score, floor)
        least = np.partition(masked, -k, axis=1)[:, -k]
        fits = fits & (score >= least[:, None])
    r, c = np.nonzero(fits)
    order = np.lexsort((ids[c], ~score[r, c], r))
    r, c = r[order], c[order]
    top = np.arange(len(r)) - np.searchsorted(r, r) < k
    return r[top], c[top]


def _blockwise(emit, scale: int, tile: int = 8192, lot: int = 128):
    """A partition's stream (block, then anchors) to keys; each block's rows come before its anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, x = None, [], None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            number, asks = table.column("block").to_numpy(), table.column("asks").to_numpy(zero_copy_only=False)
            for start in np.flatnonzero(np.r_[True, (number[1:] != number[:-1]) | (asks[1:] != asks[:-1])]):
                same = (number[start:] == number[start]) & (asks[start:] == asks[start])
                part = table.slice(start, len(same) if same.all() else int(np.argmin(same)))
                if number[start] != block:
                    block, held, x = number[start], [], None
                if not asks[start]:
                    held.append(part)
                    continue
                if x is None:
                    rows = pa.concat_tables(held) if held else part.slice(0, 0)
                    x, ids, labels = _Matrix(rows.column("vec"), scale), rows.column("vec_id").to_numpy(), rows.column("label").to_numpy()
                    held = []
                for a in range(0, part.num_rows, lot):
                    some = part.slice(a, lot)
                    q = _Matrix(some.column("vec"), scale)
                    for b in range(0, len(ids), tile):
                        at = slice(b, b + tile)
                        yield from emit(some, q.times(x, slice(None), at), ids[at], labels[at])

    return run


def mine(rows: DataFrame, anchors: Column, label: Column | None = None, positives: int = 5, per_positive: int = 3, lo: int = 50, hi: int = 95, scale: int = 256, block_rows: int = 65536) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for rows where ``anchors`` holds.

    ``rows`` have ``vec_id``, ``embedding`` and, unless ``label`` is given, ``label``.
    """
    spark = rows.sparkSession
    base = cut(usable(rows, F.col("label") if label is None else label).withColumn("_n", F.monotonically_increasing_id()))
    blocks = max(math.ceil(base.count() / block_rows), 2 * spark.sparkContext.defaultParallelism)
    data = base.select(F.pmod(F.xxhash64("_n"), F.lit(blocks)).cast("int").alias("block"), F.lit(False).alias("asks"), "vec_id", "label", "vec", F.lit(None).cast("array<long>").alias("windows"))
    asks = base.where(anchors).select("vec_id", "label", "vec")

    def against_blocks(asked: DataFrame, emit) -> DataFrame:
        copies = asked.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(True).alias("asks"), "vec_id", "label", "vec", "windows")
        met = data.unionByName(copies).repartition(blocks, "block").sortWithinPartitions("block", "asks")
        return met.mapInArrow(_blockwise(emit, scale), KEYED)

    def best_positives(some, score, ids, labels):
        who, mine_ = some.column("vec_id").to_numpy(), some.column("label").to_numpy()
        r, c = _best(score, ids, (mine_[:, None] == labels) & (who[:, None] != ids), positives)
        yield _keyed(pack(who[r], score[r, c], 0, ids[c]), who[r])

    def best_negatives(some, score, ids, labels):
        who, mine_ = some.column("vec_id").to_numpy(), some.column("label").to_numpy()
        windows = some.column("windows").to_pylist()
        other = mine_[:, None] != labels
        found = []
        for i in range(positives):
            p = np.array([w[i] if len(w) > i else -1 for w in windows], np.int64)
            low, high = _bounds(p, lo, hi)
            found.append(np.stack(_best(score, ids, other & (score >= low[:, None]) & (score <= high[:, None]), per_positive), axis=1))
        r, c = np.unique(np.concatenate(found), axis=0).T  # a row that several windows want is sent once
        yield _keyed(pack(who[r], score[r, c], 1, ids[c]), who[r])

    none = F.lit(None).cast("array<long>")
    first = cut(_streamed(against_blocks(asks.withColumn("windows", none), best_positives), _first(positives), f"{KEYED}, score long"))
    windows = first.groupBy(F.col("anchor").alias("vec_id")).agg(F.array_distinct(F.collect_list("score")).alias("windows"))  # at most ``positives``
    keys = first.select("anchor", "key").unionByName(against_blocks(asks.join(windows, "vec_id"), best_negatives))
    return _streamed(keys, _windows(per_positive, lo, hi), MINED)


def _bounds(p: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest negative score of a positive score's window, ``lo * p <= 100 * n <= hi * p``; none below 0."""
    whole = [(-(-lo * x // 100), hi * x // 100) if x >= 0 else (0, -1) for x in p.tolist()]
    return np.array([w[0] for w in whole], np.int64), np.array([w[1] for w in whole], np.int64)


def _streamed(keys: DataFrame, walk, schema: str) -> DataFrame:
    """Keys partitioned by anchor, sorted inside partitions, read as one stream each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def stream():
            for batch in batches:
                if batch.num_rows:
                    keys = batch.column("key")
                    yield from zip(*(x.tolist() for x in unpack(keys)), keys.to_pylist(), strict=True)

        yield from walk(stream())

    return keys.repartition("anchor").sortWithinPartitions("key").mapInArrow(run, schema)


def _batches(rows: Iterator[tuple], names: list[str], types: list[pa.DataType], most: int = 8192) -> Iterator[pa.RecordBatch]:
    lot = []
    make = lambda: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*lot, strict=True), types, strict=True)], names)
    for row in rows:
        lot.append(row)
        if len(lot) == most:
            yield make()
            lot = []
    if lot:
        yield make()


def _first(k: int):
    """The first ``k`` keys of each anchor."""

    def walk(stream):
        def rows():
            anchor, taken = None, 0
            for who, score, _, _, key in stream:
                if who != anchor:
                    anchor, taken = who, 0
                if taken < k:
                    taken += 1
                    yield who, key, score

        return _batches(rows(), ["anchor", "key", "score"], [pa.int64(), pa.binary(), pa.int64()])

    return walk


def _windows(k: int, lo: int, hi: int):
    """Opens a window at each positive, hands negatives to the windows they fall in, closes full and passed ones."""

    def walk(stream):
        def rows():
            anchor, live = None, []
            for who, score, mark, item, _ in stream:
                if who != anchor:
                    anchor, live = who, []
                if mark == 0:
                    if score >= 0:
                        live.append([score, item, 0])
                    continue
                for w in live:
                    if lo * w[0] <= 100 * score <= hi * w[0]:
                        w[2] += 1
                        yield who, w[1], w[2], item, w[0], score
                live = [w for w in live if w[2] < k and 100 * score >= lo * w[0]]

        types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        return _batches(rows(), [c.split()[0] for c in MINED.split(", ")], types)

    return walk
