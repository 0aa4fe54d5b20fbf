"""SimHash near-duplicates, compared bit-sliced.

Fingerprints of equal value are folded first, so only distinct ones are compared. Two fingerprints
within three bits agree on one of four 16-bit bands, and on one of four bands of the other 48 bits:
each fingerprint enters 16 buckets of 28 agreed bits. Buckets of more than ``bucket_rows`` distinct
fingerprints are split again by four bands of the bits left, exactly, up to three times more.

Within a block of buckets the fingerprints stand in 64 bit planes. All distances of a query advance
together: plane xor query bit is added to two bitwise counters by carry-save steps, a third vector
marks sums above three; queries for which every candidate is marked are abandoned. A block emits links to
the smallest member of each local group (linear in its rows), and connected components join them.

Defined results: null text and text without words have fingerprint zero and link like any other;
repeated rows share their component; null ids get their group's component (null if all are null);
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.llm.components import components
from tidemark.llm.shared import cut

BITS, RADIUS = 64, 3
BANDS = RADIUS + 1


def fingerprint(text: str | None, words: int = 3, seed: int = 42) -> int:
    """64 majority bits over the XXH64 values of all word shingles, as a signed long."""
    import xxhash

    toks = (text or "").encode("utf-8", "replace").lower().split()
    if not toks:
        return 0
    joined = b" ".join(toks)
    lens = np.fromiter(map(len, toks), np.int64, len(toks)) + 1
    ends = np.cumsum(lens) - 1
    starts = ends - lens + 1
    k = min(words, len(toks))
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(toks) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)
    h = np.fromiter((digest(joined[a:b], seed) for a, b in spans), np.uint64)
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(h), 1 << 16):
        part = h[i : i + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, words: int = 3, seed: int = 42) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = [fingerprint(t, words, seed) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp, pa.int64())], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, fp long")


def _bands(bits: int) -> list[tuple[int, int]]:
    """(shift, width) of four near-equal bands of ``bits`` bits."""
    edges = [bits * i // BANDS for i in range(BANDS + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _split(rows: DataFrame, bits: int) -> DataFrame:
    """``key, rest, fp`` (``bits`` bits of ``rest`` not agreed yet) to one row per further agreed band."""
    def one(j: int, shift: int, width: int) -> Column:
        rest = F.col("rest")
        band = F.shiftrightunsigned(rest, shift).bitwiseAND(F.lit((1 << width) - 1))
        low = rest.bitwiseAND(F.lit((1 << shift) - 1)) if shift else F.lit(0).cast("long")
        high = F.shiftrightunsigned(rest, shift + width) if shift + width < BITS else F.lit(0).cast("long")
        return F.struct(F.xxhash64("key", F.lit(bits * BANDS + j), band).alias("key"), F.shiftleft(high, shift).bitwiseOR(low).alias("rest"))

    parts = F.explode(F.array(*[one(j, s, w) for j, (s, w) in enumerate(_bands(bits))])).alias("p")
    return rows.select("fp", parts).select("p.key", "p.rest", "fp")


def buckets(fps: DataFrame, bucket_rows: int) -> DataFrame:
    """``key, fp``: any two distinct fingerprints within the radius share a key."""
    bits = BITS
    rows = fps.select(F.lit(0).cast("long").alias("key"), F.col("fp").alias("rest"), "fp")
    for _ in range(2):
        rows, bits = _split(rows, bits), bits - min(w for _, w in _bands(bits))
    out = []
    for _ in range(3):
        hot = cut(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > bucket_rows).select("key"))
        if hot.isEmpty():
            break
        out.append(rows.join(hot, "key", "left_anti").select("key", "fp"))
        rows = cut(_split(rows.join(hot, "key", "left_semi"), bits))
        bits -= min(w for _, w in _bands(bits))
    for part in out:
        rows = rows.select("key", "fp").unionByName(part)
    return rows.select("key", "fp")


def within(fps: np.ndarray, group: np.ndarray, radius: int = RADIUS, queries: int = 256) -> Iterator[tuple[int, np.ndarray]]:
    """(i, later positions within ``radius`` of i and in i's group) by carry-save bit counters."""
    assert radius == 3, "two counters and one overflow vector count to three"
    n = len(fps)
    wide = -(-n // 64)
    planes = np.zeros((BITS, wide * 8), np.uint8)
    bits = np.unpackbits(fps.astype("<i8").view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    planes[:, : -(-n // 8)] = np.packbits(bits.T, axis=1, bitorder="little")
    planes = planes.view("<u8")
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    at = np.arange(wide * 64)
    groups = np.full(wide * 64, -1, np.int64)
    groups[:n] = group
    for a in range(0, n, queries):
        live = np.arange(a, min(n, a + queries))
        off = (at[None, :] <= live[:, None]) | (groups[None, :] != groups[live][:, None])
        over = np.packbits(off, axis=1, bitorder="little").view("<u8")
        ones, twos = np.zeros_like(over), np.zeros_like(over)
        for p in range(BITS):
            x = planes[p][None, :] ^ np.where(bits[live, p], full, np.uint64(0))[:, None]
            carry = ones & x
            ones ^= x
            over |= twos & carry
            twos ^= carry
            if p % 8 == 7:
                keep = (over != full).any(axis=1)
                if not keep.all():
                    live, ones, twos, over = live[keep], ones[keep], twos[keep], over[keep]
                    if not len(live):
                        break
        for i, row in zip(live.tolist(), over):
            yield i, np.flatnonzero(np.unpackbits((~row).view(np.uint8), bitorder="little"))


def _links(fps: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links from every fingerprint of a local group to the group's first."""
    root = np.arange(len(fps))
    for i, js in within(fps, group):
        mine = np.unique(root[np.append(js, i)])
        if len(mine) > 1:
            root[np.isin(root, mine)] = mine[0]
    moved = np.flatnonzero(root != np.arange(len(fps)))
    return fps[moved], fps[root[moved]]


def links(fps: DataFrame, bucket_rows: int = 2048, block_rows: int = 512) -> DataFrame:
    """Links ``(u, v)`` whose components are those of all pairs of distinct ``fp`` within the radius."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(blocks: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            if blocks:
                u, v = _links(np.concatenate(blocks), np.repeat(np.arange(len(blocks)), [len(b) for b in blocks]))
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

        pending, size = [], 0
        key, fp = np.zeros(0, np.int64), np.zeros(0, np.int64)
        def groups(key: np.ndarray, fp: np.ndarray) -> list[np.ndarray]:
            cuts = np.append(np.append(0, np.flatnonzero(np.diff(key)) + 1), len(key))
            long = np.flatnonzero(np.diff(cuts) > 1)
            return [fp[cuts[i] : cuts[i + 1]] for i in long.tolist()]

        for b in batches:  # sorted by key; the last key of a batch may go on in the next
            key = np.concatenate([key, b.column(0).to_numpy(zero_copy_only=False)])
            fp = np.concatenate([fp, b.column(1).to_numpy(zero_copy_only=False)])
            if not len(key):
                continue
            whole = np.searchsorted(key, key[-1])
            for g in groups(key[:whole], fp[:whole]) if whole else ():
                pending.append(g)
                size += len(g)
                if size >= block_rows:
                    yield from emit(pending)
                    pending, size = [], 0
            key, fp = key[whole:], fp[whole:]
        if len(key):
            pending += groups(key, fp)
        yield from emit(pending)

    rows = buckets(fps, bucket_rows).repartition("key").sortWithinPartitions("key")
    return rows.mapInArrow(run, "u long, v long")


def _rooted(docs: DataFrame, words: int, seed: int, bucket_rows: int) -> tuple[DataFrame, DataFrame]:
    """``doc_id, fp`` of every row, and ``fp, first_id, root``: the component of every distinct fingerprint."""
    rows = cut(fingerprints(docs, words, seed))
    distinct = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    roots = components(links(distinct.select("fp"), bucket_rows))
    named = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    return rows, cut(named)


def near_duplicates(docs: DataFrame, words: int = 3, seed: int = 42, bucket_rows: int = 2048) -> DataFrame:
    """``doc_id, fp, component_id`` for every row."""
    rows, named = _rooted(docs, words, seed, bucket_rows)
    ids = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rows.join(named.join(ids, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def _with_fingerprint(docs: DataFrame, words: int, seed: int) -> DataFrame:
    """``_id, fp, _row``: every row as a struct beside its fingerprint."""
    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("string").alias("_text"), F.struct(*docs.columns).alias("_row"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = [fingerprint(t, words, seed) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp, pa.int64()), b.column(2)], names=["_id", "fp", "_row"])

    return rows.mapInArrow(run, StructType([StructField("_id", LongType()), StructField("fp", LongType()), rows.schema["_row"]]))


def drop_near_duplicates(docs: DataFrame, words: int = 3, seed: int = 42, bucket_rows: int = 2048, null_ids: bool = False) -> DataFrame:
    """One row per component: that of its smallest ``doc_id``, of several such rows the smallest by all columns.

    One id on different texts may stand for several components and gives one row for each of them. A component
    without any id gives its smallest row if ``null_ids``, else none.
    """
    rows, named = _rooted(docs, words, seed, bucket_rows)
    kept = cut(named.groupBy("root").agg(F.min("first_id").alias("_keep")))
    winners = kept.where("_keep IS NOT NULL").select("_keep").distinct()
    # an id with one fingerprint names its component; other rows are told apart by their own fingerprints
    mixed = rows.where("doc_id IS NOT NULL").groupBy("doc_id").agg((F.min("fp") != F.max("fp")).alias("_mixed")).where("_mixed").select(F.col("doc_id").alias("_keep"))
    several = cut(winners.join(mixed, "_keep", "left_semi"))
    mine = F.col("doc_id").cast("long")
    clear = docs.join(winners.join(several, "_keep", "left_anti"), mine == F.col("_keep"), "left_semi")
    out = clear.groupBy(mine.alias("_id")).agg(F.min(F.struct(*docs.columns)).alias("_row")).select("_row.*")
    doubtful = [docs.join(several, mine == F.col("_keep"), "left_semi")] if not several.isEmpty() else []
    if null_ids and not kept.where("_keep IS NULL").isEmpty():
        doubtful.append(docs.where(mine.isNull()))
    for part in doubtful:
        x = _with_fingerprint(part, words, seed).join(named.select("fp", "root"), "fp").join(kept, "root").where(F.col("_id").eqNullSafe(F.col("_keep")))
        out = out.unionByName(x.groupBy("root").agg(F.min("_row").alias("_row")).select("_row.*"))
    return out
