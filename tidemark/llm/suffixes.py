"""Repeated passages by longest-previous-factor arrays over suffixes.

A passage is ``length`` bytes that start at two places or more. The suffixes of all texts are dealt so that
suffixes with a common prefix of ``length`` bytes always meet:

1. Each window of ``length`` bytes is named by its smallest 48-byte gram (a hash minimum over the
   window, leftmost on ties), which depends on the window alone. Neighbouring windows share it and form a
   run; one row per run (about one per 64 bytes) holds the gram, a hash of the run's bytes and its place.
2. Runs whose gram occurs once end here. Runs with equal gram and bytes repeat as a whole and are settled by
   counts and the first place, folded before the shuffle. What is left are runs that differ at an edge.
3. For those, one text per distinct run goes to the partition of its gram. A block of suffixes is ranked by
   prefix doubling to ``length`` bytes (8, 16 ... 128, ``length``), suffixes of equal rank being ordered by place. In that
   order the previous smaller position of a suffix is its neighbour, and the longest previous factor
   reaches ``length`` exactly if the neighbour has equal rank; the next one gives later copies.
4. Grams with more than ``hot_runs`` distinct runs are not gathered: their windows are counted by hash
   and gram with partial aggregation, and joined back.

``mode="all"`` marks every copy, ``mode="first"`` all but the first (smallest ``doc_id``, then place). Texts are
known by a 64-bit hash, runs by two; matches between different suffixes in step 3 compare bytes.

Defined results: null text is empty; text shorter than ``length`` bytes keeps everything; overlapping copies inside
one text count; with ``"first"``, repeated rows of one id and text are one document; null ids come first;
an empty table gives an empty result; other columns are kept by ``strip_repeats``, ignored elsewhere.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.shared import cut, text_of

LENGTH, GRAM = 200, 48
CHUNK = 1 << 21
BASE = 0x9E3779B97F4A7C15
MASK64 = (1 << 64) - 1
NO_ID = -(1 << 63)


def gram_hashes(a: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` bytes (a power of two, or three halves of one) by doubling."""
    letters = np.random.default_rng(11).integers(0, 1 << 64, 256, dtype=np.uint64)
    h, m, parts = letters[a], 1, {}
    while m * 2 <= size:
        parts[m] = h
        h = h[:-m] * np.uint64(pow(BASE, m, 1 << 64)) + h[m:]
        m *= 2
    if size > m:
        n = len(a) - size + 1
        h = h[:n] * np.uint64(pow(BASE, size - m, 1 << 64)) + parts[size - m][m : m + n]
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    n, m, cur = len(v) - width + 1, 1, v
    while m * 2 <= width:
        cur = np.minimum(cur[:-m], cur[m:])
        m *= 2
    return np.minimum(cur[:n], cur[width - m : width - m + n])


def chunk_runs(data: bytes, ends: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(gram hash, text number, first window, windows) of every run in texts joined to ``data``."""
    a = np.frombuffer(data, np.uint8)
    h = gram_hashes(a, GRAM)
    low = np.uint64((1 << 24) - 1)
    place = (sliding_min((h & ~low) | np.arange(len(h), dtype=np.uint64), length - GRAM + 1) & low).astype(np.int64)
    doc = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))[: len(place)]
    i = np.flatnonzero(np.arange(len(place)) + length <= ends[doc])
    place, doc = place[i], doc[i]
    first = np.flatnonzero(np.append(True, (np.diff(place) != 0) | (np.diff(doc) != 0)))
    return h[place[first]].view(np.int64), doc[first], i[first], np.diff(np.append(first, len(i)))


def runs(texts: DataFrame, length: int) -> DataFrame:
    """``gram, run, tk, at, n``: one row per run of windows of each distinct text of a task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        seen: set[int] = set()

        def emit(tks: list[int], parts: list[bytes], offsets: list[int]) -> pa.RecordBatch:
            data, ends = b"".join(parts), np.cumsum([len(p) for p in parts])
            gram, doc, at, n = chunk_runs(data, ends, length)
            digest = xxhash.xxh3_64_intdigest
            spans = zip(at.tolist(), (at + n + length - 1).tolist())
            body = np.fromiter((digest(data[x:y]) for x, y in spans), np.uint64, len(at)).view(np.int64)
            start = np.append(0, ends[:-1])
            cols = [gram, body, np.array(tks)[doc], at - start[doc] + np.array(offsets)[doc], n]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["gram", "run", "tk", "at", "n"])

        tks, parts, offsets, size = [], [], [], 0
        for b in batches:
            for tk, raw in zip(b.column(0).to_pylist(), b.column(1)):
                if tk in seen:
                    continue
                if len(seen) > 1_000_000:
                    seen.clear()
                seen.add(tk)
                buf = raw.as_buffer()
                for s in range(0, max(1, len(buf) - length + 1), CHUNK):
                    part = buf[s : s + CHUNK + length - 1].to_pybytes()
                    tks.append(tk)
                    parts.append(part)
                    offsets.append(s)
                    size += len(part)
                    if size >= CHUNK:
                        yield emit(tks, parts, offsets)
                        tks, parts, offsets, size = [], [], [], 0
        if parts:
            yield emit(tks, parts, offsets)

    rows = texts.select("tk", F.col("text").cast("binary").alias("b")).where(F.length("b") >= length)
    return rows.mapInArrow(run, "gram long, run long, tk long, at long, n long")


def suffix_ranks(a: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Dense ranks, in suffix order, of the ``length``-byte prefixes at ``starts`` (prefix doubling)."""
    words = np.zeros(len(a), np.uint64)
    padded = np.append(a, np.zeros(8, np.uint8)).astype(np.uint64)
    for i in range(8):
        words = (words << np.uint64(8)) | padded[i : i + len(a)]
    rank = np.unique(words, return_inverse=True)[1].astype(np.uint64)
    m = 8
    while m * 2 <= length:
        nxt = np.append(rank[m:], np.zeros(min(m, len(rank)), np.uint64))
        rank = np.unique((rank << np.uint64(32)) | nxt, return_inverse=True)[1].astype(np.uint64)
        m *= 2
    return np.unique((rank[starts] << np.uint64(32)) | rank[starts + (length - m)], return_inverse=True)[1]


def previous_factor_reaches(rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per suffix (in order of place): does its longest previous, its longest next factor reach full rank?

    Suffixes of equal rank stand in order of place, so the previous smaller position in suffix order is the
    left neighbour if it has equal rank, and the next smaller one can't reach further; likewise for later copies.
    """
    order = np.argsort(rank, kind="stable")
    same = rank[order][1:] == rank[order][:-1]
    before, after = np.zeros(len(rank), bool), np.zeros(len(rank), bool)
    before[order[1:]], after[order[:-1]] = same, same
    return before, after


def block_repeats(pieces: list[bytes], length: int, mode: str) -> list[tuple[int, int, int]]:
    """(piece, first window, windows) of the repeated windows; pieces stand in order of place."""
    lens = np.array([len(p) for p in pieces])
    data = np.frombuffer(b"".join(pieces), np.uint8)
    base = np.cumsum(lens) - lens
    count = lens - length + 1
    piece = np.repeat(np.arange(len(pieces)), count)
    local = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    before, after = previous_factor_reaches(suffix_ranks(data, base[piece] + local, length))
    hit = np.flatnonzero(before if mode == "first" else before | after)
    if not len(hit):
        return []
    first = np.flatnonzero(np.append(True, (np.diff(hit) != 1) | (np.diff(piece[hit]) != 0)))
    n = np.diff(np.append(first, len(hit)))
    return list(zip(piece[hit[first]].tolist(), local[hit[first]].tolist(), n.tolist()))


def _edges(pieces: DataFrame, length: int, mode: str, block_bytes: int = 1 << 20) -> DataFrame:
    """Repeated windows of runs that differ at an edge: ``tk, at, n``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(rows: list[tuple]) -> pa.RecordBatch:
            rows.sort(key=lambda r: (r[2], r[3], r[4]))
            found = block_repeats([r[5] for r in rows], length, mode)
            cols = [[rows[p][3] for p, _, _ in found], [rows[p][4] + w for p, w, _ in found], [n for _, _, n in found]]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["tk", "at", "n"])

        rows, size, last = [], 0, None
        for b in batches:
            for r in zip(*(c.to_pylist() for c in b.columns)):
                if r[:2] == last:
                    continue  # the same run again, from a repeated row
                if size >= block_bytes and r[0] != last[0]:
                    yield emit(rows)
                    rows, size = [], 0
                last = r[:2]
                rows.append(r)
                size += len(r[5])
        if rows:
            yield emit(rows)

    by_gram = pieces.select("gram", "run", "first_id", "tk", "at", "piece").repartition("gram").sortWithinPartitions("gram", "run")
    return by_gram.mapInArrow(run, "tk long, at long, n long")


def _hot_edges(pieces: DataFrame, length: int, mode: str) -> DataFrame:
    """The same for grams with very many runs: windows are counted by gram and hash, then joined back."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for b in batches:
            cols = [[] for _ in range(5)]
            for gram, first_id, tk, at, piece in zip(*(c.to_pylist() for c in b.columns)):
                for i in range(len(piece) - length + 1):
                    for c, v in zip(cols, (gram, xxhash.xxh3_64_intdigest(piece[i : i + length]) - (1 << 63), first_id, tk, at + i)):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["gram", "w", "first_id", "tk", "at"])

    rows = pieces.dropDuplicates(["gram", "run"]).select("gram", "first_id", "tk", "at", "piece")
    rows = cut(rows.mapInArrow(run, "gram long, w long, first_id long, tk long, at long"))
    many = rows.groupBy("gram", "w").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("first_id", "tk", "at")).alias("first")).where("c > 1")
    hit = rows.join(many, ["gram", "w"])
    if mode == "first":
        hit = hit.where(F.struct("first_id", "tk", "at") != F.col("first"))
    return hit.select("tk", "at", F.lit(1).cast("long").alias("n"))


def repeats(docs: DataFrame, length: int = LENGTH, mode: str = "all", hot_runs: int = 4096) -> DataFrame:
    """Per distinct text with something to remove: ``tk, copies, first_id, ranges`` (first window, windows)."""
    if mode not in ("all", "first"):
        raise ValueError("mode is 'all' or 'first'")
    if length < 2 * GRAM or length > 256:
        raise ValueError("length lies between 96 and 256 bytes")
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), text_of().cast("string").alias("text")).withColumn("tk", F.xxhash64("text"))
    known = cut(texts.groupBy("tk").agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("first_id")))
    found = cut(runs(texts, length))
    # cut, so that the join below has an exchange on both sides and a hot gram can be split
    grams = cut(found.groupBy("gram").agg(F.count(F.lit(1)).alias("c"), F.min("run").alias("low"), F.max("run").alias("high")).where("c > 1"))
    again = cut(found.join(grams.select("gram", "low", "high"), "gram").join(known.select("tk", "first_id"), "tk"))
    place = F.struct("first_id", "tk", "at", "n")
    groups = cut(again.groupBy("gram", "run").agg(F.count(F.lit(1)).alias("c"), F.min(place).alias("first"), F.max(F.col("low") != F.col("high")).alias("mixed")))
    if mode == "all":
        whole = again.where("low = high").select("tk", "at", "n").unionByName(
            again.where("low != high").join(groups.where("mixed AND c > 1").select("gram", "run"), ["gram", "run"], "left_semi").select("tk", "at", "n"))
    else:
        whole = again.join(groups.where("c > 1").select("gram", "run", F.col("first.tk").alias("_tk"), F.col("first.at").alias("_at")), ["gram", "run"])
        whole = whole.where("tk != _tk OR at != _at").select("tk", "at", "n")
    asked = groups.where("mixed").select("gram", "run", "c", F.col("first.first_id").alias("id"), F.col("first.tk").alias("tk"), F.col("first.at").alias("at"), F.col("first.n").alias("n"))
    hot = cut(asked.groupBy("gram").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > hot_runs).select("gram"))
    wanted = asked.groupBy("tk", "id").agg(F.collect_list(F.struct("gram", "run", "at", "n")).alias("asked"))
    bodies = texts.join(wanted, ["tk", "id"]).select("tk", F.col("id").alias("first_id"), F.col("text").cast("binary").alias("b"), F.explode("asked").alias("a"))
    piece = F.expr(f"substring(b, cast(a.at + 1 as int), cast(a.n + {length - 1} as int))")
    bodies = bodies.select("a.gram", "a.run", "first_id", "tk", "a.at", piece.alias("piece"))
    if hot.isEmpty():
        edges = _edges(bodies, length, mode)
    else:
        bodies = cut(bodies)
        edges = _edges(bodies.join(hot, "gram", "left_anti"), length, mode).unionByName(_hot_edges(bodies.join(hot, "gram", "left_semi"), length, mode))
    ranges = whole.unionByName(edges).groupBy("tk").agg(F.collect_list(F.struct("at", "n")).alias("ranges"))
    return known.join(ranges, "tk", "left").where("copies > 1 OR ranges IS NOT NULL")


def removed_mask(n: int, ranges: list[dict] | None, whole: bool, length: int) -> np.ndarray:
    if whole:
        return np.ones(n, bool)
    step = np.zeros(n + 1, np.int32)
    for r in ranges or ():
        step[r["at"]] += 1
        step[r["at"] + r["n"] + length - 1] -= 1
    return np.cumsum(step[:n]) > 0


def strip_repeats(docs: DataFrame, length: int = LENGTH, mode: str = "all", **kw) -> DataFrame:
    """``docs`` with its text stripped of repeats, plus ``n_bytes, n_removed, n_spans, kept_sha256, spans``.

    Bytes of a code point that was cut are dropped from the text; the digest covers all kept bytes.
    """
    found = repeats(docs, length, mode, **kw).withColumnsRenamed({"tk": "_tk", "copies": "_copies", "first_id": "_first", "ranges": "_ranges"})
    names = [c for c in docs.columns if c != "text"]
    rows = docs.select(*names, text_of().cast("string").alias("text")).withColumn("_key", F.xxhash64("text"))
    rows = rows.join(found, rows["_key"] == found["_tk"], "left")
    alone = F.lit(False) if mode == "all" else F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)) == F.col("_first")
    rows = rows.withColumn("_whole", F.coalesce((F.col("_copies") > 1) & ~alone, F.lit(False))).drop("_key", "_tk", "_copies", "_first")
    keep = T.StructType([f for f in docs.schema.fields if f.name != "text"])
    schema = T.StructType([*keep.fields, T.StructField("text", T.StringType()), *(T.StructField(c, T.LongType()) for c in ("_n_bytes", "_n_removed", "_n_spans")), T.StructField("_sha", T.StringType()), T.StructField("_spans", T.ArrayType(T.ArrayType(T.LongType())))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [[] for _ in range(6)]
            for text, ranges, whole in zip(b.column("text"), b.column("_ranges").to_pylist(), b.column("_whole").to_pylist()):
                raw = text.as_buffer().to_pybytes()
                gone, starts, stops = np.zeros(0, bool), [], []
                if len(raw) >= length and (ranges or whole):
                    gone = removed_mask(len(raw), ranges, whole, length)
                    edge = np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))
                    starts, stops = np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()
                kept = np.frombuffer(raw, np.uint8)[~gone].tobytes() if len(starts) else raw
                row = (kept.decode("utf-8", "ignore"), len(raw), int(gone.sum()), len(starts), hashlib.sha256(kept).hexdigest(), [list(x) for x in zip(starts, stops)])
                for c, v in zip(out, row):
                    c.append(v)
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep.names), *(pa.array(c, k) for c, k in zip(out, kinds))], names=schema.names)

    return rows.select(*keep.names, "text", "_ranges", "_whole").mapInArrow(run, schema)
