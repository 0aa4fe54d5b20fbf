"""Packing token pieces into fixed windows by minimum bin slack.

Every document becomes token ids plus an end id and is cut at multiples of the window, so only the
tail of a document is shorter than a window. The tails of a part (some thousand documents dealt
evenly over tasks) form a multiset of lengths. Each window starts with the longest tail left; a
bitset subset-sum dynamic programme over the remaining multiset finds the sum closest to the free
room, and backtracking through its stages gives the count of every length used. A found pattern is
applied as often as the counts allow.

Defined results: a null or empty text is one piece holding only the end id; repeated rows are packed
once per row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import json
import math
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.shared import cut

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PLACED = f"{PIECES}, sequence_id long, offset long"
#: Entries of a task's word cache before it starts anew (bounds memory, not results).
CACHE_WORDS = 600_000
#: Documents whose words are held at once (bounds memory, not results).
SLICE_ROWS = 512


#: Word pattern of the vocabulary for which white space and letter runs separate tokens (fixed value).
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def byte_letters() -> dict[int, int]:
    """Printable stand-ins of byte-level vocabularies: printable bytes stay, the others follow at 256."""
    stay = {*range(33, 127), *range(161, 173), *range(174, 256)}
    moved = [b for b in range(256) if b not in stay]
    return {b: 256 + i for i, b in enumerate(moved)}


#: ASCII marks that end words; a run of them is one token pattern of its own (an apostrophe may start another).
STOPS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


class WordEncoder:
    """Ids of white-space separated words, as little-endian bytes, exactly as the whole text gives.

    A word of Latin letters with trailing marks is the letters' ids followed by the marks' ids, and letters
    need only lower case before the merges; every other word takes the full tokenizer.
    """

    def __init__(self, tok):
        self.tok, self.model, self.moved, self.stops = tok, tok.model, byte_letters(), {"": b""}
        self.cores: dict[str, bytes] = {}  # many words differ by case and stops only

    @staticmethod
    def fits(spec: dict) -> bool:
        kinds = lambda x, k: [y["type"] for y in (x or {}).get(k) or []]
        pre = spec.get("pre_tokenizer")
        return (
            kinds(spec.get("normalizer"), "normalizers") == ["NFC", "Replace", "Lowercase"] and kinds(pre, "pretokenizers") == ["Split", "ByteLevel"]
            and pre["pretokenizers"][0]["pattern"].get("Regex") == WORD_PATTERN and not spec["model"].get("dropout")
        )

    def __call__(self, words: list[bytes]) -> list[bytes]:
        out, rest = [], []
        for i, w in enumerate(words):
            s = w.decode()
            core = s.rstrip(STOPS)
            if core.isalpha() and (core.isascii() or (max(core) < "\u0180" and "\u0130" not in core)):
                low = core.lower()
                ids = self.cores.get(low)
                if ids is None:
                    letters = low if low.isascii() else low.encode().decode("latin-1").translate(self.moved)
                    ids = self.cores[low] = b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(letters)])
                stop = s[len(core) :]
                if stop not in self.stops:
                    self.stops[stop] = self.full([stop])[0]
                out.append(ids + self.stops[stop] if stop else ids)
            else:
                rest.append(i)
                out.append(b"")
        for i, ids in zip(rest, self.full([words[i].decode() for i in rest])):
            out[i] = ids
        return out

    def full(self, texts: list[str]) -> list[bytes]:
        return [b"".join([x.to_bytes(4, "little") for x in e.ids]) for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]


def tokenize(docs: DataFrame, path: str, window: int = 4096, end_id: int = 2, with_ids: bool = False) -> DataFrame:
    """One row per piece of at most ``window`` ids; ``with_ids`` adds the ids themselves.

    For a vocabulary whose tokens never cross white space each distinct word is encoded once per task and
    documents are joined from the encoded words; with any other vocabulary whole texts are encoded.
    """
    schema = PIECES + (", ids array<int>" if with_ids else "")
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            by_word = WordEncoder.fits(json.load(f))
        encode = WordEncoder(tok)
        cache: dict[bytes, bytes] = {}
        for batch in (b.slice(i, SLICE_ROWS) for b in batches for i in range(0, b.num_rows, SLICE_ROWS)):
            cols: list[list] = [[] for _ in range(6)]
            texts = [t or "" for t in batch.column(1).to_pylist()]
            if by_word:
                texts = [t.encode("utf-8", "replace").split() for t in texts]
                new = list({w for ws in texts for w in ws if w not in cache})
                if len(cache) + len(new) > CACHE_WORDS:
                    cache.clear()
                    encode.cores.clear()
                    new = list({w for ws in texts for w in ws})
                for i in range(0, len(new), 20_000):
                    part = new[i : i + 20_000]
                    cache.update(zip(part, encode(part), strict=True))
                found = (b"".join(map(cache.__getitem__, ws)) for ws in texts)
            else:
                found = (encode.full([t])[0] for t in texts)
            for doc_id, ids in zip(batch.column(0).to_pylist(), found, strict=True):
                ids += end
                total = len(ids) // 4
                for start in range(0, total, window):
                    piece = ids[start * 4 : (start + window) * 4]
                    row = (doc_id, start, len(piece) // 4, zlib.crc32(piece), total)
                    for c, v in zip(cols, row):
                        c.append(v)
                    if with_ids:
                        cols[5].append(memoryview(piece).cast("i").tolist())
            types = [pa.int64()] * 5 + [pa.list_(pa.int32())] * with_ids
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names[: len(types)])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def best_fill(room: int, lengths: list[int], left: dict[int, int]) -> dict[int, int]:
    """Counts per length whose sum is closest to ``room`` from below (``lengths`` descending)."""
    mask = (1 << (room + 1)) - 1
    bits, stages = 1, []
    for n in lengths:
        if n > room:
            continue
        many, step = min(left[n], room // n), 1
        while many > 0:  # counts in powers of two: each stage takes ``step`` copies or none
            step = min(step, many)
            stages.append((n, step, bits))
            bits |= (bits << (n * step)) & mask
            many -= step
            step *= 2
        if bits >> room & 1:
            break
    sum_, used = bits.bit_length() - 1, {}
    for n, step, before in reversed(stages):
        if not before >> sum_ & 1:
            used[n] = used.get(n, 0) + step
            sum_ -= n * step
    return used


def slack_plan(counts: dict[int, int], window: int) -> list[tuple[dict[int, int], int]]:
    """Patterns (counts per length) with their multiplicities; together they use every length."""
    left = {n: c for n, c in counts.items() if c}
    lengths = sorted(left, reverse=True)
    plan = []
    while lengths:
        first = lengths[0]
        left[first] -= 1
        used = best_fill(window - first, lengths, left)
        left[first] += 1
        used[first] = used.get(first, 0) + 1
        times = min(left[n] // c for n, c in used.items())
        for n, c in used.items():
            left[n] -= c * times
        lengths = [n for n in lengths if left[n]]
        plan.append((used, times))
    return plan


def pack(pieces: DataFrame, window: int = 4096, part_rows: int = 4096) -> DataFrame:
    """Place pieces (``length <= window``) into sequences; adds ``sequence_id`` and ``offset``.

    Rows are dealt evenly over parts of about ``part_rows``, whatever their keys, so no part is
    unbounded; each part leaves at most one sequence partly filled.
    """
    names = list(pieces.columns)
    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    pieces = cut(pieces)
    parts = max(1, math.ceil(pieces.count() / part_rows))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
        if rows is None or not rows.num_rows:
            return
        lengths = rows.column("length").to_pylist()
        by_length: dict[int, list[int]] = {}
        for i, n in enumerate(lengths):
            by_length.setdefault(n, []).append(i)
        base = rows.column("_part")[0].as_py() << 32
        seq, off, now = [0] * len(lengths), [0] * len(lengths), 0
        for used, times in slack_plan({n: len(v) for n, v in by_length.items()}, window):
            for _ in range(times):
                at = 0
                for n, c in used.items():
                    for _ in range(c):
                        i = by_length[n].pop()
                        seq[i], off[i] = base + now, at
                        at += n
                now += 1
        out = rows.select(names).append_column("sequence_id", pa.array(seq, pa.int64())).append_column("offset", pa.array(off, pa.int64()))
        yield from out.to_batches(max_chunksize=8192)

    return pieces.repartition(parts).withColumn("_part", F.spark_partition_id().cast("long")).mapInArrow(run, schema)
