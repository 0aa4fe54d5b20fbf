"""Language identification by bit-sliced Bloom filters over character n-grams.

All languages share one table of ``slots``; the bit of a language in a slot is that slot of its Bloom filter,
so looking up an n-gram (``hashes`` slots, combined by AND) returns the mask of all languages that contain
it. A text adds up, per language, how many of its n-grams carry the language's bit; the popcounts are
corrected for the filter's false positives, ``(count - f * n) / (1 - f)``, and the largest decides. The
score is its share of all corrected counts.

Filters are fitted on at most ``train_docs`` labelled documents per language (smallest keyed digests): an
n-gram enters a language's filter if it is seen in at least two of its documents and at least ``share`` times
as often as in the language where it is most frequent, so foreign passages do not leak in. Scoring
reads every whole text. Masks hold up to 64 languages.

Defined results: null text or text without a letter is ``und`` with score 0, as is every text if there is
nothing to learn from; a text whose letters stand so far apart that no n-gram holds two is decided by filters of single
letters; where no n-gram is known the language with most training documents is given, with score 0; ties go to the language with more training documents, then the smaller name;
repeated rows are scored alike; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

N = 4
SPACE = np.uint32(32)


def letter_table() -> np.ndarray:
    """True for code points of letters (all planes in use)."""
    out = np.zeros(0x110000, bool)
    out[: 0x40000] = [chr(c).isalpha() for c in range(0x40000)]
    return out


def ngrams(text: str, letters: np.ndarray) -> np.ndarray:
    """64-bit hashes of the 4-grams of letters and word gaps (at least two letters each)."""
    code = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    is_letter = letters[code]
    if not is_letter.any():
        return np.zeros(0, np.uint64)
    code = np.where(is_letter, code, SPACE)
    gap = code == SPACE
    code = code[~(gap & np.append(True, gap[:-1]))]
    code = np.concatenate([[SPACE], code, [SPACE, SPACE]]).astype(np.uint64)
    w = [code[i : len(code) - N + 1 + i] for i in range(N)]
    h = np.zeros(len(w[0]), np.uint64)
    for x in w:
        h = (h ^ x) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h[sum((x != SPACE).astype(np.int8) for x in w) >= 2]


def single_letters(text: str, letters: np.ndarray) -> np.ndarray:
    """64-bit hashes of the letters alone, for texts without an n-gram of two letters."""
    code = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    h = (code[letters[code]].astype(np.uint64) + np.uint64(1 << 40)) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ h >> np.uint64(29)


def slots_of(h: np.ndarray, hashes: int, slots: int) -> list[np.ndarray]:
    mask = np.uint64(slots - 1)
    mixed = h * np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(31)
    step = (mixed >> np.uint64(33)) | np.uint64(1)
    return [(mixed + np.uint64(i) * step) & mask for i in range(hashes)]


class Filters:
    """The fitted table: ``langs`` by prior, ``table`` of masks, false-positive rate per language."""

    def __init__(self, langs: list[str], table: np.ndarray, hashes: int):
        self.langs, self.table, self.hashes = langs, table, hashes
        fill = np.array([((table >> np.array(i, table.dtype)) & np.array(1, table.dtype)).mean() for i in range(len(langs))])
        self.false = fill**hashes

    def counts(self, h: np.ndarray) -> np.ndarray:
        mask = None
        for at in slots_of(h, self.hashes, len(self.table)):
            got = self.table[at]
            mask = got if mask is None else mask & got
        if self.table.dtype == np.uint8:
            by_value = np.bincount(mask, minlength=256)
            hits = np.array([by_value[np.arange(256) >> i & 1 == 1].sum() for i in range(len(self.langs))])
        else:
            hits = np.array([int(((mask >> np.array(i, mask.dtype)) & np.array(1, mask.dtype)).sum()) for i in range(len(self.langs))])
        return np.maximum(0.0, (hits - self.false * len(h)) / (1 - self.false))

    def predict(self, text: str | None, letters: np.ndarray) -> tuple[str, float]:
        h = ngrams(text, letters) if text else np.zeros(0, np.uint64)
        if text and not len(h):
            h = single_letters(text, letters)
        if not len(h) or not self.langs:
            return "und", 0.0
        c = self.counts(h)
        best = int(np.argmax(c))
        return self.langs[best], float(c[best] / c.sum()) if c.sum() > 0 else 0.0


def _own(rows: list[tuple[str, np.ndarray]], docs: Counter, langs: list[str], share: float) -> dict[str, np.ndarray]:
    """Per language the hashes it shows in two documents and often enough beside the language that shows them most."""
    seen: dict[str, list[np.ndarray]] = {lang: [] for lang in langs}
    used: dict[str, list[np.ndarray]] = {lang: [] for lang in langs}
    for lang, h in rows:
        u, c = np.unique(h, return_counts=True)
        seen[lang].append(u)
        used[lang].append(c)
    rate = {}
    for lang in langs:
        u, at = np.unique(np.concatenate(seen[lang]), return_inverse=True)
        n = np.bincount(at, weights=np.concatenate(used[lang]))
        twice = np.bincount(at) >= min(2, docs[lang])
        rate[lang] = (u, np.where(twice, n / max(1.0, n.sum()), 0.0))
    if not rate:
        return {}
    all_u, at = np.unique(np.concatenate([u for u, _ in rate.values()]), return_inverse=True)
    top = np.zeros(len(all_u))
    np.maximum.at(top, at, np.concatenate([r for _, r in rate.values()]))
    return {lang: u[(r > 0) & (r >= share * top[np.searchsorted(all_u, u)])] for lang, (u, r) in rate.items()}


def fit(rows: list[tuple[str, str]], slots: int = 1 << 22, hashes: int = 3, share: float = 0.2) -> Filters:
    """Filters from (lang, text) rows."""
    letters = letter_table()
    docs = Counter(lang for lang, _ in rows)
    langs = sorted(docs, key=lambda x: (-docs[x], x))
    if len(langs) > 64:
        raise ValueError("masks hold up to 64 languages")
    families = [_own([(lang, grams(text or "", letters)) for lang, text in rows], docs, langs, share) for grams in (ngrams, single_letters)]
    kind = next(t for t, n in ((np.uint8, 8), (np.uint16, 16), (np.uint32, 32), (np.uint64, 64)) if len(langs) <= n)
    table = np.zeros(slots, kind)
    for i, lang in enumerate(langs):
        for own in families:
            for s in slots_of(own[lang], hashes, slots):
                table[s] |= kind(1 << i)
    return Filters(langs, table, hashes)


def training_rows(docs: DataFrame, train_docs: int = 500) -> list[tuple[str, str]]:
    """At most ``train_docs`` different labelled texts per language, those with the smallest digests.

    Copies count once, so a text repeated a million times weighs as one row from the first shuffle on; only digests are
    ranked, and the texts of those chosen (a bounded number) are fetched by them.
    """
    docs = docs.select("lang", "text", F.xxhash64("text").alias("_key"))
    keys = docs.groupBy("lang", "_key").agg(F.count(F.lit(1)).alias("_c")).select("lang", "_key", (F.pmod("_key", F.lit(1 << 30)) / (1 << 30)).alias("_h"))
    per = keys.groupBy("lang").agg(F.count(F.lit(1)).alias("_n"))
    thin = keys.join(per, "lang").where(F.col("_h") * F.col("_n") < 2 * train_docs)  # a few more than wanted, before the sort
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("_h", "_key"))
    chosen = thin.withColumn("_r", rank).where(F.col("_r") <= train_docs).select("lang", "_key")
    texts = docs.join(F.broadcast(chosen), ["lang", "_key"]).groupBy("lang", "_key").agg(F.min("text").alias("text"))  # at most 64 languages
    return [tuple(r) for r in texts.orderBy("lang", "_key").select("lang", "text").collect()]


def identify(docs: DataFrame, model: Filters) -> DataFrame:
    """``doc_id, lang_pred, score`` for every row."""
    shared = docs.sparkSession.sparkContext.broadcast((model.langs, model.table, model.hashes))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters, letters = Filters(*shared.value), letter_table()
        for b in batches:
            got = [filters.predict(t, letters) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())], names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, lang_pred string, score double")
