"""Toxicity by compression distance between two zstandard dictionaries.

An ordinary dictionary is trained on windows of ordinary text; a toxic one on the passages of toxic text whose
byte 6-grams are over-represented: their document-frequency odds in toxic against ordinary texts are high even one
standard error lower, so a mark that a few ordinary texts also have stays a mark. A window of text is compressed
once with the ordinary dictionary and once with both; how many bytes the toxic dictionary saves is its distance. Every window of the whole
text is measured; the windows that save most are measured again at shifted places and with a stronger
parse, which evens out the noise of single parses. Marks too short to save bytes count by the log odds of the text's strongest
passages. A logistic curve, fitted out of fold, turns both into a calibrated score.

Fitting reads at most ``toxic_rows`` and ``ordinary_rows`` labelled rows (smallest keyed digests); the class
shares come from all labelled rows. Scoring streams over the documents without a shuffle.

Defined results: null or empty text is scored as a text that saves nothing; labels other than 0 and 1 and
labels without a document are ignored; without both classes every score is the share of toxic labels (0
without labels); repeated rows are scored alike; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import cut

WIDTH, STRIDE, GRAM = 64, 48, 6
SHIFTS = (-20, -10, 10, 20)
AGAIN, FROM = 8, 3


def _bytes(text: str | None) -> bytes:
    return (text or "").lower().encode("utf-8", "replace")


def _grams(b: bytes) -> np.ndarray:
    a = np.frombuffer(b, np.uint8).astype(np.uint64)
    h = np.zeros(max(0, len(a) - GRAM + 1), np.uint64)
    for i in range(GRAM if len(h) else 0):
        h = h * np.uint64(0x100000001B3) + a[i : len(h) + i]
    return h


def _among(h: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(h), bool)
    return known[np.minimum(np.searchsorted(known, h), len(known) - 1)] == h


def _trained(samples: list[bytes], size: int, **kw) -> bytes:
    """A trained dictionary's bytes; too few samples for training are joined as they are."""
    import zstandard

    try:
        raw = zstandard.train_dictionary(size, samples, **kw).as_bytes()
        return raw[-max(256, size - 256) :]
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[-size:] or b" "


class Distance:
    """Compressors for one pair of dictionaries, and the grams the toxic one was chosen by."""

    def __init__(self, ordinary: bytes, toxic: bytes, seeds: np.ndarray, weights: np.ndarray):
        self.seeds, self.weights = seeds, weights
        self.fast = self._pair(ordinary, toxic, 3)
        self.strong = self._pair(ordinary, toxic, 12)

    @staticmethod
    def _pair(ordinary: bytes, toxic: bytes, level: int):
        import zstandard

        out = []
        # one set of parameters, or parses differ by more than the dictionaries do
        p = zstandard.ZstdCompressionParameters.from_level(level, source_size=WIDTH, dict_size=len(ordinary + toxic), write_content_size=False, write_checksum=False, write_dict_id=False)
        for raw in (ordinary, ordinary + toxic):
            d = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(compression_params=p)
            out.append(zstandard.ZstdCompressor(dict_data=d, compression_params=p).compress)
        return out

    def evidence(self, b: bytes) -> list[float]:
        """Log odds of the five strongest passages, of the strongest and of the third, and how many differ."""
        h = _grams(b)
        at = np.flatnonzero(_among(h, self.seeds))
        if not len(at):
            return [0.0] * 4
        w = self.weights[np.searchsorted(self.seeds, h[at])]
        best = np.sort(np.maximum.reduceat(w, np.append(0, np.flatnonzero(np.diff(at) > GRAM) + 1)))[::-1]
        return [float(best[:5].sum()), float(best[0]), float(best[2]) if len(best) > 2 else 0.0, np.log1p(len(best))]

    def features(self, text: str | None) -> list[float]:
        b = _bytes(text)
        ordinary, both = self.fast
        starts = range(0, max(1, len(b) - (WIDTH - STRIDE)), STRIDE)
        saved = np.fromiter((len(ordinary(w := b[i : i + WIDTH])) - len(both(w)) for i in starts), np.int64)
        again = []
        for j in np.argsort(-saved, kind="stable")[:AGAIN].tolist():
            if saved[j] >= FROM:
                at = j * STRIDE
                near = [b[max(0, at + s) :][:WIDTH] if at + s < len(b) else b[at : at + WIDTH] for s in SHIFTS]
                v = [int(saved[j]), *(len(ordinary(w)) - len(both(w)) for w in near)]
                w = b[at : at + WIDTH]
                again.append((np.mean(v), len(self.strong[0](w)) - len(self.strong[1](w)), np.median(v)))
        m = np.array(again or [(0.0, 0.0, 0.0)])
        mixed = np.sort(m[:, 0] + m[:, 1] / 2)[::-1]
        top = np.sort(saved)[::-1]
        return [
            float(top[0]), float(top[1]) if len(top) > 1 else 0.0, np.log1p(len(top)), np.log1p((top >= 4).sum()), np.log1p((top >= 6).sum()),
            m[:, 0].max(), m[:, 1].max(), m[:, 2].max(), mixed[0], mixed[1] if len(mixed) > 1 else 0.0, float((m[:, 0] >= 4).sum()),
            *self.evidence(b),
        ]


def over_represented(toxic: list[str], ordinary: list[str], least: int = 4, odds: float = 4.0) -> tuple[np.ndarray, np.ndarray]:
    """Grams whose document-frequency odds in toxic against ordinary texts exceed ``odds`` by one standard error, and their log odds."""

    def frequency(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return np.unique(np.concatenate([np.zeros(0, np.uint64), *(np.unique(_grams(_bytes(t))) for t in texts)]), return_counts=True)

    v, c = frequency(toxic)
    v, c = v[c >= least], c[c >= least]
    u, n = frequency(ordinary)
    also = np.zeros(len(v), np.int64)
    known = _among(v, u)
    also[known] = n[np.searchsorted(u, v[known])]
    log = np.log((c + 0.5) / (len(toxic) - c + 0.5)) - np.log((also + 0.5) / (len(ordinary) - also + 0.5))
    low = log - np.sqrt(1 / (c + 0.5) + 1 / (also + 0.5))
    keep = low >= np.log(odds)
    return v[keep], log[keep]


def dictionaries(toxic: list[str], ordinary: list[str], toxic_size: int = 1500, ordinary_size: int = 16384, least: int = 4) -> tuple[bytes, bytes, np.ndarray, np.ndarray]:
    """(ordinary dictionary, toxic dictionary, over-represented grams, their log odds)."""
    seeds, weights = over_represented(toxic, ordinary, least)
    samples = []
    for t in toxic:
        b = _bytes(t)
        at = np.flatnonzero(_among(_grams(b), seeds))
        if len(at):
            samples += [b[q[0] : q[-1] + GRAM] for q in np.split(at, np.flatnonzero(np.diff(at) > GRAM) + 1)]
    rng = np.random.default_rng(5)
    windows = []
    for t in ordinary:
        b = _bytes(t)
        windows += [b[i : i + WIDTH] for i in rng.integers(0, max(1, len(b) - WIDTH), 3).tolist()]
    return _trained([w for w in windows if w], ordinary_size), _trained(samples, toxic_size, k=32, d=8), seeds, weights


class Curve:
    """Logistic regression by Newton steps; ``odds`` corrects the class shares of the fitted sample."""

    def __init__(self, x: np.ndarray, y: np.ndarray, odds: float, ridge: float = 1.0):
        self.mean, self.sd = x.mean(axis=0), np.maximum(x.std(axis=0), 0.25)
        z = self._design(x)
        w = np.zeros(z.shape[1])
        for _ in range(60):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            w -= np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w)), z.T @ (p - y) + ridge * w)
        self.w, self.shift = w, float(np.log(odds))

    def _design(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([np.ones((len(x), 1)), (x - self.mean) / self.sd], axis=1)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self._design(x) @ self.w + self.shift, -30, 30)))


def fit(toxic: list[str], ordinary: list[str], odds: float):
    """(what ``dictionaries`` gives, curve); ``odds``: toxic to ordinary in all labelled rows."""
    parts = [(toxic[i::2], ordinary[i::2]) for i in (0, 1)]
    x, y = [], []
    for mine, (t, o) in zip(reversed(parts), parts):  # each half is measured with the other's dictionaries
        d = Distance(*dictionaries(*mine))
        x += [d.features(s) for s in t + o]
        y += [1.0] * len(t) + [0.0] * len(o)
    y = np.array(y)
    share = max(1e-6, y.sum()) / max(1e-6, (1 - y).sum())
    return dictionaries(toxic, ordinary), Curve(np.array(x, float), y, odds / share)


def training(docs: DataFrame, labels: DataFrame, toxic_rows: int = 1200, ordinary_rows: int = 2500, usable: Column | None = None) -> tuple[list[str], list[str], float, float]:
    """Texts of both classes within the bounds, and how many rows of each class there are."""
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id IS NOT NULL AND toxic IN (0, 1)")
    if usable is not None:
        rows = rows.where(usable)
    counts = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    most = F.when(F.col("toxic") == 1, toxic_rows).otherwise(ordinary_rows)
    size = F.when(F.col("toxic") == 1, counts.get(1, 0)).otherwise(counts.get(0, 0))
    digest = F.pmod(F.xxhash64(F.lit("toxicity"), "doc_id"), F.lit(1 << 30))
    thin = rows.withColumn("_h", digest).where(F.col("_h") / (1 << 30) * size < 1.5 * most + 50).distinct()
    picked = cut(thin.withColumn("_r", F.row_number().over(Window.partitionBy("toxic").orderBy("_h", "doc_id"))).where(F.col("_r") <= most).select("doc_id", "toxic"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(picked, "doc_id")
    found = sorted((r["toxic"], r["doc_id"], r["text"] or "") for r in texts.collect())
    seen, by = set(), {0: [], 1: []}
    for y, i, t in found:
        if (y, i) not in seen:
            seen.add((y, i))
            by[y].append(t)
    return by[1], by[0], float(counts.get(1, 0)), float(counts.get(0, 0))


def model_of(docs: DataFrame, labels: DataFrame, usable: Column | None = None, **bounds):
    """A function from texts to scores, fitted on the labelled rows."""
    toxic, ordinary, n1, n0 = training(docs, labels, usable=usable, **bounds)
    if not toxic or not ordinary:
        share = n1 / max(1.0, n1 + n0)
        return lambda: lambda texts: np.full(len(texts), share)
    found, curve = fit(toxic, ordinary, n1 / n0)

    def opened():
        d = Distance(*found)
        return lambda texts: curve(np.array([d.features(t) for t in texts], float)) if texts else np.zeros(0)

    return opened


def score(docs: DataFrame, labels: DataFrame, usable: Column | None = None, **bounds) -> DataFrame:
    """``doc_id, score`` for every row of ``docs``; ``usable`` limits the label rows to learn from."""
    model = model_of(docs, labels, usable, **bounds)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = model()
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores(b.column(1).to_pylist()), pa.float64())], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, score double")


def filter_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, usable: Column | None = None, **bounds) -> DataFrame:
    """The rows of ``docs`` scored below ``threshold``, in one pass without a join."""
    model = model_of(docs, labels, usable, **bounds)
    at = docs.columns.index("text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = model()
        for b in batches:
            yield b.filter(pa.array(scores(b.column(at).to_pylist()) < threshold, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
