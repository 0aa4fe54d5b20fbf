"""Quality rules with adaptive thresholds from mergeable quantile sketches.

Every document gets plain counts (words, symbols, repeated lines, words in repeated windows ...).
Instead of fixed cut-offs, five ratios are compared with upper fences learnt per language and source:
``q75 + reach * max(q75 - q25, least spread)``. The quartiles come from log-linear histograms (16 cells
per power of two, exact below 32): cells are counts, so sketches merge by adding them, any order gives
the same result, and a source holding a third of all rows is folded before the shuffle. Groups with
fewer than ``min_docs`` documents use the merged sketch of their language, then of all documents.
Fences are joined back and filter the documents.

Everything is DataFrame and SQL functions. Windows hold the cells of one sketch only.

Defined results: null or empty text has no words and fails the base rules; null language or source
is a group of its own; repeated rows count once each; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import SPACES, cut, let, n_words, text_of

SYMBOLS = "#*$%&|<>"
WINDOW = 8
#: metric: (numerator, denominator, scale, least spread in scaled units)
METRICS = {
    "symbols": ("n_symbols", "n_words", 1000, 100),
    "marks": ("n_marks", "n_words", 1000, 100),
    "dup_lines": ("n_dup_lines", "n_lines", 1000, 200),
    "repeats": ("n_repeat_words", "n_words", 1000, 100),
    "word_length": ("word_chars", "n_words", 100, 100),
}


def _count_of(col: Column, chars: str) -> Column:
    return (F.length(col) - F.length(F.translate(col, chars, ""))).cast("long")


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words covered by ``window``-word runs that occur at least twice in the array ``words``.

    Runs are compared by 64-bit hashes; texts without a repeated hash end after one distinct count.
    """
    def covered(h: Column) -> Column:
        marked = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        hits = let(marked, lambda s: F.filter(s, lambda e, j: F.coalesce(F.get(s, j - 1)["h"] == e["h"], F.lit(False)) | F.coalesce(F.get(s, j + 1)["h"] == e["h"], F.lit(False))))
        start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-window).cast("long").alias("last"))
        step = lambda a, p: F.struct((a["n"] + F.least(F.lit(window), p - a["last"])).alias("n"), p.cast("long").alias("last"))
        return F.aggregate(F.array_sort(F.transform(hits, lambda e: e["i"])), start, step, lambda a: a["n"])

    def from_hashes(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(covered(h))

    def from_words(w: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(1), F.size(w) - (window - 1)), lambda i: F.xxhash64(F.slice(w, i, window)))
        return F.when(F.size(w) < window, F.lit(0).cast("long")).otherwise(let(hashes, from_hashes))

    return let(words, from_words)


def features(docs: DataFrame) -> DataFrame:
    t = text_of()
    lines = F.filter(F.split(t, "\n"), lambda x: F.length(F.translate(x, SPACES, "")) > 0)
    line_counts = let(lines, lambda a: F.struct(F.size(a).cast("long").alias("n"), (F.size(a) - F.size(F.array_distinct(a))).cast("long").alias("dup")))
    words = F.filter(F.split(t, r"[\x20\x09-\x0D]+"), lambda x: x != "")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"),
        n_words().alias("n_words"), F.length(F.translate(t, SPACES, "")).cast("long").alias("word_chars"), _count_of(t, SYMBOLS).alias("n_symbols"), _count_of(t, "!").alias("n_marks"),
        line_counts.alias("_lines"), repeated_words(words).alias("n_repeat_words"),
    ).select("*", F.col("_lines.n").alias("n_lines"), F.col("_lines.dup").alias("n_dup_lines")).drop("_lines")


def ratio(metric: str) -> Column:
    top, below, scale, _ = METRICS[metric]
    return F.expr(f"coalesce(({scale} * {top}) div nullif({below}, 0), 0)")


def cell(v: str) -> Column:
    """Cell of a log-linear histogram: exact below 32, then 16 cells per power of two."""
    power = f"(length(bin({v})) - 5)"
    return F.expr(f"cast(CASE WHEN {v} < 32 THEN {v} ELSE 16 * {power} + shiftright({v}, {power}) END as int)")


def cell_floor(c: str = "cell") -> Column:
    return F.expr(f"CASE WHEN {c} < 32 THEN cast({c} as bigint) ELSE shiftleft(cast({c} % 16 + 16 as bigint), cast({c} div 16 - 1 as int)) END")


def sketches(feats: DataFrame) -> DataFrame:
    """Histogram cells per (lang, source, metric): ``lang, source, metric, cell, n``."""
    values = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), ratio(m).alias("v")) for m in METRICS])).alias("m")
    rows = feats.select("lang", "source", values).select("lang", "source", "m.metric", F.col("m.v").alias("v"))
    return rows.groupBy("lang", "source", "metric", cell("v").alias("cell")).agg(F.count(F.lit(1)).alias("n"))


def quartiles(cells: DataFrame, by: list[str]) -> DataFrame:
    """Merge cells by ``by`` and read both quartiles (lower edges of their cells)."""
    merged = cells.groupBy(*by, "metric", "cell").agg(F.sum("n").alias("n"))
    w = Window.partitionBy(*by, "metric")
    merged = merged.withColumn("upto", F.sum("n").over(w.orderBy("cell"))).withColumn("docs", F.sum("n").over(w))
    at = lambda q: F.min(F.when(F.col("upto") >= q * F.col("docs"), F.col("cell")))
    out = merged.groupBy(*by, "metric").agg(F.max("docs").alias("docs"), at(0.25).alias("c25"), at(0.75).alias("c75"))
    return out.select(*by, "metric", "docs", cell_floor("c25").alias("q25"), cell_floor("c75").alias("q75"))


def fences(feats: DataFrame, reach: int = 3, min_docs: int = 100) -> DataFrame:
    """One row per (lang, source) with one upper fence per metric (``f_<metric>``, ratio units)."""
    cells = cut(sketches(feats))
    fine, by_lang, overall = quartiles(cells, ["lang", "source"]), quartiles(cells, ["lang"]), quartiles(cells, [])
    x = fine.alias("f").join(by_lang.alias("l"), F.col("f.lang").eqNullSafe(F.col("l.lang")) & (F.col("f.metric") == F.col("l.metric")))
    x = x.join(overall.alias("o"), F.col("f.metric") == F.col("o.metric"))
    for q in ("q25", "q75"):
        x = x.withColumn(f"_{q}", F.when(F.col("f.docs") >= min_docs, F.col(f"f.{q}")).when(F.col("l.docs") >= min_docs, F.col(f"l.{q}")).otherwise(F.col(f"o.{q}")))
    spread = F.coalesce(*[F.when(F.col("f.metric") == m, F.lit(s)) for m, (_, _, _, s) in METRICS.items()])
    x = x.select("f.lang", "f.source", "f.metric", (F.col("_q75") + reach * F.greatest(F.col("_q75") - F.col("_q25"), spread)).alias("fence"))
    per = [F.max(F.when(F.col("metric") == m, F.col("fence"))).alias(f"f_{m}") for m in METRICS]
    return x.groupBy("lang", "source").agg(*per)


def quality(docs: DataFrame, reach: int = 3, min_docs: int = 100, min_words: int = 20, max_repeat_pct: int = 30) -> DataFrame:
    """Counts, ``base_failed``, the ratios that pass their fence (``over``) and ``kept``."""
    feats = cut(features(docs))
    limits = fences(feats, reach, min_docs).withColumnRenamed("lang", "_lang").withColumnRenamed("source", "_source")
    rows = feats.join(limits, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")))
    base = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_pct * F.col("n_words"))
    over = F.filter(F.array(*[F.when(ratio(m) > F.col(f"f_{m}"), F.lit(m)) for m in METRICS]), lambda m: m.isNotNull())
    rows = rows.withColumn("base_failed", base).withColumn("over", over)
    kept = ~F.col("base_failed") & (F.size("over") == 0)
    return rows.select("doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "over", kept.alias("kept"))
