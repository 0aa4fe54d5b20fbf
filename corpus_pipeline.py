"""The corpus pipeline: toxicity, near-duplicates, repeated passages, mixing to weights, packing.

Every stage takes all rows its predecessor kept and returns the columns of ``documents``, the last one the
packed pieces. ``run`` writes each stage's result to the shared folder and reads it back, so a lost
executor costs one stage's tasks at most.

Stages keep what their operators define for nulls, ties, repeated rows and empty tables; a document the
suffix stage empties stays as an empty text. No SQL states these stages, see the tests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import mixing, packing, simhash, suffixes, toxicity
from tidemark.llm.queries import fold_of, word_vocabulary
from tidemark.llm.shared import cut, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
REJECT_FROM = 0.3


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold; labels are learnt from the same rows as in the query."""
    return toxicity.filter_toxic(docs.select(*COLUMNS), table(spark, sf_dir, "labels"), REJECT_FROM, usable=fold_of(4) != 2)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component, the one with the smallest id; components without an id stay."""
    return simhash.drop_near_duplicates(docs.select(*COLUMNS), null_ids=True)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of passages of 200 bytes; the first copy of each stays."""
    rows = suffixes.strip_repeats(docs.select(*COLUMNS), mode="first")
    return rows.select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources mixed to their target words; a document drawn twice is there twice."""
    return mixing.mix(docs.select(*COLUMNS))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 4096 tokens."""
    return packing.pack(packing.tokenize(docs, word_vocabulary()))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", drop_repeated_passages),
    ("mixing", mix_sources),
    ("packing", pack),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = cut(docs)
    return docs
