"""Helpers the operators share: table readers, cuts in the shared folder, word expressions."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import checkpoint_dir

#: Words are maximal runs of characters outside ASCII white space (Java regex).
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it back.

    The table is read by several consumers and survives lost executors. All files of one
    application lie under one folder, so that a job can delete them together.
    """
    spark = df.sparkSession
    path = f"{_own_folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _own_folder(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark)}/tidemark-{spark.sparkContext.applicationId}"


def drop_cuts(spark: SparkSession) -> None:
    """Delete all tables this application has cut, once their results are written."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and bind it in ``body`` (a one-element ``transform``)."""
    return F.transform(F.array(value), body)[0]


def text_of(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def n_words(col: str = "text") -> Column:
    """Number of words, as a long; null text has none."""
    return F.coalesce(F.regexp_count(F.col(col), F.lit(WORD)), F.lit(0)).cast("long")
