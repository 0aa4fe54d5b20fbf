"""Session helpers: local sessions for tests, checkpoint location for real clusters."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "tidemark", cpus: int | None = None) -> SparkSession:
    """A session for tests and benches; clusters bring their own."""
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.parquet.filterPushdown", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where it is unset, a local master gets a temporary folder that goes with the process; a cluster must
    name one, as its machines share no local folder.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    current = sc.getCheckpointDir()
    if named:
        if current is None:
            sc.setCheckpointDir(named)
        return named
    if current is None:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        own = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        sc.setCheckpointDir(own)
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder so that several consumers read one result.

    Used where an operator must read its input twice (counts first, rows second); the files
    survive the loss of executors, so both passes see identical rows.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
