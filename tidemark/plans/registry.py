"""Registry of named queries and their SQL equivalents."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
COVERS: dict[str, str] = {}


def query(name: str, covers: str, sql: str | None = None):
    """Register a query; ``covers`` lists the inventory ids it exercises."""

    def wrap(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        COVERS[name] = covers
        if sql is not None:
            # ``asof`` is a keyword in some dialects, hence quoted as a column
            ORACLES[name] = re.sub(r'(?<![.\w"])asof(?![\w"])', '"asof"', sql)
        return fn

    return wrap


def tidy(df: DataFrame, *cols: str, digits: int = 4) -> DataFrame:
    """Select ``cols`` and put floating columns on a decimal grid, as ``rnd`` does in SQL.

    The small offset moves the rounding boundary off the exact half steps that means of decimal
    prices often hit, where the last bit would otherwise decide.
    """
    cols = cols or df.columns
    scale = 10.0 ** digits
    types = dict(df.dtypes)
    return df.select(*[
        (F.floor(F.col(c) * scale + 0.50001) / scale).alias(c) if types[c] in ("double", "float") else F.col(c)
        for c in cols
    ])


def rnd(e: str, alias: str | None = None, digits: int = 4) -> str:
    s = 10 ** digits
    return f"floor(CAST({e} AS DOUBLE) * {s}.0 + 0.50001) / {s}.0 AS {alias or e}"


def rnds(cols: str, digits: int = 4) -> str:
    return ", ".join(rnd(c, digits=digits) for c in cols.split())
