"""Incremental batch recomputation: read a look-back, write only the newest days."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def incremental(op: Callable[[DataFrame], DataFrame], rows: DataFrame, until: str, read_days: int, write_days: int, date: str = "date") -> DataFrame:
    """Run ``op`` on the last ``read_days`` and keep its last ``write_days``.

    The difference must cover the operator's warm-up; both cuts reach the scan as date filters.
    """
    if read_days <= write_days:
        raise ValueError("read_days must exceed write_days by the operator's warm-up")
    day = F.lit(until).cast("date")
    recent = rows.filter((F.col(date) <= day) & (F.col(date) > F.date_sub(day, read_days)))
    return op(recent).filter(F.col(date) > F.date_sub(day, write_days))
