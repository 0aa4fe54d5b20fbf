"""Window specifications shared by all per-entity operators.

Every frame partitions by ``entity`` and orders by ``date``, so Spark plans a single exchange
and sort for any number of columns built from them.  A partition holds at most one row per
calendar day, whatever the raw volume of the entity, because raw rows are aggregated to
``(entity, date)`` bars first.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

KEY, TIME = "entity", "date"


def series(*extra: str) -> WindowSpec:
    return Window.partitionBy(KEY, *extra).orderBy(TIME)


def latest_first(*extra: str) -> WindowSpec:
    return Window.partitionBy(KEY, *extra).orderBy(F.desc(TIME))


def trailing(n: int) -> WindowSpec:
    """Last ``n`` rows, current one included."""
    return series().rowsBetween(-(n - 1), 0)


def before(n: int) -> WindowSpec:
    """The ``n`` rows ahead of the current one, which is excluded."""
    return series().rowsBetween(-n, -1)


def so_far() -> WindowSpec:
    return series().rowsBetween(Window.unboundedPreceding, 0)


def position() -> Column:
    """Zero-based bar number inside the entity."""
    return F.row_number().over(series()) - 1


def prev(c, n: int = 1) -> Column:
    return F.lag(c, n).over(series())


def zscore_before(c: str, n: int, min_obs: int) -> Column:
    """Deviation from the preceding ``n`` rows in population standard deviations."""
    col, w = F.col(c), before(n)
    sd = F.stddev_pop(col).over(w)
    return F.when((F.count(col).over(w) >= min_obs) & (sd > 1e-12), (col - F.avg(col).over(w)) / sd)


def run_length(cond: Column, pos: str = "idx") -> Column:
    """Length of the unbroken run of true ``cond`` that ends at the current row (0 if false)."""
    last_false = F.max(F.when(~F.coalesce(cond, F.lit(False)), F.col(pos))).over(so_far())
    return F.col(pos) - F.coalesce(last_false, F.lit(-1))


def wide_extremes(df: DataFrame, wanted: dict[str, tuple[str, str, int, int]], **beside: Column) -> DataFrame:
    """Append the ``max`` or ``min`` of a column over the n rows that end some rows ago: name -> (fn, column, n, gap).

    A sliding frame is read anew for every row, so a long one is put together from extremes over about sqrt(n) rows,
    which overlap where they do not fit. Columns ``beside`` them share their pass.
    """
    over, parts, whole = "OVER (PARTITION BY entity ORDER BY date", {}, {}
    for out, (fn, c, n, gap) in wanted.items():
        size = math.isqrt(n - 1) + 1
        parts[f"{out}_part"] = F.expr(f"{fn}({c}) {over} ROWS BETWEEN {size - 1} PRECEDING AND CURRENT ROW)")
        ends = sorted({*range(gap, gap + n - size, size), gap + n - size})
        meets = [F.expr(f"lag({out}_part, {k}) {over})") for k in ends]
        whole[out] = (F.greatest if fn == "max" else F.least)(*meets, *meets[:1])  # takes two at least
    df = df.withColumns(parts | beside) if parts or beside else df
    return df.withColumns(whole).drop(*parts) if whole else df
