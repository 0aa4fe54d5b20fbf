"""Exact ranks and quantiles inside groups that may be far larger than one task.

A plain ``row_number() over (partition by date)`` sends a whole cross-section to one task.  Here all rows
are dealt by range of (group, metric, tie), which balances any distribution of values and ids; rows are
numbered inside a range, and the counts per range (map-side combined) supply each range's starting rank.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import cut


def dealt_by_range(df: DataFrame, order: list[Column]) -> DataFrame:
    """``df`` cut into ranges of ``order`` of about equal size; ``_p`` numbers them in that order."""
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut(df.repartitionByRange(ranges, *order).withColumn("_p", F.spark_partition_id()))


def ranked_rows(df: DataFrame, by: list[str], metric: str, ascending: bool = True, tie: str = "entity",
                rank_col: str = "rank", size_col: str = "universe_size") -> DataFrame:
    """Add ``rank`` (1..n by metric, ties by ``tie`` ascending) and the group size.

    ``df`` must hold only rows to be ranked (metric not null).  The ranges are read twice (counts, then
    rows), hence ``cut``.
    """
    order = F.col(metric).asc() if ascending else F.col(metric).desc()
    base = dealt_by_range(df, [*map(F.col, by), order, F.col(tie).asc()])
    group = Window.partitionBy(*by)
    cells = base.groupBy(*by, "_p").agg(F.count("*").alias("_n"))
    cells = cells.select(*by, "_p", (F.sum("_n").over(group.orderBy("_p")) - F.col("_n")).alias("_start"), F.sum("_n").over(group).cast("int").alias(size_col))
    inside = Window.partitionBy(*by, "_p").orderBy(order, F.col(tie).asc())
    return (
        base.join(cells, [*by, "_p"])
        .withColumn(rank_col, (F.col("_start") + F.row_number().over(inside)).cast("int"))
        .select(*df.columns, rank_col, size_col)
    )


def group_quantiles(df: DataFrame, by: list[str], value: str, probs: dict[str, float], tie: str = "entity") -> DataFrame:
    """Exact quantiles (linear interpolation) per group from ranked positions; one row per group."""
    r = ranked_rows(df.filter(F.col(value).isNotNull()), by, value, True, tie, "_rank", "_size")
    aggs = []
    for name, p in probs.items():
        pos = (F.col("_size") - 1) * F.lit(p) + 1
        lo, frac = F.floor(pos), pos - F.floor(pos)
        at_lo = F.max(F.when(F.col("_rank") == lo, F.col(value)))
        at_hi = F.max(F.when(F.col("_rank") == F.least(lo + 1, F.col("_size")), F.col(value)))
        f = F.max(frac)
        aggs.append((at_lo + (at_hi - at_lo) * f).alias(name))
    return r.groupBy(*by).agg(*aggs, F.max("_size").alias("n"))
