"""Recursions as associative scans, so that one series may span many tasks.

A recursion whose step is a map out of a family closed under composition (affine maps, triangular
systems, fractions of linear terms) needs no walk from its first row: maps are composed instead.
Rows are cut into blocks that follow the order column (calendar years by default).

1. Inside a block, the composition of all maps up to each row takes ``log2(longest)`` rounds; round k
   composes a row's map with that of the row 2^k before it.
2. The composition of a whole block is one small row; the state that enters a block is a fold of the
   blocks before it, over rows as few as blocks.
3. Each row applies its composition to the state that enters its block.

Short blocks mean fewer rounds and longer folds.  Rows are shuffled once, by (keys, block), so a series is never one task's work; only one row per
block is shuffled again.  All of it are built-in expressions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAPS, BLOCK, ROWS = "_maps", "_block", "_rows"


def in_blocks(df: DataFrame, order: str = "date", block: Column | None = None) -> DataFrame:
    """Add the block of each row; ``block`` must not decrease along ``order``."""
    return df if BLOCK in df.columns else df.withColumn(BLOCK, F.year(order) if block is None else block)


def scan(df: DataFrame, step: Column, identity: Column, compose: Callable, apply: Callable, start: Column, out: str,
         keys: tuple[str, ...] = ("entity",), order: str = "date", longest: int = 366) -> DataFrame:
    """Append ``out``, the state after each row.

    ``step`` is the row's map as a struct of doubles, ``compose(f, g)`` the map "first f, then g" with
    the same fields, ``apply(state, f)`` the mapped state and ``start`` the state before the first row,
    read from that row.  (keys, order) is unique and inputs are not null.  A block of more than
    ``longest`` rows raises an error, as its rounds would be too few.
    """
    df = in_blocks(df, order)
    by = [*keys, BLOCK]
    w = Window.partitionBy(*by).orderBy(order)

    totals = df.select(*by, order, step.alias("m"), start.alias("s")).groupBy(*by).agg(
        F.array_sort(F.collect_list(F.struct(order, "m"))).alias("l"), F.min_by("s", order).alias("s"))
    size = F.when(F.size("l") > longest, F.raise_error(F.lit(f"a block holds more than {longest} rows")).cast("double")).otherwise(F.lit(0.0))
    totals = totals.select(*by, "s", F.aggregate("l", identity, lambda f, r: compose(f, r["m"])).alias("m"), size.alias("_checked"))
    along = Window.partitionBy(*keys).orderBy(BLOCK)
    so_far = along.rowsBetween(Window.unboundedPreceding, 0)
    enters = totals.select(*by, "_checked", F.collect_list("m").over(along.rowsBetween(Window.unboundedPreceding, -1)).alias("l"), F.first("s").over(so_far).alias("s"))
    enters = enters.select(*by, F.aggregate("l", F.col("s"), apply).alias("_enters"), "_checked")

    rows, reach = df.withColumn(MAPS, step), 1
    while reach < longest:
        rows = rows.withColumn("_earlier", F.lag(MAPS, reach).over(w))
        rows = rows.withColumn(MAPS, F.when(F.col("_earlier").isNull(), F.col(MAPS)).otherwise(compose(F.col("_earlier"), F.col(MAPS))))
        reach *= 2
    rows = rows.join(enters, by, "left").filter(F.col("_checked") == 0.0)
    return rows.withColumn(out, apply(F.col("_enters"), F.col(MAPS))).drop(MAPS, "_earlier", "_enters", "_checked")


def dealt(df: DataFrame, keys: tuple[str, ...] = ("entity",), order: str = "date") -> DataFrame:
    """Rows shuffled to their block; rows without a key or block are left out.

    What reads the result several times reads one shuffle, if it reads the same columns.
    """
    df = in_blocks(df, order)
    for k in (*keys, BLOCK):
        df = df.filter(F.col(k).isNotNull())
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys, BLOCK)


def packed(df: DataFrame, cols: list[str], keys: tuple[str, ...] = ("entity",), order: str = "date", longest: int = 366) -> DataFrame:
    """One row per block of ``dealt`` rows: ``ROWS``, an array of (order, cols) in order, of at most ``longest`` rows."""
    df = df.groupBy(*keys, BLOCK).agg(F.array_sort(F.collect_list(F.struct(order, *cols))).alias(ROWS))
    return df.filter(F.when(F.size(ROWS) > longest, F.raise_error(F.lit(f"a block holds more than {longest} rows")).cast("boolean")).otherwise(True))


def entering(totals: DataFrame, total: Column, start: Column, apply: Callable, out: str, keys: tuple[str, ...] = ("entity",)) -> DataFrame:
    """Append ``out``, the state that enters each block: ``start`` of the first block through ``apply(state, total)`` of all before this one.

    ``totals`` has one small row per block, so a series may be gathered here.
    """
    along = Window.partitionBy(*keys).orderBy(BLOCK)
    df = totals.withColumns({"_before": F.collect_list(total).over(along.rowsBetween(Window.unboundedPreceding, -1)), "_start": F.first(start).over(along.rowsBetween(Window.unboundedPreceding, 0))})
    return df.withColumn(out, F.aggregate("_before", F.col("_start"), apply)).drop("_before", "_start")


def located(df: DataFrame, before: dict[str, str], keys: tuple[str, ...] = ("entity",), order: str = "date") -> DataFrame:
    """Append ``idx`` (from 0), ``n`` (rows of the series) and values of the row before (name -> column) across blocks."""
    df = in_blocks(df, order)
    by = [*keys, BLOCK]
    per = df.groupBy(*by).agg(F.count("*").alias("_n"), *[F.max_by(c, order).alias(f"_last_{k}") for k, c in before.items()])
    along = Window.partitionBy(*keys).orderBy(BLOCK)
    per = per.select(*by, (F.sum("_n").over(along) - F.col("_n")).alias("_skip"), F.sum("_n").over(Window.partitionBy(*keys)).alias("n"),
                     *[F.lag(f"_last_{k}").over(along).alias(f"_last_{k}") for k in before])
    w = Window.partitionBy(*by).orderBy(order)
    rows = df.withColumns({"_at": F.row_number().over(w)} | {f"_in_{k}": F.lag(c).over(w) for k, c in before.items()}).join(per, by, "left")
    rows = rows.withColumns({"idx": F.col("_skip") + F.col("_at") - 1} | {k: F.when(F.col("_at") > 1, F.col(f"_in_{k}")).otherwise(F.col(f"_last_{k}")) for k in before})
    return rows.drop("_skip", "_at", *[f"_{p}_{k}" for p in ("in", "last") for k in before])


def doubles(**fields) -> Column:
    """A struct of non-null doubles, the type of every map and state of several numbers."""
    return F.struct(*[F.coalesce((F.lit(v) if isinstance(v, (int, float)) else v).cast("double"), F.lit(0.0)).alias(k) for k, v in fields.items()])


def affine(df: DataFrame, a: Column, b: dict[str, Column], start: dict[str, Column], keys: tuple[str, ...] = ("entity",), order: str = "date", longest: int = 366) -> DataFrame:
    """Columns y[t] = a[t] * y[t-1] + b[t], several ``b`` over one ``a``, from ``start``."""
    names = list(b)
    df = scan(df, doubles(a=a, **b), doubles(a=1.0, **{k: 0.0 for k in names}),
              lambda f, g: doubles(a=f["a"] * g["a"], **{k: g["a"] * f[k] + g[k] for k in names}),
              lambda y, f: doubles(**{k: f["a"] * y[k] + f[k] for k in names}),
              doubles(**start), "_y", keys, order, longest)
    return df.withColumns({k: F.col("_y")[k] for k in names}).drop("_y")
