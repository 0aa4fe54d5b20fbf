"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``vnodes`` points of a ring of ``2**16`` positions, placed by a hash of (shard, point) alone, so a
further shard only adds points. A row stands on the ring at the hash of its key and belongs to the next point
clockwise. A shard's load is bounded by ``(1 + slack) * total / shards``: where a shard has no room left, rows go on
clockwise to the next shard that has.

Room is given in one fixed order, large documents first, then by hash. To find who overflows without sorting all rows
in one place, rows are summed up in cells: (arc between two points, size class, part). A cell holds about
``1 / cells`` of the rows and bytes at most, or rows of one size class, as an arc's class is split by a hash of the row
into as many parts as its share asks for; a hot key or one text repeated a million times is split like any other. Cells
number at most ``3 * cells`` plus arcs times size classes whatever the input, so the walk around the ring runs over this
bounded summary, and its result comes back to the rows by a broadcast of that proven size. A cell moves as a whole.

Defined results: null keys share one place on the ring and overflow like any hot key. Rows repeated in all columns are
numbered, so they spread and still give the same result for any partitioning. Null or negative sizes count 0. A cell
that has room nowhere (one document larger than what any shard has left) goes to the shard with the smallest load, the
first clockwise of those. An empty table gives no rows. Input columns named ``shard`` or ``slot`` give way to the result's.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import cut

POSITIONS = 1 << 16
OWN = ["shard", "slot"]


def ring(shards: int, vnodes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each position the number of its arc, for each arc the shards in the order met clockwise, and its end.

    Two points on one position: the smaller shard is met first.
    """
    points = sorted((int.from_bytes(hashlib.blake2b(f"{s}:{v}".encode(), digest_size=8).digest(), "big") % POSITIONS, s) for s in range(shards) for v in range(vnodes))
    owners = np.array([s for _, s in points])
    orders = np.empty((len(points), shards), np.int16)
    for i in range(len(points)):
        _, first = np.unique(np.roll(owners, -i), return_index=True)
        orders[i] = np.argsort(first)
    ends = np.array([p for p, _ in points])
    return np.searchsorted(ends, np.arange(POSITIONS)) % len(points), orders, ends


def walk(arcs: np.ndarray, sizes: np.ndarray, orders: np.ndarray, bound: float) -> np.ndarray:
    """Shard of each cell, cells taken in the given order; a cell goes to the first shard clockwise with room."""
    load = [0] * orders.shape[1]
    ways = orders.tolist()
    out = np.empty(len(arcs), np.int32)
    for i, (arc, size) in enumerate(zip(arcs.tolist(), sizes.tolist(), strict=True)):
        way = ways[arc]
        s = next((s for s in way if load[s] + size <= bound), None)
        if s is None:
            s = min(way, key=load.__getitem__)
        load[s] += size
        out[i] = s
    return out


def _numbered(rows: DataFrame) -> DataFrame:
    """Adds ``_mix``, a hash of the row and, for rows equal in all columns, of its number among them.

    Equal rows are numbered inside the partitions they came from, then shifted by the counts of earlier partitions,
    so a group of equal rows is never brought together.
    """
    at = ["_id", "_from"]
    counts = rows.groupBy(*at).agg(F.count(F.lit(1)).alias("_n"))
    ahead = Window.partitionBy("_id").orderBy("_from").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select(*at, F.sum("_n").over(ahead).alias("_shift")).where("_shift > 0")
    nth = F.row_number().over(Window.partitionBy(*at).orderBy(F.lit(0)))
    rows = rows.withColumn("_nth", nth).join(shifts, at, "left")
    return rows.withColumn("_mix", F.xxhash64("_id", F.col("_nth") + F.coalesce("_shift", F.lit(0)))).drop("_id", "_from", "_nth", "_shift")


def place(rows: DataFrame, key: str, size: str, shards: int = 16, slack: float = 0.002, vnodes: int = 64, cells: int = 1 << 14) -> DataFrame:
    """``rows`` with ``shard`` (0 to ``shards - 1``) and ``slot`` (gapless from 0 in each shard, shuffled).

    ``key`` names the column that places a row, ``size`` the one that loads are counted in. ``slack`` bounds how far a
    shard's load may exceed the mean; less slack moves more rows when shards are added.
    """
    spark = rows.sparkSession
    kept = [c for c in rows.columns if c.lower() not in OWN]
    hashed = [F.col(f"_row.`{c}`") for c, t in rows.dtypes if c in kept and "map<" not in t and t != "variant"]
    base = rows.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row"))
    base = base.select(
        "_row", F.greatest(F.coalesce(F.col(f"_row.`{size}`").cast("long"), F.lit(0)), F.lit(0)).alias("_size"),
        F.pmod(F.xxhash64(F.col(f"_row.`{key}`")), F.lit(POSITIONS)).cast("int").alias("_pos"),
        F.xxhash64(*hashed).alias("_id"), F.spark_partition_id().alias("_from"))
    base = cut(base)
    arcs, orders, ends = ring(shards, vnodes)
    arc = F.broadcast(spark.createDataFrame([(i, int(a)) for i, a in enumerate(arcs)], "_pos int, _arc int"))  # 2**16 rows
    kind = (63 - F.when(F.col("_size") > 0, F.length(F.bin("_size"))).otherwise(0)).cast("int")
    digest = cut(_numbered(base).join(arc, "_pos").withColumn("_kind", kind).drop("_pos"))

    groups = digest.groupBy("_arc", "_kind").agg(F.sum("_size").alias("_bytes"), F.count(F.lit(1)).alias("_rows")).toPandas()
    n_bytes, n_rows = int(groups["_bytes"].sum()), int(groups["_rows"].sum())
    share = np.maximum(groups["_bytes"].to_numpy(float) / max(n_bytes, 1), groups["_rows"].to_numpy(float) / max(n_rows, 1))
    groups["_parts"] = np.ceil(share * cells).clip(1).astype(int)
    parts = F.broadcast(spark.createDataFrame(groups[["_arc", "_kind", "_parts"]].astype(int).values.tolist(), "_arc int, _kind int, _parts int"))  # arcs times classes
    digest = digest.join(parts, ["_arc", "_kind"]).withColumn("_part", F.pmod(F.xxhash64(F.lit(1), "_mix"), F.col("_parts")).cast("int"))

    cell = ["_kind", "_part", "_arc"]
    sums = digest.groupBy(*cell).agg(F.sum("_size").alias("_bytes"), F.count(F.lit(1)).alias("_rows")).toPandas()  # at most 3 * cells rows, and those of groups
    # one fixed order: large documents first, then by a hash of the cell that further points elsewhere don't change
    turn = [hashlib.blake2b(f"{p}:{ends[a]}".encode(), digest_size=8).digest() for p, a in zip(sums["_part"], sums["_arc"], strict=True)]
    sums = sums.assign(_turn=turn).sort_values(["_kind", "_turn", "_part", "_arc"], ignore_index=True)
    sums["_shard"] = walk(sums["_arc"].to_numpy(), sums["_bytes"].to_numpy(), orders, (1 + slack) * n_bytes / shards)
    sums = sums.sort_values(["_turn", "_kind", "_part", "_arc"], ignore_index=True)  # slots mix sizes
    sums["_before"] = sums.groupby("_shard")["_rows"].cumsum() - sums["_rows"]
    placed = F.broadcast(spark.createDataFrame(sums[[*cell, "_shard", "_before"]].astype(int).values.tolist(), "_kind int, _part int, _arc int, _shard int, _before long"))
    inside = F.row_number().over(Window.partitionBy(*cell).orderBy("_mix"))
    return digest.withColumn("_inside", inside).join(placed, cell).select(
        "_row.*", F.col("_shard").alias("shard"), (F.col("_before") + F.col("_inside") - 1).alias("slot"))
