"""Trie of conversation prefixes with subtree totals by depth-band rollup.

A node is a distinct sequence of turns from the start. Its key is a sum over its turns of hashes of (place, role, text)
in four 32-bit lanes, so the keys of a conversation are running sums, which long conversations take over segments of
turns. A node is known in the result by its smallest member and its depth.

Subtree totals: depths are cut in bands of ``height``. A node explodes only to its ancestors inside its band, at most
``height`` rows, which gives every node the total of its band's part. The roots of the bands, with their completed
totals, form a trie of a ``height``-th of the depth, on which the same is done; then each band root adds its total to
its at most ``height`` ancestors in the band above. Rounds grow with the logarithm of the depth, rows by a constant.

Hot keys: turns are ordered over key ranges, so a conversation that holds a third of all rows lies in several
partitions; nodes that many conversations share are folded before the shuffle. Digests of members run over ranges of
members first: each task joins its ids to stretches of text, and one stream per node hashes the stretches.

Defined results: rows with a null conv_id take no part. Turns are ordered by (turn, role, text), null turns first;
null role and text are empty; repeated rows stay repeated turns. Further columns are ignored. An empty table has no node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import cut, n_words

KEY = ["k1", "k2"]
LOW = 0xFFFFFFFF


def ordered_turns(rows: DataFrame) -> DataFrame:
    """``conv_id, place`` (from 1), ``role, text``: rows numbered in the order of their turns.

    Rows are dealt by ranges of the whole order, numbered inside each partition and shifted by the counts of earlier ones.
    """
    by = [F.asc("conv_id"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("text"), F.asc("_tie")]
    rows = rows.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), F.monotonically_increasing_id().alias("_tie"))
    rows = cut(rows.repartitionByRange(*by).sortWithinPartitions(*by).select("conv_id", "role", "text", F.monotonically_increasing_id().alias("_at")))
    part = F.shiftright("_at", 33)
    here = rows.groupBy("conv_id", part.alias("_part")).agg(F.min("_at").alias("_from"), F.count(F.lit(1)).alias("_n"))
    ahead = Window.partitionBy("conv_id").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    here = here.select("conv_id", "_part", (F.coalesce(F.sum("_n").over(ahead), F.lit(0)) - F.col("_from") + 1).alias("_shift"))
    return rows.withColumn("_part", part).join(here, ["conv_id", "_part"]).select("conv_id", (F.col("_at") + F.col("_shift")).alias("place"), "role", "text")


def digested(turns: DataFrame) -> DataFrame:
    """``conv_id, place, t1, t2, words``: two hashes of (role, text) and the number of words in place of the texts."""
    return turns.select("conv_id", "place", F.xxhash64(F.lit(1), "role", "text").alias("t1"), F.xxhash64(F.lit(2), "role", "text").alias("t2"), n_words("text").alias("words"))


def branched(turns: DataFrame, head: Column, base: Column, longest: int) -> DataFrame:
    """Every conversation rebuilt as the first ``head`` turns of its base and its own turns after its first ``head``.

    ``turns`` have ``conv_id, place`` and more; ``head`` (at most ``longest``) and ``base`` are expressions of
    ``conv_id``. A turnless conversation is one row with a null place.
    """
    more = [c for c in turns.columns if c not in ("conv_id", "place")]
    turns = turns.withColumns({"_head": head, "_base": base})
    convs = turns.groupBy("conv_id", "_head", "_base").agg(F.max("place").alias("_own"))
    first = turns.where(F.col("place") <= longest).select(F.col("conv_id").alias("_base"), "place", *more).join(convs.select("_base").distinct(), "_base")
    sizes = first.groupBy("_base").agg(F.max("place").alias("_there"))
    convs = convs.join(sizes, "_base", "left").withColumn("_there", F.least("_head", F.coalesce("_there", F.lit(0))))
    taken = convs.join(first, "_base").where(F.col("place") <= F.col("_there")).select("conv_id", "place", *more)
    # own turns move by as many places as the base gives less than it should
    short = convs.where(F.col("_there") < F.col("_head")).select("conv_id", (F.col("_there") - F.col("_head")).alias("_move"))
    own = turns.where(F.col("place") > F.col("_head")).join(short, "conv_id", "left").select("conv_id", (F.col("place") + F.coalesce("_move", F.lit(0))).alias("place"), *more)
    bare = convs.where((F.col("_there") == 0) & (F.col("_own") <= F.col("_head"))).select("conv_id", F.lit(None).cast("long").alias("place"), *[F.lit(None).cast(turns.schema[c].dataType).alias(c) for c in more])
    return taken.unionByName(own).unionByName(bare)


def _members(turns: DataFrame, segment: int = 256) -> DataFrame:
    """``conv_id, depth, k1, k2, p1, p2, words, last``: each conversation at each of its nodes, the root included."""
    lanes = []
    for c in ("t1", "t2"):
        h = F.xxhash64("place", c)
        lanes += [F.shiftrightunsigned(h, 32), h.bitwiseAND(F.lit(LOW))]
    named = [f"h{i}" for i in range(4)]
    turns = turns.where("place IS NOT NULL").select("conv_id", "place", "words", *[h.alias(c) for h, c in zip(lanes, named, strict=True)])
    turns = cut(turns.withColumn("seg", F.floor((F.col("place") - 1) / segment).cast("long")))
    inside = Window.partitionBy("conv_id", "seg").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    sums = turns.groupBy("conv_id", "seg").agg(*[F.sum(c).alias(c) for c in named], F.max("place").alias("upto"))
    ahead = Window.partitionBy("conv_id").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("conv_id", "seg", *[F.coalesce(F.sum(c).over(ahead), F.lit(0)).alias(f"b{c}") for c in named], F.lead("seg").over(Window.partitionBy("conv_id").orderBy("seg")).isNull().alias("final"), "upto")
    rows = turns.withColumns({f"s{c}": F.sum(c).over(inside) for c in named}).join(sums, ["conv_id", "seg"])
    total = [F.col(f"s{c}") + F.col(f"b{c}") for c in named]
    key = lambda t, less: [F.shiftleft((t[i] - less[i]).bitwiseAND(F.lit(LOW)), 32).bitwiseOR((t[i + 1] - less[i + 1]).bitwiseAND(F.lit(LOW))) for i in (0, 2)]
    zero = [F.lit(0).cast("long")] * 4
    now, above = key(total, zero), key(total, [F.col(c) for c in named])
    return rows.select("conv_id", F.col("place").alias("depth"), now[0].alias("k1"), now[1].alias("k2"), above[0].alias("p1"), above[1].alias("p2"), "words", (F.col("final") & (F.col("place") == F.col("upto"))).alias("last"))


def _paths(members: DataFrame, step: int, height: int) -> DataFrame:
    """``k1, k2, depth, up, path``: a node at a depth that ``step`` divides, with its ancestors of the same band.

    Depths count in steps, bands are ``height`` steps high; the path ends with the node itself. A band's root also
    stands, marked ``up``, below the band above, whose nodes are then its path.
    """
    rows = members.where(F.col("depth") % step == 0).select("conv_id", "k1", "k2", F.floor(F.col("depth") / step).cast("long").alias("depth"))
    band = F.floor(F.col("depth") / height).cast("long")
    bands = F.when((F.col("depth") % height == 0) & (F.col("depth") > 0), F.array(band, band - 1)).otherwise(F.array(band))
    rows = rows.withColumn("band", F.explode(bands))
    over = Window.partitionBy("conv_id", "band").orderBy("depth").rowsBetween(-height, 0)
    rows = rows.withColumn("path", F.collect_list(F.struct(*KEY)).over(over)).withColumn("up", F.col("band") < band)
    return rows.groupBy(*KEY, "depth", "up").agg(F.first("path").alias("path"))


def subtree_sums(members: DataFrame, values: DataFrame, names: list[str], deepest: int, height: int, step: int = 1) -> DataFrame:
    """``k1, k2`` and the sums of ``names`` over each node's subtree; ``values`` has a row per node of depths in steps."""
    paths = cut(_paths(members, step, height))
    adds = [F.sum(c).alias(c) for c in names]
    inside = paths.where(~F.col("up")).join(values, KEY).select(F.inline("path"), *names).groupBy(*KEY).agg(*adds)
    if deepest < height:
        return inside
    inside = cut(inside)
    roots = paths.where((F.col("depth") % height == 0) & ~F.col("up")).select(*KEY).join(inside, KEY)
    whole = cut(subtree_sums(members, roots, names, deepest // height, height, step * height))
    handed = paths.where("up").join(whole, KEY).select(F.inline(F.slice("path", 1, F.size("path") - 1)), *names)
    return inside.unionByName(handed).groupBy(*KEY).agg(*adds)


def _digests(ends: DataFrame, stretch: int = 4096) -> DataFrame:
    """``k1, k2, depth, sha``: SHA-256 of the ascending ids of each node's last members, joined by commas."""
    by = [*KEY, "depth"]
    pieces = "k1 long, k2 long, depth long, first long, text string"

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids, out = None, [], []
        close = lambda: out.append((*node, ids[0], ",".join(map(str, ids))))
        names = [c.split()[0] for c in pieces.split(", ")]
        batch_of = lambda: pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names)
        for batch in batches:
            for k1, k2, depth, c in zip(*(batch.column(x).to_pylist() for x in (*by, "conv_id")), strict=True):
                if (k1, k2, depth) != node or len(ids) == stretch:
                    if ids:
                        close()
                    node, ids = (k1, k2, depth), []
                ids.append(c)
            if out:
                yield batch_of()
                out = []
        if ids:
            close()
            yield batch_of()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, sha = None, None
        for batch in batches:
            done = []
            for *at, text in zip(*(batch.column(x).to_pylist() for x in (*by, "text")), strict=True):
                if at != node:
                    if node:
                        done.append((*node, sha.hexdigest()))
                    node, sha = at, hashlib.sha256(text.encode())
                else:
                    sha.update(b"," + text.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], [*by, "sha"])
        if node:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*node, sha.hexdigest())], [*by, "sha"])

    order = [*by, "conv_id"]
    stretches = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(join, pieces)
    return stretches.repartition(*by).sortWithinPartitions(*by, "first").mapInArrow(digest, "k1 long, k2 long, depth long, sha string")


def trie(turns: DataFrame, height: int = 4) -> DataFrame:
    """One row per node of ``turns`` (``conv_id, place, t1, t2, words``; a null place stands for a turnless conversation).

    ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.
    """
    turns = cut(turns)
    deep = _members(turns)
    at_root = [F.lit(0).cast("long").alias(c) for c in ("depth", *KEY)]
    above = [F.lit(None).cast("long").alias(c) for c in ("p1", "p2")]
    convs = turns.groupBy("conv_id").agg(F.max("place").isNull().alias("last"))
    members = cut(deep.unionByName(convs.select("conv_id", *at_root, *above, F.lit(0).cast("long").alias("words"), "last")))
    by = ["depth", *KEY]
    nodes = cut(members.groupBy(*by).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.min("words").alias("words")))
    up = nodes.where("depth > 0").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2"), (F.col("depth") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = cut(nodes.join(up, by, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))))
    values = nodes.select(*KEY, (F.col("n_children") == 0).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"))
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    sums = subtree_sums(members, values, ["n_leaves", "saved_tokens"], deepest, height)
    parents = nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("parent_conv_id"))
    rows = nodes.join(sums, KEY).join(parents, ["p1", "p2", "depth"], "left").join(_digests(members.where("last")), by, "left")
    empty = hashlib.sha256(b"").hexdigest()
    return rows.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("sha", F.lit(empty)).alias("ends_sha256"))
