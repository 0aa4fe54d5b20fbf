"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

1. Targets: the words wanted are shared among sources by weight; a source stops at ``cap`` times its
   size and its excess is shared again. That is water-filling: with sources ordered by cap / weight
   the level is the largest of (rest of the total) / (rest of the weights).
2. Blocks: within a source a keyed hash permutes the documents; blocks are ranges of that hash of
   about ``block_docs`` documents. A source is drawn in passes over its permuted blocks, the last
   block cut at the document nearest the target, so no document is drawn more than ``cap`` times.
3. Tree: the vector of block quotas is split among output shards. Each node gives its left child a
   multivariate-hypergeometric draw of half its slots (one univariate inverse-CDF draw per source,
   over eight standard deviations), so every leaf holds exact block counts per source.
4. Prefix sums of the leaves turn counts into disjoint ranges of permuted blocks; each shard is
   shuffled locally by another keyed hash.

All of it is DataFrame and SQL functions. Only word counts per document, one row per block and one
row per source are shuffled. Windows over blocks hold one row per ``block_docs`` documents.

Defined results: null or empty text has size 0 and takes 0 words; a null source is a source of its
own, ordered last; repeated rows are drawn together; an empty table gives an empty result; other
columns are kept by ``mix`` and ignored by ``draws``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import cut, n_words

KEY_BITS = 60


def permutation_key(seed: str, col: str = "doc_id") -> Column:
    """60 bits of a keyed digest: the place of a document in its source's permutation."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(col).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, KEY_BITS // 4), 16, 10).cast("long")


def source_key(col: str = "source") -> Column:
    """Non-null form of the source; a null source differs from every text."""
    return F.coalesce(F.concat(F.lit("="), F.col(col).cast("string")), F.lit("null"))


def source_targets(sized: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """One row per source: ``src, pos, source_size, n_docs, target``."""
    per = sized.groupBy("src", "source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    per = per.withColumn("pos", F.row_number().over(by_name).cast("int"))
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("pos") - 1) % len(weights) + 1))
    room = F.lit(float(cap)) * F.col("source_size")
    rising = Window.orderBy(room / F.col("weight"), "pos")
    before, after = rising.rowsBetween(Window.unboundedPreceding, -1), rising.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    total = F.lit(float(share)) * F.sum("source_size").over(everything)
    per = per.withColumn("_level", (total - F.coalesce(F.sum(room).over(before), F.lit(0.0))) / F.sum("weight").over(after))
    return per.select("src", "pos", "source_size", "n_docs", F.least(room, F.max("_level").over(everything) * F.col("weight")).alias("target"))


def _hypergeometric(total: str, marked: str, drawn: str, u: str) -> str:
    """SQL for one inverse-CDF draw: marked items among ``drawn`` of ``total``, ``u`` uniform."""
    spread = f"8 * sqrt(greatest(0D, {drawn} * ({marked} / {total}) * (1 - {marked} / {total}) * ({total} - {drawn}) / greatest(1D, {total} - 1))) + 2"
    lo = f"cast(greatest(0D, {drawn} - ({total} - {marked}), floor({drawn} * {marked} / {total} - ({spread}))) as bigint)"
    hi = f"cast(least({drawn}, {marked}, ceil({drawn} * {marked} / {total} + ({spread}))) as bigint)"
    ratio = f"(({marked} - x + 1) * ({drawn} - x + 1) / (x * ({total} - {marked} - {drawn} + x)))"
    return (
        f"CASE WHEN {total} <= 0 THEN 0D ELSE transform(array(named_struct('lo', {lo}, 'hi', {hi})), b -> CASE WHEN b.hi <= b.lo THEN double(b.lo) ELSE "
        f"transform(array(aggregate(sequence(b.lo + 1, b.hi), named_struct('p', 1D, 's', 1D), (a, x) -> named_struct('p', a.p * {ratio}, 's', a.s + a.p * {ratio}), a -> a.s)), all -> "
        f"aggregate(sequence(b.lo + 1, b.hi), named_struct('p', 1D, 's', 1D, 'at', double(b.lo)), (a, x) -> IF(a.s >= {u} * all, a, "
        f"named_struct('p', a.p * {ratio}, 's', a.s + a.p * {ratio}, 'at', double(x))), a -> a.at))[0] END)[0] END"
    )


def splitting_tree(quotas: DataFrame, levels: int, seed: str = "split") -> DataFrame:
    """``quotas(src, pos, slots)`` to ``(src, leaf, first, last)``: slot ranges of 2**levels shards."""
    root = quotas.groupBy().agg(F.array_sort(F.collect_list(F.struct("pos", F.col("slots").cast("double").alias("k")))).alias("q"))
    nodes = root.where("size(q) > 0").select(F.lit(0).cast("long").alias("leaf"), "q")
    for level in range(levels):
        u = f"(shiftrightunsigned(xxhash64('{seed}', {level}, leaf, s.pos), 11) / 9007199254740992D)"
        draw = _hypergeometric("t.n", "s.k", "t.m", u)
        total = "aggregate(q, 0D, (a, s) -> a + s.k)"
        left = (
            f"aggregate(q, named_struct('n', {total}, 'm', floor({total} / 2) + 0D, 'out', cast(array() as array<double>)), "
            f"(t, s) -> transform(array({draw}), x -> named_struct('n', t.n - s.k, 'm', t.m - x, 'out', array_append(t.out, x)))[0], t -> t.out)"
        )
        nodes = nodes.withColumn("l", F.expr(left)).select(
            "leaf", F.explode(F.expr("array(named_struct('b', 0, 'q', transform(q, (s, i) -> named_struct('pos', s.pos, 'k', l[i]))), named_struct('b', 1, 'q', transform(q, (s, i) -> named_struct('pos', s.pos, 'k', s.k - l[i]))))")).alias("c")
        ).select((F.col("leaf") * 2 + F.col("c.b")).alias("leaf"), F.col("c.q").alias("q"))
    parts = nodes.select("leaf", F.explode("q").alias("s")).select("leaf", F.col("s.pos").alias("pos"), F.col("s.k").cast("long").alias("k"))
    running = Window.partitionBy("pos").orderBy("leaf").rowsBetween(Window.unboundedPreceding, 0)
    parts = parts.withColumn("last", F.sum("k").over(running)).where("k > 0").withColumn("first", F.col("last") - F.col("k"))
    return parts.join(quotas.select("src", "pos"), "pos").select("src", "leaf", "first", "last")


def block_draws(sized: DataFrame, sources: DataFrame, block_docs: int, blocks_per_shard: int) -> DataFrame:
    """One row per drawn block: ``src, block, draws`` with ``draws`` = (copy, shard, limit) at most twice.

    A document of the block is drawn by an entry if its key is at most the entry's ``limit``.
    """
    placed = sized.join(sources.select("src", "n_docs"), "src").withColumn("block", block_of("key", "n_docs", block_docs))
    blocks = placed.groupBy("src", "block").agg(F.sum("size").alias("words"))
    order = Window.partitionBy("src").orderBy("block")
    blocks = blocks.withColumn("upto", F.sum("words").over(order)).withColumn("rank", F.row_number().over(order) - 1)
    blocks = cut(blocks.join(sources.select("src", "pos", "source_size", "target"), "src"))
    copies = F.explode(F.array(
        F.struct(F.lit(0).alias("copy"), F.least("target", "source_size").alias("quota")),
        F.struct(F.lit(1).alias("copy"), F.greatest(F.col("target") - F.col("source_size"), F.lit(0.0)).alias("quota")),
    )).alias("c")
    wanted = blocks.select("*", copies).select("*", "c.*").drop("c").withColumn("before", F.col("upto") - F.col("words"))
    whole = wanted.where("upto <= quota AND quota > 0").select("src", "pos", "block", "rank", "copy", F.lit((1 << KEY_BITS) - 1).alias("limit"))
    last = wanted.where("before < quota AND upto > quota").select("src", "pos", "block", "rank", "copy", "before", "quota")
    inside = Window.partitionBy("src", "block", "copy").orderBy("key", "size").rowsBetween(Window.unboundedPreceding, 0)
    nearest = (
        placed.select("src", "block", "key", "size").join(last, ["src", "block"])
        .withColumn("mid", F.col("before") + F.sum("size").over(inside) - F.col("size") / 2)
        .where("mid <= quota").groupBy("src", "pos", "block", "rank", "copy").agg(F.max("key").alias("limit"))
    )
    taken = cut(whole.unionByName(nearest))
    quotas = taken.groupBy("src", "pos").agg(F.count(F.lit(1)).alias("slots"), F.sum(F.when(F.col("copy") == 0, 1).otherwise(0)).alias("first_pass"))
    quotas = cut(quotas)
    slots = quotas.agg(F.sum("slots")).first()[0] or 0
    levels = max(0, math.ceil(math.log2(max(1, slots / blocks_per_shard))))
    leaves = splitting_tree(quotas, levels)
    leaves = leaves.select("src", "leaf", F.explode(F.sequence(F.col("first"), F.col("last") - 1)).alias("slot"))
    taken = taken.join(quotas.select("src", "first_pass"), "src").withColumn("slot", F.col("rank") + F.col("copy") * F.col("first_pass"))
    taken = taken.join(leaves, ["src", "slot"])
    return taken.groupBy("src", "block").agg(F.array_sort(F.collect_list(F.struct("copy", F.col("leaf").alias("shard"), "limit"))).alias("draws"))


def block_of(key: str, n_docs: str, block_docs: int) -> Column:
    blocks = F.ceil(F.col(n_docs) / block_docs).cast("long")
    return F.shiftright(F.shiftright(F.col(key), 30) * blocks, 30)


def draws(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, cap: float = 2.0, block_docs: int = 256, blocks_per_shard: int = 64, seed: str = "mix") -> DataFrame:
    """Per document: ``doc_id, source, size, source_size, target, draws`` (copy and shard of each draw)."""
    if cap > 2:
        raise ValueError("at most two passes over a source")
    sized = cut(docs.select("doc_id", F.col("source").cast("string").alias("source"), source_key().alias("src"), n_words().alias("size"), permutation_key(seed).alias("key")))
    sources = cut(source_targets(sized, weights, share, cap))
    blocks = block_draws(sized, sources, block_docs, blocks_per_shard)
    rows = sized.join(sources.drop("pos"), "src").withColumn("block", block_of("key", "n_docs", block_docs))
    rows = rows.join(blocks, ["src", "block"], "left")
    drawn = F.coalesce(F.filter("draws", lambda d: F.col("key") <= d["limit"]), F.array().cast("array<struct<copy:int,shard:bigint,limit:bigint>>"))
    return rows.select("doc_id", "source", "size", "source_size", "target", F.transform(drawn, lambda d: F.struct(d["copy"].alias("copy"), d["shard"].alias("shard"))).alias("draws"))


def mix(docs: DataFrame, seed: str = "mix", **kw) -> DataFrame:
    """The mixed corpus: rows of ``docs`` once per draw, gathered by shard and shuffled inside it."""
    names = docs.columns
    drawn = draws(docs, seed=seed, **kw).where(F.size("draws") > 0)
    # repeated doc_ids share key and source, hence their draws
    drawn = drawn.groupBy("doc_id", source_key().alias("_src")).agg(F.first("draws").alias("_draws"))
    rows = docs.withColumn("_src", source_key()).withColumnRenamed("doc_id", "_id")
    rows = rows.join(drawn.withColumnRenamed("doc_id", "_id2"), F.col("_id").eqNullSafe(F.col("_id2")) & (rows["_src"] == drawn["_src"]))
    rows = rows.select(*[F.col("_id" if c == "doc_id" else c).alias(c) for c in names], F.explode("_draws").alias("_draw"))
    rows = rows.select("*", F.col("_draw.shard").alias("_shard"), F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("_draw.copy")).alias("_order"))
    return rows.repartition("_shard").sortWithinPartitions("_shard", "_order").select(*names)
