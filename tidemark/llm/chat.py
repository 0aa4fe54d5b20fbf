"""Multi-party perspective rotation of dialogues.

For every participant of a dialogue the whole dialogue is rendered with that speaker as the assistant and all
others as named users; mask spans cover what the assistant says (its text and the end mark), so each
participant's turns are learnt once. Narrators (``system``) are no participants and stay as they are.

A dialogue is rendered in parts of ``part_turns`` turn numbers, so no row grows without bound; a part that still
holds more than eight times as many rows (many rows of one turn number) is cut into sub-parts, contiguous ranges in
the order of its turns, numbered without gathering it. ``whole_parts`` joins the sub-parts to one row a part again.
Everything is DataFrame and SQL functions; participants are folded before the shuffle.

Defined results: repeated rows are one turn; turns of one number stand in order of speaker and text; a null
role is the speaker with the empty name; null text is empty; null turns stand in a part of their own (null);
null ids are one dialogue; a dialogue of narrators only gives no rows; "<|" inside a text or a name is written "< |"
and line breaks in a name are spaces, so neither can forge marks or turns; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import cut, text_of

START, END = "<|im_start|>", "<|im_end|>\n"


def _numbered(rows: DataFrame, size: int) -> DataFrame:
    """``sub``: which range of ``size`` rows of its (conv_id, part) a row stands in, by turn, speaker and text."""
    order = ["turn", "who", "text"]
    rows = cut(rows.repartitionByRange("conv_id", "part", *order).withColumn("_pid", F.spark_partition_id()))
    key = ["conv_id", "part"]
    counts = rows.groupBy(*key, "_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select(
        F.col("conv_id").alias("_c"), F.col("part").alias("_p"), F.col("_pid").alias("_q"),
        (F.sum("_n").over(Window.partitionBy(*key).orderBy("_pid")) - F.col("_n")).alias("_before"),
    )
    rows = rows.withColumn("_at", F.row_number().over(Window.partitionBy("_pid", *key).orderBy(*order)))
    rows = rows.join(before, F.col("conv_id").eqNullSafe(F.col("_c")) & F.col("part").eqNullSafe(F.col("_p")) & (F.col("_pid") == F.col("_q")))
    return rows.withColumn("sub", F.floor((F.col("_before") + F.col("_at") - 1) / size).cast("int")).drop("_c", "_p", "_q", "_pid", "_at", "_before")


def perspectives(turns: DataFrame, part_turns: int = 64, narrators: tuple[str, ...] = ("system",), whole: bool = False) -> DataFrame:
    """``conv_id, speaker, part, sub, n_turns, text, masks``; masks are (start, stop) in code points. ``whole``: no ``sub``, one row a part."""
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("who"), text_of().cast("string").alias("text"),
    ).distinct()
    rows = rows.withColumn("part", F.floor(F.col("turn") / part_turns))
    speakers = rows.where(~F.col("who").isin(list(narrators))).select(F.col("conv_id").alias("_c"), F.col("who").alias("speaker")).distinct()
    full = cut(rows.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 8 * part_turns).select(F.col("conv_id").alias("_f"), F.col("part").alias("_p")))
    same = F.col("conv_id").eqNullSafe(F.col("_f")) & F.col("part").eqNullSafe(F.col("_p"))
    if full.isEmpty():
        out = _rendered(rows.withColumn("sub", F.lit(0)), speakers, narrators)
        return out.drop("sub") if whole else out
    few = _rendered(rows.join(full, same, "left_anti").withColumn("sub", F.lit(0)), speakers, narrators)
    many = _rendered(_numbered(rows.join(full, same, "left_semi"), 8 * part_turns), speakers, narrators)
    return few.drop("sub").unionByName(whole_parts(many)) if whole else few.unionByName(many)


def whole_parts(subs: DataFrame) -> DataFrame:
    """Sub-parts joined in order to ``conv_id, speaker, part, n_turns, text, masks``."""
    key = ["conv_id", "speaker", "part"]
    at = (F.sum(F.length("text")).over(Window.partitionBy(*key).orderBy("sub")) - F.length("text")).cast("int")
    moved = F.transform("masks", lambda m: F.struct((m["start"] + F.col("_at")).alias("start"), (m["stop"] + F.col("_at")).alias("stop")))
    out = subs.withColumn("_at", at).groupBy(*key).agg(F.sum("n_turns").alias("n_turns"), F.array_sort(F.collect_list(F.struct("sub", "text", moved.alias("masks")))).alias("_subs"))
    return out.select(*key, "n_turns", F.array_join("_subs.text", "").alias("text"), F.flatten("_subs.masks").alias("masks"))


def _rendered(rows: DataFrame, speakers: DataFrame, narrators: tuple[str, ...]) -> DataFrame:
    told = F.col("who").isin(list(narrators))
    rows = rows.join(speakers, F.col("conv_id").eqNullSafe(F.col("_c"))).drop("_c")
    mine = F.col("who") == F.col("speaker")
    head = F.when(mine, "assistant").when(told, F.col("who")).otherwise(F.concat(F.lit("user name="), F.translate(F.replace(F.col("who"), F.lit("<|"), F.lit("< |")), "\n\r", "  ")))
    head = F.concat(F.lit(START), head, F.lit("\n"))
    body = F.concat(F.replace(F.col("text"), F.lit("<|"), F.lit("< |")), F.lit(END))
    turn = F.struct("turn", "who", "text", head.alias("head"), body.alias("body"), mine.alias("mine"))
    out = rows.groupBy("conv_id", "speaker", "part", "sub").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    spans = F.expr(
        "aggregate(turns, named_struct('at', 0, 'spans', cast(array() as array<struct<start:int,stop:int>>)), (a, t) -> named_struct("
        "'at', a.at + length(t.head) + length(t.body), "
        "'spans', IF(t.mine, array_append(a.spans, named_struct('start', a.at + length(t.head), 'stop', a.at + length(t.head) + length(t.body) - 1)), a.spans)), a -> a.spans)"
    )
    text = F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"])), "")
    return out.select("conv_id", "speaker", "part", "sub", F.size("turns").cast("long").alias("n_turns"), text.alias("text"), spans.alias("masks"))
