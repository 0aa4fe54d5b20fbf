"""Thin queries over the test tables; operators keep their own interfaces."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.llm import chat, html, language, mixing, negatives, neighbours, packing, prefixes, quality, sharding, simhash, suffixes, toxicity
from tidemark.llm.registry import query
from tidemark.llm.shared import table

#: Words as DuckDB sees them.
W = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP2_SQL = rf"""
WITH w AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS t, {W} AS ws FROM documents),
x AS (SELECT r, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS x FROM w),
runs AS (SELECT * FROM (SELECT r, i, x || ' ' || lead(x, 1) OVER o || ' ' || lead(x, 2) OVER o || ' ' || lead(x, 3) OVER o || ' ' || lead(x, 4) OVER o || ' ' || lead(x, 5) OVER o || ' ' || lead(x, 6) OVER o || ' ' || lead(x, 7) OVER o AS g
  FROM x WINDOW o AS (PARTITION BY r ORDER BY i)) WHERE g IS NOT NULL),
hits AS (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM runs),
cover AS (SELECT r, sum(least(8, i - prev)) AS n FROM (SELECT r, i, lag(i, 1, -8) OVER (PARTITION BY r ORDER BY i) AS prev FROM hits WHERE c > 1) GROUP BY r),
lines AS (SELECT r, unnest(string_split(t, chr(10))) AS line FROM w),
ll AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
f AS (SELECT w.r, doc_id, lang, source, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(length(array_to_string(ws, '')), 0) AS BIGINT) AS word_chars,
  CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(length(t) - length(replace(t, '!', '')) AS BIGINT) AS n_marks,
  CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(cover.n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN ll USING (r) LEFT JOIN cover USING (r)),
v AS (SELECT r, lang, source, 'symbols' AS metric, coalesce(1000 * n_symbols // nullif(n_words, 0), 0) AS v, 100 AS spread FROM f
  UNION ALL SELECT r, lang, source, 'marks', coalesce(1000 * n_marks // nullif(n_words, 0), 0), 100 FROM f
  UNION ALL SELECT r, lang, source, 'dup_lines', coalesce(1000 * n_dup_lines // nullif(n_lines, 0), 0), 200 FROM f
  UNION ALL SELECT r, lang, source, 'repeats', coalesce(1000 * n_repeat_words // nullif(n_words, 0), 0), 100 FROM f
  UNION ALL SELECT r, lang, source, 'word_length', coalesce(100 * word_chars // nullif(n_words, 0), 0), 100 FROM f),
e AS (SELECT *, CASE WHEN v < 32 THEN v ELSE (v >> (length(bin(v)) - 5)) << (length(bin(v)) - 5) END AS edge FROM v),
q AS (SELECT lang, source, metric, any_value(spread) AS spread, count(*) AS docs, quantile_disc(edge, 0.25) AS q25, quantile_disc(edge, 0.75) AS q75 FROM e GROUP BY ALL),
ql AS (SELECT lang, metric, count(*) AS docs, quantile_disc(edge, 0.25) AS q25, quantile_disc(edge, 0.75) AS q75 FROM e GROUP BY ALL),
qo AS (SELECT metric, quantile_disc(edge, 0.25) AS q25, quantile_disc(edge, 0.75) AS q75 FROM e GROUP BY ALL),
p AS (SELECT q.lang, q.source, q.metric, q.spread, CASE WHEN q.docs >= 100 THEN q.q25 WHEN ql.docs >= 100 THEN ql.q25 ELSE qo.q25 END AS q25, CASE WHEN q.docs >= 100 THEN q.q75 WHEN ql.docs >= 100 THEN ql.q75 ELSE qo.q75 END AS q75
  FROM q JOIN ql ON q.lang IS NOT DISTINCT FROM ql.lang AND q.metric = ql.metric JOIN qo ON q.metric = qo.metric),
bad AS (SELECT DISTINCT e.r FROM e JOIN p ON e.lang IS NOT DISTINCT FROM p.lang AND e.source IS NOT DISTINCT FROM p.source AND e.metric = p.metric WHERE e.v > p.q75 + 3 * greatest(p.q75 - p.q25, p.spread))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND bad.r IS NULL AS kept
FROM (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM f) f LEFT JOIN bad USING (r)
"""


@query("op2_quality_rules", OP2_SQL)
def op2(spark, d):
    rows = quality.quality(table(spark, d, "documents"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


OP4_SQL = rf"""
WITH s AS (SELECT doc_id, source, CAST(len({W}) AS BIGINT) AS size, CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS k FROM documents),
g AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM s GROUP BY source),
w AS (SELECT *, ([5.0, 2.0, 1.0])[CAST((row_number() OVER (ORDER BY source IS NULL, source COLLATE C) - 1) % 3 AS INT) + 1]::DOUBLE AS weight FROM g),
l AS (SELECT *, (1.5 * (SELECT sum(source_size) FROM w)::DOUBLE - coalesce(sum(2.0::DOUBLE * source_size) OVER (ORDER BY 2.0::DOUBLE * source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / sum(weight) OVER (ORDER BY 2.0::DOUBLE * source_size / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
t AS (SELECT source, source_size, least(2.0::DOUBLE * source_size, (SELECT max(level) FROM l) * weight) AS target FROM l),
r AS (SELECT s.*, source_size, target, sum(size) OVER (PARTITION BY s.source ORDER BY k, size ROWS UNBOUNDED PRECEDING) - size / 2.0 AS mid
  FROM s JOIN t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, CAST(size * ((target >= source_size OR mid <= target)::INT + (target > source_size AND (target >= 2 * source_size OR mid <= target - source_size))::INT) AS BIGINT) AS taken FROM r
"""


@query("op4_mixing", OP4_SQL)
def op4(spark, d):
    rows = mixing.draws(table(spark, d, "documents"))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.size("draws")).cast("long").alias("taken"))


@query("op10_packing")
def op10(spark, d):
    return packing.pack(packing.tokenize(table(spark, d, "documents"), word_vocabulary()))


def word_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op5_simhash")
def op5(spark, d):
    rows = simhash.near_duplicates(table(spark, d, "documents"))
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op3_neighbours")
def op3(spark, d):
    rows = table(spark, d, "embeddings")
    return neighbours.nearest(rows, rows.where("vec_id % 100 = 0"))


def fold_of(n: int):
    return F.crc32(F.col("doc_id").cast("string")) % n


@query("op9_language_id")
def op9(spark, d):
    docs = table(spark, d, "documents")
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.coalesce(fold_of(5), F.lit(1)) != 0)).select("lang", "text")
    rows = language.identify(docs, language.fit(language.training_rows(labelled)))
    return rows.select("doc_id", F.coalesce(fold_of(5) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")


@query("op7_html_text")
def op7(spark, d):
    return html.extract(table(spark, d, "pages"))


@query("op8_toxicity")
def op8(spark, d):
    rows = toxicity.score(table(spark, d, "documents"), table(spark, d, "labels"), usable=fold_of(4) != 2)
    return rows.select("doc_id", F.coalesce(fold_of(4) == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query("op1_suffix_dedup")
def op1(spark, d):
    rows = suffixes.strip_repeats(table(spark, d, "documents"))
    return rows.select("doc_id", F.col("_n_bytes").alias("n_bytes"), F.col("_n_removed").alias("n_removed"), F.col("_n_spans").alias("n_spans"), F.col("_sha").alias("kept_sha256"))


OP6_SQL = r"""
WITH r AS (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS who, coalesce(text, '') AS text FROM conversations),
p AS (SELECT DISTINCT conv_id, who AS speaker FROM r WHERE who <> 'system'),
s AS (SELECT r.conv_id, speaker, CAST(floor(turn / 64) AS BIGINT) AS part, turn, who, text, who = speaker AS mine,
  '<|im_start|>' || CASE WHEN who = speaker THEN 'assistant' WHEN who = 'system' THEN who ELSE 'user name=' || translate(replace(who, '<|', '< |'), chr(10) || chr(13), '  ') END || chr(10) AS head, replace(text, '<|', '< |') || '<|im_end|>' || chr(10) AS body
  FROM r JOIN p ON r.conv_id IS NOT DISTINCT FROM p.conv_id),
o AS (SELECT *, sum(length(head) + length(body)) OVER (PARTITION BY conv_id, speaker, part ORDER BY turn, who, text ROWS UNBOUNDED PRECEDING) - length(body) AS pos FROM s)
SELECT conv_id, speaker, part, count(*) AS n_turns, string_agg(head || body, '' ORDER BY turn, who, text) AS text,
  string_agg(CAST(pos AS VARCHAR) || '-' || CAST(pos + length(body) - 1 AS VARCHAR), ' ' ORDER BY turn, who, text) FILTER (WHERE mine) AS masks
FROM o GROUP BY conv_id, speaker, part
"""


@query("op6_perspectives", OP6_SQL)
def op6(spark, d):
    rows = chat.perspectives(table(spark, d, "conversations"), whole=True)
    masks = F.array_join(F.transform("masks", lambda m: F.concat(m["start"].cast("string"), F.lit("-"), m["stop"].cast("string"))), " ")
    return rows.select("conv_id", "speaker", "part", "n_turns", "text", F.when(F.size("masks") > 0, masks).alias("masks"))


@query("op11_sharding")
def op11(spark, d):
    text = F.coalesce("text", F.lit(""))
    rows = table(spark, d, "documents").select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    rows = sharding.place(rows, key="doc_id", size="size", shards=16)
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


OP12_SQL = r"""
WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id AS id, a.label = c.label AS same, CAST(list_dot_product(a.q, c.q) AS BIGINT) AS score FROM r a JOIN r c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS k FROM s WHERE same) WHERE k <= 5),
n AS (SELECT p.anchor_id, p.id AS positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank, s.id AS negative_id, p.score AS positive_score, s.score AS negative_score
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT * FROM n WHERE rank <= 3
"""


@query("op12_hard_negatives", OP12_SQL)
def op12(spark, d):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, d, "embeddings"), anchors=F.col("vec_id") % 50 == 0, label=label)


OP13_SQL = r"""
WITH t AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i FROM conversations WHERE conv_id IS NOT NULL),
h AS (SELECT c, c - c % 20 AS b, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda a, y: list_reduce(list_prepend(xor(a, y), list_transform(range(8), lambda z: CAST(z AS BIGINT))), lambda u, z: xor(u >> 1, (u & 1) * 3988292384))), 4294967295) % 4 AS h FROM (SELECT DISTINCT c FROM t)),
w AS (SELECT h.c, 0 AS own, i, role, text FROM h JOIN t ON t.c = b AND i <= h UNION ALL SELECT h.c, 1, i, role, text FROM h JOIN t ON t.c = h.c AND i > h),
s AS (SELECT c, role, text, row_number() OVER (PARTITION BY c ORDER BY own, i) AS d FROM w),
m AS (SELECT c, d, text, md5(string_agg(md5(role) || md5(text), '') OVER (PARTITION BY c ORDER BY d ROWS UNBOUNDED PRECEDING)) AS k FROM s UNION ALL SELECT c, 0, '', '' FROM h),
e AS (SELECT *, lag(k) OVER (PARTITION BY c ORDER BY d) AS pk, d = max(d) OVER (PARTITION BY c) AS last FROM m),
n AS (SELECT d, k, any_value(pk) AS pk, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(len(regexp_extract_all(text, '[^ 	-
]+'))) AS saved,
  sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE last), '')) AS ends_sha256 FROM e GROUP BY d, k),
ch AS (SELECT pk, d - 1 AS d, count(*) AS n_children FROM n WHERE d > 0 GROUP BY pk, d),
f AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN ch ON n.k = ch.pk AND n.d = ch.d),
u AS (SELECT e.d, e.k, sum((f.n_children = 0)::BIGINT) AS n_leaves, sum(f.saved) AS saved_tokens FROM f JOIN e ON e.c = f.conv_id AND e.d <= f.d GROUP BY e.d, e.k)
SELECT f.conv_id, CAST(f.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children, CAST(u.n_leaves AS BIGINT) AS n_leaves, CAST(u.saved_tokens AS BIGINT) AS saved_tokens, f.ends_sha256
FROM f JOIN u ON f.d = u.d AND f.k = u.k LEFT JOIN f p ON f.pk = p.k AND p.d = f.d - 1
"""


@query("op13_prefix_trie", OP13_SQL)
def op13(spark, d):
    conv = F.col("conv_id")
    turns = prefixes.digested(prefixes.ordered_turns(table(spark, d, "conversations")))
    head = F.crc32(conv.cast("string")) % 4
    return prefixes.trie(prefixes.branched(turns, head, conv - conv % 20, longest=3))
