"""The pipeline's stages against brute force on a small table, and the registered queries against their SQL."""

import glob
import os

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from tidemark.llm import chat, mixing, simhash, suffixes, toxicity
from tidemark.llm.queries import fold_of
from tidemark.llm.registry import ORACLES, QUERIES


def text_rows(df):
    return sorted((r.doc_id, r.text or "") for r in df.collect())


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    steps = dict(corpus_pipeline.STAGES)
    scores = {r.doc_id: r.score for r in toxicity.score(docs, labels, usable=fold_of(4) != 2).collect()}
    clean = steps["toxicity"](spark, docs, sf).cache()
    assert clean.columns == corpus_pipeline.COLUMNS
    assert {r.doc_id for r in clean.select("doc_id").collect()} == {i for i, s in scores.items() if s < 0.3}
    fps = {r.doc_id: np.uint64(r.fp & (1 << 64) - 1) for r in simhash.fingerprints(clean, 3, 42).collect()}
    label = {i: i for i in fps}
    for a in sorted(fps):
        for b in sorted(fps):
            if label[a] != label[b] and np.bitwise_count(fps[a] ^ fps[b]) <= 3:
                low, high = sorted((label[a], label[b]))
                label = {i: low if x == high else x for i, x in label.items()}
    single = steps["near_duplicates"](spark, clean, sf).cache()
    assert {r.doc_id for r in single.select("doc_id").collect()} == set(label.values()) and single.columns == docs.columns
    texts = text_rows(single)
    seen, want = set(), {}
    for i, t in texts:
        b = t.encode()
        gone = np.zeros(len(b), bool)
        for j in range(len(b) - 199):
            w = b[j : j + 200]
            if w in seen:
                gone[j : j + 200] = True
            seen.add(w)
        want[i] = np.frombuffer(b, np.uint8)[~gone].tobytes().decode("utf-8", "ignore")
    stripped = steps["repeated_passages"](spark, single, sf).cache()
    assert dict(text_rows(stripped)) == want and stripped.columns == docs.columns
    mixed = steps["mixing"](spark, stripped, sf).cache()
    times = {r.doc_id: len(r.draws) for r in mixing.draws(stripped).collect()}
    got = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert got == {i: n for i, n in times.items() if n} and mixed.columns == docs.columns
    packed = steps["packing"](spark, mixed, sf).collect()
    assert {r.doc_id for r in packed} == set(got) and max(r.offset + r.length for r in packed) <= 4096
    assert len(corpus_pipeline.run(spark, sf).collect()) == len(packed)
    assert suffixes.LENGTH == 200


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, sf, name):
    con = duckdb.connect()
    for f in glob.glob(f"{sf}/*.parquet"):
        con.sql(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    got = QUERIES[name](spark, sf)
    want = con.sql(ORACLES[name])
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    a = sorted(str(tuple(r[c] for c in cols)) for r in got.collect())
    b = sorted(str(r) for r in want.select(*[f'"{c}"' for c in cols]).fetchall())
    assert a == b


def test_perspectives_sql_over_full_parts(spark, tmp_path):
    # a hot turn number, null turns and null ids, each beyond the rows of one sub-part
    rows = [(1, 5 if i % 3 else 6, "ann" if i % 2 else "bob", f"t{i} é") for i in range(1300)]
    rows += [(2, None, "ann" if i % 7 else "system", f"n{i}") for i in range(600)] + [(None, i % 2, "bob", f"z{i}") for i in range(700)] + [(3, 0, "ann", "few"), (1, 70, "ann", "next part")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5).write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.sql(f"create view conversations as select * from '{tmp_path}/conversations.parquet/*.parquet'")
    names = ["conv_id", "speaker", "part", "n_turns", "text", "masks"]
    want = con.sql(ORACLES["op6_perspectives"]).select(*names).fetchall()
    got = [tuple(r[c] for c in names) for r in QUERIES["op6_perspectives"](spark, str(tmp_path)).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want)) and max(r[3] for r in got) > 1024
    subs = sorted((r for r in chat.perspectives(spark.read.parquet(f"{tmp_path}/conversations.parquet")).collect() if r.conv_id == 1 and r.speaker == "ann" and r.part == 0), key=lambda r: r["sub"])
    assert [r.n_turns for r in subs] == [512, 512, 276]
    assert "".join(r.text for r in subs) == next(r[4] for r in got if r[:3] == (1, "ann", 0))
