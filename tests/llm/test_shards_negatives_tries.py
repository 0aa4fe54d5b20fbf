"""Sharding, hard negatives and the prefix trie on small fixtures against brute force."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import negatives, prefixes, sharding
from tidemark.llm.queries import op13


def sized(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, size long, text string, _arc int, Shard string")


def placed(df):
    return [r.asDict() for r in df.collect()]


def docs(n=400, hot=200):
    rng = random.Random(3)
    rows = [(i, int(rng.paretovariate(1.1) * 50), f"t{i}", 1, "x") for i in range(n)]
    return rows + [(None, 30, "same", 1, "x")] * hot + [(7, None, None, None, None), (7, -5, "", 0, ""), (None, 0, None, None, None)]


def test_ring_is_consistent():
    at, orders, ends = sharding.ring(16, 64)
    grown_at, grown, _ = sharding.ring(17, 64)
    assert all(sorted(o) == list(range(16)) for o in orders.tolist()) and (np.diff(ends) >= 0).all()
    first, then = orders[at, 0], grown[grown_at, 0]
    assert set(then[first != then]) == {16} and 0.02 < (first != then).mean() < 0.12
    for p in (0, int(ends[0]), int(ends[-1]) + 1, 40000):
        here = next((e for e in ends if e >= p), ends[0])
        assert ends[at[p % sharding.POSITIONS]] == here


@pytest.mark.parametrize("cells", [16384, 64])
def test_shards_hold_their_bound(spark, cells):
    rows = docs()
    got = placed(sharding.place(sized(spark, rows), "doc_id", "size", shards=8, slack=0.05, cells=cells))
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in got) == sorted((str(r[0]), str(r[2])) for r in rows)
    assert set(got[0]) == {"doc_id", "size", "text", "_arc", "shard", "slot"}
    load, total = [0] * 8, sum(max(r[1] or 0, 0) for r in rows)
    for s in range(8):
        mine = [r for r in got if r["shard"] == s]
        assert sorted(r["slot"] for r in mine) == list(range(len(mine)))
        load[s] = sum(max(r["size"] or 0, 0) for r in mine)
    largest = max(r[1] or 0 for r in rows)
    cell = largest if cells == 16384 else 2 * total / cells + largest
    assert max(load) <= max(1.05 * total / 8, min(load) + cell)
    if cells == 16384:  # a hot key is spread over shards, repeated rows included
        assert len({r["shard"] for r in got if r["doc_id"] is None}) > 1


def test_walk_against_single_rows(spark):
    """Rows that are cells of their own go where a plain walk puts them."""
    rng = random.Random(5)
    rows = [(i, 1 + rng.randrange(1000), f"t{i}", 1, "x") for i in range(300)]
    got = {r["doc_id"]: r["shard"] for r in placed(sharding.place(sized(spark, rows), "doc_id", "size", shards=5, slack=0.01))}
    positions = {r.doc_id: r.p for r in sized(spark, rows).select("doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(sharding.POSITIONS)).alias("p")).collect()}
    points = sorted((int.from_bytes(hashlib.blake2b(f"{s}:{v}".encode(), digest_size=8).digest(), "big") % sharding.POSITIONS, s) for s in range(5) for v in range(64))
    bound = 1.01 * sum(r[1] for r in rows) / 5
    load = [0] * 5
    for i, size, *_ in rows:
        load[got[i]] += size
    assert max(load) <= bound
    for i, size, *_ in rows:  # whoever went past its first shard found it short of room
        owner = next((s for p, s in points if p >= positions[i]), points[0][1])
        assert got[i] == owner or load[owner] + size > bound


def test_growth_moves_little_and_partitions_do_not_matter(spark):
    rows = [(i, 100 + i % 900, f"t{i}", 1, "x") for i in range(4000)] + [(None, 30, "same", 1, "x")] * 50
    df = sized(spark, rows)
    key = lambda out: sorted((str(r["doc_id"]), r["shard"], r["slot"]) for r in placed(out))
    one = sharding.place(df.repartition(7), "doc_id", "size", shards=16, slack=0.05)
    assert key(one) == key(sharding.place(df.repartition(2), "doc_id", "size", shards=16, slack=0.05))
    before = {r["doc_id"]: r["shard"] for r in placed(one)}
    after = {r["doc_id"]: r["shard"] for r in placed(sharding.place(df, "doc_id", "size", shards=17, slack=0.05))}
    assert np.mean([before[i] != after[i] for i in range(4000)]) < 0.25


def test_shards_of_nothing(spark):
    assert sharding.place(sized(spark, []), "doc_id", "size").count() == 0
    assert {(r["shard"], r["slot"]) for r in placed(sharding.place(sized(spark, [(1, 0, None, 1, "x")]), "doc_id", "size", shards=1))} == {(0, 0)}


def mined(rows, positives=5, each=3):
    """Brute force over (vec_id, label, vector)."""
    best = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        best[i] = min(best.get(i, (label, v)), (label, v))
    q = {i: (label, [math.floor(256 * x) for x in v]) for i, (label, v) in best.items()}
    out = set()
    for a in q:
        if a % 50:
            continue
        score = {i: sum(x * y for x, y in zip(q[a][1], q[i][1])) for i in q if i != a}
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if q[i][0] == q[a][0]][:positives]:
            inside = [i for i in order if q[i][0] != q[a][0] and 50 * score[p] <= 100 * score[i] <= 95 * score[p]]
            out |= {(a, p, n + 1, i, score[p], score[i]) for n, i in enumerate(inside[:each])}
    return out


def vectors(spark, rows):
    return spark.createDataFrame([(i, label, v, 0, 1, "w", b"k") for i, label, v in rows], "vec_id long, label int, embedding array<double>, block int, asks int, windows string, key binary")


def vector_rows():
    rng = np.random.default_rng(1)
    rows = [(i, int(rng.integers(3)), rng.normal(0, 0.3, 6).round(2).tolist()) for i in range(0, 400)]
    rows += [(1000 + i, 1, rows[100][2]) for i in range(40)] + [(2000 + i, 2, rows[100][2]) for i in range(40)]
    rows += [rows[50], rows[50], (100, 0, rows[3][2]), (50, 2, None), (None, 1, rows[1][2]), (450, None, rows[2][2])]
    rows += [(451, 1, [0.1, None]), (452, 1, [float("nan")]), (453, 1, [float("inf"), 0.0]), (500, 1, []), (501, 2, [0.5]), (550, 0, [0.0] * 6), (-50, 1, rows[4][2]), (600, 2, [3.0] * 9)]
    return rows


@pytest.mark.parametrize("block_rows", [65536, 7])
def test_negatives(spark, block_rows):
    got = negatives.mine(vectors(spark, vector_rows()), F.col("vec_id") % 50 == 0, block_rows=block_rows)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    got = [tuple(r) for r in got.collect()]
    assert len(got) == len(set(got)) and set(got) == mined(vector_rows()) and any(p == n == 0 for *_, p, n in got)


def test_negatives_with_large_scores(spark):
    """Scores past 53 bits are summed in integers."""
    rng = np.random.default_rng(2)
    rows = [(i, i // 10 % 2, (rng.integers(1, 2**20, 3) * 4.0 + rng.integers(0, 4, 3) / 256).tolist()) for i in range(0, 400, 10)]
    got = {tuple(r) for r in negatives.mine(vectors(spark, rows), F.col("vec_id") % 50 == 0).collect()}
    assert got == mined(rows) and max(s for *_, s, _ in got) > 2**53


def test_no_negatives(spark):
    assert negatives.mine(vectors(spark, []), F.col("vec_id") % 50 == 0).count() == 0
    assert negatives.mine(vectors(spark, [(1, 1, [0.5])]), F.col("vec_id") % 50 == 0).count() == 0
    assert negatives.mine(vectors(spark, [(50, 1, [0.5]), (1, 1, [0.5])]), F.col("vec_id") % 50 == 0).count() == 0


def test_packed_keys_sort_as_numbers():
    rng = np.random.default_rng(3)
    edge = np.array([-(2**63), -1, 0, 1, 2**63 - 1])
    a, s, i = (np.concatenate([edge, rng.integers(-9, 9, 200), rng.permutation(edge)]) for _ in range(3))
    keys = [k.tobytes() for k in negatives.pack(a, s, 0, i)]
    order = sorted(range(len(a)), key=lambda j: (a[j], -int(s[j]), i[j]))
    assert [keys[j] for j in order] == sorted(keys)
    import pyarrow as pa

    back = negatives.unpack(pa.array(keys))
    assert all((x == y).all() for x, y in zip(back, (a, s, np.zeros(len(a)), i)))


def nodes(rows, head, base):
    """Brute force over (conv_id, turn, role, text)."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    built = {c: tuple(own.get(base(c), [])[: head(c)] + own[c][head(c):]) for c in own}
    members = {}
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            members.setdefault(ts[:d], []).append(c)
    words = lambda p: len(p[-1][1].split()) if p else 0
    out = set()
    for p, cs in members.items():
        below = [q for q in members if q[: len(p)] == p]
        ends = ",".join(map(str, sorted(c for c in cs if len(built[c]) == len(p))))
        parent = min(members[p[:-1]]) if p else None
        leaves = sum(not any(len(r) == len(q) + 1 and r[: len(q)] == q for r in below) for q in below)
        out.add((min(cs), len(p), parent, len(cs), sum(len(q) == len(p) + 1 for q in below), leaves, sum((len(members[q]) - 1) * words(q) for q in below), hashlib.sha256(ends.encode()).hexdigest()))
    return out


def talks(deep=0):
    rng = random.Random(9)
    rows = []
    for c in list(range(-25, 90)) + [1000, 1003] + list(range(121, 140)):
        for t in range(rng.choice([1, 1, 2, 4, 7])):
            rows.append((c, rng.choice([t, t, t, None, 2]), rng.choice(["user", "bot", None]), rng.choice(["one two", "one", None, "", " \t", "three  four\nfive"])))
    rows += [r for c in (40, 41, 42) for r in [(c, 1, "user", "same words here"), (c, 1, "user", "same words here")]] + [(None, 1, "user", "x"), (None, None, None, None)]
    rows += [(c, t, "user", f"turn {t if t < deep - c % 3 else c}") for c in range(200, 205) for t in range(deep)]
    return rows


def trie_of(spark, rows, head, base, **kw):
    df = spark.createDataFrame([(*r, 0, "p", 1) for r in rows], "conv_id long, turn long, role string, text string, place int, path string, depth int")
    turns = prefixes.digested(prefixes.ordered_turns(df))
    return [tuple(r) for r in prefixes.trie(prefixes.branched(turns, head, base, longest=3), **kw).collect()]


@pytest.mark.parametrize("height,deep", [(4, 0), (2, 23), (64, 23)])
def test_trie(spark, height, deep):
    rows, conv = talks(deep), F.col("conv_id")
    got = trie_of(spark, rows, F.crc32(conv.cast("string")) % 4, conv - conv % 20, height=height)
    want = nodes(rows, lambda c: zlib.crc32(str(c).encode()) % 4, lambda c: c - int(math.fmod(c, 20)))
    assert len(got) == len(set(got)) and set(got) == want


def test_trie_of_long_and_bare_conversations(spark):
    """Longer than a segment of running sums; a conversation whose turns all went is a turnless member of the root."""
    rows = [(c, t, "user", str(t)) for c in (1, 2) for t in range(600)] + [(3, 0, "user", "gone"), (4, 0, "user", "0")]
    got = trie_of(spark, rows, F.when(F.col("conv_id") == 3, 3).otherwise(0), F.when(F.col("conv_id") == 3, 99).otherwise(F.col("conv_id")))
    by = {(r[0], r[1]): r for r in got}
    assert len(got) == 601 and by[1, 600][2:7] == (1, 2, 0, 1, 1) and by[1, 0][2:7] == (None, 4, 1, 1, 2 * 600 - 600 + 1 * 1)
    assert by[1, 0][7] == hashlib.sha256(b"3").hexdigest() and by[1, 1][7] == hashlib.sha256(b"4").hexdigest() and by[1, 600][7] == hashlib.sha256(b"1,2").hexdigest()


def test_trie_of_nothing(spark):
    assert trie_of(spark, [], F.lit(0), F.col("conv_id")) == []
    assert trie_of(spark, [(None, 1, "a", "b")], F.lit(0), F.col("conv_id")) == []


def test_digest_of_a_hot_node(spark):
    """Ids of one node in several stretches and ranges."""
    ends = spark.range(-3, 5000, numPartitions=5).select(F.lit(1).cast("long").alias("k1"), F.lit(2).cast("long").alias("k2"), F.lit(1).cast("long").alias("depth"), F.col("id").alias("conv_id"))
    got = prefixes._digests(ends, stretch=100).collect()
    assert [r.sha for r in got] == [hashlib.sha256(",".join(map(str, range(-3, 5000))).encode()).hexdigest()]


def test_trie_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = nodes(rows, lambda c: zlib.crc32(str(c).encode()) % 4, lambda c: c - c % 20)
    assert {tuple(r) for r in op13(spark, sf).collect()} == want
