"""Price clusters are read from sorted streams: the plain rule, and one shuffle of the points."""

import random

from tidemark.operators import fusion as FU


def plain(points, width):
    out = {}
    for key in {p[0] for p in points if p[0] is not None}:
        anchor, found = None, {}
        for price, source in sorted(((p, s) for k, p, s in points if k == key and p > 0), key=lambda x: x[0]):
            if anchor is None or (price != found[anchor][-1][0] and not (price - anchor) / anchor < width):
                anchor = price
            found.setdefault(anchor, []).append((price, source))
        out[key] = [(round(sum(p for p, _ in m) / len(m), 6), m[0][0], m[-1][0], len({s for _, s in m if s is not None}), len(m)) for m in found.values()]
    return out


def test_clusters_by_the_plain_rule(spark):
    r = random.Random(3)
    points = [(r.choice([1, 2, 3, None]), round(r.uniform(-5, 100), 1), r.choice(["a", "b", "c", None])) for _ in range(3000)]
    df = spark.createDataFrame(points, "entity int, price double, source string").repartition(5)
    was = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")  # keys go on over batches
    try:
        got, best = FU.cluster_levels(df).collect(), FU.key_levels(df, top_n=4).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", was)
    row = lambda x: (round(x.level, 6), x.low, x.high, x.strength, x.members)
    want = plain(points, 0.01)
    assert {k: sorted(row(x) for x in got if x.entity == k) for k in want} == {k: sorted(v) for k, v in want.items()} and len(got) == sum(map(len, want.values()))
    assert {k: sorted(row(x) for x in best if x.entity == k) for k in want} == {k: sorted(sorted(v, key=lambda x: (-x[3], -x[4], x[0]))[:4]) for k, v in want.items()}


def test_points_are_shuffled_once_and_in_no_table(spark):
    df = spark.createDataFrame([(1, 100.0, "a")], "entity int, price double, source string")
    plan = FU.key_levels(df)._jdf.queryExecution().sparkPlan().toString()
    assert "Aggregate" not in plan and "Join" not in plan and plan.count("Exchange") == 1
