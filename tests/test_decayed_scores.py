"""Decayed scores don't depend on the order in which facts are added."""

import datetime

from tidemark.operators import fusion as FU


def test_facts_that_cancel_leave_nothing(spark):
    """Three rising facts against three falling ones of the same day, added one by one, at ages of up to 60 days."""
    asof = datetime.date(2024, 1, 7)
    rows = [(age, asof - datetime.timedelta(age), "click", net) for age in range(61) for net in (3, -1, -1, -1)]
    signs = spark.createDataFrame(rows, "entity long, date date, source string, net long").selectExpr("*", "0L bull", "0L bear", "1L n")
    asks = spark.createDataFrame([(age, asof) for age in range(61)], "entity long, asof date")
    got = FU.decayed_scores(asks, signs, 20.0, 90).collect()
    assert len(got) == 61 and {r["score"] for r in got} == {0.0}
