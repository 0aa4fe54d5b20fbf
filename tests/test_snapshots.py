"""Snapshots of all sections against brute force; every event kind has a direction or is known to have none."""

import datetime
import random

from tidemark.functions import events
from tidemark.functions.signs import SIGNS
from tidemark.operators import detection as D
from tidemark.operators import snapshots as SN

DAY = datetime.date(2023, 1, 1)
LOOKBACK = {"daily": 30, "quarterly": 60}

# Kinds that report a state or a change without a direction of its own.
NEUTRAL = """
bandwidth_extreme_low squeeze_streak walking_upper_band walking_lower_band kumo_twist doji volatility_extreme_high volatility_extreme_low
""".split()


def days(n):
    return DAY + datetime.timedelta(days=n)


def test_sections_at_every_request(spark):
    rng = random.Random(2)
    facts = [(rng.choice([1, 2, 3, 90, 91]), days(d := rng.randrange(200)), rng.choice([None, None, days(d + rng.randrange(-3, 40))]), rng.choice("ab"), rng.choice(["daily", "quarterly", "weekly", None])) for _ in range(500)]
    facts += [(1, None, None, "a", "daily"), (None, days(3), None, "a", "daily")]
    latest = [(rng.choice([1, 2, 4]), rng.choice(["indicator", "structure"]), rng.choice("xy"), rng.choice(["daily", "weekly"]), days(i), rng.choice([None, rng.random()])) for i in range(180)]
    latest += [(1, "indicator", "x", "daily", days(50), 0.25), (1, "indicator", "x", "daily", days(50), 0.75), (2, "indicator", "x", "daily", None, 1.0)]
    asks = [(e, days(d)) for e in (1, 2, 4, 5, 90) for d in (-5, 20, 50, 51, 120, 199, 320)]
    f = spark.createDataFrame(facts, "entity long, fact_date date, report_date date, source string, timeframe string")
    la = spark.createDataFrame(latest, "entity long, section string, source string, timeframe string, date date, value double")
    rq = spark.createDataFrame(asks + asks[:3], "entity long, asof date")
    got = {}
    for r in SN.sections_at(rq, f, la, {90: "index", 91: "rates"}, LOOKBACK).collect():
        key = (r.entity, r.asof, r.section, r.source, r.timeframe)
        assert key not in got
        got[key] = (r.date, r.value)

    def facts_of(entity, asof):
        out = {}
        for e, day, report, source, timeframe in facts:
            if e == entity and day and timeframe in LOOKBACK and max(day, report or day) <= asof and (asof - day).days <= LOOKBACK[timeframe]:
                was = out.get((source, timeframe), (day, 0.0))
                out[source, timeframe] = (max(was[0], day), was[1] + 1)
        return out

    want = {}
    for e, asof in asks:
        want |= {(e, asof, "facts", *k): v for k, v in facts_of(e, asof).items()}
        for m, name in ((90, "index"), (91, "rates")):
            want |= {(e, asof, f"market:{name}", *k): v for k, v in facts_of(m, asof).items()}
        newest = {}
        for e2, section, source, timeframe, day, v in latest:
            if e2 == e and day and day <= asof:
                k = (section, source, timeframe)
                newest[k] = max(newest.get(k, (day, None)), (day, v), key=lambda x: (x[0], x[1] is not None, x[1] or 0.0))
        want |= {(e, asof, *k): v for k, v in newest.items()}
    assert got == want and len(want) > 150
    assert SN.sections_at(rq.limit(0), f, la, {90: "index"}, LOOKBACK).count() == 0
    assert {r.section for r in SN.sections_at(rq, f, la.limit(0), None, LOOKBACK).collect()} == {"facts"}


def test_directions_of_the_catalogue():
    assert {SIGNS[k] for k in ("strong_trend_start", "concentration_rising", "vwap_bullish_cross", "net_buy_streak", "momentum_down")} == {1}
    assert {SIGNS[k] for k in ("concentration_decreasing", "vwap_bearish_cross", "net_sell_streak", "momentum_up", "per_negative")} == {-1}
    assert not set(NEUTRAL) & set(SIGNS)
    lists = [v for v in vars(D).values() if isinstance(v, list) and v and all(isinstance(r, events.Rule) for r in v)]
    kinds = {r.kind for rules in lists for r in rules}
    assert len(kinds) > 60 and all(SIGNS.get(k, 0) in (-1, 0, 1) for k in kinds)
    # a pair of crossings never points the same way
    for k in kinds:
        if "bullish" in k and (other := k.replace("bullish", "bearish")) in kinds:
            assert SIGNS.get(k, 0) == -SIGNS.get(other, 0) != 0, k
