"""Event primitives: rules over keyed series, refractory spacing, pivots and divergences."""

from __future__ import annotations

import re
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import texts as X
from tidemark.functions.signs import SIGNS
from tidemark.functions.windows import wide_extremes


@dataclass(frozen=True)
class Rule:
    """One event kind: fires on rows where ``when`` holds and reports ``value``.

    ``spacing`` keeps an event only when at least that many bars passed since the last *kept*
    event of the same ``group`` (the kind itself unless named).
    """

    kind: str
    when: str
    value: str
    spacing: int = 0
    group: str | None = None

    @property
    def sign(self) -> int:
        return SIGNS.get(self.kind, 0)


#: A window as ``functions/texts.py`` spells it, over an argument without parentheses, and an extreme of a hundred rows or more.
_WINDOW = re.compile(rf"\b\w+\([^()]*\) OVER \({X.OVER}[^()]*\)")
_EXTREME = re.compile(rf"(max|min)\((\w+)\) OVER \({X.OVER} ROWS BETWEEN (\d+) PRECEDING AND (?:(\d+) PRECEDING|CURRENT ROW)\)")
_LONG = 100


def windows_once(series: DataFrame, exprs: list[str]) -> tuple[DataFrame, list[str]]:
    """The windows of the expressions as columns ``_w<i>``, and the expressions over those.

    Spark evaluates a window as often as it is written, so one that several expressions name is a column here.
    """
    names = {w: f"_w{i}" for i, w in enumerate(dict.fromkeys(w for e in exprs for w in _WINDOW.findall(e)))}
    long = {}
    for w, name in names.items():
        if m := _EXTREME.fullmatch(w):
            first, last = int(m[3]), int(m[4] or 0)
            if first - last + 1 >= _LONG:
                long[name] = (m[1], m[2], first - last + 1, last)
    series = wide_extremes(series, long, **{name: F.expr(w) for w, name in names.items() if name not in long})
    return series, [_WINDOW.sub(lambda m: names[m.group()], e) for e in exprs]


def rules_once(series: DataFrame, rules: list[Rule]) -> tuple[DataFrame, list[Rule]]:
    """The conditions of the rules as columns ``_r<i>``, as a hit and its value both ask for them, and the rules over those."""
    series, exprs = windows_once(series, [e for r in rules for e in (r.when, r.value)])
    series = series.withColumns({f"_r{i}": F.expr(f"coalesce({e}, false)") for i, e in enumerate(exprs[::2])})
    return series, [replace(r, when=f"_r{i}", value=e) for i, (r, e) in enumerate(zip(rules, exprs[1::2]))]


def candidates(series: DataFrame, rules: list[Rule]) -> DataFrame:
    """Evaluate all rules in one pass over the sorted series; one output row per hit.

    ``grp`` is the group that spaces a hit, empty where none does.
    """
    spaced = {r.group or r.kind for r in rules if r.spacing}
    series, rules = rules_once(series, rules)
    hits = F.array(*[
        F.struct(
            F.lit(r.kind).alias("event_kind"),
            F.lit((r.group or r.kind) if (r.group or r.kind) in spaced else "").alias("grp"),
            F.lit(r.spacing).alias("spacing"),
            F.col(r.when).alias("hit"),
            F.expr(f"CASE WHEN {r.when} THEN cast({r.value} as double) END").alias("value"),
        )
        for r in rules
    ])
    return (
        series.select("entity", "date", "idx", hits.alias("hits"))
        .select("entity", "date", "idx", F.inline(F.filter("hits", lambda h: h["hit"])))
        .drop("hit")
    )


def keep_spaced(cands: DataFrame) -> DataFrame:
    """Greedy minimum spacing per (entity, group): an ``aggregate`` over the sparse hit positions.

    Groups whose rules ask for no spacing keep all their hits. The array holds at most one entry per
    bar and kind of the entity, never raw rows.
    """
    hits = F.collect_list(F.struct("idx", "event_kind", "date", "value", "spacing"))
    kept = F.expr("""
        if(spaced = 0, hits, aggregate(array_sort(hits),
          named_struct('last', cast(null as int), 'kept',
            cast(array() as array<struct<idx:int,event_kind:string,date:date,value:double,spacing:int>>)),
          (acc, x) -> if(acc.last is null or x.idx - acc.last >= x.spacing,
                         named_struct('last', x.idx, 'kept', array_append(acc.kept, x)), acc),
          acc -> acc.kept))
    """)
    return (
        cands.groupBy("entity", "grp").agg(hits.alias("hits"), F.max("spacing").alias("spaced"))
        .select("entity", F.inline(kept))
        .select("entity", "date", "idx", "event_kind", "value")
    )


def detect(series: DataFrame, rules: list[Rule]) -> DataFrame:
    """Events (entity, date, event_kind, value) for a series that carries ``idx``, in one pass over it."""
    cols = ["entity", "date", "event_kind", "value"]
    found = candidates(series, rules)
    return (keep_spaced(found) if any(r.spacing for r in rules) else found).select(*cols)


def is_pivot_high(e: str, n: int = 3) -> str:
    return f"({X.past('count', e, n)} = {n} AND {X.ahead('count', e, n)} = {n} AND {e} > {X.past('max', e, n)} AND {e} > {X.ahead('max', e, n)})"


def is_pivot_low(e: str, n: int = 3) -> str:
    return f"({X.past('count', e, n)} = {n} AND {X.ahead('count', e, n)} = {n} AND {e} < {X.past('min', e, n)} AND {e} < {X.ahead('min', e, n)})"


def pivots(series: DataFrame, high: str = "high", low: str = "low", n: int = 3) -> DataFrame:
    """Swing points: strictly beyond ``n`` bars on both sides, dated when they become known."""
    marked = series.select(
        "entity", "date", "idx",
        F.expr(f"lead(date, {n}) OVER ({X.OVER})").alias("confirm_date"),
        F.when(F.expr(is_pivot_high(high, n)), F.col(high)).alias("hi"),
        F.when(F.expr(is_pivot_low(low, n)), F.col(low)).alias("lo"),
    )
    return (
        marked.select("entity", "date", "idx", "confirm_date",
                      F.expr("stack(2, 'high', hi, 'low', lo) as (side, price)"))
        .filter(F.col("price").isNotNull())
    )


def with_divergences(series: DataFrame, price: str, indicator: str, n: int = 3, min_gap: int = 12,
                     skip_zero: bool = True, report: str | None = None) -> tuple[DataFrame, list[Rule]]:
    """Columns and rules for price/indicator divergences between neighbouring pivots.

    Bearish: price makes a higher high, the indicator does not; bullish the reverse.  Events fall on
    the row that confirms the pivot (``n`` bars later).  Pivots where the indicator is still in
    warm-up (zero) are skipped; with ``skip_zero=False`` they only void the pair they start.  All of
    it is window columns on the same sorted series, so other rules share the pass.
    """
    live = f"abs({indicator}) >= 1e-12" if skip_zero else "true"
    point = f"named_struct('i', idx, 'p', {price}, 'v', {indicator})"
    df = series.withColumns({
        "_ph": F.expr(f"coalesce({is_pivot_high(price, n)} AND {live}, false)"),
        "_pl": F.expr(f"coalesce({is_pivot_low(price, n)} AND {live}, false)"),
    })
    before = f"OVER ({X.OVER} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    df = df.withColumns({f"_l{s}": F.expr(f"last_value(CASE WHEN {s} THEN {point} END) IGNORE NULLS {before}") for s in ("_ph", "_pl")})
    alive = "true" if skip_zero else "{0}.v > 0"
    df = df.withColumns({
        "_bear": F.expr(f"_ph AND idx - _l_ph.i >= {min_gap} AND {price} > _l_ph.p AND {indicator} < _l_ph.v AND {alive.format('_l_ph')}"),
        "_bull": F.expr(f"_pl AND idx - _l_pl.i >= {min_gap} AND {price} < _l_pl.p AND {indicator} > _l_pl.v AND {alive.format('_l_pl')}"),
    })
    value = report or X.prev(indicator, n)
    return df, [Rule("bearish_divergence", X.prev("_bear", n), value), Rule("bullish_divergence", X.prev("_bull", n), value)]


def rearmed_touches(series: DataFrame, kind: str, touch: str, reset: str, value: str) -> DataFrame:
    """First touches: fires on ``touch`` and stays silent until a ``reset`` row re-arms it.

    A touch row that does not fire re-arms as well when ``reset`` holds on it.  Only touch rows are
    collected (at most one per bar); resets in between are carried as a running count.
    """
    resets = X.cum("sum", f"CASE WHEN NOT ({touch}) AND ({reset}) THEN 1 ELSE 0 END")
    rows = series.select(
        "entity", "date", F.expr(touch).alias("t"), F.expr(f"coalesce({reset}, false)").alias("r"),
        F.expr(resets).alias("n"), F.expr(f"cast({value} as double)").alias("value")).filter("t")
    fired = F.expr("""
        aggregate(array_sort(collect_list(struct(date, r, n, value))),
          named_struct('on', false, 'n', cast(0 as bigint), 'kept', cast(array() as array<struct<date:date,value:double>>)),
          (a, x) -> CASE
            WHEN NOT a.on OR x.n > a.n THEN named_struct('on', true, 'n', x.n, 'kept', array_append(a.kept, named_struct('date', x.date, 'value', x.value)))
            ELSE named_struct('on', NOT x.r, 'n', x.n, 'kept', a.kept) END,
          a -> a.kept)""")
    return rows.groupBy("entity").agg(fired.alias("k")).select("entity", F.inline("k")).select(
        "entity", "date", F.lit(kind).alias("event_kind"), "value")
