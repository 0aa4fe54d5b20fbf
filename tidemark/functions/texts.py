"""SQL text for window expressions, used by the event rules (``tidemark.functions.events``).

Rules are configuration: a boolean SQL expression over the columns of a keyed series.  These
helpers spell the window part of such expressions.
"""

from __future__ import annotations

OVER = "PARTITION BY entity ORDER BY date"


def prev(e: str, n: int = 1) -> str:
    return f"lag({e}, {n}) OVER ({OVER})"


def nxt(e: str, n: int = 1) -> str:
    return f"lead({e}, {n}) OVER ({OVER})"


def roll(fn: str, e: str, n: int) -> str:
    """Aggregate over the last ``n`` rows including the current one."""
    return f"{fn}({e}) OVER ({OVER} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def past(fn: str, e: str, n: int, gap: int = 1) -> str:
    """Aggregate over the ``n`` rows that end ``gap`` rows ago."""
    return f"{fn}({e}) OVER ({OVER} ROWS BETWEEN {n + gap - 1} PRECEDING AND {gap} PRECEDING)"


def ahead(fn: str, e: str, n: int) -> str:
    return f"{fn}({e}) OVER ({OVER} ROWS BETWEEN 1 FOLLOWING AND {n} FOLLOWING)"


def cum(fn: str, e: str) -> str:
    return f"{fn}({e}) OVER ({OVER} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def ever_before(fn: str, e: str) -> str:
    return f"{fn}({e}) OVER ({OVER} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"


def run(p: str) -> str:
    """Length of the run of true ``p`` ending here."""
    last_false = cum("max", f"CASE WHEN coalesce({p}, false) THEN NULL ELSE idx END")
    return f"(idx - coalesce({last_false}, -1))"


def rises(p: str) -> str:
    """``p`` is true now and was not on the previous row (a missing previous row counts as false)."""
    return f"(coalesce({p}, false) AND NOT coalesce({prev(p)}, false))"


def falls(p: str) -> str:
    return f"(NOT coalesce({p}, false) AND coalesce({prev(p)}, false))"


def flips_up(p: str) -> str:
    """Like ``rises`` but needs a previous row."""
    return f"(({p}) AND NOT ({prev(p)}))"


def flips_down(p: str) -> str:
    return f"(NOT ({p}) AND ({prev(p)}))"


def closes_run(p: str, n: int) -> tuple[str, str]:
    """(condition, length): last row of a run of at least ``n`` true rows."""
    r = run(p)
    return f"(coalesce({p}, false) AND {r} >= {n} AND NOT coalesce({nxt(p)}, false))", r
