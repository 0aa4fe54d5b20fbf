"""Support and resistance levels and trendlines as of any day.

Both answer requests (entity, asof) through ``serving.serve``: a series is read once for all its request days, and each
answer uses only what was known on its day.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.indicators import true_range
from tidemark.operators.recursive import atr_values
from tidemark.operators.serving import serve

LEVEL = "kind string, level double, touches int, first_seen date, last_seen date, recency int, span int, avg_volume double"
EVENT = "date date, event_kind string, value double"
LINE = "kind string, start_date date, anchor_date date, start_price double, slope double, anchors int, touches int, last_touch date, price_now double, broken_at date"


def swings(v: np.ndarray, n: int) -> np.ndarray:
    """Places whose value is strictly above the ``n`` values on either side."""
    if len(v) < 2 * n + 1:
        return np.zeros(0, int)
    around = np.lib.stride_tricks.sliding_window_view(v, 2 * n + 1)
    rest = np.delete(around, n, axis=1)
    return np.flatnonzero((around[:, n, None] > rest).all(axis=1)) + n


class SlidingLevels:
    """Swing points of one side in order of price, entering when confirmed and leaving with their window.

    Ascending prices reach only the newest cluster, so clusters are runs of the ordered points; they are found anew
    only when a point came or went.
    """

    def __init__(self, prices: np.ndarray, at: np.ndarray, n: int, lookback: int, touches: int, tolerance: float, min_distance: float):
        self.prices, self.at, self.n, self.lookback = prices, at, n, lookback
        self.touches, self.tolerance, self.min_distance = touches, tolerance, min_distance
        self.points: list[tuple[float, int]] = []
        self.came = self.went = 0
        self.levels: list[tuple[float, list[int]]] | None = []

    def known(self, rows: int) -> list[tuple[float, list[int]]]:
        """Levels (price, touched rows) when ``rows`` rows are known; best touched first. ``rows`` never falls."""
        start = max(0, rows - self.lookback)
        while self.came < len(self.at) and self.at[self.came] + self.n < rows:
            i = int(self.at[self.came])
            insort(self.points, (float(self.prices[i]), i))
            self.came, self.levels = self.came + 1, None
        while self.went < self.came and self.at[self.went] - self.n < start:
            i = int(self.at[self.went])
            del self.points[bisect_left(self.points, (float(self.prices[i]), i))]
            self.went, self.levels = self.went + 1, None
        if self.levels is None:
            self.levels = self._apart(self._runs())
        return self.levels

    def _runs(self) -> list[tuple[float, list[int]]]:
        runs: list[tuple[float, list[int]]] = []
        for price, i in self.points:
            if runs and abs(price - runs[-1][0]) / runs[-1][0] <= self.tolerance:
                mean, rows = runs[-1]
                runs[-1] = ((mean * len(rows) + price) / (len(rows) + 1), [*rows, i])
            else:
                runs.append((price, [i]))
        return [r for r in runs if len(r[1]) >= self.touches]

    def _apart(self, runs):
        kept: list = []
        for price, rows in sorted(runs, key=lambda r: -len(r[1])):
            if all(abs(k - price) / ((k + price) / 2) >= self.min_distance for k, _ in kept):
                kept.append((price, rows))
        return kept


def _sides(columns: dict, n: int, **limits) -> list[tuple[str, SlidingLevels]]:
    high, low = columns["high"].astype(float), columns["low"].astype(float)
    return [("resistance", SlidingLevels(high, swings(high, n), n, **limits)), ("support", SlidingLevels(low, swings(-low, n), n, **limits))]


def levels_at(requests: DataFrame, bars: DataFrame, lookback: int = 120, touches: int = 3, tolerance: float = 0.01, min_distance: float = 0.02, n: int = 3) -> DataFrame:
    """Levels as of each request: clusters of confirmed swing points of the ``lookback`` bars up to then.

    A swing joins the cluster whose running mean lies within ``tolerance``; levels closer than ``min_distance`` to a
    better touched one go. ``recency`` counts bars since the last touch, ``span`` those between first and last. Prices
    must be positive.
    """

    def answer(c: dict, cuts: np.ndarray) -> dict:
        sides = _sides(c, n, lookback=lookback, touches=touches, tolerance=tolerance, min_distance=min_distance)
        day, volume = c["date"], c["volume"].astype(float)
        out = [(k, kind, price, len(rows), day[min(rows)], day[max(rows)], known - max(rows) - 1, max(rows) - min(rows), volume[rows].sum() / len(rows))
               for k, known in enumerate(cuts.tolist()) for kind, side in sides for price, rows in side.known(known)]
        return dict(zip(["request", *(f.split()[0] for f in LEVEL.split(", "))], zip(*out))) if out else {"request": []}

    return serve(requests, bars.select("entity", "date", "high", "low", "volume"), answer, LEVEL)


def level_events_at(requests: DataFrame, bars: DataFrame, retest: int = 30, bounce: int = 5, lookback: int = 120, touches: int = 3, tolerance: float = 0.01, min_distance: float = 0.02, n: int = 3) -> DataFrame:
    """Breaks and role flips in each request's window, measured at the levels of that request.

    A break closes 2 % beyond a level from its inner side. A flip is a resistance's first break whose level is met again
    within ``retest`` bars (a low within ``tolerance``) and holds for the next ``bounce`` closes.
    """

    def answer(c: dict, cuts: np.ndarray) -> dict:
        sides = _sides(c, n, lookback=lookback, touches=touches, tolerance=tolerance, min_distance=min_distance)
        day, low, close = c["date"], c["low"].astype(float), c["close"].astype(float)
        out = []
        for k, known in enumerate(cuts.tolist()):
            first = max(0, known - lookback)
            was, now = close[first:known - 1], close[first + 1:known]
            for kind, side in sides:
                for level, _ in side.known(known):
                    up = kind == "resistance"
                    broke = np.flatnonzero((was <= level) & (now > level * 1.02) if up else (was >= level) & (now < level * 0.98)) + first + 1
                    out += [(k, day[i], f"{kind}_break", level) for i in broke]
                    if up and len(broke):
                        last = min(broke[0] + retest, known)
                        met = np.flatnonzero(np.abs(low[broke[0] + 1:last] - level) / level < tolerance)
                        if len(met) and (close[(i := broke[0] + 1 + met[0]):min(i + bounce, known)] >= level).all():
                            out.append((k, day[i], "level_flip", level))
        return dict(zip(["request", "date", "event_kind", "value"], zip(*out))) if out else {"request": []}

    return serve(requests, bars.select("entity", "date", "high", "low", "close"), answer, EVENT)


def leg_ends(mid: np.ndarray, atr: np.ndarray, reversal: float) -> tuple[list[tuple[int, int, int]], np.ndarray, np.ndarray]:
    """Ends of swing legs as (place, direction, place where it became known), and the open leg's end and way at each bar."""
    found, start, ext, way = [], 0, 0, 0
    open_at, open_way = np.zeros(len(mid), int), np.zeros(len(mid), int)
    for i in range(1, len(mid)):
        move = mid[i] - mid[ext]
        sign = int(np.sign(move))
        if sign and (way == 0 or sign == way):
            way, ext = sign, i
        elif sign and abs(move) >= atr[ext] * reversal:
            found.append((ext, way, i))
            start, ext, way = ext, i, sign
        open_at[i], open_way[i] = ext, way if ext > start else 0
    return found, open_at, open_way


class Lines:
    """Lines through pairs of one side's pivots, each pair looked at once however many days ask for it.

    In the dual plane a pivot ahead of pivot i is an interval of slopes: those of the lines from i that pass it within
    the tolerance. Sorted interval ends count for every slope how many intervals hold it, so only slopes that could reach
    ``min_pivots`` touches are verified against the pivots themselves.
    """

    def __init__(self, at: np.ndarray, price: np.ndarray, lookback: int, min_pivots: int, tolerance: float, min_span: int):
        self.at, self.price = at, price
        i_, j_, slope_, anchors_, touched_ = [], [], [], [], []
        for i in range(len(at)):
            j = np.arange(i + 1, np.searchsorted(at, at[i] + lookback))
            if len(j) < min_pivots - 1:
                continue
            off = (at[j] - at[i]).astype(float)
            slope = (price[j] - price[i]) / off
            ends = np.sort([(price[j] / (1 + tolerance) - price[i]) / off, (price[j] / (1 - tolerance) - price[i]) / off], axis=0)
            slack = 1e-9 * (np.abs(ends) + np.abs(price[i]) / off)
            held = np.searchsorted(np.sort(ends[0] - slack[0]), slope, "right") - np.searchsorted(np.sort(ends[1] + slack[1]), slope, "left")
            c = np.flatnonzero((off >= min_span) & (held + 1 >= min_pivots))
            if not len(c):
                continue
            want = price[i] + slope[c, None] * off
            with np.errstate(divide="ignore", invalid="ignore"):
                near = (want > 0) & (np.abs(price[j] - want) / want < tolerance)
            near[np.arange(len(c)), c] = True
            enough = near.sum(axis=1) + 1 >= min_pivots
            for row, touch in zip(c[enough], near[enough]):
                i_.append(i)
                j_.append(j[row])
                slope_.append(slope[row])
                anchors_.append(int(touch[:row + 1].sum()) + 1)
                touched_.append(j[touch])
        self.i, self.j, self.slope, self.anchors, self.touched = np.array(i_, int), np.array(j_, int), np.array(slope_), np.array(anchors_, int), touched_

    def known(self, rows: int, first: int, pivots: int, min_pivots: int) -> list[tuple[int, int]]:
        """(line, touches) of the lines from row ``first`` on with enough touches among the first ``pivots`` pivots."""
        live = np.flatnonzero((self.at[self.i] >= first) & (self.j < pivots)) if len(self.i) else []
        return [(x, t) for x in live if (t := 1 + int(np.searchsorted(self.touched[x], pivots))) >= min_pivots]


def trendlines_at(requests: DataFrame, bars: DataFrame, lookback: int = 250, min_pivots: int = 5, tolerance: float = 0.005, min_span: int = 30, reversal: float = 0.5, atr_period: int = 14) -> DataFrame:
    """Trendlines as of each request through ends of swing legs of the ``lookback`` bars up to then.

    A leg's end counts from the bar that reversed it; the open leg's extreme counts as its end for now. A line runs from
    one end to a later one of its side at least ``min_span`` bars away and needs ``min_pivots`` touches within
    ``tolerance``. Of near-equal lines (slope within 5 %, start within 5 days) the one with most touches up to its second
    anchor stays, then the earlier start, then the earlier anchor. A close 2 % beyond the line breaks it.
    """

    def answer(c: dict, cuts: np.ndarray) -> dict:
        mid = (c["high"].astype(float) + c["low"].astype(float)) / 2
        close, day = c["close"].astype(float), c["date"]
        ends, open_at, open_way = leg_ends(mid, atr_values(c["tr"].astype(float), atr_period), reversal) if len(mid) else ([], [], [])
        number = np.array([d.toordinal() for d in day], int)
        out = []
        fixed = {}
        for kind, way in (("resistance", 1), ("support", -1)):
            mine = [(at, seen) for at, w, seen in ends if w == way]
            at = np.array([e[0] for e in mine], int)
            fixed[kind] = (way, at, np.array([e[1] for e in mine], int), Lines(at, mid[at], lookback, min_pivots - 1, tolerance, min_span))  # the open end may add a touch
        for k, rows in enumerate(cuts.tolist()):
            if not rows:
                continue
            first = max(0, rows - lookback)
            for kind, (way, at, seen, lines) in fixed.items():
                pivots = int(np.searchsorted(seen, rows))
                tip = int(open_at[rows - 1]) if open_way[rows - 1] == way else None
                found = _with_tip(lines, at, mid, first, pivots, tip, min_pivots, tolerance, min_span)
                found.sort(key=lambda x: (-x[3], x[0], x[1]))
                kept: list = []
                for ln in found:
                    if not any(abs(o[2] - ln[2]) < 0.05 * max(abs(o[2]), 1e-9) and abs(number[o[0]] - number[ln[0]]) < 5 for o in kept):
                        kept.append(ln)
                for a, b, slope, anchors, touches, last in kept:
                    line = mid[a] + slope * np.arange(1, rows - a)
                    shut = close[a + 1:rows]
                    past = np.flatnonzero((line > 0) & ((shut < line * 0.98) if kind == "support" else (shut > line * 1.02)))
                    out.append((k, kind, day[a], day[b], mid[a], slope, anchors, touches, day[last], mid[a] + slope * (rows - 1 - a), day[a + 1 + past[0]] if len(past) else None))
        return dict(zip(["request", *(f.split()[0] for f in LINE.split(", "))], zip(*out))) if out else {"request": []}

    return serve(requests, true_range(bars).select("entity", "date", "high", "low", "close", "tr"), answer, LINE)


def _with_tip(lines: Lines, at: np.ndarray, mid: np.ndarray, first: int, pivots: int, tip: int | None, min_pivots: int, tolerance: float, min_span: int) -> list[tuple]:
    """Lines (start, anchor, slope, anchors, touches, last touch) of the known pivots and, if any, the open leg's end.

    The open end can touch lines of known pivots and anchor lines of its own.
    """
    found = []
    for x, n in lines.known(0, first, pivots, min_pivots - (tip is not None)):
        a, b, slope = int(at[lines.i[x]]), int(at[lines.j[x]]), float(lines.slope[x])
        last = int(at[lines.touched[x][n - 2]]) if n > 1 else b
        last = max(last, b)
        if tip is not None:
            want = mid[a] + slope * (tip - a)
            if want > 0 and abs(mid[tip] - want) / want < tolerance:
                n, last = n + 1, tip
        if n >= min_pivots:
            found.append((a, b, slope, int(lines.anchors[x]), n, last))
    if tip is not None:
        own = at[:pivots][(at[:pivots] >= first)]
        for p, a in enumerate(own[own <= tip - min_span].tolist()):
            slope = (mid[tip] - mid[a]) / (tip - a)
            between = own[p + 1:]
            want = mid[a] + slope * (between - a)
            with np.errstate(divide="ignore", invalid="ignore"):
                n = 2 + int(((want > 0) & (np.abs(mid[between] - want) / want < tolerance)).sum())
            if n >= min_pivots:
                found.append((a, tip, slope, n, n, tip))
    return found
