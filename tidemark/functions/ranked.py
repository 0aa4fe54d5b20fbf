"""Order statistics of sliding windows, kept in order as rows enter and leave.

A window's values stand in ascending order in blocks of bounded length with running block counts, so entering, leaving,
rank and k-th smallest cost the square root of the window instead of sorting it again for each row.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort

import numpy as np

BLOCK = 512


class Ranked:
    """A multiset of numbers in order. Nulls and NaN must be kept out by the caller."""

    def __init__(self):
        self.blocks: list[list[float]] = [[]]
        self.size = 0

    def _block(self, v: float) -> int:
        lo, hi = 0, len(self.blocks) - 1
        while lo < hi:
            mid = (lo + hi) // 2
            if self.blocks[mid][-1] < v:
                lo = mid + 1
            else:
                hi = mid
        return lo

    def add(self, v: float) -> None:
        b = self._block(v)
        insort(self.blocks[b], v)
        self.size += 1
        if len(self.blocks[b]) > 2 * BLOCK:
            self.blocks[b:b + 1] = [self.blocks[b][:BLOCK], self.blocks[b][BLOCK:]]

    def drop(self, v: float) -> None:
        b = self._block(v)
        i = bisect_left(self.blocks[b], v)
        if i == len(self.blocks[b]) or self.blocks[b][i] != v:
            raise KeyError(v)
        del self.blocks[b][i]
        self.size -= 1
        if not self.blocks[b] and len(self.blocks) > 1:
            del self.blocks[b]

    def kth(self, k: int) -> float:
        """The k-th smallest, from 1."""
        if not 1 <= k <= self.size:
            raise IndexError(k)
        for block in self.blocks:
            if k <= len(block):
                return block[k - 1]
            k -= len(block)
        raise IndexError(k)

    def below(self, v: float, inclusive: bool = False) -> int:
        """How many values are less than ``v`` (or equal to it)."""
        cut, n = bisect_right if inclusive else bisect_left, 0
        for block in self.blocks:
            if block and block[-1] < v:
                n += len(block)
            else:
                return n + cut(block, v) + (sum(_equal_ahead(self.blocks, block, v)) if inclusive else 0)
        return n


def _equal_ahead(blocks, block, v):
    """Values equal to ``v`` in the blocks after ``block``, where a run of ties spans several."""
    for other in blocks[blocks.index(block) + 1:]:
        if not other or other[0] > v:
            return
        yield bisect_right(other, v)


def rank_in_window(values: np.ndarray, starts: np.ndarray, inclusive: bool) -> tuple[np.ndarray, np.ndarray]:
    """For each row i the number of values of rows ``starts[i]..i`` at or below (or below) its own, and their number.

    Null (NaN) values are in no window; ``starts`` must not fall.
    """
    window, first = Ranked(), 0
    rank, size = np.zeros(len(values), int), np.zeros(len(values), int)
    live = ~np.isnan(values)
    for i, v in enumerate(values.tolist()):
        if live[i]:
            window.add(v)
        while first < starts[i]:
            if live[first]:
                window.drop(float(values[first]))
            first += 1
        size[i] = window.size
        if live[i]:
            rank[i] = window.below(v, inclusive)
    return rank, size
