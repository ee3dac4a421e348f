"""Suffix sorting by hashed comparisons.

Polynomial prefix hashes give the hash of any substring in O(1). A binary search over them finds the common
extension of two suffixes, so a comparison takes a logarithmic number of steps, and a bottom-up mergesort
orders the suffixes of all groups at once: every merge finds each suffix's rank in the sibling run by binary
search. What the hashes found equal is compared byte by byte afterwards; a group with a collision is sorted plainly.
"""

from __future__ import annotations

import numpy as np

from .common import prefix_hashes, ranges


class Suffixes:
    """Suffixes buf[start:end] of a byte buffer."""

    def __init__(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: tuple[np.ndarray, np.ndarray] | None = None):
        self.buf, self.starts, self.ends = buf, starts, ends
        self.sums, self.back = prefix_hashes(buf) if hashes is None else hashes

    def common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The length of the common extension of suffixes x[i] and y[i]."""
        a, b = self.starts[x], self.starts[y]
        hi = np.minimum(self.ends[x] - a, self.ends[y] - b)
        lo = np.zeros(len(hi), np.int64)
        sa, sb, ba, bb = self.sums[a], self.sums[b], self.back[a], self.back[b]
        while (lo < hi).any():
            mid = (lo + hi + 1) >> 1
            equal = (self.sums[a + mid] - sa) * ba == (self.sums[b + mid] - sb) * bb
            lo, hi = np.where(equal, mid, lo), np.where(equal, hi, mid - 1)
        return lo

    def less(self, x: np.ndarray, y: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        n = self.common(x, y)
        i, j = self.starts[x] + n, self.starts[y] + n
        end_x, end_y = i >= self.ends[x], j >= self.ends[y]
        last = len(self.buf) - 1
        below = self.buf[np.minimum(i, last)] < self.buf[np.minimum(j, last)]
        return np.where(end_x | end_y, (end_x & ~end_y) | (end_x & end_y & or_equal), below)

    def sort(self, first: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Positions in sorted order; group g is ``arange(first[g], first[g] + size[g])`` and keeps its place."""
        order = np.arange(len(self.starts))
        wide, width = size > 1, 1
        while wide.any():
            at = ranges(first[wide], size[wide])
            begin, n = np.repeat(first[wide], size[wide]), np.repeat(size[wide], size[wide])
            rank = at - begin
            block = rank // width
            low = np.minimum((block ^ 1) * width, n)
            top = np.minimum(low + width, n)
            right = block % 2 == 1
            x, lo, hi = order[at], low.copy(), top.copy()
            active = np.flatnonzero(lo < hi)
            while len(active):
                mid = (lo[active] + hi[active]) >> 1
                other, own, r = order[begin[active] + mid], x[active], right[active]
                # a sibling precedes: from the left run if not above, from the right run if below
                before = self.less(other, own, r)
                lo[active] = np.where(before, mid + 1, lo[active])
                hi[active] = np.where(before, hi[active], mid)
                active = active[lo[active] < hi[active]]
            place = begin + (block // 2) * 2 * width + (rank - block * width) + (lo - low)
            merged = order.copy()
            merged[place] = x
            order, width = merged, 2 * width
            wide = size > width
        return order

    def neighbours(self, order: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The common extension of each suffix with the one before it (-1 at the start of a group)."""
        out = np.full(len(order), -1, np.int64)
        if len(order) > 1:
            inner = np.ones(len(order), bool)
            inner[first] = False
            k = np.flatnonzero(inner)
            out[k] = self.common(order[k - 1], order[k])
        return out

    def sorted_groups(self, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Order and neighbours' common extensions, verified byte by byte."""
        order = self.sort(first, size)
        common = self.neighbours(order, first)
        for g in np.flatnonzero(np.add.reduceat(self._differs(order, common).astype(np.int64), first)) if len(first) else ():
            at = np.arange(first[g], first[g] + size[g])
            texts = {int(k): self.buf[self.starts[k]:self.ends[k]].tobytes() for k in at}
            order[at] = sorted(texts, key=texts.get)
            for k in at[1:]:
                a, b = texts[int(order[k - 1])], texts[int(order[k])]
                common[k] = next((i for i, (p, q) in enumerate(zip(a, b, strict=False)) if p != q), min(len(a), len(b)))
        return order, common

    def _differs(self, order: np.ndarray, common: np.ndarray) -> np.ndarray:
        """Where a common extension isn't that of the bytes, or the order isn't theirs."""
        bad = np.zeros(len(order), bool)
        k = np.flatnonzero(common >= 0)
        a, b, n = self.starts[order[k - 1]], self.starts[order[k]], common[k]
        wrong = self.buf[ranges(a, n)] != self.buf[ranges(b, n)]
        bad[np.repeat(k, n)[wrong]] = True
        more = (a + n < self.ends[order[k - 1]]) & (b + n < self.ends[order[k]])
        bad[k[more]] |= self.buf[(a + n)[more]] >= self.buf[(b + n)[more]]
        return bad
