"""Burrows-Wheeler transform and common prefixes of a collection of strings, built column
by column.

Round j inserts one symbol of every string, the j-th from its end, so that after it the
collection's suffixes of up to j symbols are in order. The transform, the common prefixes
and a round's insertions are plain sequences: a round reads them once from front to back
and writes them anew. Callers bound the collection, so the sequences are arrays here.
"""

from __future__ import annotations

import numpy as np

BLOCK = 16


class RangeMinimum:
    """Minima of ranges of one sequence: whole blocks by a table of block minima, the ends cell
    by cell."""

    def __init__(self, values: np.ndarray):
        n = (-(-len(values) // BLOCK) + 2) * BLOCK
        self.values = np.full(n, 255, np.uint8)
        self.values[: len(values)] = values
        part, width = self.values, n // BLOCK
        grid = part.reshape(width, BLOCK)
        half = BLOCK // 2
        while half:
            grid = np.minimum(grid[:, :half], grid[:, half : 2 * half])
            half //= 2
        self.table = [grid.ravel()]
        step = 1
        while 2 * step <= len(self.table[0]):
            last = self.table[-1]
            self.table.append(np.minimum(last[: len(last) - step], last[step:]))
            step *= 2

    def __call__(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Minima of values[first..last], both included, first <= last."""
        low = -(-first // BLOCK)  # whole blocks low .. high - 1
        high = (last + 1) // BLOCK
        cells = np.arange(BLOCK)
        at = np.minimum(first[:, None] + cells, last[:, None])
        out = self.values[at].min(axis=1)
        at = np.maximum(last[:, None] - cells, first[:, None])
        out = np.minimum(out, self.values[at].min(axis=1))
        span = high - low
        whole = np.flatnonzero(span > 0)
        level = np.frexp(span[whole].astype(float))[1] - 1
        for k in np.unique(level):
            here = whole[level == k]
            table = self.table[k]
            out[here] = np.minimum(out[here], np.minimum(table[low[here]], table[high[here] - (1 << int(k))]))
        return out


def build(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string, start, common prefix with the suffix before) of all suffixes in order, the
    empty ones included. Common prefixes stop at 254; equal suffixes follow the strings'
    order."""
    m = len(strings)
    lengths = np.array([len(s) for s in strings])
    longest = int(lengths.max(initial=0))
    known, codes = np.unique(np.frombuffer(b"".join(strings), np.uint8), return_inverse=True)
    kind = np.uint8 if len(known) < 255 else np.uint16
    # Column j holds the j-th symbol from the end, 0 past the start of a string.
    columns = np.zeros((longest + 1, m), kind)
    row = np.repeat(np.arange(m), lengths)
    back = np.repeat(np.cumsum(lengths), lengths) - 1 - np.arange(len(codes))
    columns[back, row] = codes + 1

    transform = columns[0].copy()  # the empty suffixes, one a string
    prefix = np.zeros(m, np.uint8)
    at = np.arange(m)  # of each string's longest suffix so far
    live = np.arange(m)
    for j in range(longest):
        live_now = columns[j, live] != 0
        live, at = live[live_now], at[live_now]
        ordered = np.argsort(transform, kind="stable")
        ended = int(np.count_nonzero(transform == 0))
        place = np.empty(len(ordered), np.int64)
        place[ordered] = np.arange(len(ordered))
        to = place[at]  # among the suffixes with this first symbol and all smaller ones
        minimum = RangeMinimum(prefix)
        symbol = transform[at]

        def neighbour(step: int) -> tuple[np.ndarray, np.ndarray]:
            near = np.clip(to + step, 0, len(ordered) - 1)
            other = ordered[near]
            return other, (near == to + step) & (transform[other] == symbol)

        before, has_before = neighbour(-1)
        after, has_after = neighbour(1)
        with_before = np.zeros(len(at), np.uint8)
        found = minimum(before[has_before] + 1, at[has_before])
        with_before[has_before] = np.minimum(found, 253) + 1
        with_after = np.zeros(len(at), np.uint8)
        found = minimum(at[has_after] + 1, after[has_after])
        with_after[has_after] = np.minimum(found, 253) + 1

        new = to - ended + m  # where the longer suffixes stand after this round
        size = len(transform) + len(at)
        fresh = np.zeros(size, bool)
        fresh[new] = True
        grown = np.empty(size, kind)
        grown[~fresh] = transform
        grown[new] = columns[j + 1, live]
        shared = np.empty(size, np.uint8)
        shared[~fresh] = prefix
        follower = new + 1
        # The suffix behind a new one shares with it what it shares over the range between.
        has_follower = has_after & (follower < size)
        shared[follower[has_follower]] = with_after[has_follower]
        # A suffix of another first symbol behind a new one shares nothing.
        apart = ~has_after & (follower < size)
        shared[follower[apart]] = 0
        shared[new] = with_before
        transform, prefix, at = grown, shared, new

    string = np.empty(len(transform), np.int32)
    size = np.empty(len(transform), np.int32)
    ordered = np.argsort(transform, kind="stable")
    ended = int(np.count_nonzero(transform == 0))
    place = np.empty(len(ordered), np.int64)
    place[ordered] = np.arange(len(ordered))
    at, live = np.arange(m), np.arange(m)
    for j in range(longest + 1):
        string[at], size[at] = live, j
        live_now = columns[j, live] != 0
        live, at = live[live_now], at[live_now]
        at = place[at] - ended + m
    return string, lengths[string] - size, prefix
