"""Plans for packing pieces into windows, from the histogram of their lengths.

Combinations of a few lengths that fill a window are enumerated in rounded lengths (steps), non-negative
least squares fits how often each repeats, and exact lengths are dealt to the rounded repeats so that their
deviations cancel. This goes in rounds over what is left; the residual pieces are packed greedily.
All of it sees at most as many numbers as a window has tokens.
"""

from bisect import bisect_left, insort
from collections import Counter, defaultdict
from typing import NamedTuple

import numpy as np

# Share of what is left that a round must place for another one to follow.
LEAST_GAIN = 0.005


def nnls(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """x >= 0 with the least squared error of a x against b, by active sets."""
    x, free = np.zeros(a.shape[1]), np.zeros(a.shape[1], dtype=bool)
    slope, small = a.T @ b, 1e-9 * max(1.0, float(np.abs(b).max(initial=0)))
    for _ in range(3 * a.shape[1]):
        if free.all() or slope[~free].max() <= small:
            break
        free[np.argmax(np.where(free, -np.inf, slope))] = True
        while True:
            step = np.zeros_like(x)
            own = a[:, free]
            step[free] = np.linalg.solve(own.T @ own + 1e-9 * np.eye(own.shape[1]), own.T @ b)
            low = free & (step <= small)
            if not low.any():
                break
            ratio = x[low] / np.maximum(x[low] - step[low], 1e-300)
            x += min(1.0, float(ratio.min())) * (step - x)
            free &= x > small
            x[~free] = 0
        x = step
        slope = a.T @ (b - a @ x)
    return x


class Plan(NamedTuple):
    """``fitted`` and ``greedy``: (lengths in one window, number of such windows)."""

    fitted: list[tuple[tuple[int, ...], int]]
    greedy: list[tuple[tuple[int, ...], int]]

    def share_fitted(self) -> float:
        """Share of all tokens in windows that the fit filled."""
        held = [sum(sum(lengths) * n for lengths, n in part) for part in self]
        return held[0] / max(1, sum(held))


def combinations(total: int, depth: int, present: list[int]) -> list[tuple[int, ...]]:
    """All descending tuples of up to ``depth`` of the ``present`` numbers that add up to ``total``."""
    found, sizes, known = [], sorted(present), set(present)

    def extend(chosen, left, depth):
        if left in known and left <= (chosen[-1] if chosen else left):
            found.append((*chosen, left))
        if depth > 1:
            for size in sizes:
                # The next one is the largest of the rest, so the rest must fit under it.
                if size * depth >= left and size < left and (not chosen or size <= chosen[-1]):
                    extend((*chosen, size), left - size, depth - 1)

    extend((), total, depth)
    return found


def fit_round(left: np.ndarray, steps: int, depth: int) -> list[tuple[tuple[int, ...], int]]:
    """Full windows dealt from the histogram ``left``, which is lessened by what they hold."""
    window = len(left) - 1
    lengths = np.arange(window + 1)
    step = (2 * lengths * steps + window) // (2 * window)        # nearest, halves up
    ideal = np.rint(np.arange(steps + 1) * window / steps).astype(int)
    held = np.bincount(step, weights=left, minlength=steps + 1)
    present = [int(s) for s in np.flatnonzero(held) if s]
    shapes = combinations(steps, depth, present)
    if not shapes:
        return []
    a = np.zeros((len(present), len(shapes)))
    row = {s: i for i, s in enumerate(present)}
    for j, shape in enumerate(shapes):
        for s in shape:
            a[row[s], j] += 1
    repeats = nnls(a, held[present])
    found = []
    for j in np.argsort(-repeats, kind="stable"):
        n = int(round(repeats[j]))
        if n:
            found += _dealt(left, [lengths[step == s] for s in shapes[j]], ideal[list(shapes[j])], n)
    return found


def _dealt(left, choices, ideal, n):
    """Up to ``n`` windows with one length out of each of ``choices``, all full.

    The plentiful lengths go first; the last two are the pair of most copies that fills the window.
    Each step uses a length up or ends the pattern, so there are no more steps than lengths.
    """
    window, found = len(left) - 1, []
    while n:
        lengths = []
        for own in choices[:-2]:
            counts = left[own] - sum(own == x for x in lengths)
            best = int(np.argmax(counts))
            if counts[best] <= 0:
                return found
            lengths.append(int(own[best]))
        rest = window - sum(lengths)
        if len(choices) == 1:
            last = [rest] if rest in choices[0] else None
        else:
            last = _pair(left, choices[-2], choices[-1], rest, lengths)
        if last is None:
            return found
        lengths += last
        need = Counter(lengths)
        k = min(n, *(int(left[x]) // m for x, m in need.items()))
        if k == 0:
            return found
        for x, m in need.items():
            left[x] -= k * m
        found.append((tuple(lengths), k))
        n -= k
    return found


def _pair(left, first, second, rest, lengths):
    """The two lengths of most copies that add up to ``rest``, one of each range; None if there are none."""
    other = rest - first
    fits = (other >= second[0]) & (other <= second[-1])
    first, other = first[fits], other[fits]
    if not len(first):
        return None
    one, two = left[first].copy(), left[other].copy()
    for x in lengths:
        one -= first == x
        two -= other == x
    copies = np.where(first == other, one // 2, np.minimum(one, two))
    best = int(np.argmax(copies))
    return [int(first[best]), int(other[best])] if copies[best] > 0 else None


def plan_windows(counts: dict[int, int], window: int, rounds) -> Plan:
    """Windows that hold exactly ``counts`` pieces of each length from 1 to ``window``."""
    left = np.zeros(window + 1, dtype=np.int64)
    for length, n in counts.items():
        left[length] = n
    fitted, lengths = [], np.arange(window + 1)
    if left[window]:
        fitted, left[window] = [((window,), int(left[window]))], 0
    n_round = 0
    while left.any():
        before = int(lengths @ left)
        steps, depth = rounds[min(n_round, len(rounds) - 1)]
        fitted += fit_round(left, min(steps, window), depth)
        n_round += 1
        if before - int(lengths @ left) < LEAST_GAIN * before and n_round >= len(rounds):
            break
    return Plan(fitted, _greedy({int(x): int(left[x]) for x in np.flatnonzero(left)}, window))


def _greedy(left, window):
    """The residual pieces, longest first, each into the smallest gap that holds it."""
    open_windows, gaps = defaultdict(Counter), []

    def put(lengths, n):
        gap = window - sum(lengths)
        if not open_windows[gap]:
            insort(gaps, gap)
        open_windows[gap][lengths] += n

    for length in sorted(left, reverse=True):
        rest = left[length]
        while rest:
            i = bisect_left(gaps, length)
            if i == len(gaps):
                each = window // length
                if rest >= each:
                    put((length,) * each, rest // each)
                if rest % each:
                    put((length,) * (rest % each), 1)
                break
            gap = gaps[i]
            lengths, n = next(iter(open_windows[gap].items()))
            k = min(n, rest)
            open_windows[gap][lengths] -= k
            if k == n:
                del open_windows[gap][lengths]
                if not open_windows[gap]:
                    gaps.pop(i)
            put((*lengths, length), k)
            rest -= k
    return [(lengths, n) for gap in gaps for lengths, n in open_windows[gap].items()]
