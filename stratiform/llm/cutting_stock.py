"""Column generation for the cutting-stock linear program over a histogram of lengths.

The histogram has at most ``capacity - 1`` rows whatever the corpus holds, so solving it on the driver
takes the same time for a thousand documents as for a trillion.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Pattern:
    lengths: tuple[int, ...]  # with repetition, longest first
    times: int

    @property
    def fill(self) -> int:
        return sum(self.lengths)


def knapsack(values: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Best total value for every capacity, and the item last put in (-1: the one unit stays empty)."""
    best, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1, np.int64)
    within = np.searchsorted(sizes, np.arange(capacity + 1), side="right")
    for room in range(1, capacity + 1):
        best[room] = best[room - 1]
        if count := within[room]:
            gains = values[:count] + best[room - sizes[:count]]
            top = int(gains.argmax())
            if gains[top] > best[room] + 1e-12:
                best[room], choice[room] = gains[top], top
    return best, choice


def traced(choice: np.ndarray, sizes: np.ndarray, room: int) -> list[int]:
    items = []
    while room > 0:
        if (item := int(choice[room])) < 0:
            room -= 1
        else:
            items.append(item)
            room -= int(sizes[item])
    return items


def _start(sizes: np.ndarray, counts: np.ndarray, capacity: int) -> tuple[list[list[int]], np.ndarray]:
    """A first basis: the longest length left, completed to a full sequence where that can be done.

    Every step uses up one length and later steps do without it, so the columns are triangular.
    """
    at = np.full(capacity + 1, -1)
    at[sizes] = np.arange(len(sizes))
    left = np.zeros(capacity + 1)
    left[sizes] = counts
    basis: list[list[int]] = [[] for _ in sizes]
    x = np.zeros(len(sizes))
    for longest in sizes[::-1]:
        while left[longest] > 0:
            used, room = [int(longest)], int(capacity - longest)
            while room > 0:
                if left[room] > 0:
                    used.append(room)
                    break
                pairs = np.minimum(left[1:room], left[room - 1 : 0 : -1])
                if len(pairs) and pairs.max() > 0:
                    first = int(pairs.argmax()) + 1
                    used += [first, room - first]
                    break
                fitting = np.flatnonzero(left[: room + 1])
                if not len(fitting):
                    break
                used.append(int(fitting[-1]))
                room -= used[-1]
            lengths, copies = np.unique(used, return_counts=True)
            ratios = left[lengths] / copies
            gone = int(ratios.argmin())
            left[lengths] -= ratios[gone] * copies
            left[lengths[gone]] = 0
            left[left < 1e-9] = 0
            basis[at[lengths[gone]]], x[at[lengths[gone]]] = [int(at[k]) for k in used], ratios[gone]
    for i, items in enumerate(basis):
        if not items:  # a length that vanished by rounding
            basis[i] = [i]
    return basis, x


def column_generation(
    histogram: dict[int, int], capacity: int, gap: float = 1e-3, pivots: int = 2000, columns: int = 24
) -> list[tuple[tuple[int, ...], float]]:
    """Patterns and how often each is cut, fractionally: ``min sum(x), patterns @ x = counts``.

    The first basis completes the longest lengths to full sequences. Each round prices new columns by a knapsack over the dual values; up to ``columns`` of them enter
    the basis one by one while they still price out. It ends when Farley's bound, or the sum of all
    lengths, proves the relative ``gap``, when no column prices out, or after ``pivots`` exchanges (any basis is a valid cover).
    """
    sizes = np.array(sorted(k for k, v in histogram.items() if v > 0), np.int64)
    counts = np.array([histogram[int(k)] for k in sizes], float)
    if not len(sizes):
        return []
    basis, x = _start(sizes, counts, capacity)
    matrix = np.zeros((len(sizes), len(sizes)))
    for column, items in enumerate(basis):
        np.add.at(matrix[:, column], items, 1)
    inverse = np.linalg.inv(matrix)
    duals, left, least = inverse.sum(axis=0), pivots, (sizes @ counts) / capacity
    while left > 0:
        best, choice = knapsack(duals, sizes, capacity)
        total = x.sum()
        least = max(least, (duals @ counts) / max(best[-1], 1.0))
        if best[-1] <= 1 + 1e-9 or total - least <= gap * total:
            break
        forced = duals + best[capacity - sizes]
        pool = [traced(choice, sizes, capacity)]
        pool += [[int(i), *traced(choice, sizes, int(capacity - sizes[i]))] for i in np.argsort(-forced)[: 4 * columns]]
        entered = 0
        for items in pool:
            worth = duals[items].sum()
            if worth <= 1 + 1e-7 or entered == columns or left == 0:
                continue
            direction = inverse[:, items].sum(axis=1)
            able = np.flatnonzero(direction > 1e-9)
            if not len(able):
                continue
            row = able[(x[able] / direction[able]).argmin()]
            step = x[row] / direction[row]
            inverse[row] /= direction[row]
            rows = np.flatnonzero(np.abs(direction) > 1e-12)
            rows = rows[rows != row]
            inverse[rows] -= np.outer(direction[rows], inverse[row])
            x -= step * direction
            x[row], basis[row] = step, items
            np.maximum(x, 0, out=x)
            duals = duals + (1 - worth) * inverse[row]
            entered, left = entered + 1, left - 1
        if not entered:
            break
    return [(tuple(sorted((int(sizes[i]) for i in items), reverse=True)), float(v)) for items, v in zip(basis, x, strict=True)]


def rounded(histogram: dict[int, int], capacity: int, min_fill: float = 0.995, gap: float = 1e-3) -> list[Pattern]:
    """Whole multiples of the patterns that waste little; together they never use more than there is."""
    left, chosen = dict(histogram), []
    for lengths, value in sorted(column_generation(histogram, capacity, gap), key=lambda p: (-sum(p[0]), p[0])):
        use = {k: lengths.count(k) for k in set(lengths)}
        times = min([int(value + 1e-6), *(left[k] // n for k, n in use.items())])
        if times > 0 and sum(lengths) >= min_fill * capacity:
            for k, n in use.items():
                left[k] -= n * times
            chosen.append(Pattern(lengths, times))
    return chosen
