"""Cutting-stock column generation over a histogram of piece lengths.

The driver solves it: its input is one count for each length below the
capacity, whatever the size of the corpus.
"""

from __future__ import annotations

import numpy as np


def knapsack(value: np.ndarray, length: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable pattern that fits (unbounded knapsack by dynamic
    programming over the capacity) and its copies of each length."""
    by_length = np.zeros(capacity + 1)
    by_length[length] = value
    best = np.zeros(capacity + 1)
    taken = np.zeros(capacity + 1, dtype=np.int64)
    item = by_length[1:]
    for room in range(1, capacity + 1):
        gain = item[:room] + best[room - 1::-1]
        k = int(gain.argmax())
        if gain[k] > best[room - 1]:
            best[room], taken[room] = gain[k], k + 1
        else:
            best[room] = best[room - 1]
    copies = np.zeros(capacity + 1)
    room = capacity
    while room > 0:
        if taken[room] and by_length[taken[room]] > 0:
            copies[taken[room]] += 1
            room -= int(taken[room])
        else:
            room -= 1
    return float(best[capacity]), copies[length]


def solve(demand: dict[int, int], capacity: int, gap: float = 0.002) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The linear program min sum(x), patterns * x = demand, by the revised
    simplex method with priced columns.

    Starts from patterns of one length each. The bound of a pricing round is
    sum(x) / (value of the priced pattern); the loop ends when sum(x) is
    within ``gap`` of the best bound. Returns lengths, patterns (a column
    each) and how often each is used (fractions; ``patterns`` checks them
    against the demand, so that rounding errors cost padding, never pieces).
    """
    length = np.array(sorted(demand), dtype=np.int64)
    need = np.array([demand[int(k)] for k in length], dtype=float)
    m = len(length)
    fit = capacity // length
    columns = np.diag(fit.astype(float))
    inverse = np.diag(1.0 / fit)
    used = inverse @ need
    bound = need @ length / capacity
    price = inverse.sum(axis=0)
    for turn in range(50 * m):
        if used.sum() <= bound * (1 + gap):
            break
        value, column = knapsack(np.maximum(price, 0), length, capacity)
        bound = max(bound, used.sum() / value if value > 1 else used.sum())
        if value <= 1 + 1e-9:
            break
        direction = inverse @ column
        ratio = np.where(direction > 1e-9, used / np.where(direction > 1e-9, direction, 1), np.inf)
        leave = int(ratio.argmin())
        step = ratio[leave]
        used = np.maximum(used - step * direction, 0)
        used[leave] = step
        columns[:, leave] = column
        row = inverse[leave] / direction[leave]
        inverse -= np.outer(direction, row)
        inverse[leave] = row
        price += (value - 1) * -row
        if turn % 500 == 499:  # against rounding
            price = inverse.sum(axis=0)
    return length, columns, used


def patterns(demand: dict[int, int], capacity: int, gap: float = 0.002) -> list[tuple[int, dict[int, int]]]:
    """(times, {length: copies}) that together hold ``demand`` exactly.

    The solution's patterns are used the whole number of times below their
    fraction; what is left (less than one pattern for each length) is packed
    first-fit by decreasing length.
    """
    demand = {k: v for k, v in demand.items() if v > 0}
    if not demand:
        return []
    out = []
    left = dict(demand)
    full = left.pop(capacity, 0)
    if full:
        out.append((full, {capacity: 1}))
    if left:
        length, columns, used = solve(left, capacity, gap)
        for j in np.argsort(-used, kind="stable"):
            copies = {int(k): int(c) for k, c in zip(length, np.rint(columns[:, j])) if c > 0}
            times = min([int(used[j] + 1e-6), *(left[k] // c for k, c in copies.items())])
            if times > 0:
                out.append((times, copies))
                for k, c in copies.items():
                    left[k] -= times * c
        out += [(1, p) for p in first_fit(left, capacity)]
    return out


def first_fit(left: dict[int, int], capacity: int) -> list[dict[int, int]]:
    """Patterns for the few remaining pieces, longest first into the fullest
    open pattern that has room."""
    by_room: dict[int, list[dict[int, int]]] = {}
    done = []
    for k in sorted((k for k, v in left.items() for _ in range(v)), reverse=True):
        room = next((r for r in range(k, capacity) if by_room.get(r)), None)
        pattern = by_room[room].pop() if room is not None else {}
        pattern[k] = pattern.get(k, 0) + 1
        rest = (capacity if room is None else room) - k
        (by_room.setdefault(rest, []) if rest else done).append(pattern)
    return done + [p for group in by_room.values() for p in group]
