"""Cutting stock by column generation: how to fill sequences of one length with pieces of given lengths.

Gilmore and Gomory's method. The linear program has a row per piece length and a column per pattern, a way to fill
one sequence; columns are made as needed: a knapsack over the rows' prices finds the pattern that would help
most. The size depends on the sequence length alone, never on the number of pieces.
"""

from __future__ import annotations

import numpy as np


def _best_fills(lengths: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Unbounded knapsack: the best worth of each capacity and the piece (index) taken last, -1 for none."""
    worth = np.zeros(capacity + 1)
    last = np.full(capacity + 1, -1)
    fitting = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for room in range(1, capacity + 1):
        n = fitting[room]
        worth[room] = worth[room - 1]
        if n:
            options = worth[room - lengths[:n]] + prices[:n]
            best = int(options.argmax())
            if options[best] > worth[room] + 1e-12:
                worth[room], last[room] = options[best], best
    return worth, last


def _pattern(last: np.ndarray, lengths: np.ndarray, first: int, capacity: int) -> dict[int, int]:
    """The fill that takes piece ``first`` and the best of the room that is left."""
    found, room = {first: 1}, capacity - int(lengths[first])
    while room > 0:
        if last[room] < 0:
            room -= 1
            continue
        piece = int(last[room])
        found[piece] = found.get(piece, 0) + 1
        room -= int(lengths[piece])
    return found


def _first_columns(lengths: np.ndarray, demand: np.ndarray, capacity: int) -> list[dict[int, int]]:
    """Patterns to start from: the longest open piece with one or two that fill the rest, until nothing is open."""
    left = np.zeros(capacity + 1, np.int64)
    left[lengths] = demand
    index = np.full(capacity + 1, -1)
    index[lengths] = np.arange(len(lengths))
    found = []
    for size in lengths[::-1].tolist():
        while left[size] > 0:
            fill, room = {size: 1}, capacity - size
            left[size] -= 1
            while room > 0:
                open_ = np.flatnonzero(left[1 : room + 1] > 0) + 1
                if not len(open_):
                    break
                # The largest piece that leaves nothing or the length of an open piece; else the largest.
                rest = room - open_
                exact = open_[(rest == 0) | ((rest > 0) & (left[rest] > (rest == open_)))]
                piece = int(exact[-1] if len(exact) else open_[-1])
                left[piece] -= 1
                fill[piece] = fill.get(piece, 0) + 1
                room -= piece
            times = min(int(left[p]) // k for p, k in fill.items())
            for p, k in fill.items():
                left[p] -= k * times
            found.append({int(index[p]): k for p, k in fill.items()})
    return found


def solve(
    lengths: np.ndarray,
    demand: np.ndarray,
    capacity: int,
    gap: float = 5e-4,
    batch: int = 60,
    most: int = 3000,
    patience: int = 100,
) -> tuple[list[dict[int, int]], np.ndarray]:
    """Patterns (piece index to count) and how often each is used, as fractions: demand is met exactly.

    Stops when a bound says that no solution needs ``gap`` less sequences (or half a sequence), when ``patience``
    exchanges of columns have gained next to nothing, or after ``most``; each state on the way is feasible.
    """
    n = len(lengths)
    patterns = [{i: int(capacity // lengths[i])} for i in range(n)]
    inverse = np.diag([1.0 / p[i] for i, p in enumerate(patterns)])
    used = inverse @ demand
    # No solution needs less than all pieces laid end to end.
    least = (lengths * demand).sum() / capacity
    exchanges, best_total, since = 0, np.inf, 0

    def near_enough() -> bool:
        """Whether the total is as good as the bound, or has not fallen for long."""
        nonlocal best_total, since
        total, since = used.sum(), since + 1
        slack = max(0.5, gap * total)
        if best_total - total > slack / 100:
            best_total, since = total, 0
        return total - least <= slack or since > patience

    def pivot_in(columns: list[dict[int, int]]) -> bool:
        """Exchange columns into the basis, best reduced cost first, until none of them helps."""
        nonlocal exchanges
        matrix = np.zeros((n, len(columns)))
        for j, column in enumerate(columns):
            matrix[list(column), j] = list(column.values())
        start = exchanges
        while exchanges < most and not near_enough():
            gains = inverse.sum(axis=0) @ matrix - 1
            best = int(gains.argmax())
            if gains[best] <= 1e-7:
                break
            column = columns[best]
            direction = inverse[:, list(column)] @ np.array(list(column.values()), float)
            ratios = np.full(n, np.inf)
            rising = direction > 1e-9
            ratios[rising] = np.maximum(used[rising], 0) / direction[rising]
            row = int(ratios.argmin())
            step = ratios[row]
            if not np.isfinite(step):
                break
            np.subtract(used, step * direction, out=used)
            used[row] = step
            pivot = inverse[row] / direction[row]
            rows, wide = np.flatnonzero(np.abs(direction) > 1e-13), np.flatnonzero(pivot)
            inverse[np.ix_(rows, wide)] -= np.outer(direction[rows], pivot[wide])
            inverse[row] = pivot
            patterns[row] = column
            exchanges += 1
        return exchanges > start

    pivot_in(_first_columns(lengths, demand.astype(np.int64), capacity))
    while exchanges < most and not near_enough():
        total = used.sum()
        prices = np.maximum(inverse.sum(axis=0), 0)
        worth, last = _best_fills(lengths, prices, capacity)
        if worth[capacity] <= 1 + 1e-7 or total * (1 - 1 / worth[capacity]) <= max(0.5, gap * total):
            break
        # Several columns from one knapsack: the best fills that start with different pieces.
        starts = prices + worth[capacity - lengths]
        if not pivot_in([_pattern(last, lengths, int(i), capacity) for i in np.argsort(-starts)[:batch]]):
            break
    return patterns, np.maximum(used, 0)


def whole_patterns(
    lengths: np.ndarray, demand: np.ndarray, capacity: int, waste: float = 0.01
) -> tuple[list[tuple[dict[int, int], int]], np.ndarray]:
    """``(pattern, times)`` and the demand they leave open.

    The linear program's patterns are used as often as their fractions say, rounded down, then once more in
    order of the part cut off, where the open demand allows. What is open then is filled best fit, largest
    first. Fills that waste more than ``waste`` are left out, unless their sum is a power of two.
    """
    left = demand.astype(np.int64).copy()
    found: list[tuple[dict[int, int], int]] = []
    if not len(lengths):
        return found, left
    patterns, used = solve(lengths.astype(np.int64), demand.astype(float), capacity)

    def fits(pattern: dict[int, int]) -> int:
        return min(left[i] // k for i, k in pattern.items())

    def take(pattern: dict[int, int], times: int) -> None:
        found.append((pattern, times))
        for i, k in pattern.items():
            left[i] -= k * times

    def tight(pattern: dict[int, int]) -> bool:
        total = sum(int(lengths[i]) * k for i, k in pattern.items())
        return total >= capacity * (1 - waste) or total & (total - 1) == 0

    order = np.argsort(-(used - np.floor(used)))
    for p, share in enumerate(used):
        times = min(int(share + 1e-9), fits(patterns[p]))
        if times > 0 and tight(patterns[p]):
            take(patterns[p], times)
    for p in order:
        if used[p] % 1 > 1e-9 and tight(patterns[p]) and fits(patterns[p]) > 0:
            take(patterns[p], 1)
    open_ = np.flatnonzero(left)
    for column in _first_columns(lengths[open_], left[open_], capacity):
        pattern = {int(open_[i]): k for i, k in column.items()}
        if tight(pattern) and fits(pattern) > 0:
            take(pattern, fits(pattern))
    for fill, times in _best_fit(lengths, left, capacity):
        if tight(fill):
            take(fill, times)
    return found, left


def _best_fit(lengths: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[dict[int, int], int]]:
    """Fills and how often each is used: pieces, longest first, go where they leave the least room.

    Equal fills are one entry, so the work depends on the number of lengths, not on that of pieces.
    """
    rooms: list[list[tuple[dict[int, int], int]]] = [[] for _ in range(capacity + 1)]
    for i in np.argsort(-lengths).tolist():
        size, open_ = int(lengths[i]), int(demand[i])
        while open_:
            room = next((r for r in range(size, capacity) if rooms[r]), None)
            if room is not None:
                fill, times = rooms[room].pop()
                used = min(times, open_)
                if used < times:
                    rooms[room].append((fill, times - used))
                rooms[room - size].append((fill | {i: fill.get(i, 0) + 1}, used))
                open_ -= used
                continue
            # Nothing fits: new fills of as many pieces as go in, and one of the rest.
            each = capacity // size
            for count, times in ((each, open_ // each), (open_ % each, 1)):
                if count and times:
                    rooms[capacity - count * size].append(({i: count}, times))
            open_ = 0
    return [entry for held in rooms for entry in held]
