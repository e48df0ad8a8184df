"""How many sequences of which lengths: the packing plan, made from the histogram of lengths alone.

There are at most as many lengths as a sequence has tokens, so everything here is bounded by the
capacity, whatever the number of documents. Linear grouping: the large lengths are put into groups
of equal cardinality and rounded up to the largest of their group; for these few sizes the best
configurations are found by column generation (a knapsack prices them); actual lengths take
the places of the rounded ones; and what is left, small lengths above all, goes best-fit into the
space that remains.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np

Content = list[tuple[int, int]]

#: Lengths above this part of the capacity are large; the part that needs the fewest sequences wins.
LARGE_PARTS = (1 / 3, 1 / 8)
#: Groups of equal cardinality.
GROUPS = 64
MOST_COLUMNS = 2000


def linear_groups(counts: dict[int, int], groups: int) -> list[list[list[int]]]:
    """Runs [length, number], descending, cut into groups of equal cardinality."""
    total = sum(counts.values())
    out: list[list[list[int]]] = []
    room = 0
    each = max(1, -(-total // groups))
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            # A group that would only repeat the size of the last one is part of it.
            if room == 0 and out and out[-1][0][0] == length:
                out[-1].append([length, left])
                break
            if room == 0:
                out.append([])
                room = each
            take = min(left, room)
            out[-1].append([length, take])
            left, room = left - take, room - take
    return out


def best_configuration(sizes: list[int], prices: np.ndarray, capacity: int) -> tuple[float, list]:
    """The most valuable multiset of sizes within the capacity (unbounded knapsack)."""
    size, best = np.array(sizes), np.zeros(capacity + 1)
    pick = np.full(capacity + 1, -1)
    for room in range(int(size.min()), capacity + 1):
        fits = size <= room
        worth = np.where(fits, prices + best[np.maximum(room - size, 0)], -1.0)
        j = int(worth.argmax())
        best[room], pick[room] = best[room - 1], -1
        if worth[j] > best[room] + 1e-12:
            best[room], pick[room] = worth[j], j
    taken, room = [0] * len(sizes), capacity
    while room > 0:
        j = pick[room]
        if j < 0:
            room -= 1
        else:
            taken[j] += 1
            room -= sizes[j]
    return float(best[capacity]), taken


def configurations(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[list, int]]:
    """Configurations and how often each is used: the linear programme's optimum, rounded down."""
    n = len(sizes)
    basis = np.diag([float(capacity // s) for s in sizes])
    need = np.array(demand, dtype=float)
    for _ in range(MOST_COLUMNS):
        prices = np.linalg.solve(basis.T, np.ones(n))
        value, column = best_configuration(sizes, np.maximum(prices, 0), capacity)
        if value <= 1 + 1e-9:
            break
        step = np.linalg.solve(basis, np.array(column, dtype=float))
        use = np.linalg.solve(basis, need)
        ratio = np.where(step > 1e-9, use / np.where(step > 1e-9, step, 1), np.inf)
        basis[:, int(ratio.argmin())] = column
    use = np.linalg.solve(basis, need)
    whole = [int(np.floor(max(u, 0) + 1e-9)) for u in use]
    return [([int(round(x)) for x in basis[:, i]], whole[i]) for i in range(n) if whole[i]]


def substituted(groups: list[list[list[int]]], used: list[tuple[list, int]]) -> list:
    """Configurations with actual lengths in place of the rounded ones: (content, times).

    Actual lengths are shorter, so the smallest place of a configuration is left to best fit, which
    finds the length that fills what the others leave.
    """
    bins: list[tuple[Content, int]] = []
    for config, times in used:
        config = list(config)
        if sum(config) > 1:
            config[max(j for j, c in enumerate(config) if c)] -= 1
        wanted = [(groups[j], c) for j, c in enumerate(config) if c]
        while times and wanted and all(sum(n for _, n in runs) >= c for runs, c in wanted):
            at_once = min(times, *[runs[0][1] // c for runs, c in wanted])
            content: Content = []
            for runs, c in wanted:
                if at_once:
                    content.append((runs[0][0], c))
                    runs[0][1] -= at_once * c
                    if not runs[0][1]:
                        runs.pop(0)
                    continue
                while c:
                    take = min(c, runs[0][1])
                    content.append((runs[0][0], take))
                    runs[0][1] -= take
                    c -= take
                    if not runs[0][1]:
                        runs.pop(0)
            bins.append((content, max(1, at_once)))
            times -= max(1, at_once)
    return bins


def best_fit(bins: list[tuple[Content, int]], counts: dict[int, int], capacity: int) -> list:
    """Put the counted lengths, longest first, into the fullest sequences that take them."""
    by_room: dict[int, list[tuple[Content, int]]] = defaultdict(list)
    for content, times in bins:
        by_room[capacity - sum(s * c for s, c in content)].append((content, times))
    open_rooms = np.zeros(capacity + 1, dtype=bool)
    open_rooms[[r for r in by_room]] = True

    def put(room: int, content: Content, times: int) -> None:
        by_room[room].append((content, times))
        open_rooms[room] = True

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            rooms = open_rooms[length:]
            room = length + int(rooms.argmax()) if rooms.any() else capacity
            if by_room[room]:
                content, times = by_room[room].pop()
                open_rooms[room] = bool(by_room[room])
            else:
                content, times = [], left
            # The fullest sequence stays the fullest until it takes no more.
            each = min(room // length, left)
            filled = min(times, left // each)
            if times > filled and content:
                put(room, content, times - filled)
            put(room - each * length, [*content, (length, each)], filled)
            left -= each * filled
    return [entry for room in sorted(by_room) for entry in by_room[room]]


def _plan(counts: dict[int, int], capacity: int, large_part: float, groups: int) -> list:
    large = {s: n for s, n in counts.items() if s > capacity * large_part and n}
    rest = {s: n for s, n in counts.items() if s not in large and n}
    bins: list[tuple[Content, int]] = []
    if large:
        grouped = linear_groups(large, groups)
        sizes = [runs[0][0] for runs in grouped]
        demand = [sum(n for _, n in runs) for runs in grouped]
        bins = substituted(grouped, configurations(sizes, demand, capacity))
        for runs in grouped:
            for size, n in runs:
                rest[size] = rest.get(size, 0) + n
    return best_fit(bins, rest, capacity)


def packing_plan(
    counts: dict[int, int],
    capacity: int,
    large_parts: tuple[float, ...] = LARGE_PARTS,
    groups: int = GROUPS,
) -> list[tuple[Content, int]]:
    """Sequences as (content, times); content lists (length, number of such pieces)."""
    least = -(-sum(s * n for s, n in counts.items()) // capacity)
    best: list[tuple[Content, int]] | None = None
    for part in large_parts:
        plan = _plan(counts, capacity, part, groups)
        if best is None or sum(t for _, t in plan) < sum(t for _, t in best):
            best = plan
        if sum(t for _, t in best) == least:
            break
    return best or []
