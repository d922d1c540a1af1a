"""Page layout rules (operators H1, H5, H6, H7, O10, O11, J18, J20, F13).

Pure functions over one page's or column's entries, in reading order. Their results
depend on the order of processing, so on tables they run through ``sequence.grouped``: one Arrow
group a page, never more than a page in memory.
"""

from __future__ import annotations

import math
from itertools import takewhile
from statistics import median

import numpy as np


def fit_error(y: list[float], v: list[float]) -> float:
    """Mean squared error of the straight line of values over positions."""
    if len(set(y)) < 2:
        level = median(y) if y else 0.0
        return float(np.mean([(x - level) ** 2 for x in v])) if v else 0.0
    k, b = np.polyfit(y, v, 1)
    return float(np.mean((np.array(v) - k * np.array(y) - b) ** 2))


def rising(v: list[float]) -> int:
    return sum(a < b for i, a in enumerate(v) for b in v[i + 1 :])


def is_column_valid(y: list[float], v: list[float], noise: int = 0) -> bool:
    """three entries at least, little noise, strictly rising, correlated with the position over 0.95."""
    n = len(v)
    if n < 3 or noise > 1.25 * (n - 2.5) ** 2 or any(b <= a for a, b in zip(v, v[1:])) or np.std(y) == 0:
        return False
    return float(np.corrcoef(y, v)[0, 1]) > 0.95


def reduce_to_valid(y: list[float], v: list[float], noise: int = 0) -> tuple[list[float], list[float]] | None:
    """While the column is not valid, leaves out the entry without which the fit is best (the first of equals); None under three entries."""
    y, v = list(y), list(v)
    while not is_column_valid(y, v, noise):
        if len(v) <= 3:
            return None
        i = min(range(len(v)), key=lambda i: fit_error(y[:i] + y[i + 1 :], v[:i] + v[i + 1 :]))
        del y[i], v[i]
    return y, v


def repair_decimals(y: list[float], v: list[float], has_decimal: list[bool]) -> list[float]:
    """Whole numbers above the median may have lost their decimal point: tries a hundredth and a tenth, and keeps what makes more rising pairs, then a better fit."""
    v, mid = list(v), median(v) if v else 0.0
    for i, x in enumerate(v):
        if not has_decimal[i] and x > mid:
            options = [x, x / 100, x / 10]
            v[i] = max(options, key=lambda o: (rising(v[:i] + [o] + v[i + 1 :]), -fit_error(y, v[:i] + [o] + v[i + 1 :])))
    return v


Interval = tuple[float, float | None]


def holds(outer: Interval, inner: Interval) -> bool:
    """Bounds included; without an end the outer one holds everything, and of an inner one the start decides."""
    (s, e), (a, z) = outer, inner
    return e is None or (s <= a <= e and (z is None or s <= z <= e))


def parts_exactly(outer: Interval, following: list[Interval]) -> bool:
    """Whether the following intervals, those without an end aside, join up from the start of the outer one to its end."""
    at, end = outer
    if end is None:
        return False
    for a, z in following:
        if z is None:
            continue
        if a != at or z > end:
            return False
        if z == end:
            return True
        at = z
    return False


def interval_hierarchy(intervals: list[Interval]) -> list[str]:
    """H6: ``parent`` where the following live intervals part it exactly, then ``sub`` for the run of live ones inside an earlier one, else ``plain``; the first that applies is marked, until none does."""
    kind = ["plain"] * len(intervals)
    live = lambda: [i for i, k in enumerate(kind) if k == "plain"]
    while True:
        now = live()
        at = next((i for k, i in enumerate(now) if parts_exactly(intervals[i], [intervals[j] for j in now[k + 1 :]])), None)
        if at is None:
            break
        kind[at] = "parent"
    while True:
        now, run = live(), []
        for k, i in enumerate(now):
            run = list(takewhile(lambda j: holds(intervals[i], intervals[j]), now[k + 1 :]))  # noqa: B023
            if run:
                break
        if not run:
            return kind
        for j in run:
            kind[j] = "sub"


Rect = tuple[float, float, float, float]


def _fits(start: Rect, end: Rect, r: Rect) -> tuple[float, float] | None:
    """The left and right edge that a box at the height of ``r`` would have between ``start`` and ``end``; None at one height."""
    y0, y1, y = (start[1] + start[3]) / 2, (end[1] + end[3]) / 2, (r[1] + r[3]) / 2
    if y0 == y1:
        return None
    t = (y - y0) / (y1 - y0)
    return start[0] + t * (end[0] - start[0]), start[2] + t * (end[2] - start[2])


def _shared(a: float, b: float, r: Rect, level: float, larger: bool) -> bool:
    return max(0.0, min(b, r[2]) - max(a, r[0])) > level * (max if larger else min)(b - a, r[2] - r[0])


def is_misaligned(rects: list[Rect]) -> bool:
    """Whether boxes half a column apart, made equally wide, leave out more than their share of the others."""
    n = len(rects)
    if n <= 2:
        return False
    outside = checks = 0
    for i in range(n // 2):
        j = i + n // 2
        wide, thin = (rects[j], rects[i]) if rects[j][2] - rects[j][0] > rects[i][2] - rects[i][0] else (rects[i], rects[j])
        w = wide[2] - wide[0]
        if thin[0] < wide[0]:
            thin = (thin[0], thin[1], thin[0] + w, thin[3])
        elif thin[2] > wide[2]:
            thin = (thin[2] - w, thin[1], thin[2], thin[3])
        else:
            thin = (wide[0], thin[1], wide[2], thin[3])
        for k, r in enumerate(rects):
            if k not in (i, j):
                at = _fits(wide, thin, r)
                outside += at is not None and not _shared(*at, r, 0.4, False)
                checks += 1
    return outside / checks > 1 / n


def alignment_clusters(rects: list[Rect], pairs: bool = False, skew: float = 5.0) -> list[list[int]]:
    """H5: columns of boxes in reading order, as lists of their numbers; a box can be in several.

    Every box is tried as the top of a column and, from the last on, every later one as its bottom, if their middles, left
    or right edges lie within ``skew`` degrees of the vertical and no column has both as perfect fits. Boxes between join
    if they lie within the edges interpolated between the two (a perfect fit), or nearly so. A column needs such a box (unless
    ``pairs``), must not lie within an earlier one, and must not be misaligned.
    """
    n, found = len(rects), []
    perfect: list[set[int]] = [set() for _ in rects]
    member: list[set[int]] = [set() for _ in rects]
    for i in range(n):
        for j in range(n - 1, i, -1):
            a, b = rects[i], rects[j]
            if perfect[i] & perfect[j]:
                continue
            dy = abs((b[1] + b[3]) - (a[1] + a[3])) / 2
            dxs = (abs((b[0] + b[2]) - (a[0] + a[2])) / 2, abs(b[0] - a[0]), abs(b[2] - a[2]))
            if not any(dx == 0 or math.degrees(math.atan2(dy, dx)) >= 90 - skew for dx in dxs):
                continue
            margin, between, exact = (a[3] - a[1] + b[3] - b[1]) / 4, [], []
            for k in range(i + 1, j):
                at, r = _fits(a, b, rects[k]), rects[k]
                if at is None:
                    continue
                if at[0] <= r[0] and r[2] <= at[1]:
                    between.append(k)
                    exact.append(k)
                elif (at[0] - margin < r[0] and r[2] < at[1] + margin and _shared(*at, r, 0.01, True)) or _shared(*at, r, 0.2, True):
                    between.append(k)
            column = [i, *between, j]
            if not (between or pairs) or set.intersection(*[member[k] for k in column]) or is_misaligned([rects[k] for k in column]):
                continue
            for k in (i, *exact, j):
                perfect[k].add(len(found))
            for k in column:
                member[k].add(len(found))
            found.append(column)
    return found


Segment = tuple[float, float, float, float]


def _ends(s: Segment) -> tuple[tuple[float, float], tuple[float, float]]:
    return (s[0], s[1]), (s[2], s[3])


def _size(s: Segment) -> float:
    return math.hypot(s[2] - s[0], s[3] - s[1])


def _mergeable(a: Segment, b: Segment, tolerance: float, degrees: float) -> bool:
    turn = lambda s: math.degrees(math.atan2(s[3] - s[1], s[2] - s[0])) % 180
    gap = abs(turn(a) - turn(b))
    if min(gap, 180 - gap) > degrees:
        return False
    for s, o in ((a, b), (b, a)):
        n = _size(s)
        if n == 0:
            continue
        reach = min(max(tolerance / 10, n), tolerance)
        ux, uy = (s[2] - s[0]) / n, (s[3] - s[1]) / n
        for x, y in _ends(o):
            dx, dy = x - s[0], y - s[1]
            if -reach <= dx * ux + dy * uy <= n + reach and abs(dx * uy - dy * ux) <= reach / 3:
                return True
    return False


def merge_segments(segments: list[Segment], tolerance: float = 8.0, degrees: float = 5.0) -> list[Segment]:
    """H1: longest first, each takes in its longest mergeable neighbour (the two ends farthest apart stay) and tries again, until nothing merges."""
    queue, done = sorted(segments, key=lambda s: (-_size(s), s)), []
    while queue:
        s = queue.pop(0)
        k = next((i for i, o in enumerate(queue) if _mergeable(s, o, tolerance, degrees)), None)
        if k is None:
            done.append(s)
            continue
        ends = [*_ends(s), *_ends(queue.pop(k))]
        p, q = max(((p, q) for p in ends for q in ends), key=lambda pq: math.dist(*pq))
        merged = (*p, *q) if p <= q else (*q, *p)
        queue = sorted([*queue, merged], key=lambda s: (-_size(s), s))
    return done


def pair_depths(words: list[tuple[float, float, float]], max_gap: float, max_dy: float) -> list[tuple[float, float]]:
    """``(value, x, y)`` in reading order: each value with the first greater one to its right on the same height."""
    out = []
    for v, x, y in words:
        hit = next((b for b, bx, by in words if b > v and 0 < bx - x <= max_gap and abs(by - y) <= max_dy), None)
        if hit is not None:
            out.append((v, hit))
    return out


def entry_shifts(entries: list[tuple[float, float]], diagonals: list[tuple[float, float]]) -> list[float]:
    """How far each entry (top, bottom) is moved by a diagonal (height of its start, of its end).

    The closest entry and diagonal are paired, each once, until their distance is over the mean height; then, downwards, an
    entry that would come before half of the one above is moved down to it.
    """
    shift = [0.0] * len(entries)
    mean = sum(b - a for a, b in entries) / len(entries) if entries else 0.0
    used_e, used_d = set(), set()
    for d, i, j in sorted((abs((a + b) / 2 - y), i, j) for i, (a, b) in enumerate(entries) for j, (y, _) in enumerate(diagonals)):
        if i in used_e or j in used_d:
            continue
        if d > mean:
            break
        used_e.add(i)
        used_d.add(j)
        shift[i] = diagonals[j][1] - diagonals[j][0]
    last = 0.0
    for i, (a, b) in enumerate(entries):
        half = (b - a) / 2
        if last - half > a + shift[i]:
            shift[i] = last - a - half
        last = b + shift[i]
    return shift


def description_columns(lines: list[tuple[float, float]], bad: list[bool], ratio: float = 0.15) -> list[list[int]]:
    """H7: repeatedly the x range that covers most lines is taken with all lines whose middle it holds; groups with too many excluded lines are rejected."""
    left, out = list(range(len(lines))), []
    while left:
        cover = lambda k: [i for i in left if lines[k][0] <= sum(lines[i]) / 2 <= lines[k][1]]
        best = max(left, key=lambda k: len(cover(k)))
        group = sorted({*cover(best), best})
        left = [i for i in left if i not in group]
        wrong = sum(bad[i] for i in group)
        if len(group) > wrong and wrong / (len(group) - wrong) <= ratio:
            out.append(group)
    return out
