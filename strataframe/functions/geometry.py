"""Rectangle and segment expressions (operators P1-P11, F1-F7, F21, G19, G20).

A rectangle is four columns ``x0, y0, x1, y1`` under a prefix, a segment two points
likewise with ``x0 <= x1``. Everything is an expression, usable in join conditions.
Touching edges do not intersect; containment includes them.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Box(NamedTuple):
    """A rectangle, or a segment from (x0, y0) to (x1, y1)."""

    x0: Column
    y0: Column
    x1: Column
    y1: Column


def box(prefix: str = "") -> Box:
    return Box(*[F.col(f"{prefix}{c}") for c in ("x0", "y0", "x1", "y1")])


def width(b: Box) -> Column:
    return b.x1 - b.x0


def height(b: Box) -> Column:
    return b.y1 - b.y0


def area(b: Box) -> Column:
    return width(b) * height(b)


def x_overlap(a: Box, b: Box) -> Column:
    """Shared length of the x ranges, 0 when apart or touching."""
    return F.greatest(F.lit(0.0), F.least(a.x1, b.x1) - F.greatest(a.x0, b.x0))


def y_overlap(a: Box, b: Box) -> Column:
    return F.greatest(F.lit(0.0), F.least(a.y1, b.y1) - F.greatest(a.y0, b.y0))


def x_overlap_significant(a: Box, b: Box, level: float, largest: bool = False) -> Column:
    """The overlap is over ``level`` times the smaller (or larger) width."""
    return x_overlap(a, b) > level * (F.greatest if largest else F.least)(width(a), width(b))


def y_overlap_significant(a: Box, b: Box, level: float, largest: bool = False) -> Column:
    return y_overlap(a, b) > level * (F.greatest if largest else F.least)(height(a), height(b))


def intersects(a: Box, b: Box) -> Column:
    return (a.x0 < b.x1) & (b.x0 < a.x1) & (a.y0 < b.y1) & (b.y0 < a.y1)


def contains(a: Box, b: Box) -> Column:
    return (a.x0 <= b.x0) & (a.y0 <= b.y0) & (a.x1 >= b.x1) & (a.y1 >= b.y1)


def union_aggregates(prefix: str = "") -> list[Column]:
    """Aggregates for the outer rectangle of a group."""
    return [F.min(f"{prefix}x0").alias("x0"), F.min(f"{prefix}y0").alias("y0"), F.max(f"{prefix}x1").alias("x1"), F.max(f"{prefix}y1").alias("y1")]


def rescale(b: Box, fx: Column | float, fy: Column | float) -> Box:
    """P4."""
    return Box(b.x0 * fx, b.y0 * fy, b.x1 * fx, b.y1 * fy)


def length(s: Box) -> Column:
    return F.hypot(s.x1 - s.x0, s.y1 - s.y0)


def slope(s: Box) -> Column:
    """P5: infinite for a vertical segment."""
    return F.when(s.x1 == s.x0, F.lit(float("inf"))).otherwise(F.try_divide(s.y1 - s.y0, s.x1 - s.x0))


def angle(s: Box) -> Column:
    """P5: degrees in (-90, 90]."""
    return F.when(s.x1 == s.x0, F.lit(90.0)).otherwise(F.degrees(F.atan(F.try_divide(s.y1 - s.y0, s.x1 - s.x0))))


def intercept(s: Box) -> Column:
    return s.y0 - slope(s) * s.x0


def x_at(s: Box, y: Column) -> Column:
    """P5: null for a horizontal segment."""
    return s.x0 + F.try_divide((y - s.y0) * (s.x1 - s.x0), F.nullif(s.y1 - s.y0, F.lit(0.0)))


def distance_to_line(s: Box, x: Column, y: Column) -> Column:
    """P5: to the infinite line through the segment; to its point if it has no length."""
    cross = F.abs((s.y1 - s.y0) * x - (s.x1 - s.x0) * y + s.x1 * s.y0 - s.y1 * s.x0)
    return F.coalesce(F.try_divide(cross, F.nullif(length(s), F.lit(0.0))), F.hypot(x - s.x0, y - s.y0))


def distance_to_segment(s: Box, x: Column, y: Column) -> Column:
    """P5."""
    t = F.try_divide((x - s.x0) * (s.x1 - s.x0) + (y - s.y0) * (s.y1 - s.y0), F.nullif(F.pow(length(s), 2), F.lit(0.0)))
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(t, F.lit(0.0))))
    return F.hypot(x - (s.x0 + t * (s.x1 - s.x0)), y - (s.y0 + t * (s.y1 - s.y0)))


def project(x: Column, y: Column, phi: Column, r: Column) -> tuple[Column, Column]:
    """Orthogonal projection on the line x cos(phi) + y sin(phi) = r."""
    d = r - (x * F.cos(phi) + y * F.sin(phi))
    return x + d * F.cos(phi), y + d * F.sin(phi)


def is_horizontal(s: Box, tolerance: float) -> Column:
    """F1."""
    return F.abs(slope(s)) <= tolerance


def is_vertical(s: Box, tolerance: float) -> Column:
    return F.abs(angle(s)) >= 90 - tolerance


def point_near_line(s: Box, x: Column, y: Column, extension: float, perpendicular: float) -> Column:
    """beside the segment, lengthened at both ends, within the tolerance."""
    along = F.try_divide((x - s.x0) * (s.x1 - s.x0) + (y - s.y0) * (s.y1 - s.y0), F.nullif(length(s), F.lit(0.0)))
    return F.coalesce((along >= -extension) & (along <= length(s) + extension) & (distance_to_line(s, x, y) <= perpendicular), F.lit(False))


def segments_intersect(a: Box, b: Box) -> Column:
    """false for (nearly) parallel ones."""
    ax, ay, bx, by = a.x1 - a.x0, a.y1 - a.y0, b.x1 - b.x0, b.y1 - b.y0
    d = ax * by - ay * bx
    den = F.when(F.abs(d) >= 1e-10, d)
    t = F.try_divide((b.x0 - a.x0) * by - (b.y0 - a.y0) * bx, den)
    u = F.try_divide((b.x0 - a.x0) * ay - (b.y0 - a.y0) * ax, den)
    return F.coalesce(t.between(0, 1) & u.between(0, 1), F.lit(False))


def are_parallel(a: Box, b: Box, degrees: float) -> Column:
    """F6."""
    gap = F.abs(angle(a) - angle(b))
    return F.least(gap, 180 - gap) <= degrees


def are_mergeable(a: Box, b: Box, tolerance: float, degrees: float) -> Column:
    """parallel, and an end of one near the other, with tolerances that shrink for short segments."""
    near = F.lit(False)
    for s, o in ((a, b), (b, a)):
        reach = F.least(F.greatest(F.lit(tolerance / 10), length(s)), F.lit(tolerance))
        for x, y in ((o.x0, o.y0), (o.x1, o.y1)):
            along = F.try_divide((x - s.x0) * (s.x1 - s.x0) + (y - s.y0) * (s.y1 - s.y0), F.nullif(length(s), F.lit(0.0)))
            near = near | F.coalesce((along >= -reach) & (along <= length(s) + reach) & (distance_to_line(s, x, y) <= reach / 3), F.lit(False))
    return are_parallel(a, b, degrees) & near


def match_score(sidebar: Box, rect: Box, lines: Column, noise: Column, entries: Column) -> Column:
    """P10."""
    dx = F.greatest(F.lit(0.0), rect.x0 - sidebar.x1, sidebar.x0 - rect.x1)
    dy = F.abs(rect.y0 - sidebar.y0) + F.abs(rect.y1 - sidebar.y1)
    base = width(rect) - 1.64 * dx + height(rect) - 2 * dy + lines
    return base * F.pow(F.lit(0.8), F.try_divide(10.0 * noise, entries))


def aligned(a: Box, b: Box, tolerance: float) -> Column:
    """width and left edge differ by at most that share of ``a``'s width."""
    return (F.abs(width(a) - width(b)) <= tolerance * width(a)) & (F.abs(a.x0 - b.x0) <= tolerance * width(a))


def table_confidence(area_share: Column, lines: Column, texts: Column) -> Column:
    """G19."""
    return F.least(F.lit(1.0), F.least(F.lit(0.2), area_share / 0.4) + F.least(F.lit(0.5), lines / 90.0) + F.least(F.lit(0.3), 0.01 * texts))


def orthogonal_fit(x: Column, y: Column, w: Column) -> Column:
    """Aggregate ``struct(phi, r)`` of the weighted orthogonal regression line; both null when direction is undefined."""
    n = F.sum(w)
    mx, my = F.try_divide(F.sum(w * x), n), F.try_divide(F.sum(w * y), n)
    sxx = F.try_divide(F.sum(w * x * x), n) - mx * mx
    syy = F.try_divide(F.sum(w * y * y), n) - my * my
    sxy = F.try_divide(F.sum(w * x * y), n) - mx * my
    flat = (F.abs(sxy) < 1e-12) & (F.abs(sxx - syy) < 1e-12)
    phi = 0.5 * F.atan2(2 * sxy, sxx - syy) + F.lit(3.141592653589793 / 2)
    return F.when(~flat, F.struct(phi.alias("phi"), (mx * F.cos(phi) + my * F.sin(phi)).alias("r")))
