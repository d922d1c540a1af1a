"""Line, zone and interval rules of a page (operators W1-W8, W14, J6, J10, J16, J19, J22, P8, P11, F2, F3, F7, F8, F14, F20, H5, O3).

Lines, segments and zones are rows with a ``page``, an order column and a box. A rule that
looks at neighbours is a window; one whose state goes from line to line folds the page's
array inside one expression, so nothing leaves the JVM. Groups are pages: their arrays are
as large as a page has lines, and are compared with a page's segments only.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from strataframe.functions import geometry as G
from strataframe.functions.text import parse_text
from strataframe.operators.sequence import contained_run, grouped, numbered, whole_groups

SIDES = ("x0", "y0", "x1", "y1")


def _box(s: Column) -> G.Box:
    return G.Box(*[s[c] for c in SIDES])


def _rows(df: DataFrame, order: str) -> DataFrame:
    """A row a page with ``a``, its boxes in order."""
    return df.groupBy("page").agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), *SIDES))).alias("a"))


def line_starts(lines: DataFrame, order: str = "id") -> DataFrame:
    """``(page, order, starts)``: of the lines before and after that share over half the larger width, up to three
    each way, nearest first, are counted until one is over five heights away or neither
    aligned nor indented; three aligned ones make a start, or two and an indented one. A line without a whole box is
    no start and no neighbour."""

    def fold(rows: list[dict]) -> list[dict]:
        boxes = [None if None in (b := tuple(r[c] for c in SIDES)) else b for r in rows]

        def points(me: tuple, near: Iterable[int]) -> tuple[int, int]:
            x0, y0, x1, y1 = me
            h, w, seen, exact, indented = y1 - y0, x1 - x0, 0, 0, 0
            for k in near:
                o = boxes[k]
                if o is None or not max(0.0, min(o[2], x1) - max(o[0], x0)) > 0.5 * max(o[2] - o[0], w):
                    continue
                shift = o[0] - x0
                even = abs(shift) < 0.2 * h
                if max(o[1] - y1, y0 - o[3]) > 5 * h or not (even or 0 < shift < 2 * h):
                    break
                exact, indented, seen = exact + even, indented + (not even), seen + 1
                if seen == 3:
                    break
            return exact, indented

        out = []
        for i, (r, me) in enumerate(zip(rows, boxes)):
            up, down = (points(me, range(i - 1, -1, -1)), points(me, range(i + 1, len(rows)))) if me else ((0, 0), (0, 0))
            exact = up[0] + down[0]
            out.append({"page": r["page"], order: r[order], "starts": exact >= 3 or (exact >= 2 and up[1] + down[1] >= 1)})
        return out

    kinds = dict(lines.dtypes)
    return grouped(lines.select("page", order, *SIDES), ["page"], [order], fold, f"page {kinds['page']}, {order} {kinds[order]}, starts boolean")


def indentation(lines: DataFrame, order: str = "id") -> DataFrame:
    """``(page, order, indentation)``: 1 for the first indented line, 3 while the indentation goes on, -1 where it ends, else 0; lines over a height apart give 0 and forget it."""

    def step(acc: Column, me: Column) -> Column:
        p = acc["last"]
        wide = F.greatest(p["x1"] - p["x0"], me["x1"] - me["x0"])
        near = me["y0"] <= p["y1"] + (p["y1"] - p["y0"])
        goes_on, first = me["x0"] >= p["x0"] - 0.03 * wide, me["x0"].between(p["x0"] + 0.03 * wide, p["x0"] + 0.2 * wide)
        value = F.when(~F.coalesce(near, F.lit(False)), 0.0).when(acc["inside"], F.when(goes_on, 3.0).otherwise(-1.0)).otherwise(F.when(first, 1.0).otherwise(0.0))
        return F.struct(me.alias("last"), (value > 0).alias("inside"), F.concat(acc["out"], F.array(F.struct(me["o"].alias(order), value.alias("indentation")))).alias("out"))

    g = _rows(lines, order)
    kind = g.schema["a"].dataType.elementType
    out = f"array<struct<{order}:{kind['o'].dataType.simpleString()},indentation:double>>"
    start = F.struct(F.lit(None).cast(kind).alias("last"), F.lit(False).alias("inside"), F.array().cast(out).alias("out"))
    return g.select("page", F.inline(F.aggregate("a", start, step, lambda acc: acc["out"])))


AFFINITIES = ("long_lines", "left_lines", "spacing", "right_end", "diagonal", "gap", "indentation")
#: Weights of the seven affinities and the importance, by kind of sidebar; without one, the weighted sum counts.
WEIGHTS = {
    "a_above_b": ((3.5, 1, 1.25, 1, 1.25, 0, 0.6), 5.0),
    "a_to_b": ((1, 1, 1, 1, 0, 0, 0), 2.0),
    "spulprobe": ((1, 1, 1, 1, 0, 0, 0), 2.0),
    "layer_identifier": ((0.2, 0.2, 1, 0.6, 0, 0, 0), 0.66),
    "protocol": ((1, 1, 1, 1, 1, 0.2, 0), 1.0),
    "no_sidebar": ((1, 1, 1, 1, 1, 0.2, 0), None),
}


def line_affinity(lines: DataFrame, segments: DataFrame, diagonals: DataFrame, order: str = "id", ratio: float = 0.2, least: float = 7.0, flat: float = 0.1) -> DataFrame:
    """``(page, order, <the seven affinities>)`` of each line with the line before; zeros for a page's first.

    ``long_lines``/``left_lines``: -1 if a horizontal segment that covers over ``ratio`` of the lines' outer width, or
    one over ``least`` long that cuts the left edge, lies between; ``spacing``: falls with the distance; ``right_end``: how
    much farther right the line ends; ``diagonal``: -1 if a diagonal ends between; ``gap``: 1 if the gap is like the one
    before. A page's lines and segments are folded together, so no pair of a line and a segment becomes a row. A line
    without a whole box, and the one after it, have zeros.
    """
    side = lambda d, tag, at: d.select("page", F.lit(tag).alias("__side"), at.alias(order), *SIDES)
    none = F.lit(None).cast(lines.schema[order].dataType)
    rows = side(lines, 0, F.col(order)).unionByName(side(segments.filter(G.is_horizontal(G.box(), flat)), 1, none)).unionByName(side(diagonals, 2, none)).filter("page is not null")

    def fold(rows: list[dict]) -> list[dict]:
        mine = [r for r in rows if r["__side"] == 0]
        flats = [(r["x0"], (r["y0"] + r["y1"]) / 2, r["x1"]) for r in rows if r["__side"] == 1]
        ends = [r["y1"] for r in rows if r["__side"] == 2 and r["y1"] is not None]
        boxes = [None if None in (b := tuple(r[c] for c in SIDES)) else b for r in mine]
        whole = [b for b in boxes if b]
        left, right = min((b[0] for b in whole), default=0.0), max((b[2] for b in whole), default=0.0)
        steps = [(p, b) for p, b in zip(boxes, boxes[1:]) if p and b]
        over = any(b[1] - p[3] < 0 for p, b in steps)
        tops = [b[1] - p[1] for p, b in steps if b[1] > p[1] + (p[3] - p[1]) / 2]
        lowest = min(tops) * 1.15 if tops else None
        out, p, before, inside = [], None, None, False
        for r, me in zip(mine, boxes):
            v = [0.0] * 7
            last, before = before, None
            if p and me:
                (px0, py0, px1, py1), (x0, y0, x1, y1) = p, me
                hp, h, w = py1 - py0, y1 - y0, x1 - x0
                top, bottom = py0 + hp * 2 / 3, y0 + h / 3
                between = [g for g in flats if top < g[1] < bottom]
                before = gap = y0 - py1
                if any(min(right, g[2]) - max(left, g[0]) > ratio * (right - left) for g in between):
                    v[0] = -1.0
                if any(g[2] - g[0] > least and (g[0] - 2 < px0 < g[2] + 2 or g[0] - 2 < x0 < g[2] + 2) for g in between):
                    v[1] = -1.0
                reference = h if over else lowest
                v[2] = max(-1.0, 1 - (y1 - py1) / reference) if reference else -1.0
                shift = (x1 - px1) / w if w else 0.0
                v[3] = 0.0 if shift < 0.15 else max(-1.0, -shift)
                if any((py0 + py1) / 2 < y < (y0 + y1) / 2 for y in ends):
                    v[4] = -1.0
                v[5] = 1.0 if gap <= 0.6 * hp and (last is None or gap <= last + 0.2 * hp) else 0.0
                wide = max(px1 - px0, w)
                if y0 <= py1 + hp:
                    v[6] = (3.0 if x0 >= px0 - 0.03 * wide else -1.0) if inside else float(px0 + 0.03 * wide <= x0 <= px0 + 0.2 * wide)
            p, inside = me, v[6] > 0
            out.append({"page": r["page"], order: r[order], **dict(zip(AFFINITIES, v))})
        return out

    kinds = dict(lines.dtypes)
    return grouped(rows, ["page"], ["__side", order], fold, f"page {kinds['page']}, {order} {kinds[order]}, " + ", ".join(f"{c} double" for c in AFFINITIES))


def weighted_affinity(kind: str) -> Column:
    """The mean of the seven affinities by the kind's weights, times its importance; the weighted sum where there is no sidebar."""
    weights, importance = WEIGHTS[kind]
    total = sum(F.col(c) * float(w) for c, w in zip(AFFINITIES, weights))
    return total if importance is None else total / float(sum(weights)) * importance


def affinity_blocks(affinities: DataFrame, order: str = "id") -> DataFrame:
    """``(page, order, block)``: a new block where the affinity without a sidebar is under 0, or under -0.99 on pages with three lines or more below a long rule."""
    by, page = Window.partitionBy("page").orderBy(order), Window.partitionBy("page")
    d = affinities.withColumns({"__w": weighted_affinity("no_sidebar"), "__t": F.when(F.sum("long_lines").over(page) <= -3, -0.99).otherwise(0.0)})
    return d.select("page", order, F.sum(F.when(F.col("__w") < F.col("__t"), 1).otherwise(0)).over(by.rowsBetween(Window.unboundedPreceding, 0)).alias("block"))


def split_on_mismatch(intervals: DataFrame, order: str = "id", sublayers: int = 8) -> DataFrame:
    """Adds ``part`` to rows ``page, <order>, s, e``. An interval is followed by those inside it, at most ``sublayers``, and then by one that starts where it ends (or deeper, if none is inside it); if not, a new part begins after it."""
    d = contained_run(intervals, ["page"], [order], "s", "e")
    g = d.groupBy("page").agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), "s", "e", "run", F.struct(*intervals.columns).alias("row")))).alias("a"))

    def step(acc: Column, x: Column) -> Column:
        i, run = F.size(acc["out"]), x["run"].cast("int")
        nxt = F.get(F.col("a"), i + run + 1)
        fits = F.when(run == 0, x["e"] <= nxt["s"]).otherwise(x["e"] == nxt["s"])
        good = (run <= sublayers) & (nxt.isNull() | F.coalesce(fits, F.lit(False)))
        visited = i >= acc["next"]
        return F.struct(
            F.when(~visited, acc["next"]).when(good, i + run + 1).otherwise(i + 1).alias("next"),
            F.when(visited & ~good, acc["part"] + 1).otherwise(acc["part"]).alias("part"),
            F.concat(acc["out"], F.array(acc["part"])).alias("out"),
        )

    start = F.struct(F.lit(0).alias("next"), F.lit(0).alias("part"), F.array().cast("array<int>").alias("out"))
    parts = g.select("a", F.aggregate("a", start, step, lambda acc: acc["out"]).alias("p"))
    return parts.select(F.explode(F.arrays_zip("a", "p")).alias("z")).select("z.a.row.*", F.col("z.p").cast("bigint").alias("part"))


def linked_intervals(intervals: DataFrame, order: str = "id") -> DataFrame:
    """``(page, n, linked)``: whether there is more than one interval and at least half of them start where the one before ends."""
    by = Window.partitionBy("page").orderBy(order)
    d = intervals.withColumn("__hit", F.coalesce((F.lag("e").over(by) == F.col("s")).cast("int"), F.lit(0)))
    n = F.count("*")
    return d.groupBy("page").agg(n.alias("n"), ((n > 1) & (F.sum("__hit") >= 0.5 * (n - 1))).alias("linked"))


def trim_trailing_duplicates(df: DataFrame, value: str, order: str = "id") -> DataFrame:
    """Without the rows that repeat the page's last value at its end."""
    page = Window.partitionBy("page")
    d = df.withColumn("__last", F.max(F.struct(order, value)).over(page)[value])
    d = d.withColumn("__other", F.max(F.when(~F.col(value).eqNullSafe(F.col("__last")), F.col(order))).over(page))
    by = Window.partitionBy("page").orderBy(order)
    d = d.withColumn("__first", F.lag(order).over(by).eqNullSafe(F.col("__other")))
    return d.filter(F.col("__first") | (F.col(order) <= F.col("__other"))).drop("__last", "__other", "__first")


def absorb_skipped(df: DataFrame, order: str = "id") -> DataFrame:
    """W14 over rows ``page, <order>, skipped, text``: ``(page, <order>, text)`` of the kept rows, each with the texts of the skipped ones after it; texts before the first kept one are lost."""
    by = Window.partitionBy("page").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    d = df.withColumn("__g", F.sum(F.when(F.col("skipped"), 0).otherwise(1)).over(by)).filter("__g > 0")
    texts = F.transform(F.array_sort(F.collect_list(F.struct(order, "text"))), lambda x: x["text"])
    return d.groupBy("page", "__g").agg(F.min(order).alias(order), F.concat_ws(" ", texts).alias("text")).drop("__g")


def zones(entries: DataFrame, kind: str, order: str = "id") -> DataFrame:
    """``(page, zone, start_value, end_value, s_<box>, e_<box>)`` between consecutive entries ``page, <order>, value`` and a box; an open side is null.

    ``a_above_b`` and ``protocol`` open with a zone before the first entry unless its value is 0; for ``protocol`` the
    boxes then move on by one entry. ``spulprobe`` is open at both ends.
    """
    if kind not in ("a_above_b", "protocol", "spulprobe"):
        raise ValueError(f"no zones for {kind!r}")
    by = Window.partitionBy("page").orderBy(order)
    b = F.struct(*SIDES)
    d = entries.select("page", F.col(order).alias("o"), "value", b.alias("b"))
    d = d.withColumns({"pv": F.lag("value").over(by_o := Window.partitionBy("page").orderBy("o")), "pb": F.lag("b").over(by_o), "nb": F.lead("b").over(by_o), "i": F.row_number().over(by_o), "fv": F.first("value").over(by_o)})
    del by
    none = F.lit(None)
    one = d.select("page", "i", F.col("pv").alias("start_value"), F.col("value").alias("end_value"), F.col("pb").alias("sb"), F.col("b").alias("eb"), "fv", "b", "nb")
    if kind != "spulprobe":
        one = one.filter((F.col("i") > 1) | (F.col("fv") != 0))
    if kind == "protocol":
        opened = F.col("fv") != 0  # then the zone of entry i reaches from entry i to the one after
        one = one.withColumns({"sb": F.when(opened, F.when(F.col("i") > 1, F.col("b"))).otherwise(F.col("sb")), "eb": F.when(opened, F.col("nb")).otherwise(F.col("eb"))})
    keep = ["page", F.col("i").cast("bigint").alias("zone"), "start_value", "end_value", "sb", "eb"]
    out = one.select(*keep)
    if kind == "spulprobe":
        last = d.filter(F.col("nb").isNull()).select("page", (F.col("i") + 1).cast("bigint").alias("zone"), F.col("value").alias("start_value"), none.cast(entries.schema["value"].dataType).alias("end_value"), F.col("b").alias("sb"), none.cast(d.schema["b"].dataType).alias("eb"))
        out = out.unionByName(last)
    return out.select("page", "zone", "start_value", "end_value", *[F.col(f"sb.{c}").alias(f"s_{c}") for c in SIDES], *[F.col(f"eb.{c}").alias(f"e_{c}") for c in SIDES])


def zone_score(kind: str, start: G.Box, end: G.Box, line: G.Box) -> Column:
    """1 if the line's middle lies between the tops of the zone's boxes, else 0; for ``a_above_b`` the mean of a point for lying inside the zone as a whole and of the nearness to its middle."""
    middle = (line.y0 + line.y1) / 2
    no_start, no_end = start.y0.isNull(), end.y0.isNull()
    if kind != "a_above_b":
        return F.when((no_start | (middle > start.y0)) & (no_end | (middle < end.y0)), 1.0).otherwise(0.0)
    top, bottom = (start.y0 + start.y1) / 2, (end.y0 + end.y1) / 2
    inside = F.when((no_start | (line.y0 > top)) & (no_end | (line.y1 < bottom)), 1.0).otherwise(0.0)
    own = F.when(no_start & no_end, F.lit(None)).when(no_start, F.nullif(bottom, F.lit(0.0))).when(no_end, F.nullif(top, F.lit(0.0))).otherwise((end.y0 + start.y1) / 2)
    return (F.coalesce(F.exp(-F.abs(own - middle) / 30.0), F.lit(0.0)) + inside) / 2


def long_or_horizontal(segments: DataFrame, pages: DataFrame, reference: float = 1000.0, least: float = 100.0, flat: float = 0.1) -> DataFrame:
    """segments at least ``least`` long, scaled by the page's ``width`` over ``reference``, and all horizontal ones."""
    d = segments.join(pages.select("page", F.col("width").alias("__w")), "page")
    return d.filter((G.length(G.box()) >= least * F.col("__w") / reference) | G.is_horizontal(G.box(), flat)).drop("__w")


def structure_lines(segments: DataFrame, least: float = 20.0, tolerance: float = 10.0) -> DataFrame:
    """adds ``is_vertical, start, end, position`` to segments over ``least`` long; one that is not horizontal within ``tolerance`` degrees is vertical (as in the original, whatever its angle)."""
    s = G.box()
    flat = F.abs(G.angle(s)) <= tolerance
    pick = lambda a, b: F.when(flat, a).otherwise(b)
    return segments.filter(G.length(s) > least).withColumns(
        {
            "is_vertical": ~flat,
            "start": pick(F.least(s.x0, s.x1), F.least(s.y0, s.y1)),
            "end": pick(F.greatest(s.x0, s.x1), F.greatest(s.y0, s.y1)),
            "position": pick((s.y0 + s.y1) / 2, (s.x0 + s.x1) / 2),
        }
    )


def text_diagonals(segments: DataFrame, lines: DataFrame, degrees: float = 5.0) -> DataFrame:
    """segments whose right end lies in the zone left of the page's description lines, but for strokes with both ends in texts, (nearly) vertical, too flat or too long ones."""
    h = G.height(G.box())
    zone = lines.groupBy("page").agg(
        F.min("x0").alias("a"), F.max("x0").alias("b"), F.min(h).alias("h0"), F.max(h).alias("h1"), F.min("y0").alias("ya"), F.max("y1").alias("yb"), F.array_sort(F.collect_list(F.struct(*SIDES))).alias("texts")
    )
    d = segments.join(zone, "page")
    s = G.box()
    holds = lambda x, y: F.exists("texts", lambda t: x.between(t["x0"], t["x1"]) & y.between(t["y0"], t["y1"]))
    ends = s.x1.between(F.col("a") - F.col("h1"), F.col("b") + F.col("h1") / 3) & s.y1.between(F.col("ya"), F.col("yb"))
    size = (F.abs(s.y1 - s.y0) > F.col("h0") / 2) & (s.x1 > s.x0) & (s.x1 - s.x0 < 3 * F.col("h1"))
    return d.filter(ends & size & ~G.is_vertical(s, degrees) & ~(holds(s.x0, s.y0) & holds(s.x1, s.y1))).select(*segments.columns)


def description_lines(lines: DataFrame, rects: DataFrame, order: str = "id") -> DataFrame:
    """F8: ``(page, rect, <order>, place)``: the lines inside a rectangle that start left of its right two fifths, numbered from the top."""
    from strataframe.operators.matching import range_join

    r = rects.select("page", F.col("id").alias("rect"), *SIDES)
    j = range_join(r, lines.select("page", F.col(order).alias("__o"), *SIDES), ["page"], G.contains)
    a, b = G.box(), G.box("r_")
    j = j.filter(b.x0 < a.x1 - 0.4 * G.width(a))
    place = F.row_number().over(Window.partitionBy("page", "rect").orderBy("r_y0", "r___o")).cast("bigint")
    return j.select("page", "rect", F.col("r___o").alias(order), place.alias("place"))


def containing_table(pairs: DataFrame, tables: DataFrame, buffer: float) -> DataFrame:
    """``(page, id, table)``: the first table that holds the pair's box, widened by ``buffer`` to all sides; -1 if there is none."""
    from strataframe.operators.matching import range_join

    wide = tables.select("page", F.col("id").alias("table"), (F.col("x0") - buffer).alias("x0"), (F.col("y0") - buffer).alias("y0"), (F.col("x1") + buffer).alias("x1"), (F.col("y1") + buffer).alias("y1"))
    held = range_join(wide, pairs.select("page", "id", *SIDES), ["page"], G.contains).groupBy("page", F.col("r_id").alias("id")).agg(F.min("table").alias("table"))
    return pairs.select("page", "id").join(held, ["page", "id"], "left").withColumn("table", F.coalesce("table", F.lit(-1)))


def line_to_the_right(keys: DataFrame, lines: DataFrame, reach: float | None = 50.0, level: float = 0.9) -> DataFrame:
    """``(page, id, right)``: of the lines to the right of each key that share over ``level`` of the smaller height, the nearest within ``reach``; without a reach, the first one by id."""
    from strataframe.operators.matching import range_join

    far = F.col("x1") + (reach if reach is not None else 1e6)
    band = keys.select("page", "id", F.col("x1").alias("__right"), F.col("x0").alias("__left"), F.col("x1").alias("x0"), "y0", far.alias("x1"), "y1")
    j = range_join(band, lines.select("page", "id", *SIDES), ["page"], lambda a, b: G.y_overlap_significant(a, b, level), cell=200.0 if reach is not None else 1e6)
    j = j.filter(F.col("id") != F.col("r_id")).filter((F.col("r_x0") > F.col("__right")) & (F.col("r_x0") < F.col("x1")) if reach is not None else F.col("r_x0") >= F.col("__right"))
    best = F.min(F.struct(F.col("r_x0") if reach is not None else F.lit(0.0), "r_id"))
    return j.groupBy("page", "id").agg(best.getField("r_id").alias("right"))


def one_to_one(elements: DataFrame, boxes: DataFrame) -> DataFrame:
    """J10 a file: each box gets one element, in rounds: every element left goes to its nearest free box of its page, and of those the topmost stays.

    ``elements``: ``file, id, page, y0, px, py``; ``boxes``: ``file, box, page, x0, y0, x1, y1``, one box a number and page. If
    there are fewer elements than boxes, the first is used again. Gives ``(file, box, id)``; a box that no element can reach is absent.
    """
    rows = elements.selectExpr("file", "0 as side", "id", "page", "y0", "px", "py", "cast(null as double) as x0", "cast(null as double) as x1", "cast(null as double) as y1").unionByName(
        boxes.selectExpr("file", "1 as side", "box as id", "page", "y0", "cast(null as double) as px", "cast(null as double) as py", "x0", "x1", "y1")
    )

    def fold(group: list[dict]) -> list[dict]:
        left = [r for r in group if r["side"] == 0]
        targets: dict[int, list[dict]] = {}
        for r in group:
            if r["side"]:
                targets.setdefault(r["id"], []).append(r)
        if not left or not targets:
            return []
        left += [left[0]] * (len(targets) - len(left))
        if len(targets) == 1:
            first = min(left, key=lambda r: (r["page"], r["y0"])) if len(left) > 1 else left[0]
            return [{"file": first["file"], "box": next(iter(targets)), "id": first["id"]}]
        found: dict[int, dict] = {}

        def gap(e: dict, number: int) -> float | None:
            b = next((b for b in targets[number] if b["page"] == e["page"]), None)
            if b is None:
                return None
            dx, dy = max(0.0, b["x0"] - e["px"], e["px"] - b["x1"]), max(0.0, b["y0"] - e["py"], e["py"] - b["y1"])
            return (dx * dx + dy * dy) ** 0.5

        while len(found) < len(targets):
            wish: dict[int, list[dict]] = {}
            for e in left:
                near = [(d, k) for k in sorted(targets) if k not in found and (d := gap(e, k)) is not None]
                if near:
                    wish.setdefault(min(near)[1], []).append(e)
            if not wish:
                break
            for number, some in wish.items():
                best = min(some, key=lambda r: (r["page"], r["y0"]))
                found[number] = best
                left.remove(best)
        return [{"file": e["file"], "box": k, "id": e["id"]} for k, e in sorted(found.items())]

    return grouped(rows, ["file"], ["side", "id", "page"], fold, "file bigint, box bigint, id bigint")


def compact_overlaps(df: DataFrame, order: str = "id") -> DataFrame:
    """O3: in order, a box that meets kept ones drives out the larger of them; it goes itself if one of them is not larger."""
    s = F.struct(F.col(order).alias("o"), *SIDES)
    g = df.groupBy("page").agg(F.array_sort(F.collect_list(s)).alias("a"))
    size = lambda x: (x["x1"] - x["x0"]) * (x["y1"] - x["y0"])

    def step(acc: Column, x: Column) -> Column:
        met = lambda y: G.intersects(_box(x), _box(y))
        stays = F.filter(acc, lambda y: ~(met(y) & (size(x) < size(y))))
        return F.when(F.exists(acc, lambda y: met(y) & (size(x) >= size(y))), stays).otherwise(F.concat(stays, F.array(x)))

    kept = F.aggregate("a", F.slice("a", 1, 0), step)
    return g.select("page", F.explode(kept).alias("x")).select("page", F.col("x.o").alias(order))


def depth_anchor(s: G.Box, s_page: Column, e: G.Box, e_page: Column) -> tuple[Column, Column]:
    """Where the line to a layer starts: right of its bounds, halfway between them; with one bound its lower or upper right corner; nothing across pages."""
    start, end = s.x1.isNotNull(), e.x1.isNotNull()
    x = F.when(start & end, F.when(s_page == e_page, F.greatest(s.x1, e.x1))).when(start, s.x1).otherwise(e.x1)
    y = F.when(start & end, F.when(s_page == e_page, (s.y0 + e.y1) / 2)).when(start, s.y1).otherwise(e.y0)
    return x, y


def depth_background(s: G.Box, s_page: Column, e: G.Box, e_page: Column) -> G.Box:
    """The box between the bounds of a layer, if both are on a page and apart."""
    good = (s_page == e_page) & (s.y1 < e.y0)
    some = lambda c: F.when(good, c)
    return G.Box(some(s.x0), some(s.y1), some(F.greatest(s.x1, e.x1)), some(e.y0))


def layered_groups(layers: DataFrame, by: list[str], kind: str = "kind", text: str = "text", least: int = 2, least_protocol: int = 1) -> DataFrame:
    """the layers with a text, of groups that have enough of them (a protocol needs one, but a text for every entry)."""
    w = Window.partitionBy(*by)
    some = parse_text(text) != ""
    d = layers.withColumns({"__n": F.count_if(some).over(w), "__all": F.count("*").over(w)})
    protocol = F.col(kind).eqNullSafe(F.lit("protocol"))
    good = F.when(protocol, (F.col("__n") == F.col("__all")) & (F.col("__n") >= least_protocol)).otherwise(F.col("__n") >= least)
    return d.filter(some & good).drop("__n", "__all")


def depth_complete(start: Column, end: Column) -> Column:
    """both bounds are known."""
    return start.isNotNull() & end.isNotNull()


def legend_blocks(lines: DataFrame, order: str = "id") -> DataFrame:
    """``(page, legend)``: of the lines of one word without punctuation, over one has the top, or over two the left edge, of an earlier one (to under 1)."""
    word = ~F.col("text").rlike("[ .,;:!?]")
    near = lambda c: F.exists("before", lambda b: F.abs(b[c] - F.col(c)) < 1)
    earlier = Window.partitionBy("page").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    d = lines.select("page", order, "x0", "y0", word.alias("word"))
    d = d.withColumn("before", F.collect_list(F.when(F.col("word"), F.struct("x0", "y0"))).over(earlier))
    hit = lambda c: F.count_if(F.col("word") & near(c))
    return d.groupBy("page").agg(((hit("y0") > 1) | (hit("x0") > 2)).alias("legend"))


def _components(nodes: DataFrame, edges: DataFrame, *carried: str) -> DataFrame:
    """``(page, id, group)`` and the ``carried`` columns: the smallest id that edges ``page, id, r_id`` connect each node of a page with. Pages are brought together by one shuffle, and settled on whole arrays."""
    from strataframe.operators.graph import roots

    rows = nodes.select("page", "id", F.lit(None).cast("bigint").alias("other"), *carried).unionByName(edges.selectExpr("page", "id", "cast(r_id as bigint) as other"), allowMissingColumns=True)
    out = StructType([*nodes.select("page", "id", *carried).schema, StructField("group", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_groups(batches):
            edge = ~table.column("other").is_null().to_numpy()
            group = np.cumsum(np.bincount(starts, minlength=table.num_rows)) - 1
            mine = table.column("id").to_numpy().astype(np.int64)
            ids, at = np.unique(np.concatenate([mine, table.column("other").fill_null(0).to_numpy()[edge]]), return_inverse=True)
            codes, node = np.unique(np.concatenate([group, group[edge]]) * len(ids) + at, return_inverse=True)
            root = roots(len(codes), node[: len(mine)][edge], node[len(mine) :])
            found = ids[codes[root[node[: len(mine)][~edge]]] % len(ids)]
            kept = table.filter(pa.array(~edge)).select(["page", "id", *carried]).append_column("group", pa.array(found))
            yield from kept.to_batches()

    return numbered(rows, ["page"], ["id"]).mapInArrow(run, out)


def table_regions(lines: DataFrame, reach: float = 8.0) -> DataFrame:
    """H2: ``(page, id, region)`` of ``structure_lines``: lines that cross, or one of which has an end within ``reach`` of the other, are connected; regions with lines of both directions."""
    from strataframe.operators.matching import range_join

    seg = F.struct(*SIDES).alias("seg")
    wide = lines.select("page", "id", seg, (F.col("x0") - reach).alias("x0"), (F.least("y0", "y1") - reach).alias("y0"), (F.col("x1") + reach).alias("x1"), (F.greatest("y0", "y1") + reach).alias("y1"))
    j = range_join(wide, wide, ["page"]).filter("id < r_id")
    a, b = _box(F.col("seg")), _box(F.col("r_seg"))
    ends = F.array(*[F.struct(F.col(s).alias("s"), x.alias("x"), y.alias("y")) for s, o in (("seg", b), ("r_seg", a)) for x, y in ((o.x0, o.y0), (o.x1, o.y1))])
    meets = F.exists(ends, lambda p: G.distance_to_segment(_box(p["s"]), p["x"], p["y"]) <= reach) | G.segments_intersect(a, b)  # one expression for the four ends
    found = _components(lines, j.filter(meets), "is_vertical")
    w = Window.partitionBy("page", "group")
    both = (F.max(F.col("is_vertical").cast("int")).over(w) == 1) & (F.min(F.col("is_vertical").cast("int")).over(w) == 0)
    return found.withColumn("__b", both).filter("__b").select("page", "id", F.col("group").alias("region"))


def pattern_density(boxes: DataFrame, pages: DataFrame, share: float) -> DataFrame:
    """H4: ``(page, density)``: boxes whose middles lie within ``share`` of the page's ``width`` are connected; the areas of the groups' outer boxes over the page's ``width * height``, at most 1, and 0 without boxes."""
    from strataframe.operators.matching import range_join

    eps = F.col("width") * share
    m = boxes.join(pages.select("page", "width"), "page").withColumns({"mx": (F.col("x0") + F.col("x1")) / 2, "my": (F.col("y0") + F.col("y1")) / 2, "eps": eps})
    half = lambda c, sign: (F.col(c) + sign * (F.col("eps") / 2 + 1e-9)).alias
    wide = m.select("page", "id", "mx", "my", "eps", half("mx", -1)("x0"), half("my", -1)("y0"), half("mx", 1)("x1"), half("my", 1)("y1"))
    near = F.hypot(F.col("mx") - F.col("r_mx"), F.col("my") - F.col("r_my")) <= F.col("eps")
    edges = range_join(wide, wide.select("page", "id", "mx", "my", *SIDES), ["page"]).filter(F.col("id") < F.col("r_id")).filter(near)
    areas = _components(boxes, edges, *SIDES).groupBy("page", "group").agg(((F.max("x1") - F.min("x0")) * (F.max("y1") - F.min("y0"))).alias("a"))
    total = areas.groupBy("page").agg(F.sum("a").alias("a"))
    return pages.join(total, "page", "left").select("page", F.least(F.lit(1.0), F.coalesce("a", F.lit(0.0)) / (F.col("width") * F.col("height"))).alias("density"))


def depth_pairs(entries: DataFrame, words: DataFrame, order: str = "id") -> DataFrame:
    """``(page, <order>, other)``: each entry with the first one of the page that has a greater value, about its height and starts near its right end, with at most an ``m`` and punctuation between; entries without one are left out."""
    w = words.groupBy("page").agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), "x0", "y0", "text"))).alias("words"))
    e = entries.groupBy("page").agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), "value", *SIDES))).alias("a"))
    d = e.join(w, "page", "left").select("page", "a", "words", F.explode("a").alias("e"))
    me = F.col("e")
    h = me["y1"] - me["y0"]
    level = lambda y: y.between(me["y0"] - h / 2, me["y0"] + h / 2)

    def fits(o: Column) -> Column:
        near = o["x0"].between(F.greatest(me["x0"], me["x1"] - h), me["x0"] + (me["x1"] - me["x0"]) + (o["x1"] - o["x0"]))
        between = F.transform(F.filter("words", lambda t: (t["x0"] > me["x0"]) & (t["x0"] < o["x0"]) & level(t["y0"])), lambda t: t["text"])
        plain = F.regexp_like(F.array_join(F.coalesce(between, F.array().cast("array<string>")), " "), F.lit(r"(?U)^\W*m?\W*$"))
        return (o["o"] != me["o"]) & (o["value"] > me["value"]) & near & level(o["y0"]) & plain

    return d.select("page", me["o"].alias(order), F.get(F.filter("a", fits), F.lit(0))["o"].alias("other")).filter("other is not null")
