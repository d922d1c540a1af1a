"""Alignment, greedy matching and suppression (operators J1-J14, O1-O4, W10, W11).

Joins on boxes meet by key, in grid cells where a key is large, and then by the exact condition. Loops whose
result depends on their order run once a group in Arrow batches; groups are pages
or files, so no group grows with the corpus.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strataframe.functions import geometry as G
from strataframe.functions.text import indel_ratio, ratio
from strataframe.operators.sequence import grouped, numbered, whole_groups

CELL = 50.0


#: Candidate pairs that are looked at at a time.
CANDIDATES = 1 << 20
#: Groups with more candidates than this are cut into grid cells.
WHOLE_GROUP = 1 << 12


def _expand(first: np.ndarray, count: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of rows that meet ``count`` places from ``first`` on: the rows' numbers and the places, ``CANDIDATES`` or so at a time."""
    ends = np.cumsum(count)
    at = 0
    while at < len(count):
        done = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, done + CANDIDATES, "right")))
        for low in range(0, int(count[at]), CANDIDATES) if stop == at + 1 else (0,):  # one row may meet more
            n = count[at:stop] if stop > at + 1 else np.minimum(count[at:stop] - low, CANDIDATES)
            rows = np.repeat(np.arange(at, stop), n)
            yield rows, first[rows] + low + np.arange(len(rows)) - np.repeat(np.cumsum(n) - n, n)
        at = stop


def _meet(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a[0] < b[2]) & (b[0] < a[2]) & (a[1] < b[3]) & (b[1] < a[3])


def _cells(box: np.ndarray, cell: float) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of the boxes, once a grid cell that they touch, and the cells."""
    c = np.floor(box / cell).astype(np.int64)
    low, n = np.minimum(c[:2], c[2:]), np.abs(c[2:] - c[:2]) + 1
    count = n[0] * n[1]
    rows = np.repeat(np.arange(box.shape[1]), count)
    k = np.arange(len(rows)) - np.repeat(np.cumsum(count) - count, count)
    return rows, np.stack([low[0][rows] + k % n[0][rows], low[1][rows] + k // n[0][rows]])


def _pairs(box: np.ndarray, starts: np.ndarray, lefts: np.ndarray, ends: np.ndarray, cell: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The numbers of the rows whose boxes meet: of each group, those from its start on against those after its ``lefts``."""
    work = lefts * (ends - starts - lefts)
    small = work <= WHOLE_GROUP
    n = np.where(small, lefts, 0)
    rows = np.repeat(starts, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    for k, right in _expand(np.repeat(starts + lefts, n), np.repeat(ends - starts - lefts, n)):
        hit = _meet(box[:, rows[k]], box[:, right])
        yield rows[k[hit]], right[hit]
    for s, m, e in zip(starts[~small], lefts[~small], ends[~small]):
        left, right = (at[np.isfinite(box[:, at]).all(axis=0)] for at in (np.arange(s, s + m), np.arange(s + m, e)))
        (lr, lc), (rr, rc) = _cells(box[:, left], cell), _cells(box[:, right], cell)
        _, code = np.unique(np.concatenate([lc, rc], axis=1), axis=1, return_inverse=True)
        lk, rk = code.ravel()[: len(lr)], code.ravel()[len(lr) :]
        by_cell = np.argsort(rk, kind="stable")
        first = np.searchsorted(rk[by_cell], lk)
        for k, at in _expand(first, np.searchsorted(rk[by_cell], lk, "right") - first):
            x, y = left[lr[k]], right[rr[by_cell[at]]]
            home = np.floor(np.maximum(box[:2, x], box[:2, y]) / cell)  # a pair counts in one of its cells
            hit = _meet(box[:, x], box[:, y]) & (home == lc[:, k]).all(axis=0)
            yield x[hit], y[hit]


def range_join(left: DataFrame, right: DataFrame, by: list[str], condition: Callable[[G.Box, G.Box], Column] = G.intersects, cell: float = CELL) -> DataFrame:
    """Pairs of intersecting boxes within a key that also meet ``condition``; right columns get the prefix ``r_``.

    Both sides are brought together by the key and matched on whole arrays, so a row is shuffled once at most, and not
    at all where its table is parted by the key already. Boxes of a large key are sent to all grid cells they touch; a
    pair is reported only in the cell of the upper left corner of its overlap, so none appears twice.
    """
    r = right.toDF(*[f"r_{c}" for c in right.columns])
    a, b = G.box(), G.box("r_")
    kinds = {f.name: f.dataType for f in left.schema}
    # a column that both sides have is one column of both
    shared = {c for c in right.columns if c in kinds and kinds[c] == right.schema[c].dataType}
    place = {c: c if c in shared else f"r_{c}" for c in right.columns}
    keys = [k if k in shared else f"__k{i}" for i, k in enumerate(by)]
    loose = [(k, n) for k, n in zip(by, keys) if k != n]
    lonely = [c for c in right.columns if c not in shared]
    none = lambda kind, name: F.lit(None).cast(kind).alias(name)
    one = left.select(F.lit(0).alias("__s"), *left.columns, *[none(right.schema[c].dataType, f"r_{c}") for c in lonely], *[F.col(k).alias(n) for k, n in loose])
    two = right.select(
        F.lit(1).alias("__s"), *[F.col(c) if c in shared else none(kinds[c], c) for c in left.columns], *[F.col(c).alias(f"r_{c}") for c in lonely], *[F.col(k).alias(n) for k, n in loose]
    )
    both = one.dropna(subset=keys).unionByName(two.dropna(subset=keys))
    out = StructType([*left.schema, *r.schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_groups(batches):
            table = table.combine_chunks()
            side = table.column("__s").to_numpy()
            numbers = lambda c: table.column(c).to_numpy().astype(float)  # noqa: E731, B023
            box = np.stack([numbers(c) if c in shared else np.where(side == 0, numbers(c), numbers(f"r_{c}")) for c in ("x0", "y0", "x1", "y1")])  # noqa: B023
            lefts = np.add.reduceat(1 - side.astype(np.int64), starts)
            mine, other = table.select(left_names), table.select(right_names)
            for x, y in _pairs(box, starts, lefts, np.append(starts[1:], table.num_rows), cell):
                if len(x):
                    columns = [*mine.take(pa.array(x)).columns, *other.take(pa.array(y)).columns]
                    yield pa.RecordBatch.from_arrays([c.combine_chunks() for c in columns], names=names)

    left_names, right_names, names = left.columns, [place[c] for c in right.columns], out.names
    return numbered(both, keys, ["__s"]).mapInArrow(run, out).filter(condition(a, b))


def segments_near(boxes: DataFrame, segments: DataFrame, margin: float, cell: float = CELL) -> DataFrame:
    """``(page, id, segment)``: the segments with an end within ``margin`` of a box, bounds included; an end stands in one grid cell, a widened box in all it touches."""
    cells = lambda lo, hi: F.sequence(F.floor((F.col(lo) - margin) / cell), F.floor((F.col(hi) + margin) / cell))
    wide = boxes.select("page", "id", "x0", "y0", "x1", "y1").withColumn("cx", F.explode(cells("x0", "x1"))).withColumn("cy", F.explode(cells("y0", "y1")))
    ends = segments.select("page", F.col("id").alias("segment"), F.explode(F.array(F.struct(F.col("x0").alias("x"), F.col("y0").alias("y")), F.struct(F.col("x1").alias("x"), F.col("y1").alias("y")))).alias("p"))
    ends = ends.select("page", "segment", "p.x", "p.y").withColumns({"cx": F.floor(F.col("x") / cell), "cy": F.floor(F.col("y") / cell)})
    near = F.col("x").between(F.col("x0") - margin, F.col("x1") + margin) & F.col("y").between(F.col("y0") - margin, F.col("y1") + margin)
    return wide.join(ends, ["page", "cx", "cy"]).filter(near).select("page", "id", "segment").distinct()


def near_lines(keys: DataFrame, lines: DataFrame, by: list[str], left: float, right: float, below: float, above: float) -> DataFrame:
    """Lines that intersect the key's band, widened by factors of its width to both sides, or of its height up and down; equal rows once.

    One join finds the lines that meet the box around both bands. As a pair holds all columns of both sides, pairs are
    distinct where their sides are, which takes no shuffle of pairs.
    """
    own = G.Box(*[F.col(f"k_{c}") for c in ("x0", "y0", "x1", "y1")])
    w, h = G.width(own), G.height(own)
    wide, tall = G.Box(own.x0 - left * w, own.y0, own.x1 + right * w, own.y1), G.Box(own.x0, own.y0 - above * h, own.x1, own.y1 + below * h)
    names = keys.columns
    k = keys.distinct().withColumns({f"k_{c}": F.col(c) for c in ("x0", "y0", "x1", "y1")})
    k = k.withColumns({"x0": F.least(wide.x0, tall.x0), "y0": F.least(wide.y0, tall.y0), "x1": F.greatest(wide.x1, tall.x1), "y1": F.greatest(wide.y1, tall.y1)})
    found = range_join(k, lines.distinct(), by).filter(G.intersects(wide, G.box("r_")) | G.intersects(tall, G.box("r_")))
    back = [F.col(f"k_{c}").alias(c) if c in ("x0", "y0", "x1", "y1") else F.col(c) for c in names]
    return found.select(*back, *[f"r_{c}" for c in lines.columns])


def suppress(df: DataFrame, by: list[str], score: str, ident: str) -> DataFrame:
    """O1, O2: non-maximum suppression a group: by falling score (the smaller id of equals), boxes that intersect a kept one go; negative scores go."""
    s = F.struct((-F.col(score)).alias("k"), F.col(ident).alias("id"), *[F.col(c) for c in ("x0", "y0", "x1", "y1")], F.col(score).alias("score"))
    g = df.filter(F.col(score) >= 0).groupBy(*by).agg(F.array_sort(F.collect_list(s)).alias("a"))
    hit = lambda x: lambda y: G.intersects(G.Box(x["x0"], x["y0"], x["x1"], x["y1"]), G.Box(y["x0"], y["y0"], y["x1"], y["y1"]))
    kept = F.aggregate("a", F.slice("a", 1, 0), lambda acc, x: F.when(F.exists(acc, hit(x)), acc).otherwise(F.concat(acc, F.array(x))))
    return g.select(*by, F.explode(kept).alias("x")).select(*by, F.col("x.id").alias(ident), "x.x0", "x.y0", "x.x1", "x.y1", F.col("x.score").alias(score))


def keep_longest(df: DataFrame, by: list[str], size: str, ident: str) -> DataFrame:
    """By falling size, boxes that lie inside a kept one go."""
    s = F.struct((-F.col(size)).alias("k"), F.col(ident).alias("id"), *[F.col(c) for c in ("x0", "y0", "x1", "y1")])
    g = df.groupBy(*by).agg(F.array_sort(F.collect_list(s)).alias("a"))
    inside = lambda x: lambda y: G.contains(G.Box(y["x0"], y["y0"], y["x1"], y["y1"]), G.Box(x["x0"], x["y0"], x["x1"], x["y1"]))
    kept = F.aggregate("a", F.slice("a", 1, 0), lambda acc, x: F.when(F.exists(acc, inside(x)), acc).otherwise(F.concat(acc, F.array(x))))
    return g.select(*by, F.explode(kept).alias("x")).select(*by, F.col("x.id").alias(ident), "x.x0", "x.y0", "x.x1", "x.y1")


def align(scores: list[list[float]]) -> tuple[float, list[tuple[int, int]]]:
    """The order-preserving pairs of greatest total score; ties prefer a pair, then skipping a left item, then a right one. The score is divided by the longer side."""
    n, m = len(scores), len(scores[0]) if scores else 0
    if not n or not m:
        return 0.0, []
    d = [[0.0] * (m + 1) for _ in range(n + 1)]
    for i in range(1, n + 1):
        for j in range(1, m + 1):
            d[i][j] = max(d[i - 1][j - 1] + scores[i - 1][j - 1], d[i - 1][j], d[i][j - 1])
    i, j, pairs = n, m, []
    while i and j:
        if d[i][j] == d[i - 1][j - 1] + scores[i - 1][j - 1]:
            i, j = i - 1, j - 1
            pairs.append((i, j))
        elif d[i][j] == d[i - 1][j]:
            i -= 1
        else:
            j -= 1
    return d[n][m] / max(n, m), pairs[::-1]


def align_zones(scores: list[list[float]], bonus: list[float], penalty: float = 0.2) -> tuple[float, list[tuple[int, list[int]]]]:
    """Every line goes to a zone, in order: it opens the next zone or joins the line before (plus its affinity); an empty zone costs ``penalty``.

    Zones passed over while lines remain appear with no lines; zones before the first used one don't appear.
    """
    n, m = len(scores), len(bonus)
    if not n or not m:
        return 0.0, []
    low = float("-inf")
    d = [[low] * (m + 1) for _ in range(n + 1)]
    move = [[""] * (m + 1) for _ in range(n + 1)]
    for i in range(n + 1):
        d[i][0] = -penalty * i
    for i in range(1, n + 1):
        for j in range(1, m + 1):
            s = scores[i - 1][j - 1]
            choices = (d[i - 1][j - 1] + s, d[i - 1][j] - penalty, d[i][j - 1] + s + bonus[j - 1])
            d[i][j] = max(choices)
            move[i][j] = "zuj"[choices.index(d[i][j])]
    i, j, found = n, m, {}
    while i and j:
        step = move[i][j]
        mine = found.setdefault(i - 1, [])
        if step != "u":
            j -= 1
            mine.insert(0, j)
        if step != "j":
            i -= 1
    return d[n][m] / max(n, m), sorted(found.items())


def align_zone_lines(zones: DataFrame, lines: DataFrame, bonus: DataFrame, kind: str) -> DataFrame:
    """J4 on tables: ``(page, zone, id)``, the zone of every line, from zones as ``page.zones`` gives them, lines with boxes and ``(page, id, bonus)``; a zone that stays empty between others has a null line."""
    from strataframe.operators.page import zone_score

    pairs = zones.join(lines, "page")
    scored = pairs.select("page", "zone", "id", zone_score(kind, G.box("s_"), G.box("e_"), G.box()).alias("score"), F.lit(None).cast("double").alias("bonus"))
    rows = scored.unionByName(bonus.select("page", F.lit(None).cast("bigint").alias("zone"), "id", F.lit(None).cast("double").alias("score"), F.col("bonus").cast("double").alias("bonus")))

    def fold(rows: list[dict]) -> list[dict]:
        gain = {r["id"]: r["bonus"] for r in rows if r["zone"] is None}
        score = {(r["zone"], r["id"]): r["score"] for r in rows if r["zone"] is not None and r["id"] in gain}
        zone, line = sorted({z for z, _ in score}), sorted({i for _, i in score})
        _, found = align_zones([[score[z, i] for i in line] for z in zone], [gain[i] for i in line])
        return [{"page": rows[0]["page"], "zone": zone[k], "id": i} for k, mine in found for i in ([line[j] for j in mine] or [None])]

    return grouped(rows, ["page"], ["zone", "id"], fold, "page bigint, zone bigint, id bigint")


def layer_score(p: dict, t: dict, kind: str = "layer") -> float:
    """Half a point a depth bound that is equal (nulls are equal), a point for texts alike to 0.9; "layer" needs the mean of both."""
    eq = lambda a, b: 0.5 if a == b else 0.0
    depth = eq(p["start"], t["start"]) + eq(p["end"], t["end"])
    clean = lambda s: "".join(c for c in (s or "") if c.isalnum() or c == "_").lower()
    text = 1.0 if ratio(clean(p["text"]), clean(t["text"])) >= 0.9 else 0.0
    return {"depth": depth, "text": text, "layer": (depth + text) / 2}[kind]


def align_layers(df: DataFrame, by: str, kind: str = "layer") -> DataFrame:
    """J5 a group over rows ``side`` ('p' or 't'), ``pos, start, end, text``: ``(by, p_pos, t_pos, score)`` of the matched pairs."""

    def fold(rows: list[dict]) -> list[dict]:
        p, t = ([r for r in rows if r["side"] == s] for s in "pt")
        score, pairs = align([[layer_score(a, b, kind) for b in t] for a in p])
        return [{by: rows[0][by], "p_pos": p[i]["pos"], "t_pos": t[j]["pos"], "score": score} for i, j in pairs]

    return grouped(df, [by], ["side", "pos"], fold, f"{by} {dict(df.dtypes)[by]}, p_pos bigint, t_pos bigint, score double")


def greedy_pairs(df: DataFrame, by: str, left: str, right: str, score: str, least: float = 0.0) -> DataFrame:
    """Best score first (then the smaller ids), each side used once; pairs under ``least`` never."""

    def fold(rows: list[dict]) -> list[dict]:
        a, b, out = set(), set(), []
        for r in sorted(rows, key=lambda r: (-r[score], r[left], r[right])):
            if r[score] >= least and r[left] not in a and r[right] not in b:
                a.add(r[left])
                b.add(r[right])
                out.append(r)
        return out

    t = dict(df.dtypes)
    return grouped(df.select(by, left, right, score), [by], [left, right], fold, f"{by} {t[by]}, {left} {t[left]}, {right} {t[right]}, {score} {t[score]}")


def similar_texts(left: DataFrame, right: DataFrame, by: str, ident: str, text: str, least: float) -> DataFrame:
    """``(by, left_id, right_id, ratio)`` of the texts of one key whose Indel ratio is at least ``least``.

    A pair is compared only if its lengths (and then the counts of its letters a to z) allow the ratio: a
    common subsequence is no longer than the shorter text.
    """
    letters = [F.length(text) - F.length(F.replace(text, F.lit(c))) for c in map(chr, range(97, 123))]
    part = lambda d, name: d.select(by, F.col(ident).alias(f"{name}_id"), F.col(text).alias(f"{name}_t"), F.length(text).alias(f"{name}_n"), F.array(*letters).alias(f"{name}_c"))
    total = F.col("left_n") + F.col("right_n")
    j = part(left, "left").join(part(right, "right"), by).filter(2 * F.least("left_n", "right_n") >= least * total)
    common = F.aggregate(F.zip_with("left_c", "right_c", lambda a, b: F.least(a, b)), F.lit(0), lambda s, x: s + x)
    others = lambda name: F.col(f"{name}_n") - F.aggregate(f"{name}_c", F.lit(0), lambda s, x: s + x)
    j = j.filter(2 * (common + F.least(others("left"), others("right"))) >= least * total)
    return j.select(by, "left_id", "right_id", indel_ratio("left_t", "right_t").alias("ratio")).filter(F.col("ratio") >= least)


def nearest(points: DataFrame, boxes: DataFrame, by: list[str], point_id: str, box_id: str) -> DataFrame:
    """Each point's nearest box of its key, the smaller id of equals; points of keys without a box drop out."""
    dx = F.greatest(F.lit(0.0), F.col("x0") - F.col("px"), F.col("px") - F.col("x1"))
    dy = F.greatest(F.lit(0.0), F.col("y0") - F.col("py"), F.col("py") - F.col("y1"))
    j = points.join(boxes, by).withColumn("distance", F.hypot(dx, dy))
    best = j.groupBy(*by, point_id).agg(F.min(F.struct("distance", box_id)).alias("m"))
    return best.select(*by, point_id, F.col(f"m.{box_id}").alias(box_id), F.col("m.distance").alias("distance"))


def _alike(a: dict, b: dict, edge: str = "") -> bool:
    x, y = (a["text"] or "").lower(), (b["text"] or "").lower()
    n = min(len(x), len(y))
    best = ratio(x, y)
    if edge == "first":
        best = max(best, ratio(x[len(x) - n :], y[len(y) - n :]))
    elif edge == "last":
        best = max(best, ratio(x[:n], y[:n]))
    near = lambda p, q: not p or not q or abs(p - q) <= 0.01
    return best > 0.95 and near(a["start"], b["start"]) and near(a["end"], b["end"])


def page_overlap(before: list[dict], after: list[dict]) -> tuple[int, int] | None:
    """Where two pages' layer lists overlap: the cut of the first and of the second, or None."""
    n, m = len(before), len(after)
    for k in range(min(n, m), 0, -1):
        streak = 0
        for j in range(k):
            a, b = before[n - k + j], after[j]
            if not _alike(a, b, "first" if j == 0 else "last" if j == k - 1 else ""):
                if streak >= 2:
                    return n - k + j, j
                break
            complete = all(r[c] is not None for r in (a, b) for c in ("start", "end"))
            streak = streak + 1 if complete else 0
        else:
            return n, k
    return None


def stitch_pages(df: DataFrame, by: str) -> DataFrame:
    """W10, W11 over rows ``page, pos, start, end, text``: overlapping layers once, an open end and the open start after it as one layer, a first open start as 0."""

    def fold(rows: list[dict]) -> list[dict]:
        out: list[dict] = []
        for page in sorted({r["page"] for r in rows}):
            new = [dict(r) for r in rows if r["page"] == page]
            cut = page_overlap(out, new) if out else None
            if cut:
                if cut[1] == len(new) or cut[0] == len(out):
                    out[-1] = out[-1] | {"end": new[cut[1] - 1]["end"]}
                out = out[: cut[0]] + new[cut[1] :]
            elif out and out[-1]["end"] is None and new[0]["start"] is None and out[-1]["start"] is not None and new[0]["end"] is not None and out[-1]["start"] < new[0]["end"]:
                joined = " ".join(x for x in (out[-1]["text"], new[0]["text"]) if x)
                out = [*out[:-1], out[-1] | {"end": new[0]["end"], "text": joined}, *new[1:]]
            else:
                out += new
        if out and out[0]["start"] is None and out[0]["end"] is not None:
            out[0] = out[0] | {"start": 0.0}
        return [{by: rows[0][by], "pos": i, "start": r["start"], "end": r["end"], "text": r["text"]} for i, r in enumerate(out)]

    return grouped(df, [by], ["page", "pos"], fold, f"{by} {dict(df.dtypes)[by]}, pos bigint, start double, end double, text string")
