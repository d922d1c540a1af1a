"""Page features by range joins (operators F15-F18, J7, P12, U4, D4, D8)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataframe.functions import geometry as G
from strataframe.functions import parse as P
from strataframe.operators.matching import near_lines, range_join
from strataframe.operators.sequence import best_choice, grouped

NOISE = r"^[\s01oO8|/()\-.,=_]+$"


def symbol_pair(top: G.Box, bottom: G.Box, hit: G.Box, text_height: Column) -> Column:
    """F16 without its text test: the lower stroke is shorter, spanned by the upper and close to it; the upper is of text size and over or under the text."""
    a, b = G.length(top), G.length(bottom)
    size = (b < 0.8 * a) & (b > a / 4) & (a > text_height) & (a < 3 * text_height)
    place = (top.x0 < bottom.x0) & (bottom.x1 < top.x1) & (hit.x0 < top.x1) & (top.x0 < hit.x1)
    return size & place & (bottom.y0 - top.y0 < b / 3)


def symbol_pairs(segments: DataFrame, texts: DataFrame, hits: DataFrame, page: str = "page") -> DataFrame:
    """F16: ``(page, hit, top, bottom)`` of stroke pairs by a text that holds a depth or date, with no text between them; ids are in ``id``."""
    mean = texts.groupBy(page).agg(F.avg(F.col("y1") - F.col("y0")).alias("th"))
    part = lambda d, p: d.select(page, *[F.col(c).alias(p + c) for c in ("id", "x0", "y0", "x1", "y1")])
    # strokes about each hit first, by grid cells: a pair is formed only of those near one hit
    h = G.box("h_")
    w, v = G.width(h), G.height(h)
    around = part(hits, "h_").withColumns({"x0": h.x0 - w, "y0": h.y0 - v, "x1": h.x1 + w, "y1": h.y1 + v})
    flat = segments.filter(G.is_horizontal(G.box(), 0.1)).select(page, "id", F.struct("x0", "y0", "x1", "y1").alias("s"), *[(F.col(c) + e).alias(c) for c, e in (("x0", -1e-6), ("x1", 1e-6))], (F.least("y0", "y1") - 1e-6).alias("y0"), (F.greatest("y0", "y1") + 1e-6).alias("y1"))
    s = G.Box(*[F.col(f"r_s.{c}") for c in ("x0", "y0", "x1", "y1")])
    inside = lambda x, y: x.between(h.x0 - w, h.x1 + w) & y.between(h.y0 - v, h.y1 + v)
    near = range_join(around, flat, [page]).filter((inside(s.x0, s.y0) | inside(s.x1, s.y1)) & (G.length(s) < 3 * w))
    stroke = lambda p: near.select(page, "h_id", F.col("r_id").alias(f"{p}id"), *[F.col(f"r_s.{c}").alias(p + c) for c in ("x0", "y0", "x1", "y1")])
    j = stroke("t_").join(stroke("b_"), [page, "h_id"]).filter("t_y0 < b_y0 or (t_y0 = b_y0 and t_id < b_id)").join(part(hits, "h_"), [page, "h_id"]).join(mean, page)
    j = j.filter(symbol_pair(G.box("t_"), G.box("b_"), h, F.col("th")))
    gap = [j[page] == F.col("x.page"), F.col("x.x0") < j["t_x1"], j["t_x0"] < F.col("x.x1"), F.col("x.y0") < j["b_y0"], j["t_y0"] < F.col("x.y1")]
    clear = j.join(texts.withColumnRenamed(page, "page").alias("x"), gap, "left_anti")
    return clear.select(page, F.col("h_id").alias("hit"), F.col("t_id").alias("top"), F.col("b_id").alias("bottom"))


def has_text(sections: DataFrame, texts: DataFrame, threshold: float = 0.1, penalty: float = 1.0, tau: float = 5.0) -> DataFrame:
    """adds ``is_text`` to sections (``page, id`` and a box): covered by much or long text, texts of scan noise aside."""
    real = texts.filter(~F.col("text").rlike(NOISE)).select("page", "text", "x0", "y0", "x1", "y1")
    j = range_join(sections.select("page", "id", "x0", "y0", "x1", "y1"), real, ["page"])
    a, b = G.box(), G.box("r_")
    shared = G.x_overlap(a, b) * G.y_overlap(a, b)
    g = j.groupBy("page", "id").agg(F.sum(F.try_divide(shared, G.area(a))).alias("cover"), F.sum(F.length("r_text") * F.coalesce(F.try_divide(shared, G.area(b)), F.lit(0.0))).alias("chars"))
    score = F.pow(F.greatest(F.lit(0.0), 1 - F.col("cover")) * F.exp(-F.col("chars") / tau), F.lit(penalty))
    found = g.select("page", "id", (score < threshold).alias("is_text"))
    return sections.join(found, ["page", "id"], "left").withColumn("is_text", F.coalesce("is_text", F.lit(False)))


def fallback_pages(pages: DataFrame, tables: DataFrame, strips: DataFrame, share: float = 0.85) -> DataFrame:
    """pages with a strip log, or whose tallest table reaches the share of the page's height."""
    tall = tables.groupBy("page").agg(F.max(F.col("y1") - F.col("y0")).alias("tall"))
    strip = strips.select("page").distinct().withColumn("strip", F.lit(True))
    return pages.join(tall, "page", "left").join(strip, "page", "left").filter((F.col("tall") >= share * F.col("height")) | F.col("strip")).select("page")


def below_header(columns: DataFrame, headers: DataFrame, gap: float = 40.0, level: float = 0.2) -> DataFrame:
    """columns with a header line at most ``gap`` above that shares over ``level`` of the smaller width."""
    h = headers.select(F.col("page").alias("h_page"), *[F.col(c).alias(f"h_{c}") for c in ("x0", "y0", "x1", "y1")])
    a, b = G.box(), G.box("h_")
    return columns.join(h, (F.col("page") == F.col("h_page")) & (b.y1 <= a.y0) & (a.y0 - b.y1 <= gap) & G.x_overlap_significant(a, b, level), "left_semi")


def noise_counts(sidebars: DataFrame, lines: DataFrame, entries: DataFrame, level: float = 0.25) -> DataFrame:
    """``(page, id, noise)``: lines with a letter or digit that meet the sidebar's box, share over ``level`` of the smaller width with it and touch none of its entries."""
    words = unused(lines.filter(F.col("text").rlike(r"[\p{L}\p{N}]")), entries)
    j = range_join(sidebars.select("page", "id", "x0", "y0", "x1", "y1"), words.select("page", "x0", "y0", "x1", "y1"), ["page"], lambda a, b: G.x_overlap_significant(a, b, level))
    n = j.groupBy("page", "id").agg(F.count("*").alias("noise"))
    return sidebars.select("page", "id").join(n, ["page", "id"], "left").withColumn("noise", F.coalesce("noise", F.lit(0)))


def unused(entries: DataFrame, used: DataFrame) -> DataFrame:
    """U4: entries that intersect none of the boxes already used on their page."""
    u = used.select(F.col("page").alias("u_page"), *[F.col(c).alias(f"u_{c}") for c in ("x0", "y0", "x1", "y1")])
    return entries.join(u, (F.col("page") == F.col("u_page")) & G.intersects(G.box(), G.box("u_")), "left_anti")


def pair_columns(scores: DataFrame) -> DataFrame:
    """J7 over rows ``page, sidebar, rect, score`` and the union box: best score first while the union meets no accepted one; a sidebar left over takes its best rect anyway. Ties go to the smaller ids."""

    def meets(a: dict, b: dict) -> bool:
        return a["x0"] < b["x1"] and b["x0"] < a["x1"] and a["y0"] < b["y1"] and b["y0"] < a["y1"]

    def fold(rows: list[dict]) -> list[dict]:
        ranked = sorted(rows, key=lambda r: (-r["score"], r["sidebar"], r["rect"]))
        taken: list[dict] = []
        for r in ranked:
            if all(r["sidebar"] != t["sidebar"] and not meets(r, t) for t in taken):
                taken.append(r)
        have = {t["sidebar"] for t in taken}
        for r in ranked:
            if r["sidebar"] not in have:
                have.add(r["sidebar"])
                taken.append(r)
        return taken

    return grouped(scores, ["page"], ["sidebar", "rect"], fold, "page bigint, sidebar bigint, rect bigint, score double")


def elevation_near_key(keys: DataFrame, lines: DataFrame) -> DataFrame:
    """For each key line the first line of its band, in reading order, that holds an elevation."""
    near = near_lines(keys.select("page", "id", "x0", "y0", "x1", "y1"), lines, ["page"], 0, 5, 4, 0).withColumn("elevation", P.parse_elevation("r_text"))
    first = best_choice(near.filter("elevation is not null"), ["page", "id"], F.col("r_y0"), F.col("r_x0"), F.col("r_id"))
    return first.select("page", "id", "elevation")


def groundwater_near_key(keys: DataFrame, lines: DataFrame, max_depth: float = 200.0) -> DataFrame:
    """Per key line the first date, depth and elevation among the lines of its band; keys without a depth and an elevation drop out."""
    near = near_lines(keys.select("page", "id", "x0", "y0", "x1", "y1"), lines, ["page"], 2, 8, 2, 0)
    w = Window.partitionBy("page", "id").orderBy("r_y0", "r_x0", "r_id").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first = lambda c: F.first(c, ignorenulls=True).over(w)
    found = near.select("page", "id", first(P.parse_date("r_text")).alias("date"), first(P.parse_depth("r_text", max_depth)).alias("depth"), first(P.parse_elevation("r_text")).alias("elevation")).distinct()
    return found.filter("depth is not null or elevation is not null")


def page_features(pages: DataFrame, **tables: DataFrame) -> DataFrame:
    """A row a page with the number of rows each table has for it."""
    out = pages.select("page")
    for name, t in tables.items():
        out = out.join(t.groupBy("page").agg(F.count("*").alias(f"n_{name}")), "page", "left")
    return out.fillna(0, [f"n_{n}" for n in tables])
