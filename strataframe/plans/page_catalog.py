"""Queries of the page rules over the driver's tables, and the SQL that gives the same rows.

A line item is a text line (its order the page), a rule on the page, an interval or a depth
entry; nulls, open ends, ties and equal rows are made from the keys.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from strataframe.functions import geometry as G
from strataframe.functions import parse as P
from strataframe.functions import text as T
from strataframe.operators import features, layout, matching, metrics, page, sequence
from strataframe.plans.catalog import ITEMS_SQL, LANGUAGES, boxes, items, query, read

#: The same expressions are Spark's and DuckDB's.
LINE = {
    "x0": "cast(l_partkey % 6 * 4 as double)",
    "y0": "cast(pos * 12 + l_suppkey % 5 as double)",
    "x1": "cast(l_partkey % 6 * 4 + 40 as double) + l_quantity",
    "y1": "cast(pos * 12 + l_suppkey % 5 + 10 as double)",
}
RULE = {
    "x0": "cast(l_partkey % 50 as double)",
    "y0": "cast(pos * 13 + 4 as double)",
    "x1": "cast(l_partkey % 50 as double) + l_quantity * 2",
    "y1": "cast(pos * 13 + 4 + (l_suppkey % 4 - 1) * 6 as double)",
}
SPAN = {"s": "cast(l_suppkey % 12 as double)", "e": "case when l_partkey % 7 = 0 then cast(null as double) else l_suppkey % 12 + l_quantity % 9 end"}
TEXT = "case when l_partkey % 4 = 0 then '' else lower(l_returnflag || l_linestatus) end"


def table(spark, sf, *shapes):
    return items(spark, sf).selectExpr("l_orderkey as page", "pos as id", *[f"{v} as {k}" for s in shapes for k, v in s.items()])


def sql(*shapes):
    return f"select l_orderkey as page, pos as id, {', '.join(f'{v} as {k}' for s in shapes for k, v in s.items())} from {ITEMS_SQL}"


LINES_SQL, RULES_SQL = f"l as ({sql(LINE)})", f"g as ({sql(RULE)})"


@query(f"""with {LINES_SQL}, n as (select a.page, a.id, case when b.id < a.id then 'up' else 'down' end as way, abs(b.id - a.id) as far, a.y1 - a.y0 as h, b.x0 - a.x0 as shift,
  greatest(b.y0 - a.y1, a.y0 - b.y1) as gap from l a join l b on a.page = b.page and a.id <> b.id
  and greatest(0, least(a.x1, b.x1) - greatest(a.x0, b.x0)) > 0.5 * greatest(a.x1 - a.x0, b.x1 - b.x0)),
r as (select *, row_number() over (partition by page, id, way order by far) as k, abs(shift) < 0.2 * h as exact, shift > 0 and shift < 2 * h as ind, gap > 5 * h or not (abs(shift) < 0.2 * h or (shift > 0 and shift < 2 * h)) as stop from n),
c as (select *, max(stop::int) over (partition by page, id, way order by k) as over from r where k <= 3),
s as (select page, id, count(*) filter (exact and over = 0) as e, count(*) filter (ind and not exact and over = 0) as i from c group by 1, 2)
select page, id, coalesce(e >= 3 or (e >= 2 and i >= 1), false) as starts from l left join s using (page, id)""")
def line_starts(spark, sf):
    """W1."""
    return page.line_starts(table(spark, sf, LINE))


INDENT_SQL = f"""{LINES_SQL}, i as (select page, id, 0::double as value, false as inside from l where id = 1
union all select l.page, l.id, v.value, v.value > 0 from i join l on l.page = i.page and l.id = i.id + 1 join l p on p.page = i.page and p.id = i.id,
lateral (select case when l.y0 > p.y1 + (p.y1 - p.y0) then 0 when i.inside then case when l.x0 >= p.x0 - 0.03 * greatest(p.x1 - p.x0, l.x1 - l.x0) then 3 else -1 end
when l.x0 between p.x0 + 0.03 * greatest(p.x1 - p.x0, l.x1 - l.x0) and p.x0 + 0.2 * greatest(p.x1 - p.x0, l.x1 - l.x0) then 1 else 0 end::double as value) v)"""


@query(f"with recursive {INDENT_SQL} select page, id, value as indentation from i")
def indentation(spark, sf):
    """W3."""
    return page.indentation(table(spark, sf, LINE))


AFFINITY_SQL = f"""{INDENT_SQL}, {RULES_SQL}, flat as (select * from g where x1 > x0 and abs((y1 - y0) / (x1 - x0)) <= 0.1), d as (select * from g where id % 2 = 0),
w as (select l.*, value, lag(x0) over o as px0, lag(y0) over o as py0, lag(x1) over o as px1, lag(y1) over o as py1, min(x0) over (partition by page) as rx0, max(x1) over (partition by page) as rx1
  from l join i using (page, id) window o as (partition by page order by id)),
v as (select *, y0 - py1 as gap, 1.15 * min(case when y0 > py0 + (py1 - py0) / 2 then y0 - py0 end) over (partition by page) as least, coalesce(max((y0 - py1 < 0)::int) over (partition by page), 0) = 1 as over,
  py0 + (py1 - py0) * 2 / 3 as top, y0 + (y1 - y0) / 3 as bottom from w),
x as (select *, lag(gap) over (partition by page order by id) as before from v),
a as (select page, id,
  case when exists (select 1 from flat g where g.page = x.page and (g.y0 + g.y1) / 2 > top and (g.y0 + g.y1) / 2 < bottom and least(rx1, g.x1) - greatest(rx0, g.x0) > 0.2 * (rx1 - rx0)) then -1 else 0 end::double as long_lines,
  case when exists (select 1 from flat g where g.page = x.page and (g.y0 + g.y1) / 2 > top and (g.y0 + g.y1) / 2 < bottom and g.x1 - g.x0 > 7 and ((g.x0 - 2 < px0 and px0 < g.x1 + 2) or (g.x0 - 2 < x.x0 and x.x0 < g.x1 + 2))) then -1 else 0 end::double as left_lines,
  case when px0 is null then 0 else coalesce(greatest(-1, 1 - (y1 - py1) / case when over then y1 - y0 else least end), 0) end as spacing,
  case when px0 is null or (x1 - px1) / (x1 - x0) < 0.15 then 0 else greatest(-1, -(x1 - px1) / (x1 - x0)) end as right_end,
  case when exists (select 1 from d where d.page = x.page and (py0 + py1) / 2 < d.y1 and d.y1 < (x.y0 + x.y1) / 2) then -1 else 0 end::double as diagonal,
  case when px0 is null or gap > 0.6 * (py1 - py0) then 0 when before is null or gap <= before + 0.2 * (py1 - py0) then 1 else 0 end::double as gap, value as indentation from x)"""


def affinities(spark, sf):
    rules = table(spark, sf, RULE)
    return page.line_affinity(table(spark, sf, LINE), rules, rules.filter("id % 2 = 0"))


@query(f"""with recursive {AFFINITY_SQL} select page, id, long_lines, left_lines, round(spacing, 6) as spacing, round(right_end, 6) as right_end, diagonal, gap, indentation,
round((3.5 * long_lines + left_lines + 1.25 * spacing + right_end + 1.25 * diagonal + 0.6 * indentation) / 8.6 * 5, 6) as weighted from a""")
def line_affinities(spark, sf):
    """The seven affinities and their weighted mean for one kind of sidebar."""
    return affinities(spark, sf).withColumn("weighted", F.round(page.weighted_affinity("a_above_b"), 6)).withColumns({c: F.round(c, 6) for c in ("spacing", "right_end")})


@query(f"""with recursive {AFFINITY_SQL}, t as (select page, id, long_lines + left_lines + spacing + right_end + diagonal + 0.2 * gap < case when sum(long_lines) over (partition by page) <= -3 then -0.99 else 0 end as cut from a)
select page, id, (sum(cut::int) over (partition by page order by id))::bigint as block from t""")
def affinity_blocks(spark, sf):
    """W5."""
    return page.affinity_blocks(affinities(spark, sf))


SPANS_SQL = f"""t as ({sql(SPAN)}), b as (select a.page, a.id, a.s, a.e, min(b.id) filter (not (a.e is null or (b.s >= a.s and b.s <= a.e and (b.e is null or (b.e >= a.s and b.e <= a.e))))) as stop,
count(b.id) as n from t a left join t b on a.page = b.page and b.id > a.id group by all), c as (select page, id, s, e, (case when stop is null then n else stop - id - 1 end)::bigint as run from b)"""


@query(f"with {SPANS_SQL} select page, id, run from c")
def open_interval_contains(spark, sf):
    """J17 with open ends."""
    return sequence.contained_run(table(spark, sf, SPAN), ["page"], ["id"], "s", "e").select("page", "id", "run")


@query(f"""with recursive {SPANS_SQL}, k as (select c.*, c.run <= 8 and (n.id is null or coalesce(case when c.run = 0 then c.e <= n.s else c.e = n.s end, false)) as good from c left join c n on n.page = c.page and n.id = c.id + c.run + 1),
v as (select page, id, run, good from k where id = 1 union all select k.page, k.id, k.run, k.good from v join k on k.page = v.page and k.id = case when v.good then v.id + v.run + 1 else v.id + 1 end)
select t.page, t.id, count(v.id)::bigint as part from t left join v on v.page = t.page and v.id < t.id and not v.good group by all""")
def mismatch_parts(spark, sf):
    """W7."""
    return page.split_on_mismatch(table(spark, sf, SPAN)).select("page", "id", "part")


@query(f"""with t as ({sql(SPAN)}), h as (select *, coalesce((lag(e) over (partition by page order by id) = s)::int, 0) as hit from t)
select page, count(*)::bigint as n, count(*) > 1 and sum(hit) >= 0.5 * (count(*) - 1) as linked from h group by 1""")
def linked_intervals(spark, sf):
    """F14."""
    return page.linked_intervals(table(spark, sf, SPAN))


@query(f"""with t as (select l_orderkey as page, pos as id, l_linenumber % 2 as v from {ITEMS_SQL}), z as (select *, last_value(v) over (partition by page order by id rows between unbounded preceding and unbounded following) as z from t),
o as (select *, max(case when v <> z then id end) over (partition by page) as other from z) select page, id, v from o where id <= coalesce(other, 0) + 1""")
def trimmed_duplicates(spark, sf):
    """W8."""
    return page.trim_trailing_duplicates(items(spark, sf).selectExpr("l_orderkey as page", "pos as id", "l_linenumber % 2 as v"), "v")


@query(f"""with t as (select l_orderkey as page, pos as id, l_partkey % 3 = 0 as skipped, lower(l_returnflag || l_linestatus) as text from {ITEMS_SQL}), g as (select *, sum((not skipped)::int) over (partition by page order by id) as k from t)
select page, min(id) as id, string_agg(text, ' ' order by id) as text from g where k > 0 group by page, k""")
def absorbed_texts(spark, sf):
    """W14."""
    return page.absorb_skipped(items(spark, sf).selectExpr("l_orderkey as page", "pos as id", "l_partkey % 3 = 0 as skipped", "lower(l_returnflag || l_linestatus) as text"))


ENTRY = {"value": "cast(l_suppkey % 4 as double)"} | {k: v for k, v in LINE.items()}
ENTRIES_SQL = f"""t as ({sql(ENTRY)}), w as (select *, row_number() over o as i, lag(value) over o as pv, first_value(value) over o as fv, {', '.join(f'lag({c}) over o as p_{c}, lead({c}) over o as n_{c}' for c in LINE)} from t window o as (partition by page order by id))"""


def _zone_sql(kind: str) -> str:
    side = lambda p, n: ", ".join(f"{p(c)} as {n}_{c}" for c in LINE)
    if kind == "spulprobe":
        return f"""select page, i::bigint as zone, pv as start_value, value as end_value, {side(lambda c: f'p_{c}', 's')}, {side(lambda c: c, 'e')} from w
union all select page, i + 1, value, null, {side(lambda c: c, 's')}, {side(lambda c: 'null', 'e')} from w where n_x0 is null"""
    if kind == "protocol":
        s, e = side(lambda c: f"case when fv <> 0 then case when i > 1 then {c} end else p_{c} end", "s"), side(lambda c: f"case when fv <> 0 then n_{c} else {c} end", "e")
        return f"select page, i::bigint as zone, pv as start_value, value as end_value, {s}, {e} from w where i > 1 or fv <> 0"
    return f"select page, i::bigint as zone, pv as start_value, value as end_value, {side(lambda c: f'p_{c}', 's')}, {side(lambda c: c, 'e')} from w where i > 1 or fv <> 0"


def _zones(kind: str):
    def run(spark, sf):
        return page.zones(table(spark, sf, ENTRY), kind)

    run.__name__, run.__doc__ = f"zones_{kind}", "P8."
    return query(f"with {ENTRIES_SQL} {_zone_sql(kind)}")(run)


for _kind in ("a_above_b", "protocol", "spulprobe"):
    _zones(_kind)


@query(f"""with {ENTRIES_SQL}, z as ({_zone_sql("spulprobe")}), l as ({sql(LINE)}), p as (select z.*, l.id, l.y0, l.y1, (l.y0 + l.y1) / 2 as m, (s_y0 + s_y1) / 2 as a, (e_y0 + e_y1) / 2 as b from z join l using (page)),
q as (select *, case when s_y0 is null and e_y0 is null then null when s_y0 is null then b when e_y0 is null then a else (e_y0 + s_y1) / 2 end as own from p)
select page, zone, id, case when (s_y0 is null or m > s_y0) and (e_y0 is null or m < e_y0) then 1 else 0 end::double as plain,
round((coalesce(exp(-abs(own - m) / 30), 0) + case when (s_y0 is null or y0 > a) and (e_y0 is null or y1 < b) then 1 else 0 end) / 2, 6) as near from q""")
def zone_scores(spark, sf):
    """Both rules for every zone and line of a page (the table that the alignment J4 needs)."""
    z, lines = page.zones(table(spark, sf, ENTRY), "spulprobe"), table(spark, sf, LINE)
    j = z.join(lines, "page")
    s, e, b = G.box("s_"), G.box("e_"), G.box()
    return j.select("page", "zone", "id", page.zone_score("a_to_b", s, e, b).alias("plain"), F.round(page.zone_score("a_above_b", s, e, b), 6).alias("near"))


@query(f"""with {RULES_SQL}, p as (select o_orderkey as page, 200 + o_custkey % 1000 as width from orders) select g.* from g join p using (page) where sqrt(power(x1 - x0, 2) + power(y1 - y0, 2)) >= 100.0 * width / 1000 or (x1 > x0 and abs((y1 - y0) / (x1 - x0)) <= 0.1)""")
def long_or_horizontal(spark, sf):
    """F2."""
    return page.long_or_horizontal(table(spark, sf, RULE), read(spark, sf, "orders").selectExpr("o_orderkey as page", "200 + o_custkey % 1000 as width"))


@query(f"""with {RULES_SQL}, a as (select *, abs(case when x1 = x0 then 90 else degrees(atan((y1 - y0) / (x1 - x0))) end) <= 10 as flat from g where sqrt(power(x1 - x0, 2) + power(y1 - y0, 2)) > 20)
select page, id, x0, y0, x1, y1, not flat as is_vertical, case when flat then least(x0, x1) else least(y0, y1) end as start, case when flat then greatest(x0, x1) else greatest(y0, y1) end as "end", case when flat then (y0 + y1) / 2 else (x0 + x1) / 2 end as position from a""")
def structure_lines(spark, sf):
    """F7."""
    return page.structure_lines(table(spark, sf, RULE))


STROKE = RULE | {"x0": "cast(l_partkey % 9 - 12 as double)", "x1": "cast(l_partkey % 9 - 12 as double) + l_quantity"}


@query(f"""with {LINES_SQL}, g as ({sql(STROKE)}), z as (select page, min(x0) as a, max(x0) as b, min(y1 - y0) as h0, max(y1 - y0) as h1, min(y0) as ya, max(y1) as yb from l group by 1)
select g.* from g join z using (page) where x1 between a - h1 and b + h1 / 3 and y1 between ya and yb and abs(y1 - y0) > h0 / 2 and x1 > x0 and x1 - x0 < 3 * h1 and not (x1 = x0 or abs(degrees(atan((y1 - y0) / (x1 - x0)))) >= 85)
and not (exists (select 1 from l where l.page = g.page and g.x0 between l.x0 and l.x1 and g.y0 between l.y0 and l.y1) and exists (select 1 from l where l.page = g.page and g.x1 between l.x0 and l.x1 and g.y1 between l.y0 and l.y1))""")
def text_diagonals(spark, sf):
    """F3."""
    return page.text_diagonals(table(spark, sf, STROKE), table(spark, sf, LINE))


@query(f"""with {LINES_SQL}, r as (select page, id as rect, x0 - 5 as x0, y0 - 13 as y0, x1 + 20 as x1, y1 + 30 as y1 from l where id % 3 = 1),
j as (select r.page, r.rect, l.id, l.y0 from r join l on l.page = r.page and r.x0 <= l.x0 and r.y0 <= l.y0 and r.x1 >= l.x1 and r.y1 >= l.y1 and l.x0 < r.x1 - 0.4 * (r.x1 - r.x0))
select page, rect, id, row_number() over (partition by page, rect order by y0, id) as place from j""")
def description_lines(spark, sf):
    """F8."""
    lines = table(spark, sf, LINE)
    return page.description_lines(lines, lines.filter("id % 3 = 1").selectExpr("page", "id", "x0 - 5 as x0", "y0 - 13 as y0", "x1 + 20 as x1", "y1 + 30 as y1"))


@query(f"""with {LINES_SQL}, t as (select page, id as tab, x0 - 15 as x0, y0 - 28 as y0, x1 + 15 as x1, y1 + 28 as y1 from l where id % 2 = 0)
select l.page, l.id, coalesce(min(tab), -1) as "table" from l left join t on t.page = l.page and t.x0 <= l.x0 and t.y0 <= l.y0 and t.x1 >= l.x1 and t.y1 >= l.y1 group by 1, 2""")
def containing_table(spark, sf):
    """J16."""
    lines = table(spark, sf, LINE)
    return page.containing_table(lines, lines.filter("id % 2 = 0").selectExpr("page", "id", "x0", "y0 - 13 as y0", "x1", "y1 + 13 as y1"), 15.0)


SIDE = {"x0": "cast(l_partkey % 7 * 30 as double)", "y0": "cast(l_suppkey % 3 as double)", "x1": "cast(l_partkey % 7 * 30 as double) + 10 + l_quantity % 20", "y1": "cast(l_suppkey % 3 + 20 as double)"}
RIGHT_SQL = f"t as ({sql(SIDE)}), j as (select a.page, a.id, b.id as other, b.x0 - a.x1 as gap from t a join t b on a.page = b.page and a.id <> b.id and least(a.y1, b.y1) - greatest(a.y0, b.y0) > 0.9 * least(a.y1 - a.y0, b.y1 - b.y0))"


@query(f'with {RIGHT_SQL} select page, id, arg_min(other, (gap, other)) as "right" from j where gap > 0 and gap < 50 group by 1, 2')
def line_to_the_right(spark, sf):
    """The nearest within a reach."""
    t = table(spark, sf, SIDE)
    return page.line_to_the_right(t, t)


@query(f'with {RIGHT_SQL} select page, id, min(other) as "right" from j where gap >= 0 group by 1, 2')
def first_line_to_the_right(spark, sf):
    """The first, at any distance."""
    t = table(spark, sf, SIDE)
    return page.line_to_the_right(t, t, reach=None)


@query(f"""with recursive {LINES_SQL}, f as (select page, 1::bigint as k, [{{'id': id, 'x0': x0, 'y0': y0, 'x1': x1, 'y1': y1}}] as kept from l where id = 1
union all select l.page, l.id, case when len(list_filter(f.kept, lambda z: z.x0 < l.x1 and l.x0 < z.x1 and z.y0 < l.y1 and l.y0 < z.y1 and (l.x1 - l.x0) * (l.y1 - l.y0) >= (z.x1 - z.x0) * (z.y1 - z.y0))) > 0
then list_filter(f.kept, lambda z: not (z.x0 < l.x1 and l.x0 < z.x1 and z.y0 < l.y1 and l.y0 < z.y1 and (l.x1 - l.x0) * (l.y1 - l.y0) < (z.x1 - z.x0) * (z.y1 - z.y0)))
else list_append(list_filter(f.kept, lambda z: not (z.x0 < l.x1 and l.x0 < z.x1 and z.y0 < l.y1 and l.y0 < z.y1)), {{'id': l.id, 'x0': l.x0, 'y0': l.y0, 'x1': l.x1, 'y1': l.y1}}) end from f join l on l.page = f.page and l.id = f.k + 1),
z as (select page, unnest(arg_max(kept, k)) as z from f group by page) select page, z.id as id from z""")
def compact_overlaps(spark, sf):
    """O3."""
    return page.compact_overlaps(table(spark, sf, LINE))


@query(f"""with t as (select l_orderkey as page, pos as id, case when l_orderkey % 3 = 0 then 'protocol' else 'a_to_b' end as kind, {TEXT} as text, l_linenumber::double as s, case when l_partkey % 5 > 0 then l_linenumber + 1.0::double end as e from {ITEMS_SQL}),
n as (select *, count(*) filter (text <> '') over (partition by page) as n, count(*) over (partition by page) as k from t)
select page, id, kind, text, s is not null and e is not null as complete from n where text <> '' and case when kind = 'protocol' then n = k else n >= 2 end""")
def layered_groups(spark, sf):
    """F20."""
    d = items(spark, sf).selectExpr("l_orderkey as page", "pos as id", "case when l_orderkey % 3 = 0 then 'protocol' else 'a_to_b' end as kind", f"{TEXT} as text", "cast(l_linenumber as double) as s", "case when l_partkey % 5 > 0 then l_linenumber + 1.0D end as e")
    return page.layered_groups(d, ["page"]).select("page", "id", "kind", "text", page.depth_complete(F.col("s"), F.col("e")).alias("complete"))


@query(f"""with t as ({sql(LINE)}), p as (select l.*, lead(x0) over o as ex0, lead(y0) over o as ey0, lead(x1) over o as ex1, lead(y1) over o as ey1, case when lead(id) over o is null then null else id % 3 end as other from t l window o as (partition by page order by id)),
q as (select *, ex1 is not null as has, other is not null and other <> 0 as same from p)
select page, id, case when has then case when same then greatest(x1, ex1) end else x1 end as ax, case when has then case when same then (y0 + ey1) / 2 end else y1 end as ay, case when same and y1 < ey0 then x0 end as bx0, case when same and y1 < ey0 then ey0 end as by1 from q""")
def depth_anchors(spark, sf):
    """The bounds are consecutive lines, every third pair across pages."""
    d = table(spark, sf, LINE)
    w = "over (partition by page order by id)"
    d = d.selectExpr("*", *[f"lead({c}) {w} as e_{c}" for c in LINE], "1 as sp", f"case when lead(id) {w} is not null then case when id % 3 = 0 then 2 else 1 end end as ep")
    s, e = G.box(), G.box("e_")
    x, y = page.depth_anchor(s, F.col("sp"), e, F.col("ep"))
    b = page.depth_background(s, F.col("sp"), e, F.col("ep"))
    return d.select("page", "id", x.alias("ax"), y.alias("ay"), b.x0.alias("bx0"), b.y1.alias("by1"))


@query("""with c as (select o_orderpriority, substr(o_orderpriority, 1, 1)::bigint as class from orders), n as (select class, count(*)::bigint as n from c group by 1), e as (select max(class) as k, min(1.0 / n) as a, max(1.0 / n) as z from n),
i as (select unnest(range(0, k + 1)) as class, a, z from e) select i.class, coalesce(n, 0) as n, round(case when z > a then 0.5 + 1.5 * (coalesce(1.0 / n, 0) - a) / (z - a) else 1 end, 6) as weight from i left join n using (class)""")
def class_weights(spark, sf):
    """G18 with a class that is never met (0)."""
    return metrics.class_weights(read(spark, sf, "orders").selectExpr("cast(substr(o_orderpriority, 1, 1) as bigint) as class"), "class").withColumn("weight", F.round("weight", 6))


@query("select n_regionkey::bigint as class, count(*)::bigint as n, 1.0::double as weight from nation group by 1")
def equal_class_weights(spark, sf):
    """G18 with equal counts."""
    return metrics.class_weights(read(spark, sf, "nation").selectExpr("n_regionkey as class"), "class")


@query("""with c as (select 'f' || l_suppkey as filename, count(*) filter (l_returnflag = 'A')::bigint as tp, count(*) filter (l_returnflag = 'R')::bigint as fp, count(*) filter (l_linestatus = 'O')::bigint as fn from lineitem group by 1)
select filename, round(case when 2 * tp + fp + fn > 0 then 2 * tp / (2 * tp + fp + fn)::double else 0 end, 6) as layer_f1, round(case when tp + fn > 0 then tp / (tp + fn)::double else 0 end, 6) as layer_recall,
round(case when tp + fp > 0 then tp / (tp + fp)::double else 0 end, 6) as layer_precision, tp + fn as layer_num_total, fp as layer_num_wrong, tp + fp as layer_num_detected from c""")
def file_counts(spark, sf):
    """G8."""
    c = read(spark, sf, "lineitem").groupBy(F.concat(F.lit("f"), "l_suppkey").alias("filename")).agg(*[F.count_if(F.expr(x)).alias(k) for k, x in {"tp": "l_returnflag = 'A'", "fp": "l_returnflag = 'R'", "fn": "l_linestatus = 'O'"}.items()])
    return metrics.file_counts(c, "layer").withColumns({f"layer_{k}": F.round(f"layer_{k}", 6) for k in ("f1", "recall", "precision")})


@query(f"""with l as (select l_orderkey as file, count(*) filter (l_returnflag = 'A')::bigint as tp, count(*)::bigint as n, 1 + l_orderkey % 5 as t from lineitem group by 1) select file, tp, n - tp as fp, t - tp as fn from l""")
def layer_counts(spark, sf):
    """By a correctness flag."""
    d = read(spark, sf, "lineitem").selectExpr("l_orderkey as file", "l_returnflag = 'A' as correct", "1 + l_orderkey % 5 as n_truth")
    return metrics.layer_counts(d, "correct", "file")


def _language_sql() -> str:
    hits = ", ".join(f"len(list_filter(p, lambda x: list_contains({T.STOP_WORDS[s]}, x))) as h_{s}" for s in sorted(T.STOP_WORDS))
    names = sorted(T.STOP_WORDS)
    most = f"greatest({', '.join(f'h_{s}' for s in names)})"
    pick = f"case when {most} = 0 then '' " + " ".join(f"when h_{s} = {most} then '{s}'" for s in names) + " end"
    return rf"""with t as (select doc_id, string_split(trim(regexp_replace(text, ' +', ' ', 'g'), ' '), ' ') as w from documents), k as (select doc_id, w, len(w) as n, least(5, greatest(len(w) // 10, 1)) as k from t),
p as (select doc_id, list_transform(w[i * (n // k) + 1 : i * (n // k) + 10], lambda x: lower(regexp_replace(x, '[\d!-/:-@\[-`{{-~]', '', 'g'))) as p from (select *, unnest(range(0, k)) as i from k where w is not null)),
h as (select doc_id, {hits} from p), v as (select doc_id, {pick} as lang, count(*) as c from h group by all), m as (select doc_id, lang from (select *, row_number() over (partition by doc_id order by c desc, lang) as r from v) where r = 1)
select d.doc_id, case when m.lang in ('de', 'en', 'fr', 'it') then m.lang else 'de' end as language from documents d left join m on d.doc_id is not distinct from m.doc_id"""


@query(_language_sql())
def detected_language(spark, sf):
    """The majority over windows that do not overlap; a text that is missing has the default language."""
    return read(spark, sf, "documents").select("doc_id", T.detect_language("text", LANGUAGES).alias("language"))


@query(f"""with b as ({sql(LINE)}), r as (select *, x1 - x0 as w, y1 - y0 as h, lead(x0) over o as nx0, lead(y0) over o as ny0, lead(x1) over o as nx1, lead(y1) over o as ny1 from b window o as (partition by page order by id))
select page, id, x0 * 2 as rx0, y1 * 0.5 as ry1, round(x0 + (3 - (x0 * cos(0.5) + y0 * sin(0.5))) * cos(0.5), 6) as px, round(y0 + (3 - (x0 * cos(0.5) + y0 * sin(0.5))) * sin(0.5), 6) as py,
greatest(0, least(x1, nx1) - greatest(x0, nx0)) > 0.9 * greatest(w, nx1 - nx0) as largest, greatest(0, least(y1, ny1) - greatest(y0, ny0)) > 0.1 * least(h, ny1 - ny0) as tall,
abs(w - (nx1 - nx0)) <= 0.2 * w and abs(x0 - nx0) <= 0.2 * w as aligned from r where nx0 is not null""")
def box_expressions(spark, sf):
    """P2 (larger side, heights), P4, P6, F21: each line with the next."""
    d = table(spark, sf, LINE)
    d = d.selectExpr("*", *[f"lead({c}) over (partition by page order by id) as n_{c}" for c in LINE]).filter("n_x0 is not null")
    a, b = G.box(), G.box("n_")
    r = G.rescale(a, 2.0, 0.5)
    px, py = G.project(a.x0, a.y0, F.lit(0.5), F.lit(3.0))
    return d.select("page", "id", r.x0.alias("rx0"), r.y1.alias("ry1"), F.round(px, 6).alias("px"), F.round(py, 6).alias("py"), G.x_overlap_significant(a, b, 0.9, largest=True).alias("largest"), G.y_overlap_significant(a, b, 0.1).alias("tall"), G.aligned(a, b, 0.2).alias("aligned"))


@query(f"""with g as ({sql(RULE)}), r as (select *, x1 - x0 as ax, y1 - y0 as ay, lead(x0) over o as u0, lead(y0) over o as v0, lead(x1) over o as u1, lead(y1) over o as v1 from g window o as (partition by page order by id)),
d as (select *, u1 - u0 as bx, v1 - v0 as b_y, ax * (v1 - v0) - ay * (u1 - u0) as den, sqrt(ax * ax + ay * ay) as len from r where u0 is not null and x1 > x0)
select page, id, abs(den) >= 1e-10 and (((u0 - x0) * b_y - (v0 - y0) * bx) / den) between 0 and 1 and (((u0 - x0) * ay - (v0 - y0) * ax) / den) between 0 and 1 as crosses,
((u0 - x0) * ax + (v0 - y0) * ay) / len >= -4 and ((u0 - x0) * ax + (v0 - y0) * ay) / len <= len + 4 and abs(ay * u0 - ax * v0 + x1 * y0 - y1 * x0) / len <= 10 as near_line,
round(sqrt(power(u0 - (x0 + greatest(0, least(1, ((u0 - x0) * ax + (v0 - y0) * ay) / (len * len))) * ax), 2) + power(v0 - (y0 + greatest(0, least(1, ((u0 - x0) * ax + (v0 - y0) * ay) / (len * len))) * ay), 2)), 6) as apart from d""")
def segment_relations(spark, sf):
    """P5 (to the segment), F4, F5: each rule with the next and its left end."""
    d = table(spark, sf, RULE)
    d = d.selectExpr("*", *[f"lead({c}) over (partition by page order by id) as n_{c}" for c in RULE]).filter("n_x0 is not null and x1 > x0")
    a, b = G.box(), G.box("n_")
    return d.select("page", "id", G.segments_intersect(a, b).alias("crosses"), G.point_near_line(a, b.x0, b.y0, 4.0, 10.0).alias("near_line"), F.round(G.distance_to_segment(a, b.x0, b.y0), 6).alias("apart"))


@query("select c_custkey, length(c_name) <= 20 and len(list_filter(regexp_extract_all(lower(c_name || ' ' || c_mktsegment), '[a-z]+'), lambda x: length(x) > 9)) = 0 and length(c_name || ' ' || c_mktsegment) <= 30 as fits from customer")
def name_lengths(spark, sf):
    """F12."""
    return read(spark, sf, "customer").select("c_custkey", T.name_fits(F.concat_ws(" ", "c_name", "c_mktsegment"), 30, 9).alias("fits"))


@query(f"""with g as ({sql(LINE)}), s as (select page, count(*) as n, avg(x0) as mx, avg(y0) as my, sum(x0 * x0) / count(*) - avg(x0) * avg(x0) as sxx, sum(y0 * y0) / count(*) - avg(y0) * avg(y0) as syy, sum(x0 * y0) / count(*) - avg(x0) * avg(y0) as sxy from g group by 1),
f as (select page, 0.5 * atan2(2 * sxy, sxx - syy) + pi() / 2 as phi, mx, my from s where abs(sxy) > 1e-6) select page, round(abs(mx * cos(phi) + my * sin(phi)), 4) as r from f""")
def orthogonal_fits(spark, sf):
    """The distance of the line from the origin, where its direction is defined."""
    d = table(spark, sf, LINE)
    cov = "abs(sum(x0 * y0) / count(*) - avg(x0) * avg(y0)) > 1e-6"
    g = d.groupBy("page").agg(G.orthogonal_fit(F.col("x0"), F.col("y0"), F.lit(1.0)).alias("f"), F.expr(cov).alias("c"))
    return g.filter("c").select("page", F.round(F.abs("f.r"), 4).alias("r"))


@query(f"""with l as ({sql(LINE)}), u as (select page, x0, y0, x1, y1 from l where id = 2) select l.page, l.id from l where not exists (select 1 from u where u.page = l.page and u.x0 < l.x1 and l.x0 < u.x1 and u.y0 < l.y1 and l.y0 < u.y1)""")
def unused_entries(spark, sf):
    """U4."""
    lines = table(spark, sf, LINE)
    return features.unused(lines, lines.filter("id = 2")).select("page", "id")


@query(f"""with l as ({sql(LINE)}) select distinct a.page, a.id from l a join l h on h.page = a.page and h.id % 2 = 1 and h.y1 <= a.y0 and a.y0 - h.y1 <= 4 and greatest(0, least(a.x1, h.x1) - greatest(a.x0, h.x0)) > 0.2 * least(a.x1 - a.x0, h.x1 - h.x0)""")
def columns_below_header(spark, sf):
    """F15."""
    lines = table(spark, sf, LINE)
    return features.below_header(lines, lines.filter("id % 2 = 1"), gap=4.0).select("page", "id")


@query(f"""with l as ({sql(LINE)}), p as (select page, 60 + page % 40 as height from l group by 1), t as (select page, max(y1 - y0) * 5 as tall from l where id % 3 = 0 group by 1), s as (select distinct page from l where id = 6)
select p.page from p left join t using (page) left join s using (page) where tall >= 0.85 * height or s.page is not null""")
def fallback_pages(spark, sf):
    """F17."""
    lines = table(spark, sf, LINE)
    pages = lines.groupBy("page").agg(F.first("page").alias("p")).selectExpr("page", "60 + page % 40 as height")
    tables = lines.filter("id % 3 = 0").selectExpr("page", "y0", "y0 + 5 * (y1 - y0) as y1")
    return features.fallback_pages(pages, tables, lines.filter("id = 6"))


@query(f"""with l as ({sql(LINE, {"text": "l_returnflag || ' of the long text'"})}), s as (select page, id, x0, y0, x1, y1 + 15 as y1 from l where id % 2 = 1), o as (select s.page, s.id, (least(s.x1, l.x1) - greatest(s.x0, l.x0)) * (least(s.y1, l.y1) - greatest(s.y0, l.y0)) as shared, (s.x1 - s.x0) * (s.y1 - s.y0) as own, (l.x1 - l.x0) * (l.y1 - l.y0) as other, length(l.text) as n
from s join l on l.page = s.page and l.x0 < s.x1 and s.x0 < l.x1 and l.y0 < s.y1 and s.y0 < l.y1), g as (select page, id, sum(shared / own) as cover, sum(n * shared / other) as chars from o group by 1, 2)
select s.page, s.id, coalesce(greatest(0, 1 - cover) * exp(-chars / 40) < 0.1, false) as is_text from s left join g using (page, id)""")
def text_sections(spark, sf):
    """F18."""
    lines = table(spark, sf, LINE, {"text": "l_returnflag || ' of the long text'"})
    return features.has_text(lines.filter("id % 2 = 1").selectExpr("page", "id", "x0", "y0", "x1", "y1 + 15 as y1"), lines, tau=40.0).select("page", "id", "is_text")


@query(f"""with l as ({sql(LINE)}), r as (select *, lead(x0) over o as u0, lead(y0) over o as v0, lead(x1) over o as u1, lead(y1) over o as v1, count(*) over (partition by page) as n from l window o as (partition by page order by id))
select page, id, round(((u1 - u0) - 1.64 * greatest(0, u0 - x1, x0 - u1) + (v1 - v0) - 2 * (abs(v0 - y0) + abs(v1 - y1)) + n) * power(0.8, 10.0 * (id % 3) / n), 6) as score from r where u0 is not null""")
def match_scores(spark, sf):
    """P10."""
    d = table(spark, sf, LINE).selectExpr("*", "count(*) over (partition by page) as n", *[f"lead({c}) over (partition by page order by id) as n_{c}" for c in LINE]).filter("n_x0 is not null")
    return d.select("page", "id", F.round(G.match_score(G.box(), G.box("n_"), F.col("n"), F.expr("cast(id % 3 as double)"), F.col("n")), 6).alias("score"))


@query("""select o_orderkey, o_custkey, o_totalprice as elevation from (select *, o_totalprice - 100000 as e from orders) where o_totalprice > 100000 order by elevation desc""")
def valid_elevations(spark, sf):
    """Positive elevations, all of them, highest first."""
    o = read(spark, sf, "orders").withColumn("e", F.expr("o_totalprice - 100000"))
    return o.filter(P.valid_elevation("e")).orderBy(F.desc("e")).select("o_orderkey", "o_custkey", F.col("o_totalprice").alias("elevation"))


@query(f"""with l as ({sql(LINE)}) select l_orderkey as page, count(*)::bigint as n_lines, count(*) filter (pos % 2 = 0)::bigint as n_tables from {ITEMS_SQL} group by 1""")
def page_counts(spark, sf):
    """Counts of given tables a page."""
    lines = table(spark, sf, LINE)
    f = features.page_features(lines.select("page").distinct(), lines=lines, tables=lines.filter("id % 2 = 0"))
    return f.select("page", F.col("n_lines").cast("bigint").alias("n_lines"), F.col("n_tables").cast("bigint").alias("n_tables"))


@query("""select event_id, value, case when event_id % 3 = 0 then value else round(500 - value, 2) end as depth from events""")
def inferred_depths(spark, sf):
    """A missing depth from the terrain's and the water's elevation."""
    e = read(spark, sf, "events")
    return e.select("event_id", "value", P.infer_depth(F.expr("case when event_id % 3 = 0 then value end"), F.col("value"), F.lit(500.0)).alias("depth"))


@query(None)
def clustered_entries(spark, sf):
    """H5: columns of aligned entries."""

    def fold(rows):
        found = layout.alignment_clusters([(r["x0"], r["y0"], r["x1"], r["y1"]) for r in rows])
        return [{"page": rows[0]["page"], "cluster": k, "id": rows[i]["id"]} for k, c in enumerate(found) for i in c]

    return sequence.grouped(table(spark, sf, LINE), ["page"], ["id"], fold, "page bigint, cluster bigint, id bigint")


@query(None)
def one_to_one_boxes(spark, sf):
    """J10."""
    b = boxes(spark, sf)
    e = b.filter("id > 2").selectExpr("page as file", "id", "cast(id % 2 as int) as page", "y0", "(x0 + x1) / 2 as px", "(y0 + y1) / 2 as py")
    t = b.filter("id <= 2").selectExpr("page as file", "id as box", "explode(array(0, 1)) as page", "x0", "y0", "x1", "y1")
    return page.one_to_one(e, t)


@query(None)
def zone_alignment(spark, sf):
    """Lines given to zones in order, with the affinities as bonus."""
    z = page.zones(table(spark, sf, ENTRY), "a_above_b")
    return matching.align_zone_lines(z, table(spark, sf, LINE), affinities(spark, sf).select("page", "id", page.weighted_affinity("a_above_b").alias("bonus")), "a_above_b")


def _near(s: str, o: str, p: str) -> str:
    """Whether the end ``p`` (0 or 1) of one segment lies within 8 of the other, in SQL."""
    x, y = f"{o}.x{p}", f"{o}.y{p}"
    t = f"greatest(0, least(1, (({x} - {s}.x0) * ({s}.x1 - {s}.x0) + ({y} - {s}.y0) * ({s}.y1 - {s}.y0)) / (power({s}.x1 - {s}.x0, 2) + power({s}.y1 - {s}.y0, 2))))"
    return f"sqrt(power({x} - ({s}.x0 + {t} * ({s}.x1 - {s}.x0)), 2) + power({y} - ({s}.y0 + {t} * ({s}.y1 - {s}.y0)), 2)) <= 8"


STRUCTURE = RULE | {"x1": "cast(l_partkey % 50 as double) + case when l_partkey % 2 = 0 then 3 else 30 + l_quantity end", "y1": "cast(pos * 13 + 4 as double) + case when l_partkey % 2 = 0 then 15 + l_quantity else 1 end"}
_DEN = "((a.x1 - a.x0) * (b.y1 - b.y0) - (a.y1 - a.y0) * (b.x1 - b.x0))"


@query(f"""with recursive g as ({sql(STRUCTURE)}), s as (select *, abs(degrees(atan((y1 - y0) / (x1 - x0)))) > 10 as v from g where sqrt(power(x1 - x0, 2) + power(y1 - y0, 2)) > 20),
e as (select a.page, a.id, b.id as other from s a join s b on a.page = b.page and a.id <> b.id and ((abs({_DEN}) >= 1e-10 and (((b.x0 - a.x0) * (b.y1 - b.y0) - (b.y0 - a.y0) * (b.x1 - b.x0)) / {_DEN}) between 0 and 1
  and (((b.x0 - a.x0) * (a.y1 - a.y0) - (b.y0 - a.y0) * (a.x1 - a.x0)) / {_DEN}) between 0 and 1) or {" or ".join(_near(x, y, p) for x, y in (("a", "b"), ("b", "a")) for p in "01")})),
r as (select page, id, id as seen from s union select r.page, r.id, e.other from r join e on e.page = r.page and e.id = r.seen), c as (select page, id, min(seen) as region from r group by 1, 2),
k as (select page, region, bool_or(v) and bool_or(not v) as mixed from c join s using (page, id) group by 1, 2) select page, id, region from c join k using (page, region) where mixed""")
def table_regions(spark, sf):
    """H2."""
    return page.table_regions(page.structure_lines(table(spark, sf, STRUCTURE)))


@query(f"""with recursive l as ({sql(LINE)}), p as (select o_orderkey as page, 100 + o_custkey % 200 as width, 90 as height from orders), m as (select l.*, (x0 + x1) / 2 as mx, (y0 + y1) / 2 as my, width from l join p using (page)),
e as (select a.page, a.id, b.id as other from m a join m b on a.page = b.page and a.id <> b.id and sqrt(power(a.mx - b.mx, 2) + power(a.my - b.my, 2)) <= 0.06 * a.width),
r as (select page, id, id as seen from m union select r.page, r.id, e.other from r join e on e.page = r.page and e.id = r.seen), c as (select page, id, min(seen) as g from r group by 1, 2),
a as (select page, g, (max(x1) - min(x0)) * (max(y1) - min(y0)) as a from c join l using (page, id) group by 1, 2), t as (select page, sum(a) as a from a group by 1)
select p.page, round(least(1, coalesce(a, 0) / (width * height)), 6) as density from p left join t using (page)""")
def pattern_density(spark, sf):
    """H4."""
    pages = read(spark, sf, "orders").selectExpr("o_orderkey as page", "100 + o_custkey % 200 as width", "90 as height")
    return page.pattern_density(table(spark, sf, LINE), pages, 0.06).withColumn("density", F.round("density", 6))


DEPTH = {"value": "l_quantity", "x0": "cast(l_partkey % 6 * 9 as double)", "y0": "cast(l_suppkey % 4 * 4 as double)", "x1": "cast(l_partkey % 6 * 9 + 12 as double)", "y1": "cast(l_suppkey % 4 * 4 + 10 as double)", "text": "case l_partkey % 3 when 0 then 'm' when 1 then '-' else 'sand' end"}


@query(f"""with t as ({sql(DEPTH)}), j as (select a.page, a.id, b.id as other from t a join t b on a.page = b.page and a.id <> b.id and b.value > a.value and b.x0 between greatest(a.x0, a.x1 - (a.y1 - a.y0)) and a.x1 + (b.x1 - b.x0)
and b.y0 between a.y0 - (a.y1 - a.y0) / 2 and a.y0 + (a.y1 - a.y0) / 2 and regexp_full_match(coalesce((select string_agg(text, ' ' order by w.id) from t w where w.page = a.page and w.x0 > a.x0 and w.x0 < b.x0 and w.y0 between a.y0 - (a.y1 - a.y0) / 2 and a.y0 + (a.y1 - a.y0) / 2), ''), '\\W*m?\\W*'))
select page, id, min(other) as other from j group by 1, 2""")
def depth_pairs(spark, sf):
    """J18."""
    t = table(spark, sf, DEPTH)
    return page.depth_pairs(t, t)
