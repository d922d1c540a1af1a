"""Queries of text, parsing, record and matching operators over the driver's tables, and the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataframe.functions import parse as P
from strataframe.functions import text as T
from strataframe.operators import features, matching, metrics, sequence
from strataframe.plans.catalog import ITEMS_SQL, items, query, read
from strataframe.plans.page_catalog import LINE, sql, table
from strataframe.sources import tables


def spark_text(expression: str) -> str:
    return expression.replace("varchar", "string")


CLASS = "case when c_custkey % 3 = 0 then upper(c_mktsegment) when c_custkey % 3 = 1 then ' ' || lower(c_mktsegment) || '-' else 'x' || c_mktsegment end"
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query(f"select c_custkey, case when list_contains({SEGMENTS}, upper(regexp_replace({CLASS}, '[\\s_-]+', '', 'g'))) then upper(regexp_replace({CLASS}, '[\\s_-]+', '', 'g')) else 'none' end as class from customer")
def mapped_classes(spark, sf):
    """T16 without the lithology keywords."""
    return read(spark, sf, "customer").select("c_custkey", T.map_class(F.expr(CLASS), SEGMENTS, "none").alias("class"))


@query(r"""select p_partkey, replace(replace(replace(p_name || ',5''o', ',', '.'), '''', '.'), 'o', '0') as fixed, coalesce(nullif(regexp_extract('Nr ' || p_brand || ' 7 x', '(?i)\b(\w*)(brand)(\w*)\b', 0), ''), '-') as word,
regexp_matches(case when p_size % 3 = 0 then p_size || 'a) ' || p_name when p_size % 3 = 1 then 'long' || p_size || 'abc) x' else p_name end, '^[0-9a-z-]+\)') and length(string_split(case when p_size % 3 = 0 then p_size || 'a) ' || p_name when p_size % 3 = 1 then 'long' || p_size || 'abc) x' else p_name end, ' ')[1]) < 7 as identifier,
length(regexp_replace(case when p_size % 2 = 0 then upper(p_name) else p_name end, '[^A-Z]', '', 'g')) > 0.7 * length(regexp_replace(case when p_size % 2 = 0 then upper(p_name) else p_name end, '[^A-Za-z]', '', 'g')) as header from part""")
def text_rules(spark, sf):
    """T5, T12, T17, T19 (the header test)."""
    ident = F.expr("case when p_size % 3 = 0 then p_size || 'a) ' || p_name when p_size % 3 = 1 then 'long' || p_size || 'abc) x' else p_name end")
    return read(spark, sf, "part").select(
        "p_partkey",
        T.replace_in_order(F.expr("p_name || \",5'o\""), [(",", "."), ("'", "."), ("o", "0")]).alias("fixed"),
        F.coalesce(T.match_keyword(F.expr("'Nr ' || p_brand || ' 7 x'"), ["brand"], any_case=True), F.lit("-")).alias("word"),
        T.is_layer_identifier(ident).alias("identifier"),
        T.is_header(F.expr("case when p_size % 2 = 0 then upper(p_name) else p_name end")).alias("header"),
    )


LEVEL = "case when o_orderkey % 2 = 0 then 'at ' || cast(o_custkey % 50 as varchar) || '.48 8 m u.T.' else 'nothing ' || cast(o_custkey as varchar) end"


@query(f"select o_orderkey, case when o_orderkey % 2 = 0 then cast(o_custkey % 50 as varchar) || '.48 m u.T.' else {LEVEL} end as fixed, case when o_orderkey % 3 = 0 then least(o_custkey % 7 + 0.5, 3.0)::double end as shallow from orders")
def repeated_depths(spark, sf):
    """T13, T18 (the smallest depth beside a tag)."""
    tag = F.expr("case when o_orderkey % 3 = 0 then 'Sp. ' || cast(o_custkey % 7 as string) || ',5 - 3.0 m' else '3 m' end")
    return read(spark, sf, "orders").select("o_orderkey", T.fix_repeated_depth(F.expr(spark_text(LEVEL))).alias("fixed"), T.tag_min_depth(tag).alias("shallow"))


WORD = "case l_linenumber % 4 when 0 then cast(l_linenumber as varchar) || ',5 m' when 1 then '-' || cast(l_linenumber as varchar) when 2 then 'm ' || cast(l_linenumber as varchar) else cast(l_linenumber as varchar) || '.25' end"


@query(f"""with w as (select l_orderkey, pos, l_linenumber as n from {ITEMS_SQL}) select l_orderkey, pos, case n % 4 when 0 then n + 0.5 when 1 then n when 3 then n + 0.25 end::double as value, case n % 4 when 0 then true when 1 then false when 3 then true end as has_decimal from w""")
def depth_entries(spark, sf):
    """D9."""
    return items(spark, sf).select("l_orderkey", "pos", P.depth_entry(F.expr(spark_text(WORD))).alias("d")).select("l_orderkey", "pos", "d.value", "d.has_decimal")


@query("""select o_orderkey, (o_custkey % 9)::double as start, null::double as "end", 'ab ' || cast(o_custkey % 9 as varchar) || ' m' as rest from orders""")
def open_intervals(spark, sf):
    """The open form."""
    t = F.expr("'ab ' || cast(o_custkey % 9 as string) || ' m'")
    return read(spark, sf, "orders").select("o_orderkey", P.parse_interval(t).alias("i")).select("o_orderkey", "i.start", "i.end", "i.rest")


@query(f"""with t as (select l_orderkey, pos, l_linenumber % 3 as a, case when l_partkey % 5 > 0 then l_linenumber end as b, lead(l_linenumber % 3) over o as c, lead(case when l_partkey % 5 > 0 then l_linenumber end) over o as d, l_quantity, lead(l_quantity) over o as q,
600000 + l_partkey as east, 150000 + l_suppkey as north from {ITEMS_SQL} window o as (partition by l_orderkey order by pos))
select l_orderkey, pos, coalesce(a = c and b = d, false) as same, coalesce(abs(l_quantity - q) <= 0.01, false) as level, abs(l_quantity - 10) <= 2 as near from t""")
def equal_bounds(spark, sf):
    """F22, Z9 (elevation and coordinates in either frame)."""
    w = "over (partition by l_orderkey order by pos)"
    d = items(spark, sf).selectExpr("l_orderkey", "pos", "l_linenumber % 3 as a", "case when l_partkey % 5 > 0 then l_linenumber end as b", "l_quantity", "l_partkey", "l_suppkey")
    d = d.selectExpr("*", f"lead(a) {w} as c", f"lead(b) {w} as d", f"lead(l_quantity) {w} as q")
    east, north = F.col("l_partkey") + 600000.0, F.col("l_suppkey") + 150000.0
    near = metrics.coordinates_match(east, north, east + 2000000 + F.col("l_quantity") - 10, north + 1000000)
    return d.select("l_orderkey", "pos", P.same_interval(F.col("a"), F.col("b"), F.col("c"), F.col("d")).alias("same"), metrics.elevation_matches(F.col("l_quantity"), F.col("q")).alias("level"), near.alias("near"))


@query(r"""with t as (select doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+') as w from documents)
select doc_id, case when list_position(w, 'the') > 0 and list_position(w[list_position(w, 'the') + 1 :], 'of') > 0 then 'river' when list_contains(w, 'das') or list_contains(w, 'les') then 'house' else 'none' end as prediction_class from t""")
def ordered_pattern_classes(spark, sf):
    """Coverage in order, then the longer pattern, then the one listed first."""
    from strataframe.operators import classify

    patterns = {"river": [["the", "of"]], "house": [["das"], ["les"]]}
    return classify.make("baseline", patterns=patterns, default="none")(read(spark, sf, "documents").select("doc_id", "text")).select("doc_id", "prediction_class")


@query("select doc_id, 'CL_ML' as prediction_class from documents")
def dummy_classes(spark, sf):
    """The same class for all."""
    from strataframe.operators import classify

    return classify.make("dummy", label="CL_ML")(read(spark, sf, "documents").select("doc_id"))


@query("select o_orderkey, case when o_custkey % 3 = 0 then 'URGENT' when o_custkey % 3 = 1 then 'LOW' else 'none' end as prediction_class from orders")
def parsed_answers(spark, sf):
    """Z3: the class in a tagged reply."""
    from strataframe.operators import classify

    d = read(spark, sf, "orders").selectExpr("o_orderkey", "case o_custkey % 3 when 0 then 'I think <answer> Urgent </answer>' when 1 then '<answer>l-o-w</answer> <answer>urgent</answer>' else 'no tag' end as reply")
    return classify.make("answers", names=["URGENT", "LOW"], default="none")(d).select("o_orderkey", "prediction_class")


WORDS = {"block_no": "cast(l_suppkey % 2 as int)", "line_no": "cast(pos % 2 as int)", "word_no": "cast(pos as int)", "text": "l_returnflag || cast(l_linenumber as varchar) || case when l_partkey % 3 = 0 then '. x' else '' end"}


def words(spark, sf):
    d = items(spark, sf).selectExpr("cast(l_orderkey as string) as file", "1 as page", *[f"{spark_text(v)} as {k}" for k, v in WORDS.items()], *[f"{v} as {k}" for k, v in LINE.items()])
    return d


WORDS_SQL = f"w as (select l_orderkey::varchar as file, 1 as page, {', '.join(f'{v} as {k}' for k, v in (WORDS | LINE).items())} from {ITEMS_SQL})"


@query(f"with {WORDS_SQL} select file, page, block_no, line_no, string_agg(text, ' ' order by word_no) as text, min(x0) as x0, min(y0) as y0, max(x1) as x1, max(y1) as y1 from w group by all")
def word_lines(spark, sf):
    """S3's grouping of words."""
    return tables.lines(words(spark, sf))


@query(rf"with {WORDS_SQL} select file, regexp_replace(string_agg(text, ' ' order by page, block_no, line_no, word_no), '[0-9!-/:-@\[-`{{-~\n]', ' ', 'g') as text from w group by file")
def file_texts(spark, sf):
    """S4."""
    return tables.file_text(words(spark, sf))


@query(f"with {WORDS_SQL} select file, word_no from w where (x0 + x1) / 2 between 25 and 60 and (y0 + y1) / 2 between 15 and 50")
def words_in_box(spark, sf):
    """Words whose centre lies in a box."""
    return tables.words_in(words(spark, sf), 25.0, 15.0, 60.0, 50.0).select("file", "word_no")


@query("select o_orderkey as file from orders where o_orderkey not in (select l_orderkey from lineitem where l_returnflag = 'A')")
def pending_files(spark, sf):
    """S2's resume."""
    return tables.pending(read(spark, sf, "orders").select(F.col("o_orderkey").alias("file")), read(spark, sf, "lineitem").filter("l_returnflag = 'A'").select(F.col("l_orderkey").alias("file")))


def records(spark, sf):
    d = items(spark, sf).filter("pos <= 4").selectExpr(
        "cast(l_orderkey as string) as file", "cast(pos % 2 as int) as borehole_index", "pos",
        "named_struct('material_description', case when l_partkey % 4 = 0 then null else 'Sand, ' || l_returnflag end, 'depth_interval', case when l_partkey % 5 = 0 then null else named_struct('start', cast(pos as double), 'end', pos + l_quantity) end) as layer",
        "named_struct('date', case when l_partkey % 3 = 0 then null else '2020-01-0' || cast(pos as string) end, 'depth', case when l_partkey % 2 = 0 then l_quantity end, 'elevation', l_extendedprice) as water",
    )
    g = d.groupBy("file", "borehole_index").agg(F.array_sort(F.collect_list(F.struct("pos", "layer", "water"))).alias("a"))
    return g.select("file", "borehole_index", F.create_map(F.lit("name"), F.concat(F.lit("B"), "file")).alias("metadata"), F.transform("a", lambda x: x["layer"]).alias("layers"), F.transform("a", lambda x: x["water"]).alias("groundwater"))


RECORD_SQL = f"r as (select l_orderkey::varchar as file, (pos % 2)::int as borehole_index, row_number() over (partition by l_orderkey, pos % 2 order by pos) - 1 as layer_index, * exclude (l_orderkey) from {ITEMS_SQL} where pos <= 4)"


@query(f"""with {RECORD_SQL} select file, borehole_index, layer_index::int as layer_index, case when l_partkey % 5 > 0 then pos::double end as start, case when l_partkey % 5 > 0 then pos + l_quantity end as "end",
case when l_partkey % 4 = 0 then '' else 'sand' || lower(l_returnflag) end as text, case when l_partkey % 4 > 0 then 'Sand, ' || l_returnflag end as raw_text from r""")
def record_layers(spark, sf):
    """S5's rows of layers."""
    return tables.layers(records(spark, sf))


@query(f"""with {RECORD_SQL} select file, borehole_index, case when l_partkey % 3 > 0 then ('2020-01-0' || pos)::date end as date, case when l_partkey % 2 = 0 then l_quantity end as depth, l_extendedprice as elevation from r""")
def record_groundwater(spark, sf):
    """O8's rows."""
    return tables.groundwater(records(spark, sf))


@query(f"""with {RECORD_SQL} select file || '_' || borehole_index as key, '{{"name":"B' || file || '"}}' as metadata from r group by file, borehole_index""")
def record_metadata(spark, sf):
    """K3."""
    return tables.metadata_by_borehole(records(spark, sf))


@query(f"""with {RECORD_SQL}, b as (select file, borehole_index, list({{'layer_index': layer_index::int, 'material_description': l_returnflag, 'prediction_class': l_linestatus}} order by layer_index) as layers from r group by 1, 2)
select file, sum(len(layers))::bigint as n, string_agg(borehole_index || ':' || array_to_string(list_transform(layers, lambda x: x.layer_index || x.material_description || x.prediction_class), ','), ';' order by borehole_index) as shown from b group by 1""")
def nested_predictions(spark, sf):
    """K5: two levels of nesting, shown as text."""
    d = items(spark, sf).filter("pos <= 4").selectExpr("cast(l_orderkey as string) as file", "cast(pos % 2 as int) as borehole_index", "cast(row_number() over (partition by l_orderkey, pos % 2 order by pos) - 1 as int) as layer_index", "l_returnflag as material_description", "l_linestatus as prediction_class")
    n = tables.nest_predictions(d)
    shown = F.array_join(F.transform("boreholes", lambda b: F.concat_ws(":", b["borehole_index"].cast("string"), F.array_join(F.transform(b["layers"], lambda x: F.concat(x["layer_index"].cast("string"), x["material_description"], x["prediction_class"])), ","))), ";")
    return n.select("file", F.aggregate("boreholes", F.lit(0), lambda a, b: a + F.size(b["layers"])).cast("bigint").alias("n"), shown.alias("shown"))


@query("""select o_orderkey, o_custkey % 7 as a__x, o_orderstatus as a__y__z from orders""")
def flattened(spark, sf):
    """A1, A5."""
    d = read(spark, sf, "orders").selectExpr("o_orderkey", "named_struct('x', o_custkey % 7, 'y', named_struct('z', o_orderstatus)) as a")
    return tables.flatten(d)


@query("select o_orderkey, o_custkey % 7 as found from orders")
def nested_values(spark, sf):
    """A2."""
    d = read(spark, sf, "orders").selectExpr("o_orderkey", "named_struct('x', named_struct('y', o_custkey % 7)) as entry")
    return d.select("o_orderkey", tables.nested_value(d, "entry", ["x", "y"]).alias("found"))


@query(f"""with recursive p as (select a.l_orderkey as page, a.pos as l, b.pos as r, 1 / (1 + abs(a.l_quantity - b.l_quantity)) as score from {ITEMS_SQL} a join {ITEMS_SQL} b on a.l_orderkey = b.l_orderkey and a.pos % 2 = 1 and b.pos % 2 = 0),
o as (select *, row_number() over (partition by page order by score desc, l, r) as k from p where score >= 0.1),
f as (select page, 0::bigint as k, []::bigint[] as ls, []::bigint[] as rs, null::bigint as l, null::bigint as r, null::double as score from (select distinct page from o)
union all select o.page, o.k, case when list_contains(ls, o.l) or list_contains(rs, o.r) then ls else list_append(ls, o.l) end, case when list_contains(ls, o.l) or list_contains(rs, o.r) then rs else list_append(rs, o.r) end,
case when not (list_contains(ls, o.l) or list_contains(rs, o.r)) then o.l end, o.r, o.score from f join o on o.page = f.page and o.k = f.k + 1)
select page, l as "left", r as "right", round(score, 6) as score from f where l is not null""")
def greedy_pairs(spark, sf):
    """Best score first, each side once."""
    li = items(spark, sf).selectExpr("l_orderkey as page", "pos as id", "l_quantity as q")
    pairs = li.filter("id % 2 = 1").join(li.filter("id % 2 = 0").selectExpr("page", "id as right", "q as rq"), "page").selectExpr("page", "id as left", "right", "1 / (1 + abs(q - rq)) as score")
    return matching.greedy_pairs(pairs, "page", "left", "right", "score", 0.1).withColumn("score", F.round("score", 6))


REFERENCE = "case when pos > 1 and l_partkey % 4 = 0 then 'dito' when pos > 1 and l_partkey % 4 = 1 then '- wie ' || cast(1 + l_suppkey % 4 as varchar) || '.0 m, nass' when l_partkey % 7 = 0 then '' else 'Sand ' || cast(l_partkey as varchar) end"


@query(rf"""with recursive t as (select l_orderkey as page, pos, pos::double as start, {REFERENCE} as text from {ITEMS_SQL}),
f as (select page, pos, text as resolved, [{{'t': text, 's': start}}] as seen from t where pos = 1
union all select t.page, t.pos, r.resolved, list_append(f.seen, {{'t': r.resolved, 's': t.start}}) from f join t on t.page = f.page and t.pos = f.pos + 1,
lateral (select list_filter(f.seen, lambda x: x.t <> '') as some, regexp_matches(t.text, '(?i)^[\s-]*(wie|dito)') as hit, try_cast(nullif(regexp_extract(t.text, 'wie (\d+\.\d+)', 1), '') as double) as at) c,
lateral (select coalesce(list_filter(c.some, lambda x: x.s = c.at)[-1].t, c.some[-1].t) as base) b,
lateral (select case when c.hit and b.base is not null then b.base || regexp_replace(t.text, '^[\s-]*(?:dito|wie \d+\.\d+ m)', '') else t.text end as resolved) r)
select page, pos, resolved from f""")
def resolved_references(spark, sf):
    """W12: "dito" and "wie 2.0 m" take over an earlier, resolved text."""
    d = items(spark, sf).selectExpr("l_orderkey as page", "pos", "cast(pos as double) as start", f"{spark_text(REFERENCE)} as text")
    return sequence.resolve_references(d, ["page"], ["pos"], "text", "start").select("page", "pos", "resolved")


@query(f"""with l as ({sql(LINE)}), s as (select page, min(x0) - 2 as x0, min(y0) as y0, min(x0) + 12 as x1, max(y1) as y1 from l group by 1)
select s.page, count(l.id)::bigint as noise from s left join l on l.page = s.page and l.x0 < s.x1 and s.x0 < l.x1 and l.y0 < s.y1 and s.y0 < l.y1 and least(l.x1, s.x1) - greatest(l.x0, s.x0) > 0.25 * least(l.x1 - l.x0, s.x1 - s.x0) and l.id % 3 > 0
and not exists (select 1 from l e where e.page = l.page and e.id % 3 = 0 and e.x0 < l.x1 and l.x0 < e.x1 and e.y0 < l.y1 and l.y0 < e.y1) group by 1""")
def noise_counts(spark, sf):
    """J3."""
    lines = table(spark, sf, LINE).withColumn("text", F.expr("case when id % 3 > 0 then 'word' else '--' end"))
    sidebars = lines.groupBy("page").agg((F.min("x0") - 2).alias("x0"), F.min("y0").alias("y0"), (F.min("x0") + 12).alias("x1"), F.max("y1").alias("y1")).withColumn("id", F.lit(1))
    return features.noise_counts(sidebars, lines, lines.filter("id % 3 = 0")).select("page", "noise")


@query(f"""with l as ({sql(LINE)}), t as (select a.page, a.id, b.id as end_of from l a join l b on a.page = b.page and ((b.x0 between a.x0 - 5 and a.x1 + 5 and b.y0 between a.y0 - 5 and a.y1 + 5) or (b.x1 between a.x0 - 5 and a.x1 + 5 and b.y1 between a.y0 - 5 and a.y1 + 5)) and a.id <> b.id)
select page, id, count(*)::bigint as n from t group by 1, 2""")
def segments_by_ends(spark, sf):
    """Segments with an end in a widened box."""
    lines = table(spark, sf, LINE)
    return matching.segments_near(lines, lines, 5.0).filter("id <> segment").groupBy("page", "id").agg(F.count("*").alias("n"))


@query(f"""with l as ({sql(LINE)}), k as (select * from l where id = 1), near as (select distinct l.page, l.id, l.y0, l.x0 from k join l on k.page = l.page and ((k.x0 < l.x1 and l.x0 < k.x1 + 5 * (k.x1 - k.x0) and l.y0 < k.y1 and k.y0 < l.y1) or (k.x0 < l.x1 and l.x0 < k.x1 and l.y0 < k.y1 + 4 * (k.y1 - k.y0) and k.y0 < l.y1)))
select page, 1::bigint as id, arg_min(400 + id + 0.5, (y0, x0, id))::double as elevation from near where id % 2 = 0 group by 1""")
def elevations_near_key(spark, sf):
    """D8."""
    lines = table(spark, sf, LINE).withColumn("text", F.expr("case when id % 2 = 0 then cast(400 + id as string) || '.5 m u.M.' else 'nothing' end"))
    return features.elevation_near_key(lines.filter("id = 1"), lines)


@query(f"""with l as ({sql(LINE)}), k as (select * from l where id = 1), near as (select distinct l.page, l.id, l.y0, l.x0 from k join l on k.page = l.page and ((k.x0 - 2 * (k.x1 - k.x0) < l.x1 and l.x0 < k.x1 + 8 * (k.x1 - k.x0) and l.y0 < k.y1 and k.y0 < l.y1) or (k.x0 < l.x1 and l.x0 < k.x1 and l.y0 < k.y1 + 2 * (k.y1 - k.y0) and k.y0 < l.y1)))
select page, 1::bigint as id, arg_min(id + 0.5, (y0, x0, id))::double as depth from near where id % 2 = 0 group by 1""")
def groundwater_near_key(spark, sf):
    """The first depth in a key's band."""
    lines = table(spark, sf, LINE).withColumn("text", F.expr("case when id % 2 = 0 then cast(id as string) || '.5 m u.T.' else 'nothing' end"))
    return features.groundwater_near_key(lines.filter("id = 1"), lines).select("page", "id", "depth")


@query(f"""with x as (select l_orderkey as page, row_number() over (partition by l_orderkey order by pos) as place, l_partkey as "left" from {ITEMS_SQL} where pos % 3 = 0), y as (select l_orderkey as page, row_number() over (partition by l_orderkey order by pos) as place, l_suppkey as "right" from {ITEMS_SQL} where pos % 3 > 0)
select page, place, "left", "right" from x join y using (page, place)""")
def zipped_labels(spark, sf):
    """J21."""
    d = items(spark, sf)
    side = lambda c, v: d.filter(c).selectExpr("l_orderkey as page", "pos", f"{v} as v")
    return sequence.zip_positions(side("pos % 3 = 0", "l_partkey"), side("pos % 3 > 0", "l_suppkey"), ["page"], "pos", "v")


@query(None)
def block_intervals(spark, sf):
    """W13."""
    d = items(spark, sf).selectExpr("l_orderkey as page", "pos", "case when l_partkey % 3 = 0 then concat(l_linenumber, ',0 - ', l_linenumber + 2, ' m: sand') when l_partkey % 3 = 1 then 'clay' else concat('head ', l_linenumber, ' -') end as text")
    return sequence.block_intervals(d, "page", "pos")
