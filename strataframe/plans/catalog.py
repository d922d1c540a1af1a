"""One query an operator family over the driver's tables, and the SQL that gives the same rows.

Boxes are line items: a rectangle a row, a page an order. Ratios are rounded, as sums of
doubles may differ in their last bits with the order of rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.functions import fuzzy
from strataframe.functions import geometry as G
from strataframe.functions import parse as P
from strataframe.functions import text as T
from strataframe.operators import layout, matching, metrics, sequence
from strataframe.operators.graph import connected_components

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

LANGUAGES = ["de", "en", "fr", "it"]
BOX = {
    "x0": "cast(l_partkey % 200 as double)",
    "y0": "cast(l_suppkey % 100 as double)",
    "x1": "cast(l_partkey % 200 as double) + l_quantity",
    "y1": "cast(l_suppkey % 100 as double) + 5 + 3 * l_linenumber",
}
#: Line numbers repeat within an order, so a line's place comes from a total order.
POS = "row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_shipdate)"
ITEMS_SQL = f"(select *, {POS}::bigint as pos from lineitem)"
BOX_SQL = "select l_orderkey as page, pos as id, l_extendedprice as score, " + ", ".join(f"{v} as {k}" for k, v in BOX.items()) + f" from {ITEMS_SQL}"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def items(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "lineitem").withColumn("pos", F.expr(POS).cast("bigint"))


def boxes(spark: SparkSession, sf: str) -> DataFrame:
    return items(spark, sf).selectExpr("l_orderkey as page", "pos as id", "l_extendedprice as score", *[f"{v} as {k}" for k, v in BOX.items()])


PREDICTED = """select l.doc_id, d.lang, l.quality::varchar as truth, case when d.n_chars >= 200 then '1' else '0' end as predicted
from labels l join documents d using (doc_id) where l.quality is not null"""


def predicted(spark: SparkSession, sf: str) -> DataFrame:
    lab = read(spark, sf, "labels").filter("quality is not null").select("doc_id", F.col("quality").cast("string").alias("truth"))
    return lab.join(read(spark, sf, "documents").selectExpr("doc_id", "lang", "case when n_chars >= 200 then '1' else '0' end as predicted"), "doc_id")


COUNTS = f"""with p as ({PREDICTED}), c as (select lang, truth, predicted, unnest(list_distinct([truth, predicted])) as class from p)
"""
COUNTED = """(count(*) filter (truth = class and predicted = class))::bigint as tp, (count(*) filter (predicted = class and truth <> class))::bigint as fp,
(count(*) filter (truth = class and predicted <> class))::bigint as fn"""
SCORED = """round(case when tp + fp > 0 then tp / (tp + fp)::double else 0 end, 6) as precision, round(case when tp + fn > 0 then tp / (tp + fn)::double else 0 end, 6) as recall,
round(case when 2 * tp + fp + fn > 0 then 2 * tp / (2 * tp + fp + fn)::double else 0 end, 6) as f1"""


def scored(df: DataFrame) -> DataFrame:
    return metrics.with_scores(df).withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


@query(COUNTS + f", m as (select class, lang, {COUNTED} from c group by grouping sets ((class), (class, lang))) select class, lang, tp, fp, fn, {SCORED} from m")
def exact_class_metrics(spark, sf):
    """Per-class scores, over all and a language, in one shuffle."""
    return scored(metrics.class_counts(predicted(spark, sf), "truth", "predicted", "lang", total=True))


@query(COUNTS + f", m as (select class, lang, {COUNTED} from c group by class, lang), s as (select lang, sum(tp)::bigint as tp, sum(fp)::bigint as fp, sum(fn)::bigint as fn from m group by lang) select lang, tp, fp, fn, {SCORED} from s")
def micro_scores(spark, sf):
    """G2, G7."""
    return metrics.micro(metrics.class_counts(predicted(spark, sf), "truth", "predicted", "lang"), "lang").withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


@query(COUNTS + f""", m as (select class, lang, {COUNTED} from c group by class, lang),
s as (select lang, case when tp + fp > 0 then tp / (tp + fp)::double else 0 end as p, case when tp + fn > 0 then tp / (tp + fn)::double else 0 end as r,
case when 2 * tp + fp + fn > 0 then 2 * tp / (2 * tp + fp + fn)::double else 0 end as f from m where tp + fp + fn > 0)
select lang, round(avg(p), 4) as precision, round(avg(r), 4) as recall, round(avg(f), 4) as f1 from s group by lang""")
def macro_scores(spark, sf):
    """G3."""
    return metrics.macro(metrics.class_counts(predicted(spark, sf), "truth", "predicted", "lang"), "lang", digits=4)


@query(f"""with p as ({PREDICTED}), n as (select truth, predicted, count(*)::bigint as n, (list_sort(list(doc_id)))[1:3] as samples from p group by truth, predicted),
q as (select *, n / sum(n) over (partition by truth) as share from n)
select truth, predicted, n, samples, round(share, 6) as proportion, row_number() over (partition by truth order by truth = predicted desc, share desc, predicted) as rank from q""")
def confusion_stats(spark, sf):
    """G12."""
    return metrics.confusion(predicted(spark, sf), "truth", "predicted", "doc_id").withColumn("proportion", F.round("proportion", 6))


@query("""with s as (select source, round(avg(n_chars), 6) as mean_chars, count(*)::bigint as docs from documents group by source)
select * from s union all select 'mean', round(avg(mean_chars), 3), sum(docs)::bigint from s""")
def benchmark_summary(spark, sf):
    """G9, U1."""
    d = read(spark, sf, "documents").groupBy("source").agg(F.round(F.avg("n_chars"), 6).alias("mean_chars"), F.count("*").alias("docs"))
    return metrics.benchmark_summary(d, "source", ["mean_chars"], "docs")


@query("select lang, count(*)::bigint as n_rows, count(distinct doc_id)::bigint as n_docs from (select doc_id, case when lang in ('de', 'en', 'fr', 'it') then lang else 'de' end as lang from documents) group by lang")
def language_support(spark, sf):
    """T20's default rule, G10."""
    return metrics.counts_by(read(spark, sf, "documents").select("doc_id", T.supported_language("lang", LANGUAGES).alias("lang")), "lang", "doc_id")


@query(f"""with p as ({PREDICTED}), n as (select truth, count(*)::bigint as support from p group by truth), m as (select predicted as truth, count(*)::bigint as predicted from p group by predicted)
select truth, support, predicted from n join m using (truth)""")
def metric_frame_join(spark, sf):
    """J15, G11."""
    p = predicted(spark, sf)
    return metrics.join_frames("truth", p.groupBy("truth").agg(F.count("*").alias("support")), p.groupBy(F.col("predicted").alias("truth")).agg(F.count("*").alias("predicted")))


@query("""with v as (select l_suppkey, l_quantity, count(*) filter (l_returnflag = 'A') as p, count(*) filter (l_returnflag = 'R') as t from lineitem group by 1, 2)
select l_suppkey, sum(least(p, t))::bigint as tp, sum(p - least(p, t))::bigint as fp, sum(t - least(p, t))::bigint as fn from v where p + t > 0 group by 1""")
def matched_counts(spark, sf):
    """Each true value serves one prediction."""
    li = read(spark, sf, "lineitem").select("l_suppkey", "l_quantity", "l_returnflag")
    return metrics.matched_counts(li.filter("l_returnflag = 'A'"), li.filter("l_returnflag = 'R'"), "l_quantity", "l_suppkey")


@query("""select l_suppkey, round(coalesce(case when stddev_pop(l_quantity) > 0 and stddev_pop(l_extendedprice) > 0 then corr(l_quantity, l_extendedprice) end, 0), 6) as pearson from lineitem group by 1""")
def pearson_by_supplier(spark, sf):
    """G14."""
    return metrics.pearson(read(spark, sf, "lineitem"), "l_quantity", "l_extendedprice", "l_suppkey").withColumn("pearson", F.round("pearson", 6))


@query("""with f as (select l_suppkey, count(distinct l_quantity) as k, regr_slope(l_discount, l_quantity) as s, regr_intercept(l_discount, l_quantity) as i, median(l_quantity) as m from lineitem group by 1),
g as (select l_suppkey, case when k > 1 then s else 0 end as slope, case when k > 1 then i else m end as intercept from f)
select g.l_suppkey, round(slope, 6) as slope, round(intercept, 6) as intercept, round(avg(power(l_discount - intercept - slope * l_quantity, 2)), 8) as mse from g join lineitem using (l_suppkey) group by all""")
def linear_fit_by_supplier(spark, sf):
    """G15."""
    return metrics.linear_fit(read(spark, sf, "lineitem"), "l_quantity", "l_discount", "l_suppkey").select("l_suppkey", F.round("slope", 6).alias("slope"), F.round("intercept", 6).alias("intercept"), F.round("mse", 8).alias("mse"))


INCLUDE, EXCLUDE = ["sand", "water", "stone", "river", "house", "wasser", "maison"], ["copyright", "license"]


@query(rf"""with t as (select doc_id, list_sort(list_distinct(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]+'))) as w from documents where text is not null)
select doc_id, list_filter(w, lambda x: list_contains({INCLUDE}, x)) as hits, list_has_any(w, {INCLUDE}) and not list_has_any(w, {EXCLUDE}) as is_description, len(w)::bigint as n_words from t""")
def keyword_match(spark, sf):
    """F9, T14, G13."""
    d = read(spark, sf, "documents").filter("text is not null")
    w = d.select("doc_id", F.inline(F.array(F.struct(F.array_distinct(T.tokenize(F.lower("text"))).alias("w")))))
    return w.select("doc_id", T.vocabulary_hits(F.col("w"), INCLUDE).alias("hits"), T.is_description(F.col("w"), INCLUDE, EXCLUDE).alias("is_description"), F.size("w").cast("bigint").alias("n_words"))


@query(r"""select doc_id, md5(lower(regexp_replace(coalesce(text, ''), '[^\p{L}\p{N}_]', '', 'g'))) as parsed, md5(regexp_replace(text, '\([^)]*\)', '', 'g')) as plain,
length(trim(regexp_replace(text, '[ \t\n\r]+', ' ', 'g')))::bigint as n_chars from documents""")
def normalize_text(spark, sf):
    """T1, T3, T4."""
    return read(spark, sf, "documents").select("doc_id", F.md5(T.parse_text("text")).alias("parsed"), F.md5(T.remove_parenthesised("text")).alias("plain"), F.length(T.normalize_spaces("text")).cast("bigint").alias("n_chars"))


@query(r"""with n as (select c_custkey, 'Nr. ' || c_name || ' 1:' || c_nationkey || ' (' || c_mktsegment || ')' as raw from customer)
select c_custkey, nullif(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(raw, '(?i)^nr\.', ''), '(?i)1\s?:\s?\d+', '', 'g'), '\([^)]*\)', '', 'g'), '[:._]', ' ', 'g'), '\s+', ' ', 'g')), '') as name from n""")
def clean_names(spark, sf):
    """T2, T6, T7."""
    raw = F.expr("'Nr. ' || c_name || ' 1:' || c_nationkey || ' (' || c_mktsegment || ')'")
    return read(spark, sf, "customer").select("c_custkey", T.clean_name(raw, ["nr."]).alias("name"))


NOTE = "'GW ' || cast(cast(floor(o_totalprice / 100) as bigint) % 300 as varchar) || '.5 m u.T. am ' || substr(cast(cast(o_orderdate as date) as varchar), 9, 2) || '.' || substr(cast(cast(o_orderdate as date) as varchar), 6, 2) || '.' || substr(cast(cast(o_orderdate as date) as varchar), 1, 4) || ' auf ' || cast(400 + o_custkey % 100 as varchar) || '.25 m u.M.'"


@query(rf"""with n as (select o_orderkey, {NOTE} as note from orders), p as (select o_orderkey, regexp_extract(lower(note), '([0-9.]+)\s*m\s*u\.t', 1)::double as d,
nullif(regexp_extract(note, '(\d+\.\d+)', 1), '')::double as other, try_strptime(regexp_extract(note, '\d{{1,2}}\.\d{{1,2}}\.\d{{4}}'), '%d.%m.%Y')::date as day, regexp_extract(lower(note), '(\d+(?:\.\d+)?)\s*m\s*u\.m\.', 1)::double as e from n)
select o_orderkey, case when d <= 200 then d when other <= 200 then other end as depth, strftime(day, '%Y-%m-%d') as date, e as elevation from p""")
def water_levels(spark, sf):
    """D1-D3, D6."""
    n = read(spark, sf, "orders").select("o_orderkey", F.expr(NOTE.replace("varchar", "string")).alias("note"))
    return n.select("o_orderkey", P.parse_depth("note").alias("depth"), F.date_format(P.parse_date("note"), "yyyy-MM-dd").alias("date"), P.parse_elevation("note").alias("elevation"))


@query("""with c as (select p_partkey, 600000 + p_partkey % 100000 as e, 150000 + p_size as n from part)
select p_partkey, e::double as east, n::double as north, 'LV03' as srs, (e > 324800 and e < 847500 and n > 74000 and n < 302000) as valid from c""")
def coordinates(spark, sf):
    """D7, F10."""
    t = F.expr("concat('Koordinaten: ', substr(cast(600000 + p_partkey % 100000 as string), 1, 3), '.', substr(cast(600000 + p_partkey % 100000 as string), 4), ' / ', cast(150000 + p_size as string))")
    c = read(spark, sf, "part").select("p_partkey", P.parse_coordinates(t).alias("c")).select("p_partkey", "c.east", "c.north", "c.srs")
    return c.withColumn("valid", P.valid_coordinates(F.col("east"), F.col("north")))


@query("""select l_orderkey, l_linenumber::bigint as line, l_linenumber::double as start, l_linenumber + l_quantity as "end", 'sand' as rest from lineitem""")
def interval_text(spark, sf):
    """D10."""
    t = F.expr("concat(l_linenumber, ',0 - ', cast(l_linenumber + l_quantity as string), ' m: sand')")
    return read(spark, sf, "lineitem").select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("line"), P.parse_interval(t).alias("i")).select("l_orderkey", "line", "i.start", "i.end", "i.rest")


@query(r"""select doc_id, len(regexp_extract_all(text, '\d+(?:\.\d+)?'))::bigint as n_numbers, case when len(regexp_extract_all(text, '\d+(?:\.\d+)?')) = 1 then try_cast(regexp_extract(text, '\d+(?:\.\d+)?') as double) end as number from documents where text is not null""")
def number_extract(spark, sf):
    """T21."""
    return read(spark, sf, "documents").filter("text is not null").select("doc_id", T.number_count("text").cast("bigint").alias("n_numbers"), T.single_number("text").alias("number"))


@query("""with w as (select *, lag(ts) over (partition by user_id order by ts, event_id) as before from events)
select event_id, user_id, (sum(case when before is not null and ts > before + interval 6 hour then 1 else 0 end) over (partition by user_id order by ts, event_id rows unbounded preceding))::bigint as block from w""")
def session_blocks(spark, sf):
    """The blocks of W5 with the caller's break."""
    e = read(spark, sf, "events")
    w = F.expr("ts > lag(ts) over (partition by user_id order by ts, event_id) + interval 6 hours")
    return sequence.session_blocks(e.withColumn("gap", w), ["user_id"], ["ts", "event_id"], F.col("gap")).select("event_id", "user_id", "block")


@query("""with w as (select *, lead(value) over o as n, lag(value) over o as p1, lag(value, 2) over o as p2 from events window o as (partition by user_id order by ts, event_id))
select event_id, (sum(case when value < least(p1, p2) and n < least(p1, p2) and p1 is not null and p2 is not null then 1 else 0 end) over (partition by user_id order by ts, event_id rows unbounded preceding))::bigint as part from w""")
def double_descending(spark, sf):
    """W6."""
    return sequence.double_descending(read(spark, sf, "events"), ["user_id"], ["ts", "event_id"], "value").select("event_id", "part")


@query(f"""with i as (select * from {ITEMS_SQL}) select a.l_orderkey, (count(*) filter (b.l_quantity > a.l_quantity))::bigint as pairs from i a left join i b on a.l_orderkey = b.l_orderkey and b.pos > a.pos group by 1""")
def ascending_pairs(spark, sf):
    """G16."""
    return sequence.ascending_pairs(items(spark, sf), ["l_orderkey"], "pos", "l_quantity")


@query(f"""with w as (select l_orderkey, pos, lag(l_quantity) over o as start, l_quantity as "end", row_number() over o as i from {ITEMS_SQL} window o as (partition by l_orderkey order by pos))
select l_orderkey, pos, start, "end" from w where i > 1 or "end" <> 0""")
def depth_intervals(spark, sf):
    """P8, P9."""
    return sequence.depth_intervals(items(spark, sf), ["l_orderkey"], ["pos"], "l_quantity")


@query("""with r as (select user_id, ts, max(value) as value from events where event_type = (select min(event_type) from events) group by 1, 2), l as (select * from events where event_type <> (select min(event_type) from events))
select l.event_id, r.value as prior from l asof left join r on l.user_id = r.user_id and l.ts >= r.ts""")
def nearest_prior(spark, sf):
    """The latest value before a time, as an as-of join."""
    e = read(spark, sf, "events")
    first = e.agg(F.min("event_type").alias("m"))
    e = e.join(F.broadcast(first), how="cross")  # one row
    return sequence.nearest_prior(e.filter("event_type <> m").select("event_id", "user_id", "ts"), e.filter("event_type = m").select("user_id", "ts", "value"), ["user_id"], "ts", "ts", "value", "prior").select("event_id", "prior")


@query(f"""with w as (select l_orderkey as k, pos as i, l_suppkey % 20 as s, l_suppkey % 20 + l_quantity as e from {ITEMS_SQL}),
b as (select a.k, a.i, min(b.i) filter (not (b.s >= a.s and b.e <= a.e)) as stop, count(b.i) as n from w a left join w b on a.k = b.k and b.i > a.i group by 1, 2)
select k as l_orderkey, i as line, (case when stop is null then n else (select count(*) from w where w.k = b.k and w.i > b.i and w.i < b.stop) end)::bigint as run from b""")
def interval_contains(spark, sf):
    """J17."""
    w = items(spark, sf).selectExpr("l_orderkey", "pos as line", "cast(l_suppkey % 20 as double) as s", "l_suppkey % 20 + l_quantity as e")
    return sequence.contained_run(w, ["l_orderkey"], ["line"], "s", "e").select("l_orderkey", "line", "run")


@query("""with k as (select *, count(value) over (partition by user_id, event_type) as known, row_number() over (partition by user_id, event_type, value order by ts desc, event_id desc) as r from events)
select event_id, user_id, event_type, value from k where r = 1 and (value is not null or known = 0)""")
def dedupe_by_key(spark, sf):
    """U3."""
    return sequence.dedupe_by_key(read(spark, sf, "events"), ["user_id", "event_type"], ["ts", "event_id"], "value").select("event_id", "user_id", "event_type", "value")


@query("""select o_custkey, o_orderkey, o_totalprice from (select *, row_number() over (partition by o_custkey order by o_totalprice desc, o_orderdate desc, o_orderkey) as r from orders) where r = 1""")
def best_choice(spark, sf):
    """O5."""
    return sequence.best_choice(read(spark, sf, "orders"), ["o_custkey"], F.desc("o_totalprice"), F.desc("o_orderdate"), F.col("o_orderkey")).select("o_custkey", "o_orderkey", "o_totalprice")


@query(None)
def progressions(spark, sf):
    """W9."""
    o = read(spark, sf, "orders").selectExpr("o_custkey", "o_orderdate", "o_orderkey", "cast(datediff(o_orderdate, date'1992-01-01') as double) as day")
    return sequence.arithmetic_progressions(o, "o_custkey", ["o_orderdate", "o_orderkey"], "day")


@query(f"""with b as ({BOX_SQL}) select page, id, round(sqrt(power(x1 - x0, 2) + power(y1 - y0, 2)), 6) as length, round((y1 - y0) / (x1 - x0), 6) as slope, round(degrees(atan((y1 - y0) / (x1 - x0))), 6) as angle,
round(x0 + (50 - y0) * (x1 - x0) / (y1 - y0), 6) as x_at_50, round(abs((y1 - y0) * 100 - (x1 - x0) * 50 + x1 * y0 - y1 * x0) / sqrt(power(x1 - x0, 2) + power(y1 - y0, 2)), 6) as distance, abs((y1 - y0) / (x1 - x0)) <= 0.5 as flat from b""")
def segment_maths(spark, sf):
    """P5, F1."""
    b = G.box()
    r = lambda c, n: F.round(c, 6).alias(n)
    return boxes(spark, sf).select(
        "page", "id", r(G.length(b), "length"), r(G.slope(b), "slope"), r(G.angle(b), "angle"), r(G.x_at(b, F.lit(50.0)), "x_at_50"), r(G.distance_to_line(b, F.lit(100.0), F.lit(50.0)), "distance"), G.is_horizontal(b, 0.5).alias("flat")
    )


PAIRS_SQL = f"with b as ({BOX_SQL}), j as (select a.*, b.id as r_id, b.x0 as bx0, b.y0 as by0, b.x1 as bx1, b.y1 as by1 from b a join b on a.page = b.page and a.id < b.id and a.x0 < b.x1 and b.x0 < a.x1 and a.y0 < b.y1 and b.y0 < a.y1)"


@query(PAIRS_SQL + """ select page, id, r_id, round(least(x1, bx1) - greatest(x0, bx0), 6) as x_shared, round(least(y1, by1) - greatest(y0, by0), 6) as y_shared,
least(x1, bx1) - greatest(x0, bx0) > 0.5 * least(x1 - x0, bx1 - bx0) as wide, x0 <= bx0 and y0 <= by0 and x1 >= bx1 and y1 >= by1 as holds from j""")
def range_join_boxes(spark, sf):
    """J1, P1, P2."""
    b = boxes(spark, sf)
    a, o = G.box(), G.box("r_")
    j = matching.range_join(b, b.select("page", "id", "x0", "y0", "x1", "y1"), ["page"]).filter("id < r_id")
    return j.select("page", "id", "r_id", F.round(G.x_overlap(a, o), 6).alias("x_shared"), F.round(G.y_overlap(a, o), 6).alias("y_shared"), G.x_overlap_significant(a, o, 0.5).alias("wide"), G.contains(a, o).alias("holds"))


@query(f"""with b as ({BOX_SQL}), k as (select * from b where id = 1), n as (select page, x0 - 2 * (x1 - x0) as x0, y0, x1 + 10 * (x1 - x0) as x1, y1 from k union all select page, x0, y0, x1, y1 + 3 * (y1 - y0) from k)
select distinct b.page, b.id as line from n join b on n.page = b.page and n.x0 < b.x1 and b.x0 < n.x1 and n.y0 < b.y1 and b.y0 < n.y1""")
def near_lines(spark, sf):
    """J2, U1."""
    b = boxes(spark, sf)
    return matching.near_lines(b.filter("id = 1"), b, ["page"], 2, 10, 3, 0).select("page", F.col("r_id").alias("line"))


@query(f"""with recursive b as ({BOX_SQL}), o as (select *, row_number() over (partition by page order by score desc, id) as k from b where score >= 0),
f as (select page, k, [{{'id': id, 'x0': x0, 'y0': y0, 'x1': x1, 'y1': y1, 'score': score}}] as kept from o where k = 1
union all select o.page, o.k, case when len(list_filter(f.kept, lambda z: z.x0 < o.x1 and o.x0 < z.x1 and z.y0 < o.y1 and o.y0 < z.y1)) > 0 then f.kept
else list_append(f.kept, {{'id': o.id, 'x0': o.x0, 'y0': o.y0, 'x1': o.x1, 'y1': o.y1, 'score': o.score}}) end from f join o on o.page = f.page and o.k = f.k + 1),
l as (select page, unnest(arg_max(kept, k)) as z from f group by page) select page, z.id as id, z.score as score, z.x0 as x0, z.y0 as y0, z.x1 as x1, z.y1 as y1 from l""")
def nms_boxes(spark, sf):
    """O1, O2."""
    return matching.suppress(boxes(spark, sf), ["page"], "score", "id")


@query(f"""with b as ({BOX_SQL}), c as (select *, (x1 - x0) * (y1 - y0) as size from b)
select page, id, x0, y0, x1, y1 from c where not exists (select 1 from c o where o.page = c.page and (o.size > c.size or (o.size = c.size and o.id < c.id)) and o.x0 <= c.x0 and o.y0 <= c.y0 and o.x1 >= c.x1 and o.y1 >= c.y1)""")
def keep_longest(spark, sf):
    """O4."""
    return matching.keep_longest(boxes(spark, sf).withColumn("size", G.area(G.box())), ["page"], "size", "id")


@query(PAIRS_SQL.replace("with b", "with recursive b") + """, e as (select page * 1000 + id as u, page * 1000 + r_id as v from j), bi as (select u, v from e union select v, u from e),
r as (select u as node, u as seen from bi union select r.node, bi.v from r join bi on r.seen = bi.u) select node, min(seen) as component from r group by node""")
def components(spark, sf):
    """The components of H2-H4: boxes that intersect, directly or over others."""
    b = boxes(spark, sf)
    e = matching.range_join(b, b, ["page"]).filter("id < r_id").selectExpr("page * 1000 + id as src", "page * 1000 + r_id as dst")
    return connected_components(e)


@query(f"with b as ({BOX_SQL}) select page, min(x0) as x0, min(y0) as y0, max(x1) as x1, max(y1) as y1, count(*)::bigint as n, round(least(1, least(0.2, sum((x1 - x0) * (y1 - y0)) / 100000 / 0.4) + least(0.5, count(*) / 90.0::double) + least(0.3, 0.01 * count(*)::double)), 6) as confidence from b group by page")
def outer_rectangles(spark, sf):
    """P3, P7, G19."""
    g = boxes(spark, sf).groupBy("page").agg(*G.union_aggregates(), F.count("*").alias("n"), F.sum(G.area(G.box())).alias("a"))
    return g.select("page", "x0", "y0", "x1", "y1", "n", F.round(G.table_confidence(F.col("a") / 100000, F.col("n"), F.col("n")), 6).alias("confidence"))


@query(f"""with b as ({BOX_SQL}), p as (select page, id, (x0 + x1) / 2 as px, (y0 + y1) / 2 as py from b where id > 2), t as (select * from b where id <= 2),
d as (select p.page, p.id as point, t.id as box, sqrt(power(greatest(0, x0 - px, px - x1), 2) + power(greatest(0, y0 - py, py - y1), 2)) as distance from p join t using (page))
select page, point, box, round(distance, 6) as distance from (select *, row_number() over (partition by page, point order by distance, box) as r from d) where r = 1""")
def nearest_box(spark, sf):
    """J9."""
    b = boxes(spark, sf)
    pts = b.filter("id > 2").selectExpr("page", "id as point", "(x0 + x1) / 2 as px", "(y0 + y1) / 2 as py")
    return matching.nearest(pts, b.filter("id <= 2").selectExpr("page", "id as box", "x0", "y0", "x1", "y1"), ["page"], "point", "box").withColumn("distance", F.round("distance", 6))


@query(None)
def text_similarity(spark, sf):
    """Whole benchmark texts, against those of the same key (a tenth of the items) whose length allows the ratio."""
    b = read(spark, sf, "benchmark").select("item_id", F.expr("item_id % 10").alias("file"), T.parse_text("text").alias("t"))
    return matching.similar_texts(b, b, "file", "item_id", "t", 0.3).filter("left_id < right_id").withColumn("ratio", F.round("ratio", 6))


@query(None)
def sequence_alignment(spark, sf):
    """The assistant's turns against the user's, as two layer lists."""
    c = read(spark, sf, "conversations").filter("role in ('user', 'assistant') and turn is not null")
    rows = c.selectExpr("conv_id", "if(role = 'user', 'p', 't') as side", "turn as pos", "cast(turn as double) as start", "cast(turn + 1 as double) as end", "text")
    return matching.align_layers(rows, "conv_id", "depth")


@query("select r_name, n_name, count(distinct o_orderkey)::bigint as orders, round(sum(l_extendedprice * (1 - l_discount)), 2) as revenue from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey group by 1, 2")
def relational_core(spark, sf):
    """Assembly of five tables."""
    li, o, c, n, r = (read(spark, sf, t) for t in ("lineitem", "orders", "customer", "nation", "region"))
    j = li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    return j.groupBy("r_name", "n_name").agg(F.countDistinct("o_orderkey").alias("orders"), F.round(F.sum(F.expr("l_extendedprice * (1 - l_discount)")), 2).alias("revenue"))


@query(None)
def merged_segments(spark, sf):
    """The boxes' diagonals, merged a page."""

    def fold(rows):
        merged = layout.merge_segments([(r["x0"], r["y0"], r["x1"], r["y1"]) for r in rows])
        return [{"page": rows[0]["page"], "seg": i, "x0": s[0], "y0": s[1], "x1": s[2], "y1": s[3]} for i, s in enumerate(merged)]

    return sequence.grouped(boxes(spark, sf), ["page"], ["id"], fold, "page bigint, seg bigint, x0 double, y0 double, x1 double, y1 double")


@query(None)
def interval_hierarchy(spark, sf):
    """H6: parents and sublayers among an order's depth ranges."""

    def fold(rows):
        kinds = layout.interval_hierarchy([(r["s"], r["e"]) for r in rows])
        return [{"page": r["page"], "id": r["id"], "kind": k} for r, k in zip(rows, kinds)]

    d = items(spark, sf).selectExpr("l_orderkey as page", "pos as id", "cast(l_suppkey % 20 as double) as s", "l_suppkey % 20 + l_quantity as e")
    return sequence.grouped(d, ["page"], ["id"], fold, "page bigint, id bigint, kind string")


@query(f"""with i as (select l_orderkey as page, pos, l_quantity as v, lag(l_quantity) over (partition by l_orderkey order by pos) as before from {ITEMS_SQL})
select page, count(*)::bigint as n, count(*) >= 3 and bool_and(before is null or v > before) and round(case when stddev_pop(v) > 0 and stddev_pop(pos) > 0 then corr(pos, v) else 0 end, 9) > 0.95 as valid from i group by page""")
def column_validity(spark, sf):
    """F13 without its noise limit: at least three entries, rising, correlated with their position."""
    w = F.expr("lag(l_quantity) over (partition by l_orderkey order by pos)")
    d = items(spark, sf).withColumn("before", w)
    rising = F.bool_and(F.col("before").isNull() | (F.col("l_quantity") > F.col("before")))
    valid = (F.count("*") >= 3) & rising & (F.round(metrics.correlation("pos", "l_quantity"), 9) > 0.95)
    return d.groupBy(F.col("l_orderkey").alias("page")).agg(F.count("*").alias("n"), valid.alias("valid"))


@query(None)
def stemmed_usage(spark, sf):
    """How often each stem is met; distinct words are stemmed once each."""
    words = read(spark, sf, "documents").select(F.explode(T.tokenize(F.lower("text"))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return words.select(fuzzy.stems(F.array("word"))[0].alias("stem"), "n").groupBy("stem").agg(F.sum("n").alias("n"))


@query(None)
def fuzzy_keys(spark, sf):
    """Distinct brand names against misspelt keys."""
    return read(spark, sf, "part").select("p_brand").distinct().select("p_brand", fuzzy.fuzzy_key("p_brand", ["Brant", "Barnd"]).alias("key"))


@query(None)
def stitched_pages(spark, sf):
    """A conversation's turns as layers, three a page."""
    c = read(spark, sf, "conversations").filter("conv_id is not null and turn is not null")
    d = c.selectExpr("conv_id", "turn div 3 as page", "turn as pos", "cast(turn as double) as start", "cast(turn + 1 as double) as end", "text")
    return matching.stitch_pages(d, "conv_id")


@query("select doc_id, source, case when n_chars > 400 then 'a' when n_chars > 100 then 'b' else 'c' end as priority from (select *, dense_rank() over (partition by source order by case when n_chars > 400 then 1 when n_chars > 100 then 2 else 3 end) as r from documents) where r = 1")
def first_alternative(spark, sf):
    """Of each source, the rows of the best alternative that has any."""
    p = F.expr("case when n_chars > 400 then 'a' when n_chars > 100 then 'b' else 'c' end")
    d = read(spark, sf, "documents").withColumn("priority", p)
    best = d.groupBy("source").agg(F.min("priority").alias("priority"))
    return d.join(best, ["source", "priority"], "left_semi").select("doc_id", "source", "priority")


@query("select o_orderkey, o_custkey from orders o where (select count(*) from orders p where p.o_custkey = o.o_custkey) = 1 or not exists (select 1 from lineitem where l_orderkey = o_orderkey and l_returnflag = 'R')")
def guarded_anti_join(spark, sf):
    """Rows with a match go, but only where their group has more than one."""
    o = read(spark, sf, "orders").select("o_orderkey", "o_custkey").withColumn("n", F.expr("count(*) over (partition by o_custkey)"))
    hit = read(spark, sf, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey")).distinct().withColumn("hit", F.lit(True))
    return o.join(hit, "o_orderkey", "left").filter("n = 1 or hit is null").select("o_orderkey", "o_custkey")
