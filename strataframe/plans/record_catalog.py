"""Queries of settings, vocabularies and record shapes over the driver's tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataframe.operators import page
from strataframe.plans.catalog import query, read
from strataframe.plans.page_catalog import LINE, sql, table
from strataframe.sources import settings

ADDRESS = "'https://x.org/' || case when n_nationkey % 3 = 0 then 'Nation' else 'NationNo' end || cast(n_nationkey as varchar)"
TRIPLES = [
    ("https://w3.org/core#prefLabel", "n_name", "'en'"),
    ("https://w3.org/core#altLabel", "'b' || n_name", "'en'"),
    ("https://w3.org/core#altLabel", "'a' || n_name", "'de'"),
    ("https://w3.org/core#definition", "'about ' || n_name", "'en'"),
    ("https://w3.org/core#broader", "'https://x.org/Region' || cast(n_regionkey as varchar)", "cast(null as varchar)"),
]


def concepts(spark, sf):
    n, out = read(spark, sf, "nation"), None
    for p, o, lang in TRIPLES:
        t = n.selectExpr(f"{ADDRESS} as subject".replace("varchar", "string"), f"'{p}' as predicate", f"{o} as object".replace("varchar", "string"), f"{lang} as language".replace("varchar", "string"))
        out = t if out is None else out.unionByName(t)
    return settings.concept_rows(out)


CONCEPTS_SQL = """c as (select (case when n_nationkey % 3 = 0 then 'Nation' else 'NationNo' end || n_nationkey) as id, case when n_nationkey % 3 = 0 then 1 else 2 end as term_order, * from nation)"""


@query(f"with {CONCEPTS_SQL} select id, term_order, n_name as pref, 'about ' || n_name as definition, ['b' || n_name] as alt_en, ['a' || n_name] as alt_de, len([]::varchar[]) as n_fr, ['Region' || n_regionkey] as broader from c")
def concept_rows(spark, sf):
    """S10."""
    return concepts(spark, sf).selectExpr("id", "term_order", "prefLabel_en as pref", "definition", "altLabel_en as alt_en", "altLabel_de as alt_de", "size(altLabel_fr) as n_fr", "broader")


@query(f"""with {CONCEPTS_SQL}, o as (select * from c where term_order = 1) select 'en' as language, id, [n_name, 'b' || n_name] as labels, 'about ' || n_name as description from o union all select 'de', id, ['a' || n_name], 'about ' || n_name from o
union all select 'fr', id, [], 'about ' || n_name from o union all select 'it', id, [], 'about ' || n_name from o union all select * from (values ('de', 'kA', ['keine Angabe', 'unbekannt', 'nicht beschrieben'], 'not specified'), ('fr', 'kA', ['sans indication'], 'not specified'),
('en', 'kA', ['not specified'], 'not specified'), ('it', 'kA', ['senza indicazioni'], 'not specified'))""")
def class_vocabulary(spark, sf):
    """S11."""
    return settings.vocabulary(concepts(spark, sf))


@query("""select o_orderkey, case o_orderkey % 3 when 0 then 'layer_f1' when 1 then 'name_f1' else 'deep/er_f1' end as key from orders""")
def short_metric_keys(spark, sf):
    """A5."""
    k = F.expr("case o_orderkey % 3 when 0 then 'metrics/geology/layer_f1' when 1 then 'name_f1' else 'metadata/deep/er_f1' end")
    return read(spark, sf, "orders").select("o_orderkey", settings.short_metric_key(k).alias("key"))


@query("""with n as (select 'f' || o_custkey || '.v1.pdf' as file, row_number() over (partition by o_custkey order by o_orderkey) - 1 as borehole_index, count(*) over (partition by o_custkey) as n, o_custkey from orders)
select file, borehole_index, 'f' || o_custkey || '.v1' || case when n > 1 then '_' || borehole_index else '' end || '.csv' as name from n""")
def csv_names(spark, sf):
    """K2's names."""
    d = read(spark, sf, "orders").selectExpr("'f' || o_custkey || '.v1.pdf' as file", "row_number() over (partition by o_custkey order by o_orderkey) - 1 as borehole_index")
    return settings.csv_names(d)


@query("select 'f' || o_orderkey as file, 0 as borehole_index, o_orderstatus as status from orders")
def wrapped_boreholes(spark, sf):
    """A4: one record a file as a list of one borehole."""
    d = read(spark, sf, "orders").selectExpr("'f' || o_orderkey as file", "o_orderstatus as status")
    return settings.as_boreholes(d, "status").selectExpr("file", "inline(boreholes)")


@query(f"""with l as ({sql(LINE, {"text": "case when l_partkey % 5 = 0 then 'two words' when l_partkey % 5 = 1 then 'end.' else 'sand' end"})}), s as (select * from l where text = 'sand'),
n as (select a.page, a.id, coalesce(max((abs(a.y0 - b.y0) < 1)::int), 0) as y, coalesce(max((abs(a.x0 - b.x0) < 1)::int), 0) as x from s a left join s b on a.page = b.page and b.id < a.id group by 1, 2),
g as (select page, sum(y) as y, sum(x) as x from n group by 1) select p.page, coalesce(y > 1 or x > 2, false) as legend from (select distinct page from l) p left join g using (page)""")
def legend_blocks(spark, sf):
    """F19."""
    return page.legend_blocks(table(spark, sf, LINE, {"text": "case when l_partkey % 5 = 0 then 'two words' when l_partkey % 5 = 1 then 'end.' else 'sand' end"}))
