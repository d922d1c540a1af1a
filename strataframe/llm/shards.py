"""Operator 2: sharding by a k-d tree over document metadata.

Dimensions: text bytes, ``doc_id``, and 32-bit hashes of ``lang`` and ``source``. A node
heavier than ``TARGET_BYTES`` is split at the weighted median of its widest
dimension (its range over the range of the whole table; the first of equals): the
lower child takes the values up to the smallest one at which the accumulated bytes
reach half of the node's, or below it if that is the largest value. All nodes of a level
are split together. Medians are found exactly and distributedly by histogram
refinement: bytes are summed by (node, one of ``BUCKETS`` equal parts of the
interval that holds the median), which then becomes the interval, until a part is
one value. Texts are read once, for their length; levels move metadata only.

Defined cases: null or empty texts have no bytes; a null dimension is -1; rows
equal in all dimensions cannot be parted, so their node stays whole even if too
heavy; an empty table has no shards. Repeated rows are each placed. Extra columns
are ignored. A shard's number is its node's in heap order, the root being 1.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.plans.runtime import broadcast_if_small, discard, materialize, pick

TARGET_BYTES = 64 << 20
BUCKETS = 4096
DIMS = ("size", "id", "lang_code", "source_code")


def _metadata(docs: DataFrame) -> DataFrame:
    code = lambda c: F.coalesce(F.conv(F.substring(F.md5(F.col(c)), 1, 8), 16, 10).cast("bigint"), F.lit(-1))
    d = pick(docs, doc_id="bigint", text="string", lang="string", source="string")
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint")
    return d.select(
        "doc_id", size.alias("size"), F.coalesce("doc_id", F.lit(-1)).alias("id"), code("lang").alias("lang_code"), code("source").alias("source_code")
    )


def _widest(ranges: list[int]) -> tuple:
    """The number and ends of a node's widest dimension, as expressions over its minima and maxima."""
    width = [f"({f'(cast(hi_{d} as double) - lo_{d}) / {float(r)!r}' if r else '0D'})" for d, r in zip(DIMS, ranges)]
    most = f"greatest({', '.join(width)})"
    at = "case " + " ".join(f"when {w} = {most} then {i}" for i, w in enumerate(width)) + " end"
    return at, most


def shard(docs: DataFrame, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """``(doc_id, shard, size)`` for every row."""
    active = materialize(_metadata(docs).withColumn("node", F.lit(1).cast("bigint")), "kd")
    used = [active]  # all that the result reads
    ends = active.agg(*[f(d).alias(f"{n}_{d}") for d in DIMS for n, f in (("lo", F.min), ("hi", F.max))]).first()
    ranges = [(ends[f"hi_{d}"] or 0) - (ends[f"lo_{d}"] or 0) for d in DIMS]
    at, most = _widest(ranges)
    value = F.expr("case dim " + " ".join(f"when {i} then {d}" for i, d in enumerate(DIMS)) + " end")
    done: list[DataFrame] = []
    while True:
        stats = active.groupBy("node").agg(F.sum("size").alias("w"), *[f(d).alias(f"{n}_{d}") for d in DIMS for n, f in (("lo", F.min), ("hi", F.max))])
        split = stats.filter((F.col("w") > target_bytes) & (F.expr(most) > 0)).withColumn("dim", F.expr(at))
        lo = F.expr("case dim " + " ".join(f"when {i} then lo_{d}" for i, d in enumerate(DIMS)) + " end")
        hi = F.expr("case dim " + " ".join(f"when {i} then hi_{d}" for i, d in enumerate(DIMS)) + " end")
        # below: bytes left of the interval [a, b] that holds the median
        split = materialize(split.select("node", "dim", "w", lo.alias("a"), hi.alias("b"), hi.alias("top"), F.lit(0).cast("bigint").alias("below")), "kd-split")
        if split.isEmpty():
            done.append(active.select("doc_id", F.col("node").alias("shard"), "size"))
            break
        inner = broadcast_if_small(split, 56)
        refined = False
        done.append(active.join(inner.select("node"), "node", "left_anti").select("doc_id", F.col("node").alias("shard"), "size"))
        while split.filter("b > a").limit(1).count():
            narrow = _refine(active, split, value)
            if refined:
                discard(split)
            else:
                used.append(split)  # the first is still read by the result of this level
            split, refined = narrow, True
        cut = split.selectExpr("node", "dim", "if(b = top, b - 1, b) as cut")
        cut = materialize(cut, "kd-cut")
        active = materialize(
            active.join(broadcast_if_small(cut, 24), "node").withColumn("node", F.col("node") * 2 + F.when(value > F.col("cut"), 1).otherwise(0)).select(*active.columns),
            "kd",
        )
        used += [split, cut, active]
    out = done[0]
    for d in done[1:]:
        out = out.union(d)
    out = materialize(out, "shards")
    for table in used:
        discard(table)
    return out


def _refine(active: DataFrame, split: DataFrame, value) -> DataFrame:
    """One round: each open interval shrinks to the part that holds the weighted median."""
    open_ = broadcast_if_small(split, 56)
    step = F.expr(f"greatest(1, cast(ceil((b - a + 1) / {BUCKETS}D) as bigint))")
    parts = (
        active.join(open_, "node")
        .withColumn("v", value)
        .filter("v between a and b")
        .withColumn("part", F.floor((F.col("v") - F.col("a")) / step).cast("bigint"))
        .groupBy("node", "part")
        .agg(F.sum("size").alias("mass"))
    )
    running = F.expr("sum(mass) over (partition by node order by part rows unbounded preceding)")
    joined = parts.withColumn("run", running).join(open_, "node").filter("2 * (below + run) >= w")
    first = joined.groupBy("node", "dim", "w", "a", "b", "top", "below").agg(F.min(F.struct("part", "run", "mass")).alias("m"))
    nxt = first.select(
        "node",
        "dim",
        "w",
        (F.col("a") + F.col("m.part") * step).alias("na"),
        F.least("b", F.col("a") + (F.col("m.part") + 1) * step - 1).alias("nb"),
        "top",
        (F.col("below") + F.col("m.run") - F.col("m.mass")).alias("nbelow"),
    )
    return materialize(nxt.select("node", "dim", "w", F.col("na").alias("a"), F.col("nb").alias("b"), "top", F.col("nbelow").alias("below")), "kd-split")


def op2_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(spark.read.parquet(f"{sf_dir}/documents.parquet"))


#: A target at which small tables are split many times over as well.
FINE_BYTES = 128 << 10


def op2_kd_shards_fine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(spark.read.parquet(f"{sf_dir}/documents.parquet"), FINE_BYTES)


def sql(target_bytes: int = TARGET_BYTES, levels: int = 16) -> str:
    """The same tree with window sums over values, ``levels`` levels deep."""
    code = lambda c: f"coalesce(('0x' || substr(md5({c}), 1, 8))::bigint, -1)"
    ctes = [
        f"l0 as (select row_number() over () as r, doc_id, coalesce(strlen(text), 0)::bigint as size, coalesce(doc_id, -1) as id, {code('lang')} as lang_code, {code('source')} as source_code, 1::bigint as node from documents)",
        "g as (select " + ", ".join(f"(max({d}) - min({d}))::double as r_{d}" for d in DIMS) + " from l0)",
    ]
    width = [f"(case when r_{d} > 0 then (max({d}) - min({d}))::double / r_{d} else 0 end)" for d in DIMS]
    most = f"greatest({', '.join(width)})"
    for k in range(levels):
        at = "case " + " ".join(f"when {w} = {most} then {i}" for i, w in enumerate(width)) + " end"
        ctes.append(
            f"s{k} as (select node, sum(size) as w, {at} as dim from l{k}, g group by node, {', '.join('r_' + d for d in DIMS)} having sum(size) > {target_bytes} and {most} > 0)"
        )
        val = "case dim " + " ".join(f"when {i} then {d}" for i, d in enumerate(DIMS)) + " end"
        ctes.append(f"v{k} as (select node, w, {val} as v, sum(size) as mass from l{k} join s{k} using (node) group by all)")
        ctes.append(f"c{k} as (select *, sum(mass) over (partition by node order by v rows unbounded preceding) as run, max(v) over (partition by node) as top from v{k})")
        ctes.append(f"m{k} as (select node, min(case when v = top then v - 1 else v end) as cut from c{k} where 2 * run >= w group by node)")
        ctes.append(
            f"l{k + 1} as materialized (select r, doc_id, size, id, lang_code, source_code, case when cut is null then l{k}.node else l{k}.node * 2 + case when {val} > cut then 1 else 0 end end as node"
            f" from l{k} left join s{k} on s{k}.node = l{k}.node left join m{k} on m{k}.node = l{k}.node)"
        )
    return "with " + ",\n".join(ctes) + f"\nselect doc_id, node as shard, size from l{levels}"


SQL, FINE_SQL = sql(), sql(FINE_BYTES)
