"""Bounded samples of labelled rows, without sending a class of a few values through a few tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataframe.plans.runtime import pick

#: Rows let through a class by their hash, for each that is wanted.
SLACK = 4


def smallest_hashes(labelled: DataFrame, label: str, k: int) -> DataFrame:
    """``(doc_id, label)``: of each label the ``k`` distinct ids with the smallest hash (ties by id), or all if there are fewer.

    Counts of the labels, combined before their shuffle, give a bound on the hash under which
    some ``SLACK * k`` rows of a label are expected; only these are shuffled and ranked, which
    is exact, as the bound is raised for a label that has fewer than ``k`` ids under it.
    Rows without an id or a label take no part.
    """
    rows = labelled.select("doc_id", label).dropna()
    count = {r[0]: r[1] for r in rows.groupBy(label).agg(F.count("*")).collect()}
    if not count:
        return rows
    share = {v: min(1.0, SLACK * k / n) for v, n in count.items()}
    h = F.xxhash64("doc_id")
    while True:
        bound = F.create_map(*[F.lit(x) for v, s in share.items() for x in (v, -(1 << 63) + min((1 << 64) - 1, int(s * (1 << 64))))])
        some = rows.filter(h <= bound[F.col(label)]).distinct()
        ranked = some.withColumn("__r", F.row_number().over(Window.partitionBy(label).orderBy(h, "doc_id"))).filter(F.col("__r") <= k).select("doc_id", label)
        got = {r[0]: r[1] for r in ranked.groupBy(label).agg(F.count("*")).collect()}
        few = [v for v, s in share.items() if s < 1 and got.get(v, 0) < k]
        if not few:
            return ranked
        share |= {v: min(1.0, 16 * share[v]) for v in few}


def sample_texts(docs: DataFrame, ids: DataFrame, label: str, own_label: bool) -> DataFrame:
    """``(doc_id, label, text)``: one text a sampled id, that with the smallest hash; ``own_label``: the label is a column of ``docs`` and must agree."""
    d = pick(docs, doc_id="bigint", text="string", **({label: "string"} if own_label else {})).filter("text is not null")
    held = d.join(F.broadcast(ids), ["doc_id", label] if own_label else "doc_id")  # as many rows as the sample asks for
    return held.groupBy("doc_id", label).agg(F.min(F.struct(F.xxhash64("text"), "text")).getField("text").alias("text"))
