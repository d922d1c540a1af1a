"""Description classifiers as DataFrame transforms (operators Z1, Z3, T15, T16, O9)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataframe.functions.text import map_class, ordered_coverage, tokenize

Classifier = Callable[[DataFrame], DataFrame]


def dummy(label: str) -> Classifier:
    """The same class for every row."""
    return lambda df: df.withColumn("prediction_class", F.lit(label))


def baseline(patterns: dict[str, list[list[str]]], default: str, threshold: float = 0.75, text: str = "text") -> Classifier:
    """The class of the pattern best covered in order; then the longer pattern, then the one listed first. Under the threshold, the default."""
    flat = [(cls, p) for cls, many in patterns.items() for p in many if p]

    def run(df: DataFrame) -> DataFrame:
        if not flat:
            return df.withColumn("prediction_class", F.lit(default))
        toks = tokenize(F.lower(F.coalesce(F.col(text), F.lit(""))))
        held = df.select("*", F.inline(F.array(F.struct(toks.alias("__t")))))
        scored = F.array(*[F.struct(ordered_coverage(F.col("__t"), p).alias("c"), F.lit(len(p)).alias("n"), F.lit(-i).alias("i"), F.lit(cls).alias("cls")) for i, (cls, p) in enumerate(flat)])
        best = F.array_max(F.filter(scored, lambda s: s["c"] >= threshold))
        return held.withColumn("prediction_class", F.coalesce(best["cls"], F.lit(default))).drop("__t")

    return run


def answers(names: list[str], default: str, reply: str = "reply") -> Classifier:
    """Z3: the class in a model's tagged reply; anything else is the default. The call itself is an adapter's."""
    return lambda df: df.withColumn("prediction_class", map_class(F.trim(F.regexp_extract(reply, r"(?s)<answer>(.*?)</answer>", 1)), names, default))


def make(kind: str, **settings) -> Classifier:
    """A classifier by name."""
    kinds = {"dummy": dummy, "baseline": baseline, "answers": answers}
    if kind not in kinds:
        raise ValueError(f"no classifier named {kind!r}; there are {sorted(kinds)}")
    return kinds[kind](**settings)
