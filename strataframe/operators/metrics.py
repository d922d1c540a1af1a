"""Scores against ground truth and reports (operators G1-G18, J14, J15, Z9-Z11, U2).

Each is one aggregation with map-side partial sums; shares that divide by nothing are 0.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def share(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def with_scores(df: DataFrame) -> DataFrame:
    """G1: precision, recall and F1 beside ``tp, fp, fn``; 0 where the denominator is."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return df.withColumns({"precision": share(tp, tp + fp), "recall": share(tp, tp + fn), "f1": share(2 * tp, 2 * tp + fp + fn)})


def micro(df: DataFrame, *keys: str) -> DataFrame:
    """Summed counts a key."""
    return with_scores(df.groupBy(*keys).agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in ("tp", "fp", "fn")]))


def macro(df: DataFrame, *keys: str, digits: int | None = None) -> DataFrame:
    """Mean scores a key over rows that are not all zero; rounded if asked."""
    some = with_scores(df.filter("tp + fp + fn > 0"))
    show = (lambda c: F.round(c, digits)) if digits is not None else (lambda c: c)
    return some.groupBy(*keys).agg(*[show(F.coalesce(F.avg(c), F.lit(0.0))).alias(c) for c in ("precision", "recall", "f1")])


def class_counts(df: DataFrame, truth: str, predicted: str, *by: str, total: bool = False) -> DataFrame:
    """Tp, fp and fn of every class met; ``total`` adds the rows over all of ``by`` (null there) in the same shuffle."""
    cls = F.explode(F.array_distinct(F.array(truth, predicted))).alias("class")
    t, p, c = F.col(truth), F.col(predicted), F.col("class")
    rows = df.select(*by, truth, predicted, cls).filter("class is not null")
    counts = {
        "tp": F.count_if(t.eqNullSafe(c) & p.eqNullSafe(c)),
        "fp": F.count_if(p.eqNullSafe(c) & ~t.eqNullSafe(c)),
        "fn": F.count_if(t.eqNullSafe(c) & ~p.eqNullSafe(c)),
    }
    agg = [v.cast("bigint").alias(k) for k, v in counts.items()]
    if total and by:
        return rows.groupingSets([["class"], ["class", *by]], "class", *by).agg(*agg)
    return rows.groupBy("class", *by).agg(*agg)


def layer_counts(df: DataFrame, correct: str, *by: str) -> DataFrame:
    """Tp by a flag, fp the other predictions, fn what of ``n_truth`` is missed; one row a file comes in with its predictions in rows."""
    g = df.groupBy(*by).agg(F.count_if(F.col(correct)).alias("tp"), F.count("*").alias("n"), F.max("n_truth").alias("t"))
    return g.select(*by, "tp", (F.col("n") - F.col("tp")).alias("fp"), (F.col("t") - F.col("tp")).alias("fn"))


def benchmark_summary(df: DataFrame, name: str, numbers: list[str], docs: str) -> DataFrame:
    """The rows, then their mean (3 digits) and summed document count under the name ``mean``."""
    means = df.agg(F.lit("mean").alias(name), *[F.round(F.avg(c), 3).alias(c) for c in numbers], F.sum(docs).alias(docs))
    return df.select(name, *numbers, docs).unionByName(means)


def counts_by(df: DataFrame, key: str, ident: str) -> DataFrame:
    """Rows and distinct documents a key."""
    return df.groupBy(key).agg(F.count("*").alias("n_rows"), F.countDistinct(ident).alias("n_docs"))


def confusion(df: DataFrame, first: str, second: str, ident: str, samples: int = 3) -> DataFrame:
    """Counts and proportions of the second class within the first, the smallest ``samples`` ids of each, ranked by sameness and proportion."""
    pairs = df.groupBy(first, second).agg(F.count("*").alias("n"))
    order = Window.partitionBy(first, second).orderBy(ident)
    some = (
        df.select(first, second, ident).withColumn("__r", F.row_number().over(order)).filter(F.col("__r") <= samples)
        .groupBy(first, second).agg(F.array_sort(F.collect_list(ident)).alias("samples"))
    )
    whole = Window.partitionBy(first)
    out = pairs.withColumn("proportion", F.col("n") / F.sum("n").over(whole)).join(some, [first, second])
    rank = Window.partitionBy(first).orderBy((F.col(first) == F.col(second)).desc(), F.desc("proportion"), second)
    return out.withColumn("rank", F.row_number().over(rank).cast("bigint"))


def expression_usage(used: DataFrame, configured: DataFrame, *keys: str) -> tuple[DataFrame, DataFrame]:
    """How often each expression was used, and those configured but never used."""
    return used.groupBy(*keys).agg(F.count("*").alias("n")), configured.select(*keys).distinct().join(used, list(keys), "left_anti")


def correlation(x: str, y: str) -> Column:
    """G14 as an aggregate; ``corr`` itself would fail on a constant side."""
    both = F.when(F.col(x).isNotNull() & F.col(y).isNotNull(), F.col(x)), F.when(F.col(x).isNotNull() & F.col(y).isNotNull(), F.col(y))
    return F.coalesce(F.try_divide(F.covar_pop(x, y), F.nullif(F.stddev_pop(both[0]) * F.stddev_pop(both[1]), F.lit(0.0))), F.lit(0.0))


def pearson(df: DataFrame, x: str, y: str, *by: str) -> DataFrame:
    """0 where a side is constant."""
    return df.groupBy(*by).agg(correlation(x, y).alias("pearson"))


def linear_fit(df: DataFrame, x: str, y: str, *by: str) -> DataFrame:
    """Slope, intercept and mean squared error; with fewer than two positions slope 0 and the median position as intercept."""
    sums = df.dropna(subset=[x, y]).groupBy(*by).agg(
        F.regr_slope(F.col(y), F.col(x)).alias("s"), F.regr_intercept(F.col(y), F.col(x)).alias("i"), F.countDistinct(x).alias("k"), F.median(x).alias("m"),
        F.avg(F.col(y) * F.col(y)).alias("yy"), F.avg(F.col(x) * F.col(y)).alias("xy"), F.avg(F.col(x) * F.col(x)).alias("xx"), F.avg(x).alias("mx"), F.avg(y).alias("my"),
    )
    s, i = F.when(F.col("k") > 1, F.col("s")).otherwise(0.0), F.when(F.col("k") > 1, F.col("i")).otherwise(F.col("m"))
    out = sums.select(*by, s.alias("slope"), i.alias("intercept"), "yy", "xy", "xx", "mx", "my")
    mse = F.expr("yy + slope * slope * xx + intercept * intercept - 2 * slope * xy - 2 * intercept * my + 2 * slope * intercept * mx")
    return out.select(*by, "slope", "intercept", F.greatest(mse, F.lit(0.0)).alias("mse"))


def class_weights(df: DataFrame, cls: str, low: float = 0.5, high: float = 2.0) -> DataFrame:
    """Inverse frequencies of the class numbers 0 to the largest, scaled so that the classes met fill [low, high].

    A class that is not met has the raw weight 0 and so falls under ``low``. If all that are met are
    equally frequent, every weight is 1.
    """
    n = df.groupBy(F.col(cls).cast("bigint").alias(cls)).agg(F.count("*").alias("n"))
    w = n.withColumn("w", 1.0 / F.col("n"))
    ends = w.agg(F.max(cls).alias("__k"), F.min("w").alias("a"), F.max("w").alias("z"))
    every = ends.select(F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("__k"))).alias(cls), "a", "z")  # a row a class
    raw = F.coalesce("w", F.lit(0.0))
    scaled = F.when(F.col("z") > F.col("a"), low + (high - low) * F.try_divide(raw - F.col("a"), F.col("z") - F.col("a"))).otherwise(F.lit(1.0))
    return every.join(w, cls, "left").select(cls, F.coalesce("n", F.lit(0)).alias("n"), scaled.alias("weight"))


def file_counts(df: DataFrame, prefix: str) -> DataFrame:
    """Scores a file and the derived counts, all under a prefix: ``num_total`` (tp + fn), ``num_wrong`` (fp) and ``num_detected`` (tp + fp)."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    d = with_scores(df).withColumns({"num_total": tp + fn, "num_wrong": fp, "num_detected": tp + fp})
    return d.select("filename", *[F.col(c).alias(f"{prefix}_{c}") for c in ("f1", "recall", "precision", "num_total", "num_wrong", "num_detected")])


def matched_counts(values: DataFrame, truth: DataFrame, value: str, *by: str) -> DataFrame:
    """J14 for equality: multiset matching, so each truth row serves one prediction; the counts meet by key, not pair by pair."""
    v = values.groupBy(*by, value).agg(F.count("*").alias("p"))
    t = truth.groupBy(*by, value).agg(F.count("*").alias("t"))
    on = reduce(lambda a, b: a & b, [F.col(f"v.{k}").eqNullSafe(F.col(f"t.{k}")) for k in (*by, value)])
    j = v.alias("v").join(t.alias("t"), on, "full").select(*[F.coalesce(f"v.{k}", f"t.{k}").alias(k) for k in by], F.coalesce("p", F.lit(0)).alias("p"), F.coalesce("t.t", F.lit(0)).alias("t"))
    tp = F.sum(F.least("p", "t"))
    return j.groupBy(*by).agg(tp.alias("tp"), (F.sum("p") - tp).alias("fp"), (F.sum("t") - tp).alias("fn"))


def join_frames(key: str, *frames: DataFrame) -> DataFrame:
    """Inner merge of metric frames."""
    return reduce(lambda a, b: a.join(b, key, "inner"), frames)


def elevation_matches(a: Column, b: Column, tolerance: float = 0.01) -> Column:
    """Z9."""
    return F.coalesce(F.abs(a - b) <= tolerance, F.lit(False))


def coordinates_match(e1: Column, n1: Column, e2: Column, n2: Column, tolerance: float = 2.0) -> Column:
    """Both axes within the tolerance, as they stand or once one of the two points is moved from the older frame to the newer."""
    near = lambda shift: (F.abs(e1 + 2 * shift - e2) <= tolerance) & (F.abs(n1 + shift - n2) <= tolerance)
    return F.coalesce(near(0.0) | near(1e6) | near(-1e6), F.lit(False))
