"""Ordered-row operators.

Order comes from explicit columns. What a window can say is a window; where a row's
result depends on an earlier row's result, the group is folded inside one expression
or one Arrow group.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def session_blocks(df: DataFrame, by: list[str], order: list[str], breaks: Column) -> DataFrame:
    """Adds ``block``, counted from 0; a row for which ``breaks`` holds starts a new one."""
    w = Window.partitionBy(*by).orderBy(*order)
    first = F.row_number().over(w) == 1
    return df.withColumn("__b", F.when(~first & F.coalesce(breaks, F.lit(False)), 1).otherwise(0)).withColumn("block", F.sum("__b").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__b")


def double_descending(df: DataFrame, by: list[str], order: list[str], value: str) -> DataFrame:
    """Adds ``part``; a new one starts where a value and the next are both below the two before."""
    w = Window.partitionBy(*by).orderBy(*order)
    v, n, p1, p2 = F.col(value), F.lead(value).over(w), F.lag(value).over(w), F.lag(value, 2).over(w)
    low = F.least(p1, p2)
    cut = F.coalesce(p1.isNotNull() & p2.isNotNull() & (v < low) & (n < low), F.lit(False))
    return df.withColumn("__c", cut.cast("int")).withColumn("part", F.sum("__c").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__c")


def ascending_pairs(df: DataFrame, by: list[str], order: str, value: str) -> DataFrame:
    """Number of pairs in which the later value is greater; groups are expected to be short (a column of entries)."""
    g = df.filter(F.col(value).isNotNull()).groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(value).alias("v")))).alias("a"))
    later = lambda x, i: F.size(F.filter(F.slice(F.col("a"), i + 2, F.size("a")), lambda y: y["v"] > x["v"]))
    return g.select(*by, F.aggregate(F.transform("a", later), F.lit(0), lambda s, x: s + x).cast("bigint").alias("pairs"))


def depth_intervals(df: DataFrame, by: list[str], order: list[str], value: str, include_open: bool = False) -> DataFrame:
    """Consecutive values as ``start, end``; a leading open interval unless the first value is 0; a trailing one if asked."""
    w = Window.partitionBy(*by).orderBy(*order)
    d = df.select(*by, *order, F.lag(value).over(w).alias("start"), F.col(value).alias("end"), F.row_number().over(w).alias("__i"), F.lead(value).over(w).isNull().alias("__last"))
    # the leading row has no start; a first value of exactly 0 opens nothing
    out = d.filter((F.col("__i") > 1) | (F.col("end") != 0)).select(*by, *order, "start", "end")
    if include_open:
        out = out.unionByName(d.filter("__last").select(*by, *order, F.col("end").alias("start"), F.lit(None).cast(df.schema[value].dataType).alias("end")))
    return out


def nearest_prior(left: DataFrame, right: DataFrame, by: list[str], at: str, right_at: str, value: str, out: str) -> DataFrame:
    """J19 as an as-of join: each left row gets the right ``value`` of the latest ``right_at`` at or before ``at``.

    Both sides are unioned and carried forward by one window, so one shuffle on the key
    does it and no pair is formed. Of right rows at the same time the largest value counts.
    """
    names = left.columns
    tall = left.select("*", F.col(at).alias("__t"), F.lit(1).alias("__s"), F.lit(None).cast(right.schema[value].dataType).alias("__v"))
    other = right.select(*by, F.col(right_at).alias("__t"), F.lit(0).alias("__s"), F.col(value).alias("__v"))
    w = Window.partitionBy(*by).orderBy("__t", "__s", F.col("__v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    both = tall.unionByName(other, allowMissingColumns=True)
    return both.withColumn(out, F.last("__v", ignorenulls=True).over(w)).filter("__s = 1").select(*names, out)


def contained_run(df: DataFrame, by: list[str], order: list[str], start: str, end: str) -> DataFrame:
    """Adds ``run``: how many of the intervals that follow directly lie inside this one, bounds included.

    An interval without an end holds all that follow; a following one without an end lies inside if its start does.
    """
    key = F.struct(*order)
    g = df.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(key.alias("o"), F.col(start).alias("s"), F.col(end).alias("e"), F.struct(*df.columns).alias("row")))).alias("a"))
    within = lambda x, v: (v >= x["s"]) & (v <= x["e"])
    inside = lambda x, y: x["e"].isNull() | F.coalesce(within(x, y["s"]) & (y["e"].isNull() | within(x, y["e"])), F.lit(False))

    def run(x: Column, i: Column) -> Column:
        rest = F.slice(F.col("a"), i + 2, F.size("a"))
        flags = F.transform(rest, lambda y: inside(x, y))
        stop = F.array_position(flags, F.lit(False))
        return F.struct(x["row"].alias("row"), F.when(stop > 0, stop - 1).otherwise(F.size(rest)).cast("bigint").alias("run"))

    return g.select(F.explode(F.transform("a", run)).alias("x")).select("x.row.*", "x.run")


def resolve_references(df: DataFrame, by: list[str], order: list[str], text: str, start: str) -> DataFrame:
    """Adds ``resolved``: a text that begins with "same as" (in four languages) takes over an earlier one.

    With a depth, the latest earlier row that starts there counts, else the last non-empty
    one; the remainder is appended. What is taken over may be resolved itself, so
    each group is folded in order; no earlier row leaves the text as it is.
    """
    key = r"^[\s-]*(?:wie|dito|do|idem|same as)\b(?:\s*([0-9]+(?:[.,][0-9]+)?)(?:\s*-\s*[0-9]+(?:[.,][0-9]+)?)?(?:\s?m(?:[.]?\s?(?:ü|u)[.]?\s?[mt][.]?|\b))?)?"

    pattern = "(?iu)" + key
    g = df.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(F.struct(*order).alias("o"), F.coalesce(text, F.lit("")).alias("t"), F.col(start).cast("double").alias("s"), F.struct(*df.columns).alias("row")))).alias("a"))
    done = "array<struct<t:string,s:double>>"

    def step(acc: Column, x: Column) -> Column:
        hit = F.regexp_like(x["t"], F.lit(pattern))
        depth = F.replace(F.nullif(F.regexp_extract(x["t"], pattern, 1), F.lit("")), F.lit(","), F.lit(".")).try_cast("double")
        usable = F.filter(acc, lambda y: y["t"] != "")
        at = F.filter(usable, lambda y: y["s"] == depth)
        base = F.coalesce(F.try_element_at(at, F.lit(-1)), F.try_element_at(usable, F.lit(-1)))
        new = F.when(hit & base.isNotNull(), F.concat(base["t"], F.regexp_replace(x["t"], pattern, ""))).otherwise(x["t"])
        return F.concat(acc, F.array(F.struct(new.alias("t"), x["s"].alias("s"))))

    folded = g.select("a", F.aggregate("a", F.array().cast(done), step).alias("r"))
    return folded.select(F.explode(F.arrays_zip("a", "r")).alias("z")).select("z.a.row.*", F.col("z.r.t").alias("resolved"))


def modal_step(values: list[float]) -> list[float]:
    """The members of an arithmetic progression with the modal step (the first of equals), or none."""
    v = [round(x * 100) for x in values]
    gaps = [b - a for a, b in zip(v, v[1:])]
    if not gaps:
        return []
    step = max(dict.fromkeys(gaps), key=gaps.count)
    if step <= 0:
        return []
    fits = [x for x in v if x % step == 0]
    have = set(fits)
    if sum(x + step in have for x in fits) <= 0.7 * (len(fits) - 1):
        return []
    middle = {x for x in fits if x - step in have and x + step in have}
    kept = {y for x in middle for y in (x - step, x, x + step)}
    return [x / 100 for x in fits if x in kept]


def progression(values: list[float]) -> list[float]:
    """W9 over all values, or over the whole numbers alone if these form one."""
    whole = [x for x in values if float(x).is_integer()]
    return modal_step(whole) or modal_step(values)


PLACE = "__place"


def numbered(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """Adds each row's place in its group, from 1: its window keeps a group whole and in order in its partition, so Arrow batches that follow can be cut where a place is 1."""
    return df.withColumn(PLACE, F.row_number().over(Window.partitionBy(*by).orderBy(*[F.asc_nulls_last(c) for c in order])))


def whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups of ``numbered`` rows, each with the places where its groups start; a group that a batch breaks off waits for its end."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        starts = np.flatnonzero(batch.column(PLACE).to_numpy() == 1)
        if len(starts):
            last = int(starts[-1])
            done = pa.Table.from_batches([*held, batch.slice(0, last)])
            if done.num_rows:
                yield done, np.flatnonzero(done.column(PLACE).to_numpy() == 1)
            held = [batch.slice(last)]
        else:
            held.append(batch)
    if held and (done := pa.Table.from_batches(held)).num_rows:
        yield done, np.flatnonzero(done.column(PLACE).to_numpy() == 1)


def values(column: pa.ChunkedArray) -> list:
    """A column as Python values, by whole arrays where its type has one."""
    kind = column.type
    if pa.types.is_integer(kind) or pa.types.is_floating(kind):
        if not column.null_count:
            return column.to_numpy().tolist()
        some = column.fill_null(0).to_numpy().astype(object)
        some[column.is_null().to_numpy()] = None
        return some.tolist()
    if pa.types.is_string(kind) or pa.types.is_large_string(kind) or pa.types.is_boolean(kind):
        return column.to_numpy().tolist()
    return column.to_pylist()


def grouped(df: DataFrame, by: list[str], order: list[str], fold: Callable[[list[dict]], list[dict]], schema: str) -> DataFrame:
    """A Python fold over each group's rows in order: for results that depend on the order of processing. An Arrow batch holds many groups, so small ones cost no call each."""
    out = StructType.fromDDL(schema)
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        kinds = to_arrow_schema(out)
        for table, starts in whole_groups(batches):
            rows = [dict(zip(names, row)) for row in zip(*[values(table.column(i)) for i in range(len(names))])]
            ends = [*starts[1:].tolist(), len(rows)]
            got = [r for a, z in zip(starts.tolist(), ends) for r in fold(rows[a:z])]
            yield pa.RecordBatch.from_arrays([pa.array([r.get(f.name) for r in got], f.type) for f in kinds], schema=kinds)

    return numbered(df, by, order).mapInArrow(run, out)


def arithmetic_progressions(df: DataFrame, by: str, order: list[str], value: str) -> DataFrame:
    """``(by, value)`` of the kept members of each group."""
    kind = dict(df.dtypes)[by]
    return grouped(
        df.filter(F.col(value).isNotNull()), [by], order, lambda rows: [{by: rows[0][by], "value": x} for x in progression([float(r[value]) for r in rows])], f"{by} {kind}, value double"
    )


def dedupe_by_key(df: DataFrame, by: list[str], order: list[str], value: str) -> DataFrame:
    """Within a key, rows of different known values stay (the later of equals); a missing value stays only where nothing is known."""
    known = Window.partitionBy(*by)
    same = Window.partitionBy(*by, value).orderBy(*[F.desc(c) for c in order])
    d = df.withColumn("__k", F.count(value).over(known)).withColumn("__r", F.row_number().over(same))
    return d.filter((F.col("__r") == 1) & (F.col(value).isNotNull() | (F.col("__k") == 0))).drop("__k", "__r")


def best_choice(df: DataFrame, by: list[str], *order: Column) -> DataFrame:
    """The first row of each group by the given order."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("__r", F.row_number().over(w)).filter("__r = 1").drop("__r")


def zip_positions(left: DataFrame, right: DataFrame, by: list[str], order: str, value: str) -> DataFrame:
    """``(by, place, left, right)``: the i-th value of one side with the i-th of the other; what is over on one side is left out."""
    w = Window.partitionBy(*by).orderBy(order)
    side = lambda d, name: d.select(*by, F.row_number().over(w).cast("bigint").alias("place"), F.col(value).alias(name))
    return side(left, "left").join(side(right, "right"), [*by, "place"])


def block_intervals(lines: DataFrame, by: str, order: str, text: str = "text") -> DataFrame:
    """``(by, place, start, end, text)``: the depth intervals inside a text block, each with its lines.

    A line with an interval starts a new entry, unless it starts above the block's first depth; where neither the
    line nor the one before has one, the two together are tried. The first line, and a line that starts a further
    entry, go without their leading depths. Lines before the first interval belong to it.
    """
    from strataframe.functions.parse import interval_of, plain_spaces

    d = lines.select(by, F.col(order).alias("o"), F.coalesce(text, F.lit("")).alias("t"))
    w = Window.partitionBy(by).orderBy("o")
    d = d.withColumn("x", plain_spaces("t"))
    d = d.withColumn("i", interval_of(F.col("x")))
    # two lines are tried together only where neither has an interval
    d = d.withColumn("xx", F.when(F.col("i").isNull() & F.lag("i").over(w).isNull(), F.trim(F.concat_ws(" ", F.lag("x").over(w), F.col("x")))))
    d = d.withColumn("j", F.when(F.col("xx").isNotNull(), interval_of(F.col("xx"))))
    d = d.select(by, "o", "t", F.coalesce("i.rest", "t").alias("rest"), F.col("i").isNotNull().alias("own"), F.col("j").isNotNull().alias("two"), F.col("i.start").alias("s"), F.col("i.end").alias("e"), F.col("j.start").alias("s2"), F.col("j.end").alias("e2"))

    def fold(rows: list[dict]) -> list[dict]:
        out, held, now, first, before = [], [], None, None, None
        for k, r in enumerate(rows):
            found = (r["s"], r["e"]) if r["own"] else None
            line = r["rest"] if k == 0 else r["t"]
            if k and found is None and before is None and r["two"]:
                found = (r["s2"], r["e2"])
            before = found
            if found:
                first = first or found[0]  # a first depth of 0 bars nothing
                if found[0] >= first:
                    if now:
                        out.append((now, held))
                        held, line = [], r["rest"]
                    now = found
            if line.strip():
                held.append(line)
        if held:
            out.append((now, held))
        return [{by: rows[0][by], "place": k, "start": iv and iv[0], "end": iv and iv[1], "text": " ".join(mine)} for k, (iv, mine) in enumerate(out)]

    return grouped(d, [by], ["o"], fold, f"{by} {dict(lines.dtypes)[by]}, place bigint, start double, end double, text string")
