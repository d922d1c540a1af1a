"""Settings, request checks, vocabularies and record shapes (operators S7, S8, S10, S11, K2, K4, K6, A4-A6, F23, Z8).

What is about a run, not about data, is plain Python on the driver; what has rows is a DataFrame.
"""

from __future__ import annotations

import json
import os
from pathlib import Path
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LANGUAGES = ("en", "fr", "de", "it")


def read_settings(name: str, project: str | Path, defaults: str | Path) -> dict:
    """The YAML file of that name in the project's ``config`` folder, else in the package's defaults; the first found counts as a whole."""
    import yaml

    for folder in (Path(project) / "config", Path(defaults)):
        if (folder / name).is_file():
            return yaml.safe_load((folder / name).read_text(encoding="utf-8")) or {}
    raise FileNotFoundError(f"no settings named {name}")


class BenchmarkSpec(NamedTuple):
    name: str
    inputs: str
    truth: str | None


def parse_benchmark(spec: str, must_exist: bool = False) -> BenchmarkSpec:
    """``name:inputs:truth``. With ``must_exist`` no part may be empty and both paths must be there; else the truth may be left out."""
    parts = [p.strip() for p in spec.split(":")]
    if len(parts) != 3:
        raise ValueError(f"{spec!r} is not name:inputs:truth")
    if must_exist and not parts[0]:
        raise ValueError(f"{spec!r} has no name")
    for path in parts[1:] if must_exist else ():
        if not path or not os.path.exists(path):
            raise ValueError(f"{spec!r}: there is no {path!r}")
    return BenchmarkSpec(parts[0], parts[1], parts[2] or None)


def below_common_root(paths: list[str]) -> list[str]:
    """Each path below the folder that all share; the folder itself is shown by its last two parts."""
    full = [os.path.realpath(os.path.expanduser(p)) for p in paths]
    if not full:
        return []
    root = os.path.commonpath(full)
    return [os.path.join(*p.split(os.sep)[-2:]) if p == root else os.path.relpath(p, root) for p in full]


def parent_key(paths: list[str]) -> str:
    """One key for a group of inputs, whatever their order."""
    return "multi:" + " | ".join(sorted(below_common_root(paths)))


def check_request(filename: str, page: int | None = None, kind: str | None = None, kinds: tuple[str, ...] = ("text", "number", "coordinates")) -> None:
    """raises for an empty file name, a page under 1 or an unknown kind of answer."""
    if not filename:
        raise ValueError("a request needs a file name")
    if page is not None and page < 1:
        raise ValueError(f"there is no page {page}")
    if kind is not None and kind not in kinds:
        raise ValueError(f"{kind!r} is none of {', '.join(kinds)}")


def append_failures(failures: list[dict], folder: str | Path, name: str = "api_failure.json") -> None:
    """K6: adds to the list in a JSON file; content that is no JSON is overwritten. Nothing to add, nothing written."""
    if not failures:
        return
    at = Path(folder) / name
    at.parent.mkdir(parents=True, exist_ok=True)
    try:
        before = json.loads(at.read_text(encoding="utf-8")) if at.exists() else []
    except json.JSONDecodeError:
        before = []
    at.write_text(json.dumps([*before, *failures], indent=2, ensure_ascii=False), encoding="utf-8")


def write_summary(summary: DataFrame, path: str, by: str) -> None:
    """K4: the summary rows of ``metrics.benchmark_summary`` as one CSV file with a header, the mean last. The rows are as many as there are benchmarks."""
    last = (F.col(by) == "mean").cast("int")
    summary.coalesce(1).sortWithinPartitions(last, by).write.csv(path, header=True, mode="overwrite")


def csv_names(records: DataFrame) -> DataFrame:
    """K2: ``(file, borehole_index, name)``: the file's stem, with the borehole's number only where the file has several."""
    n = F.expr("count(*) over (partition by file)")
    stem = F.regexp_replace("file", r"\.[^.]*$", "")
    d = records.select("file", "borehole_index", n.alias("n"), stem.alias("stem"))
    return d.select("file", "borehole_index", F.concat("stem", F.when(F.col("n") > 1, F.concat(F.lit("_"), "borehole_index")).otherwise(""), F.lit(".csv")).alias("name"))


def classification_inputs(spark: SparkSession, inputs: DataFrame, truth: DataFrame | None = None, subset: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Descriptions and ground truth, both with a ``file`` column.

    A ``subset`` of files needs the truth, and is what it has of them (``inputs`` is not used); inputs without truth are their own
    truth and must have classes (a column ``classification``); else both are taken as they are.
    """
    if subset is not None:
        if truth is None:
            raise ValueError("a subset of files needs the full ground truth")
        return truth.join(subset.select("file").distinct(), "file", "left_semi"), truth
    if truth is None:
        if "classification" not in inputs.columns:
            raise ValueError("only ground truth can go without ground truth")
        return inputs, inputs
    return inputs, truth


def legacy_descriptions(spark: SparkSession, path: str) -> DataFrame:
    """A4: ``(file, layers)`` of the old format, file -> tagged texts: the material descriptions, without depths."""
    raw = spark.read.text(path, wholetext=True)
    tagged = raw.select(F.explode(F.from_json("value", "map<string,array<struct<tag:string,text:string>>>")).alias("file", "t"))
    none = F.lit(None).cast("double")
    layer = lambda t: F.struct(t["text"].alias("material_description"), F.struct(none.alias("start"), none.alias("end")).alias("depth_interval"))
    return tagged.select("file", F.transform(F.filter("t", lambda t: t["tag"] == "Material description"), layer).alias("layers"))


def as_boreholes(records: DataFrame, *columns: str) -> DataFrame:
    """A4: one record a file as a list of one borehole with the number 0."""
    return records.select("file", F.array(F.struct(F.lit(0).alias("borehole_index"), *columns)).alias("boreholes"))


def short_metric_key(c: Column | str) -> Column:
    """A5: a metric's key without ``metrics/`` and without the first folder."""
    x = F.regexp_replace(F.col(c) if isinstance(c, str) else c, "^metrics/", "")
    return F.regexp_replace(x, "^[^/]*/", "")


def concept_rows(triples: DataFrame) -> DataFrame:
    """A row a concept from ``(subject, predicate, object, language)``: id (the last part of the address), number of capitals in it, one preferred label and the list of others a language, definition, ids of broader and narrower concepts.

    Predicates are compared by their last part; a label in another language than ``LANGUAGES`` raises. Lists are sorted.
    """
    tail = lambda c: F.substring_index(c, "/", -1)
    p = F.substring_index(tail("predicate"), "#", -1)
    d = triples.withColumns({"p": p, "id": tail("subject")})
    label = F.col("p").isin("prefLabel", "altLabel")
    bad = label & ~F.coalesce(F.col("language").isin(*LANGUAGES), F.lit(False))
    d = d.withColumn("object", F.when(bad, F.raise_error(F.concat(F.lit("unknown language: "), F.coalesce("language", F.lit("none"))))).otherwise(F.col("object")))
    some = lambda what, lang=None: F.when((F.col("p") == what) & (F.col("language") == lang if lang else F.lit(True)), F.col("object"))
    many = lambda c: F.array_sort(F.collect_list(c))
    rows = d.groupBy("id").agg(
        *[F.max(some("prefLabel", x)).alias(f"prefLabel_{x}") for x in LANGUAGES], F.max(some("definition")).alias("definition"), *[many(some("altLabel", x)).alias(f"altLabel_{x}") for x in LANGUAGES],
        many(tail(some("broader"))).alias("broader"), many(tail(some("narrower"))).alias("narrower"),
    )
    return rows.withColumn("term_order", F.length(F.regexp_replace("id", "[^A-Z]", "")))


def vocabulary(concepts: DataFrame, order: int | None = 1) -> DataFrame:
    """``(language, id, labels, description)`` of the concepts of that order, preferred labels first, and the class kA of texts that say nothing."""
    d = concepts if order is None else concepts.filter(F.col("term_order") == order)
    each = [
        d.select(F.lit(x).alias("language"), "id", F.concat(F.array_compact(F.array(f"prefLabel_{x}")), F.col(f"altLabel_{x}")).alias("labels"), F.col("definition").alias("description")) for x in LANGUAGES
    ]
    nothing = {"de": ["keine Angabe", "unbekannt", "nicht beschrieben"], "fr": ["sans indication"], "en": ["not specified"], "it": ["senza indicazioni"]}
    out = concepts.sparkSession.createDataFrame([(x, "kA", v, "not specified") for x, v in nothing.items()], "language string, id string, labels array<string>, description string")
    for e in each:
        out = out.unionByName(e)
    return out
