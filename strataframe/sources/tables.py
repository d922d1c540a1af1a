"""Scans and sinks (operators S2-S8, K1-K6, A1-A5, U6): nested JSON records to flat tables and back.

PDF decoding, line detection and remote stores are behind the table contract: an adapter
that writes ``words(file, page, block_no, line_no, word_no, x0, y0, x1, y1, text)``
feeds everything else.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.functions.text import parse_text

LAYER = "struct<material_description:string,depth_interval:struct<start:double,end:double>>"
BOREHOLE = f"struct<borehole_index:int,metadata:map<string,string>,layers:array<{LAYER}>,groundwater:array<struct<date:string,depth:double,elevation:double>>>"
WORDS = "file string, page int, block_no int, line_no int, word_no int, x0 double, y0 double, x1 double, y1 double, text string"


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """``(file, borehole_index, metadata, layers, groundwater)`` of JSON files that map a file name to its boreholes; one task a file."""
    raw = spark.read.text(path, wholetext=True)
    by_file = raw.select(F.explode(F.from_json("value", f"map<string,array<{BOREHOLE}>>")).alias("file", "b"))
    return by_file.select("file", F.explode("b").alias("b")).select("file", "b.*")


_SPOT = "page:int,rect:array<double>"
_BOUND = "struct<value:double,rect:array<double>,page:int>"
_COUNTS = "struct<tp:bigint,fp:bigint,fn:bigint,precision:double,recall:double,f1:double>"
#: A file's predictions: per borehole the features with the place where they were found.
PREDICTION = f"""struct<file_metadata:struct<language:string,page_dimensions:array<struct<width:double,height:double>>>,
boreholes:array<struct<borehole_index:int,
metadata:struct<elevation:struct<elevation:double,{_SPOT}>,coordinates:struct<E:double,N:double,{_SPOT}>,name:struct<name:string,confidence:double,{_SPOT}>>,
layers:array<struct<material_description:struct<text:string,lines:array<struct<text:string,{_SPOT}>>>,depths:struct<start:{_BOUND},`end`:{_BOUND}>>>,
bounding_boxes:array<struct<sidebar_rect:array<double>,depth_column_entries:array<array<double>>,material_description_rect:array<double>,page:int>>,
groundwater:array<struct<`date`:string,depth:double,elevation:double,{_SPOT}>>>>,
metrics:struct<language:string,layer_metrics:{_COUNTS},depth_interval_metrics:{_COUNTS},material_description_metrics:{_COUNTS},metadata_metrics:struct<elevation:{_COUNTS},coordinates:{_COUNTS},name:{_COUNTS}>>>""".replace("\n", "")


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """``(file, language, borehole_index, metadata, layers, bounding_boxes, groundwater, metrics)`` of JSON files that map a file name to its predictions; a missing path or unreadable JSON gives no rows."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
    raw = spark.read.text(path, wholetext=True) if found else spark.createDataFrame([], "value string")
    f = raw.select(F.explode(F.from_json("value", f"map<string,{PREDICTION}>")).alias("file", "p"))
    return f.select("file", F.col("p.file_metadata.language").alias("language"), F.explode("p.boreholes").alias("b"), F.col("p.metrics").alias("metrics")).select("file", "language", "b.*", "metrics")


def prediction_layers(predictions: DataFrame) -> DataFrame:
    """The layers of :func:`read_predictions` as :func:`layers` gives those of ground truth, with the page of each bound."""
    d = predictions.select("file", "borehole_index", F.posexplode("layers").alias("layer_index", "l"))
    bound = lambda c, what: F.col(f"l.depths.{c}.{what}")
    text = F.col("l.material_description.text")
    return d.select(
        "file", "borehole_index", "layer_index", bound("start", "value").alias("start"), bound("`end`", "value").alias("end"), parse_text(text).alias("text"), text.alias("raw_text"), bound("start", "page").alias("start_page"), bound("`end`", "page").alias("end_page")
    )


def nest_predictions_json(predictions: DataFrame) -> DataFrame:
    """A3: ``(file, json)``, the boreholes of a file back in the layout that :func:`read_predictions` reads."""
    inner = [c for c in ("borehole_index", "metadata", "layers", "bounding_boxes", "groundwater") if c in predictions.columns]
    g = predictions.groupBy("file").agg(F.first("language", ignorenulls=True).alias("language"), F.array_sort(F.collect_list(F.struct("borehole_index", F.to_json(F.struct(*inner)).alias("j")))).alias("b"))
    head = F.to_json(F.struct(F.struct("language").alias("file_metadata")))
    return g.select("file", F.concat(F.regexp_replace(head, r"\}$", ""), F.lit(',"boreholes":['), F.array_join(F.transform("b", lambda x: x["j"]), ","), F.lit("]}")).alias("json"))


def layers(records: DataFrame) -> DataFrame:
    """One row a layer; a missing interval has two null bounds, a missing text is empty."""
    d = records.select("file", "borehole_index", F.posexplode("layers").alias("layer_index", "l"))
    return d.select("file", "borehole_index", "layer_index", F.col("l.depth_interval.start").alias("start"), F.col("l.depth_interval.end").alias("end"), parse_text("l.material_description").alias("text"), F.col("l.material_description").alias("raw_text"))


def groundwater(records: DataFrame) -> DataFrame:
    """One row a measurement, in the order of (depth, date, elevation), missing ones first."""
    d = records.select("file", "borehole_index", F.explode("groundwater").alias("g")).select("file", "borehole_index", F.to_date("g.date").alias("date"), "g.depth", "g.elevation")
    return d.orderBy("file", "borehole_index", F.coalesce("depth", F.lit(0.0)), F.coalesce("date", F.lit("0001-01-01").cast("date")), F.coalesce("elevation", F.lit(0.0)))


def pending(files: DataFrame, done: DataFrame, key: str = "file") -> DataFrame:
    """What an earlier run has not written yet."""
    return files.join(done.select(key).distinct(), key, "left_anti")


def lines(words: DataFrame) -> DataFrame:
    """S3: words grouped to lines in order, with their outer rectangle."""
    w = F.struct("word_no", "text")
    return words.groupBy("file", "page", "block_no", "line_no").agg(
        F.concat_ws(" ", F.transform(F.array_sort(F.collect_list(w)), lambda x: x["text"])).alias("text"), F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1")
    )


def file_text(words: DataFrame) -> DataFrame:
    """A file's text without digits and punctuation, for language detection."""
    w = F.struct("page", "block_no", "line_no", "word_no", "text")
    t = F.concat_ws(" ", F.transform(F.array_sort(F.collect_list(w)), lambda x: x["text"]))
    return words.groupBy("file").agg(F.regexp_replace(t, r"[\d\p{Punct}\n]", " ").alias("text"))


def words_in(words: DataFrame, x0: float, y0: float, x1: float, y1: float) -> DataFrame:
    """Words whose centre lies in a box."""
    cx, cy = (F.col("x0") + F.col("x1")) / 2, (F.col("y0") + F.col("y1")) / 2
    return words.filter(cx.between(x0, x1) & cy.between(y0, y1))


def classification_rows(records: DataFrame, language: DataFrame) -> DataFrame:
    """One row a described layer with its file's language (``de`` if unknown)."""
    return layers(records).filter("text <> ''").join(language.select("file", "language"), "file", "left").withColumn("language", F.coalesce("language", F.lit("de")))


def write_layers_csv(records: DataFrame, path: str) -> None:
    """K2: a folder a borehole with its layers in order."""
    out = layers(records).select("file", "borehole_index", "layer_index", F.col("start").alias("from_depth"), F.col("end").alias("to_depth"), F.col("raw_text").alias("material_description"))
    out.repartition("file", "borehole_index").sortWithinPartitions("file", "borehole_index", "layer_index").write.partitionBy("file", "borehole_index").csv(path, header=True, mode="overwrite")


def metadata_by_borehole(records: DataFrame) -> DataFrame:
    """K3: metadata JSON keyed ``file_index``."""
    return records.select(F.concat_ws("_", "file", "borehole_index").alias("key"), F.to_json("metadata").alias("metadata"))


def nest_predictions(rows: DataFrame) -> DataFrame:
    """K5: class predictions grouped file, borehole, layers; two map-side combined aggregations."""
    layer = F.struct("layer_index", "material_description", "prediction_class")
    b = rows.groupBy("file", "borehole_index").agg(F.array_sort(F.collect_list(layer)).alias("layers"))
    return b.groupBy("file").agg(F.array_sort(F.collect_list(F.struct("borehole_index", "layers"))).alias("boreholes"))


def write_json(df: DataFrame, path: str, append: bool = False) -> None:
    """K1, K6: one JSON record a row."""
    df.write.json(path, mode="append" if append else "overwrite")


def flatten(df: DataFrame, separator: str = "__") -> DataFrame:
    """A1, A5: nested structs as flat columns, names joined by the separator."""

    def walk(fields, path: tuple[str, ...]) -> list[Column]:
        out = []
        for f in fields:
            at = (*path, f.name)
            out += walk(f.dataType.fields, at) if f.dataType.typeName() == "struct" else [F.col(".".join(f"`{p}`" for p in at)).alias(separator.join(at))]
        return out

    return df.select(*walk(df.schema.fields, ()))


def nested_value(df: DataFrame, entry: str, keys: list[str]) -> Column:
    """A2: the value at a path of keys inside a struct column; null where the schema has no such path."""
    at, kind = F.col(entry), df.schema[entry].dataType
    for k in keys:
        if kind.typeName() != "struct" or k not in kind.names:
            return F.lit(None)
        at, kind = at.getField(k), kind[k].dataType
    return at


def split_files(df: DataFrame, key: str = "file", shares: tuple[float, float] = (0.8, 0.9), seed: int = 42) -> DataFrame:
    """Adds ``part`` (train, validation or test) by a hash of the key, so a file is never parted and reruns agree."""
    u = F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(1_000_000)) / 1_000_000
    return df.withColumn("part", F.when(u < shares[0], "train").when(u < shares[1], "validation").otherwise("test"))
