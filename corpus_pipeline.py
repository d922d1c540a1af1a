"""The corpus pipeline: documents that are good, in a known language, unlike the others and free of benchmark text, as token ids.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows that the stage
before it kept; all but the last return the columns of ``documents``. ``run`` writes
each stage's result as Parquet in the shared folder, reads it again and deletes that of the
stage before.

Defined cases, of all stages: columns beyond those of ``documents`` are carried, whatever
their names, until the last stage, which has its own columns; an empty table stays empty;
very long texts are worked on whole. The case of a null or empty text, a null id and repeated
rows is each stage's own, below.
"""

from pyspark.sql import DataFrame, SparkSession

from strataframe.llm import bpe, decontaminate, langid, quality, simhash
from strataframe.plans.runtime import discard, materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose posterior quality is under the threshold. A text without words has the prior as its quality; repeated rows share their fate; a null id does not matter."""
    return quality.keep_good(docs)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that are mostly in no known language, and those without words; repeated rows share their fate; a null id does not matter."""
    return langid.keep_known(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, the one with the smallest id (then the smallest text hash), of each group of near duplicates; of rows that repeat it one stays. Rows without words or without an id stay."""
    return simhash.deduplicate(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a passage of a benchmark item, all of their rows; texts without words and null ids stay."""
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every row, with the check that they decode to the text's bytes; a null text has null ids, an empty one none."""
    return bpe.encode_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("byte_bpe", encode),
]

#: No SQL: language mixtures need iteration over n-grams, and BPE merges a rank table.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        before, docs = docs, materialize(stage(spark, docs, sf_dir), name)
        discard(before)  # nothing but a table of this run
    return docs
