"""Incremental runs by Structured Streaming (operator S2's resume; windowed counts of events)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def process_new(spark: SparkSession, source: str, schema: str | StructType, transform: Callable[[DataFrame], DataFrame], target: str, checkpoint: str) -> None:
    """Applies a row-wise transform to the Parquet files that have come since the last call, and appends the result; the checkpoint remembers what is done."""
    stream = transform(spark.readStream.schema(schema).parquet(source))
    stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start(target).awaitTermination()


def windowed_counts(events: DataFrame, at: str, key: str, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts a key and window; works on a stream, where state older than the watermark is dropped, and on a table."""
    return events.withWatermark(at, late).groupBy(F.window(at, width).alias("w"), key).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), key, "n")
