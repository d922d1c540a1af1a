"""Plan-level helpers: the shared scratch folder, materialised tables, size-checked broadcasts."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast only when its measured size is under this many bytes.
BROADCAST_BYTES = 32 << 20

_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` if set, else (local mode only) a temporary folder."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if at:
        return at.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if "dir" not in _LOCAL:
        _LOCAL["dir"] = tempfile.mkdtemp(prefix="strataframe-")
        atexit.register(shutil.rmtree, _LOCAL["dir"], ignore_errors=True)
    return _LOCAL["dir"]


def materialize(df: DataFrame, name: str = "table", **options: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back, which cuts its lineage; ``options`` are the writer's."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete a table made by :func:`materialize` that nothing reads any more."""
    path = getattr(df, "_scratch_path", None)
    if path:
        jvm = df.sparkSession.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def broadcast_if_small(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast when ``df`` (already materialised) holds at most ``limit`` bytes; else leave it to a shuffle join."""
    return F.broadcast(df) if df.count() * row_bytes <= limit else df


def pick(df: DataFrame, **types: str) -> DataFrame:
    """Only the named columns, cast; an absent one is null.

    Columns are addressed by position, so an extra column whose name differs only
    in case (or repeats) cannot make a reference ambiguous: an exact match wins,
    then the first match without regard to case.
    """
    names, flat = df.columns, df.toDF(*[f"__c{i}" for i in range(len(df.columns))])

    def find(name: str) -> Column:
        exact = [i for i, c in enumerate(names) if c == name]
        loose = [i for i, c in enumerate(names) if c.lower() == name.lower()]
        at = (exact or loose or [None])[0]
        return F.lit(None) if at is None else F.col(f"__c{at}")

    return flat.select(*[find(n).try_cast(t).alias(n) for n, t in types.items()])
