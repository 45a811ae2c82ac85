"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenurekit.session import ensure_checkpoint_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, also where the
    body reads it inside other lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def id_crc(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table into the shared folder (``spark.checkpoint.dir``) and read
    it back: later steps do not depend on executors that may be lost."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop shuffle files of finished steps: they stay until
    the driver's JVM happens to collect the plans that no one holds any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
