"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_folder

BATCH_BYTES = "8m"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BLANKS = " \t\n\x0b\f\r"


def small_batches(spark: SparkSession) -> None:
    """Let Arrow batches end at a few megabytes, so that what a Python worker holds at once does
    not depend on how long texts are. A smaller limit of the session's own stays."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
            spark.conf.get(name)) > 8 << 20:
        spark.conf.set(name, BATCH_BYTES)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: it is computed once, and the loss of an
    executor cannot make two readers see different rows."""
    path = new_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def rows_per_partition(df: DataFrame, rows: int, per: int) -> int:
    """Partitions that hold about ``per`` of ``rows`` each, no fewer than the session shuffles to."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // per))
