"""Profiles that are kept and merged: a run looks only at the rows that are new.

The exact profile (``profile.profile``) shuffles each distinct value of each column. Here every column
is one HyperLogLog and one KLL sketch of a fixed size, whatever the number of rows: a task sends one
row, and sketches of several parts of a table merge into that of the whole. Numbers of rows and NULLs
stay exact.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

LG_BUCKETS = 14    # 2^14 buckets: a standard error of 1.04 / 2^7 = 0.8 % of the distinct values
KLL_SIZE = 400     # a rank is missed by less than 1 % of the rows with 99 % probability
SKETCHES = ("column_name string, row_count long, null_count long, distinct_sketch binary, "
            "quantile_sketch binary")


def sketch(df: DataFrame) -> DataFrame:
    """A row of SKETCHES per column of ``df``, by one aggregate. Numbers have a quantile sketch too;
    NaN is in none."""
    numeric = {f.name for f in df.schema if isinstance(f.dataType, NumericType)}
    aggregates = [F.count(F.lit(1)).alias("__rows")]
    for i, name in enumerate(df.columns):
        c = F.col(f"`{name}`")
        aggregates += [F.count_if(c.isNull()).alias(f"__null{i}"),
                       # A hash, as the sketch passes over empty texts.
                       F.hll_sketch_agg(F.when(c.isNotNull(), F.xxhash64(c)), LG_BUCKETS)
                       .alias(f"__hll{i}")]
        if name in numeric:
            x = c.cast("double")
            aggregates.append(F.kll_sketch_agg_double(
                F.when(~F.isnan(x), x), F.lit(KLL_SIZE)).alias(f"__kll{i}"))
    wide = df.agg(*aggregates)
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("column_name"), F.col("__rows").alias("row_count"),
                 F.col(f"__null{i}").alias("null_count"),
                 F.col(f"__hll{i}").alias("distinct_sketch"),
                 (F.col(f"__kll{i}") if name in numeric else F.lit(None).cast("binary"))
                 .alias("quantile_sketch"))
        for i, name in enumerate(df.columns)])))


def merge(sketches: DataFrame) -> DataFrame:
    """One row of SKETCHES per column, of all parts together."""
    return sketches.groupBy("column_name").agg(
        F.sum("row_count").alias("row_count"), F.sum("null_count").alias("null_count"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_double("quantile_sketch").alias("quantile_sketch"))


def store(df: DataFrame, folder: str, part: str) -> None:
    """Keep the sketches of one part of a table. A part that is stored again replaces itself, so a
    run that is repeated counts no row twice."""
    sketch(df).write.mode("overwrite").parquet(f"{folder}/part={part}")


def stored(spark: SparkSession, folder: str) -> DataFrame:
    """The merged sketches of all parts."""
    return merge(spark.read.schema(f"{SKETCHES}, part string").parquet(folder))


def estimates(sketches: DataFrame, quantiles: Mapping[str, float]) -> DataFrame:
    """(column_name, row_count, null_count, distinct_count, then a column per quantile)."""
    return sketches.select(
        "column_name", "row_count", "null_count",
        F.hll_sketch_estimate("distinct_sketch").alias("distinct_count"),
        *[F.when(F.kll_sketch_get_n_double("quantile_sketch") > 0,
                 F.kll_sketch_get_quantile_double("quantile_sketch", F.lit(float(q)))).alias(name)
          for name, q in quantiles.items()])
