"""Profiling: what is in a table and what is wrong with it. Nothing here creates tables."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import ColumnLike, as_column, parse_date


def sample_rows(df: DataFrame, n: int = 10) -> DataFrame:
    """``n`` example rows."""
    return df.limit(n)


def profile(df: DataFrame, approx: bool = True) -> DataFrame:
    """Rows, NULLs and distinct values of every column.

    The approximate form is one aggregate over the table and shuffles one row per task. The
    exact form counts (column, value) pairs with a map-side combine, so a frequent value stays
    one row per task and no column is gathered in one place.
    """
    if approx:
        wide = df.agg(
            F.count(F.lit(1)).alias("__rows"),
            *[F.count_if(F.col(c).isNull()).alias(f"__null_{i}")
              for i, c in enumerate(df.columns)],
            *[F.approx_count_distinct(c).alias(f"__dist_{i}")
              for i, c in enumerate(df.columns)])
        return wide.select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.col("__rows").alias("row_count"),
                     F.col(f"__null_{i}").alias("null_count"),
                     F.col(f"__dist_{i}").alias("distinct_count"))
            for i, c in enumerate(df.columns)])))
    pairs = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
        for c in df.columns])))
    per_value = pairs.groupBy("column_name", "value").agg(F.count("*").alias("n"))
    return per_value.groupBy("column_name").agg(
        F.sum("n").alias("row_count"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))),
                   F.lit(0).cast("bigint")).alias("null_count"),
        F.count("value").alias("distinct_count"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("occurrences")).filter("occurrences > 1")


def duplicate_summary(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, distinct keys, rows beyond the first of each key, and keys that repeat."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("n"))
    zero = F.lit(0).cast("bigint")
    return per_key.agg(
        F.coalesce(F.sum("n"), zero).alias("row_count"),
        F.count("*").alias("distinct_keys"),
        F.coalesce(F.sum(F.col("n") - 1), zero).alias("excess_rows"),
        F.count_if(F.col("n") > 1).alias("repeated_keys"))


def nonmatching(col: ColumnLike, regex: str) -> Column:
    """TRUE for text that is present but does not match."""
    c = as_column(col)
    return c.isNotNull() & (c != "") & ~c.rlike(regex)


def missing(col: ColumnLike) -> Column:
    c = as_column(col)
    return c.isNull() | (c == "")


def not_iso_date(col: ColumnLike) -> Column:
    """TRUE for text that is present but no yyyy-MM-dd date."""
    c = as_column(col)
    return c.isNotNull() & (c != "") & parse_date(c, ["yyyy-MM-dd"]).isNull()


def out_of_range(col: ColumnLike, low: float | None = None,
                 high: float | None = None) -> Column:
    """TRUE for a number below ``low`` or at or above ``high``."""
    x = as_column(col).try_cast("double")
    tests = ([x < low] if low is not None else []) + ([x >= high] if high is not None else [])
    return F.coalesce(reduce(lambda a, b: a | b, tests), F.lit(False))


def count_where(df: DataFrame, conditions: Mapping[str, Column],
                name: str = "check_name", value: str = "n") -> DataFrame:
    """One row per named condition with the number of rows it holds for, in one pass."""
    counts = df.agg(*[F.count_if(c).alias(f"__{i}")
                      for i, c in enumerate(conditions.values())])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(label).alias(name), F.col(f"__{i}").alias(value))
        for i, label in enumerate(conditions)])))


def count_nonmatching(df: DataFrame, col: str, regex: str) -> DataFrame:
    return df.agg(F.count_if(nonmatching(col, regex)).alias("n"))


def missing_count(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return count_where(df, {c: missing(c) for c in cols}, "column_name")


def range_violations(df: DataFrame, col: str, low: float | None = None,
                     high: float | None = None) -> DataFrame:
    return df.agg(
        F.count_if(out_of_range(col, low=low) if low is not None else F.lit(False))
         .alias("too_low"),
        F.count_if(out_of_range(col, high=high) if high is not None else F.lit(False))
         .alias("too_high"))


def distinct_count(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """Distinct combinations of ``cols``; the exact form counts the groups of a group-by."""
    if approx:
        return df.agg(F.approx_count_distinct(F.struct(*cols)).alias("distinct_count"))
    return df.select(*cols).distinct().agg(F.count("*").alias("distinct_count"))


def label_summary(df: DataFrame, label: str) -> DataFrame:
    """Labelled and unlabelled rows, positives, base rate, number of classes."""
    y = F.col(label)
    return df.agg(
        F.count(y).alias("labelled"), F.count_if(y.isNull()).alias("unlabelled"),
        F.count_if(y == 1).alias("positives"), F.avg(y.cast("double")).alias("base_rate"),
        F.count_distinct(y).alias("classes"))


def unpivot_metrics(df: DataFrame, ids: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Long form ``(ids..., metric, value)`` with values as doubles."""
    wide = df.select(*ids, *[F.col(m).cast("double").alias(m) for m in metrics])
    return wide.unpivot(list(ids), list(metrics), "metric", "value")


def check_ranges(metrics: DataFrame, ranges: Mapping[str, tuple]) -> DataFrame:
    """Metrics with their expected range and whether they lie in it.

    ``ranges`` is a short literal table ``metric -> (low, high)``; a metric that was expected but
    not measured is reported as not ok.
    """
    spark = metrics.sparkSession
    expected = spark.createDataFrame(
        [(m, float(lo), float(hi)) for m, (lo, hi) in ranges.items()],
        "metric string, low double, high double")
    return (expected.join(metrics.select("metric", "value"), "metric", "left")
                    .select("metric", "value", "low", "high",
                            F.coalesce(F.col("value").between(F.col("low"), F.col("high")),
                                       F.lit(False)).alias("ok")))


def metric_spread(metrics: DataFrame) -> DataFrame:
    """Smallest and greatest value of each metric over all datasets that report it."""
    return metrics.groupBy("metric").agg(
        F.count("value").alias("datasets"), F.min("value").alias("min_value"),
        F.max("value").alias("max_value"))


# Metrics of many runs.

LEDGER = "metric string, value double"


def _done(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def record_run(metrics: DataFrame, ledger: str, run: str) -> bool:
    """Enter a run's ``metrics`` (metric, value) into a ledger; TRUE if they were not there yet.

    A run is entered once: a second call with its name changes nothing and computes nothing. What
    an interrupted call left behind is replaced.
    """
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", run):
        raise ValueError(f"a run is named by letters, digits, '_', '.' and '-', not {run!r}")
    path = f"{ledger}/run={run}"
    if _done(metrics.sparkSession, path):
        return False
    metrics.select("metric", F.col("value").cast("double").alias("value")).write.mode(
        "overwrite").parquet(path)
    return True


def recorded_runs(spark: SparkSession, ledger: str) -> DataFrame:
    """(run, metric, value) of all runs that were entered."""
    return spark.read.schema(f"{LEDGER}, run string").parquet(ledger).select(
        "run", "metric", "value")
