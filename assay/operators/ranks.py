"""Exact order statistics without sorting a group, or the table, in one task.

Values are first counted per distinct value (with a map-side combine, so a value that fills a
third of the table costs one row). The counts are dealt out by ranges of the values and staged with
the number of their range. Running totals are then taken on two levels: over the totals of the
ranges, of which there are as many as shuffle partitions, and inside each range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage

_RANGE = "__range"


def _match(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner equi-join in which NULL keys match each other; keeps the left copy of the keys."""
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    condition = [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys]
    return left.join(renamed, condition).drop(*[f"__r_{k}" for k in keys])


def totals_before(counts: DataFrame, by: Sequence[str], key: str, cols: Sequence[str]
                  ) -> DataFrame:
    """Add ``<col>_before``: the total of ``col`` over all smaller values of ``key`` in the group.

    ``counts`` has one row per group and ``key``.
    """
    width = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = stage(counts.repartitionByRange(width, *by, key)
                   .withColumn(_RANGE, F.spark_partition_id()), "ranges")
    sums = ranged.groupBy(*by, _RANGE).agg(*[F.sum(c).alias(f"__t_{c}") for c in cols])
    ahead = (Window.partitionBy(*by).orderBy(_RANGE)
                   .rowsBetween(Window.unboundedPreceding, -1))
    starts = sums.select(*by, _RANGE, *[
        F.coalesce(F.sum(f"__t_{c}").over(ahead), F.lit(0)).alias(f"__s_{c}") for c in cols])
    inside = (Window.partitionBy(*by, _RANGE).orderBy(key)
                    .rowsBetween(Window.unboundedPreceding, -1))
    return (_match(ranged, starts, [*by, _RANGE])
            .withColumns({
                f"{c}_before": F.col(f"__s_{c}") + F.coalesce(F.sum(c).over(inside), F.lit(0))
                for c in cols})
            .drop(_RANGE, *[f"__s_{c}" for c in cols]))


def exact_percentile(df: DataFrame, by: Sequence[str], expr: str, q: float = 0.5,
                     out: str = "percentile") -> DataFrame:
    """Exact interpolated percentile, per group, of a SQL expression as a double; NULLs and NaNs do
    not count. Groups without any value are absent."""
    if not 0 <= q <= 1:
        raise ValueError("q must lie between 0 and 1")
    values = df.select(*by, F.expr(expr).cast("double").alias("__v"))
    counts = values.filter("__v IS NOT NULL AND NOT isnan(__v)").groupBy(*by, "__v").agg(
        F.count("*").alias("n"))
    ranked = totals_before(counts, by, "__v", ["n"]).withColumn("__all", F.lit(1))
    keys = [*by, "__all"]  # so that no groups and some share one plan
    # The size of a group is where its last value ends.
    sizes = ranked.groupBy(*keys).agg(F.max(F.col("n_before") + F.col("n")).alias("__size"))
    placed = _match(ranked, sizes, keys).withColumn(
        "__p", F.lit(float(q)) * (F.col("__size") - 1))

    def at(index):
        return F.max(F.when((F.col("n_before") <= index)
                            & (F.col("n_before") + F.col("n") > index), F.col("__v")))

    picked = placed.groupBy(*keys).agg(
        F.max("__p").alias("__p"), at(F.floor("__p")).alias("__a"), at(F.ceil("__p")).alias("__b"))
    weight = F.col("__p") - F.floor("__p")
    value = F.when(weight == 0, F.col("__a")).otherwise(
        F.col("__a") * (F.lit(1.0) - weight) + F.col("__b") * weight)
    return picked.select(*by, value.alias(out))


def average_rank(df: DataFrame, score: str) -> DataFrame:
    """One row per distinct score: how many rows have it, and their average rank from 1."""
    counts = df.filter(F.col(score).isNotNull()).groupBy(score).agg(F.count("*").alias("n"))
    return totals_before(counts, [], score, ["n"]).select(
        score, "n", (F.col("n_before") + (F.col("n") + 1) / F.lit(2.0)).alias("avg_rank"))


def rank_auc(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve by the Mann-Whitney count, ties counted half, per group if asked.

    Positives, negatives and auc, which is NaN when a class is absent; one row if there are no groups.
    """
    counts = (df.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
                .groupBy(*by, F.col(score).alias("__key"))
                .agg(F.count_if(F.col(label) == 1).alias("pos"),
                     F.count_if(F.col(label) != 1).alias("neg")))
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    # Twice the number of (positive, negative) pairs in the right order, ties once.
    doubled = F.sum((wide("pos") * (wide("neg_before") * 2 + wide("neg"))).cast("decimal(38,0)"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0).cast("bigint"))
    totals = totals_before(counts, by, "__key", ["pos", "neg"]).groupBy(*by).agg(
        total("pos").alias("positives"), total("neg").alias("negatives"),
        doubled.alias("__doubled"))
    pairs = F.col("positives").cast("double") * F.col("negatives").cast("double")
    return totals.select(
        *by, "positives", "negatives",
        F.when(pairs > 0, F.col("__doubled").cast("double") / (pairs * 2))
         .otherwise(F.lit(float("nan"))).alias("auc"))
