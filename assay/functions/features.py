"""Churn features and the attrition scorecard."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def churn_features(df: DataFrame) -> DataFrame:
    """Add the seven clipped, logged and indicator features of the scorecard."""
    flag = lambda condition: F.coalesce(condition, F.lit(False)).cast("double")
    return df.withColumns({
        "tenure_clipped": F.least(F.col("tenure_years"), F.lit(15.0)),
        "log_balance": F.log10(F.greatest(F.col("total_balance"), F.lit(50.0))) - 3.5,
        "activity": F.least(F.col("txn_count").cast("double"), F.lit(30.0)),
        "is_young": flag(F.col("age") < 30),
        "is_switch_in": flag(F.col("acquisition_channel") == "switch_kit"),
        "is_affluent": flag(F.col("segment").isin("affluent", "private")),
        "single_account": flag(F.col("num_accounts") <= 1),
    })


def scorecard(df: DataFrame, intercept: float, weights: Mapping[str, float],
              out: str = "z") -> DataFrame:
    """Add the weighted sum ``out`` and its logistic ``<out>_probability``.

    The keys of ``weights`` are SQL expressions over the columns of ``df``.
    """
    total: Column = F.lit(float(intercept))
    for expression, weight in weights.items():
        total = total + F.lit(float(weight)) * F.expr(expression)
    z = F.col(out)
    return df.withColumn(out, total).withColumn(
        f"{out}_probability", F.lit(1.0) / (F.lit(1.0) + F.exp(-z)))
