"""Planting known defects, so that checks can be checked.

Which rows are hit depends only on the row's key and the seed, so a plan that is run twice, or
whose lost tasks are run again, plants the same defects.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import whole_share


@dataclass(frozen=True)
class Defect:
    """Replace ``column`` by the SQL expression ``value`` on about ``rate`` of the rows where
    ``where`` holds."""

    name: str
    column: str
    value: str
    rate: float
    where: str = "true"


def _hit(key: str, name: str, rate: float, seed: int) -> Column:
    return whole_share(key, f"{seed}:{name}:") < F.lit(float(rate))


def hits(defect: Defect, key: str, seed: int) -> Column:
    """TRUE for the rows that the defect is planted on."""
    return _hit(key, defect.name, defect.rate, seed) & F.coalesce(
        F.expr(defect.where), F.lit(False))


def planted_flag(name: str) -> str:
    return f"planted_{name}"


def plant(df: DataFrame, key: str, defects: Sequence[Defect], seed: int,
          flagged: bool = False) -> DataFrame:
    """Apply the defects in order. Hits are decided on the untouched row; ``flagged`` adds a column
    for each defect that tells them (``planted_flag``)."""
    flags = {f"__hit_{i}": hits(d, key, seed) for i, d in enumerate(defects)}
    out = df.withColumns(flags)
    for i, d in enumerate(defects):
        out = out.withColumn(
            d.column, F.when(F.col(f"__hit_{i}"), F.expr(d.value)).otherwise(F.col(d.column)))
    return out.select(*df.columns, *[
        F.col(f"__hit_{i}").alias(planted_flag(d.name)) for i, d in enumerate(defects) if flagged])


def plant_copies(df: DataFrame, key: str, name: str, rate: float, seed: int,
                 changes: Mapping[str, str] | None = None, flagged: bool = False) -> DataFrame:
    """Add a second row for about ``rate`` of the rows: exact, or with some columns replaced.
    ``flagged`` adds a column that tells both rows of such a pair.

    Each input row is read once and emitted once or twice; no self-union.
    """
    copies = F.when(_hit(key, name, rate, seed), F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0)))
    out = df.withColumn("__pair", F.size(copies) > 1).withColumn("__copy", F.explode(copies))
    if changes:
        out = out.select(*[
            F.when(F.col("__copy") == 1, F.expr(changes[c])).otherwise(F.col(c)).alias(c)
            if c in changes else F.col(c) for c in [*df.columns, "__pair"]])
    return out.select(*df.columns, *[F.col("__pair").alias(planted_flag(name))] * flagged)


def planted_counts(df: DataFrame, key: str, defects: Sequence[Defect], seed: int,
                   copies: Mapping[str, float] | None = None) -> DataFrame:
    """How many rows each rule hits on the table before planting, in one pass."""
    conditions = {d.name: hits(d, key, seed) for d in defects}
    conditions |= {n: _hit(key, n, rate, seed) for n, rate in (copies or {}).items()}
    counts = df.agg(*[F.count_if(c).alias(f"__{i}")
                      for i, c in enumerate(conditions.values())])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("defect"), F.col(f"__{i}").alias("n"))
        for i, n in enumerate(conditions)])))


def caught_counts(df: DataFrame, key: str, defects: Sequence[Defect], seed: int,
                  quarantined: DataFrame) -> DataFrame:
    """Per rule, the rows it hits and how many of their keys are in ``quarantined``.

    ``df`` is the table before planting. One pass and one join serve all rules.
    """
    flags = [hits(d, key, seed).alias(f"__{i}") for i, d in enumerate(defects)]
    hit = df.select(key, *flags).filter(
        reduce(lambda a, b: a | b, [F.col(f"__{i}") for i in range(len(defects))]))
    seen = quarantined.select(key).distinct().withColumn("__seen", F.lit(True))
    counts = hit.join(seen, key, "left").agg(
        *[F.count_if(F.col(f"__{i}")).alias(f"__n{i}") for i in range(len(defects))],
        *[F.count_if(F.col(f"__{i}") & F.col("__seen")).alias(f"__c{i}")
          for i in range(len(defects))])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(d.name).alias("defect"), F.col(f"__n{i}").alias("planted"),
                 F.col(f"__c{i}").alias("caught"))
        for i, d in enumerate(defects)])))
