"""Expectations, their metrics, and quarantine.

A rule passes only when its predicate is TRUE. FALSE and NULL both fail, so that the clean rows
and the quarantined rows always add up to the input.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import text

REASON = "quarantine_reason"


@dataclass(frozen=True)
class Rule:
    """``predicate`` is a SQL expression; ``action`` is drop, warn or fail."""

    name: str
    predicate: str
    action: str = "drop"
    reason: str | None = None

    def __post_init__(self):
        if self.action not in ("drop", "warn", "fail"):
            raise ValueError(f"unknown action: {self.action}")

    @property
    def passing(self) -> str:
        return f"coalesce({self.predicate}, false)"

    @property
    def passes(self) -> Column:
        return F.expr(self.passing)


def rules_from(predicates: Mapping[str, str], action: str = "drop") -> list[Rule]:
    return [Rule(name, predicate, action) for name, predicate in predicates.items()]


def expect(df: DataFrame, predicates: Mapping[str, str], action: str = "drop") -> DataFrame:
    """Apply named predicates.

    ``drop`` keeps the passing rows, ``warn`` keeps all rows and adds one flag column
    ``<name>_ok`` per rule, ``fail`` lets the job end with an error that names the rule at the
    first row that breaks it; no extra pass over the data is needed.
    """
    rules = rules_from(predicates, action)
    if action == "warn":
        return df.withColumns({f"{r.name}_ok": r.passes for r in rules})
    if action == "drop":
        return df.filter(" AND ".join(["true", *[r.passing for r in rules]]))
    checks = [
        F.when(r.passes, True).otherwise(
            F.raise_error(F.lit(f"expectation failed: {r.name}")).cast("boolean"))
        for r in rules
    ]
    return df.filter(reduce(lambda a, b: a & b, checks, F.lit(True)))


def judge(df: DataFrame, rules: Sequence[Rule], out: str = REASON) -> DataFrame:
    """Add the reason of the first failing drop rule, NULL for a clean row."""
    cases = " ".join(f"WHEN NOT {r.passing} THEN {text(r.reason or r.name)}"
                     for r in rules if r.action == "drop")
    reason = f"CASE {cases} ELSE cast(NULL AS STRING) END" if cases else "cast(NULL AS STRING)"
    return df.withColumn(out, F.expr(reason))


def clean_rows(judged: DataFrame, reason: str = REASON) -> DataFrame:
    return judged.filter(F.col(reason).isNull()).drop(reason)


def quarantined_rows(judged: DataFrame, reason: str = REASON) -> DataFrame:
    return judged.filter(F.col(reason).isNotNull())


def quarantine(df: DataFrame, reasons: Sequence[tuple[str, str]]) -> DataFrame:
    """Rows that break one of the ``(reason, predicate that must hold)`` pairs, with the first
    reason that applies."""
    return quarantined_rows(judge(df, [Rule(r, p, reason=r) for r, p in reasons]))


def expectation_metrics(df: DataFrame, rules: Sequence[Rule], table: str) -> DataFrame:
    """Passed and failed rows per rule, all counted in one pass."""
    counts = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count_if(~r.passes).alias(f"__{i}") for i, r in enumerate(rules)])
    entries = F.array(*[
        F.struct(F.lit(table).alias("table_name"), F.lit(r.name).alias("expectation"),
                 F.lit(r.action).alias("action"),
                 (F.col("__rows") - F.col(f"__{i}")).alias("passed"),
                 F.col(f"__{i}").alias("failed"))
        for i, r in enumerate(rules)])
    return counts.select(F.inline(entries))


def conservation(source: DataFrame, clean: DataFrame, quarantined: DataFrame,
                 keys: Sequence[str]) -> DataFrame:
    """Is every row of ``source`` in exactly one of the two outputs?

    One row with the input count, both output counts, and the number of keys that were lost,
    kept twice, or came from nowhere. A tagged union with map-side counts does it in one shuffle.
    """
    tagged = reduce(DataFrame.unionAll, [
        part.select(*keys, *[F.lit(int(i == j)).cast("bigint").alias(n)
                             for j, n in enumerate(["__s", "__c", "__q"])])
        for i, part in enumerate([source, clean, quarantined])])
    per_key = tagged.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("__s", "__c", "__q")])
    kept = F.col("__c") + F.col("__q")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0).cast("bigint"))
    return per_key.agg(
        total("__s").alias("input_rows"), total("__c").alias("clean_rows"),
        total("__q").alias("quarantined_rows"),
        F.count_if(kept < F.col("__s")).alias("lost_keys"),
        F.count_if((kept > F.col("__s")) & (F.col("__s") > 0)).alias("repeated_keys"),
        F.count_if(F.col("__s") == 0).alias("unknown_keys"))


def compare_metrics(before: DataFrame, after: DataFrame) -> DataFrame:
    """Failed rows per expectation in two runs and their difference."""
    keys = ["table_name", "expectation"]
    left = before.select(*keys, F.col("failed").alias("failed_before"))
    right = after.select(*keys, F.col("failed").alias("failed_after"))
    zero = F.lit(0).cast("bigint")
    return (left.join(right, keys, "full")
                .withColumns({c: F.coalesce(F.col(c), zero)
                              for c in ("failed_before", "failed_after")})
                .withColumn("delta", F.col("failed_after") - F.col("failed_before")))


def unexplained(source: DataFrame, quarantined: DataFrame, planted: Column,
                keys: Sequence[str]) -> DataFrame:
    """Planted bad rows that reached no quarantine: the expectation that is missing."""
    return source.filter(planted).join(
        quarantined.select(*keys).distinct(), list(keys), "left_anti")


# Metrics that come with a write.

@dataclass(frozen=True)
class Watch:
    """Expectations of a table, counted while its rows are written."""

    table: str
    rules: tuple[Rule, ...]
    observation: Observation

    def rows(self) -> list[tuple]:
        """(table_name, expectation, action, passed, failed); waits for the write to end."""
        seen = self.observation.get
        return [(self.table, r.name, r.action, seen["rows"] - seen[f"r{i}"], seen[f"r{i}"])
                for i, r in enumerate(self.rules)]


METRICS = "table_name string, expectation string, action string, passed long, failed long"


def watch(df: DataFrame, rules: Sequence[Rule], table: str, seen: str = "true"
          ) -> tuple[DataFrame, Watch]:
    """``df`` to be written, and what will tell the passed and failed rows per rule once it is.

    Counts travel with the tasks of the write, so there is no further scan. They are exact if no
    shuffle stands between here and the write: then each row is counted by the one task whose
    output is kept. ``seen`` tells which rows the expectations look at.
    """
    looked = F.coalesce(F.expr(seen), F.lit(False))
    observation = Observation()
    counted = df.observe(observation, F.count_if(looked).alias("rows"), *[
        F.count_if(looked & ~r.passes).alias(f"r{i}") for i, r in enumerate(rules)])
    return counted, Watch(table, tuple(rules), observation)


def watched_metrics(spark: SparkSession, watches: Sequence[Watch]) -> DataFrame:
    """What ``expectation_metrics`` tells, of frames that have been written."""
    return spark.createDataFrame([row for w in watches for row in w.rows()], METRICS)


# Which rule catches which defect.

def _mask(conditions: Mapping[str, Column]) -> Column:
    """One bit per condition that holds."""
    return reduce(lambda a, b: a.bitwiseOR(b), [
        F.when(cond, F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint")
        for i, cond in enumerate(conditions.values())], F.lit(0).cast("bigint"))


def _names(mask: str, conditions: Mapping[str, Column]) -> Column:
    held = F.filter(F.array(*[F.when(F.col(mask).bitwiseAND(F.lit(1 << i)) != 0, F.lit(n))
                              for i, n in enumerate(conditions)]), lambda x: x.isNotNull())
    return F.when(F.size(held) == 0, F.array(F.lit("none"))).otherwise(held)


def coverage(df: DataFrame, planted: Mapping[str, Column], fired: Mapping[str, Column]
             ) -> DataFrame:
    """(planted, fired, n): the rows that carry a planted defect and break a rule, for each pair.

    Rows with a defect that no rule fires on are counted under fired 'none', rules that fire on rows
    without a defect under planted 'none'. Each row becomes two bit masks, so one pass with a
    map-side count of few groups does it; the pairs are made of the counts.
    """
    masks = df.groupBy(_mask(planted).alias("__p"), _mask(fired).alias("__f")).agg(
        F.count("*").alias("n"))
    return (masks.select(F.explode(_names("__p", planted)).alias("planted"), "__f", "n")
                 .select("planted", F.explode(_names("__f", fired)).alias("fired"), "n")
                 .groupBy("planted", "fired").agg(F.sum("n").alias("n")))
