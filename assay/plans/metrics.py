"""Metric layer: named dimensions and measures that are always computed from source rows.

A measure is an aggregate expression, so an average, a rate or a median is worked out anew at
whatever grain a query asks for; nothing is ever averaged from a rollup.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ranks import exact_percentile

_ROW = "__row"


@dataclass(frozen=True)
class Dimension:
    expr: str
    comment: str = ""


@dataclass(frozen=True)
class Measure:
    """An aggregate SQL expression over the source columns."""

    expr: str
    comment: str = ""


@dataclass(frozen=True)
class Percentile:
    """Exact percentile of a SQL expression, computed without gathering a group in one task."""

    value: str
    q: float = 0.5
    comment: str = ""

    @property
    def expr(self) -> str:
        return f"PERCENTILE({self.value}, {self.q})"


@dataclass(frozen=True)
class MetricView:
    dimensions: Mapping[str, Dimension]
    measures: Mapping[str, Measure | Percentile]
    comment: str = ""
    tags: Mapping[str, str] = field(default_factory=dict)

    @classmethod
    def from_dict(cls, spec: Mapping) -> MetricView:
        """Build from a definition with lists of ``{name, expr, comment}`` entries, the shape a
        YAML definition has. An ``expr`` of the form ``PERCENTILE(value, q)`` is recognised."""
        dims = {d["name"]: Dimension(d["expr"], d.get("comment", ""))
                for d in spec["dimensions"]}
        measures = {}
        for m in spec["measures"]:
            text, comment = m["expr"].strip(), m.get("comment", "")
            if text.upper().startswith("PERCENTILE(") and text.endswith(")"):
                value, q = text[len("PERCENTILE("):-1].rsplit(",", 1)
                measures[m["name"]] = Percentile(value.strip(), float(q), comment)
            else:
                measures[m["name"]] = Measure(text, comment)
        return cls(dims, measures, spec.get("comment", ""), dict(spec.get("tags", {})))

    @classmethod
    def from_file(cls, path: str) -> MetricView:
        """Read a definition from a JSON file, or from YAML where a YAML library is installed."""
        with open(path, encoding="utf-8") as file:
            text = file.read()
        if path.endswith(".json"):
            return cls.from_dict(json.loads(text))
        try:
            import yaml
        except ImportError as error:
            raise ValueError("no YAML library is installed; use a JSON file") from error
        return cls.from_dict(yaml.safe_load(text))

    def _check(self, measures: Sequence[str], by: Sequence[str]) -> None:
        if not measures:
            raise ValueError("a metric query names at least one measure")
        if "*" in measures or "*" in by:
            raise ValueError("a metric query names its measures and dimensions; '*' is not one")
        for name in measures:
            if name not in self.measures:
                raise ValueError(f"unknown measure {name!r}; known: {sorted(self.measures)}")
        for name in by:
            if name not in self.dimensions:
                raise ValueError(f"unknown dimension {name!r}; known: {sorted(self.dimensions)}")

    def query(self, source: DataFrame, measures: Sequence[str], by: Sequence[str] = (),
              where: str | None = None) -> DataFrame:
        """Measures per combination of dimensions, over the rows for which ``where`` holds.

        ``where`` is a SQL predicate over dimension names (back-quoted where they hold spaces);
        it sees no other columns and acts before aggregation.
        """
        self._check(measures, by)
        rows = source.select(
            *[F.expr(d.expr).alias(name) for name, d in self.dimensions.items()],
            F.struct("*").alias(_ROW))
        # The alias hides the source columns from the filter, which would otherwise find them.
        rows = rows.alias("metrics")
        if where is not None:
            rows = rows.filter(F.expr(where))
        keys = [f"__d{i}" for i in range(len(by))]
        rows = rows.select(*[F.col(f"`{name}`").alias(k) for k, name in zip(keys, by)],
                           f"{_ROW}.*")
        plain = [m for m in measures if isinstance(self.measures[m], Measure)]
        ranked = [m for m in measures if isinstance(self.measures[m], Percentile)]
        # The group count keeps every group in the result, with or without plain measures.
        out = rows.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("__n"),
            *[F.expr(self.measures[m].expr).alias(f"__m{measures.index(m)}") for m in plain])
        for m in ranked:
            spec = self.measures[m]
            name = f"__m{measures.index(m)}"
            value = exact_percentile(rows, keys, spec.value, spec.q, out=name)
            out = _attach(out, value, keys)
        return out.select(*[F.col(k).alias(name) for k, name in zip(keys, by)],
                          *[F.col(f"__m{i}").alias(name) for i, name in enumerate(measures)])

    def catalogue(self, spark) -> DataFrame:
        """Definitions as a table, for searching."""
        entries = [(kind, name, item.expr, item.comment)
                   for kind, items in (("dimension", self.dimensions),
                                       ("measure", self.measures))
                   for name, item in items.items()]
        return spark.createDataFrame(
            entries, "kind string, name string, expr string, comment string")


def _attach(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Put the columns of two per-group results side by side; NULL is a group of its own, and
    without keys both have one row."""
    both = left.unionByName(right, allowMissingColumns=True)
    return both.groupBy(*keys).agg(*[F.max(c).alias(c) for c in both.columns if c not in keys])


# Dimensions and measures of the banking metrics. Money is decimal while it is summed.
BANKING_DEFINITION = {
    "comment": "Balances, card activity and retention of retail customers.",
    "tags": {"domain": "retail_banking", "certified": "true"},
    "dimensions": [
        {"name": "Age", "expr": "age", "comment": "Completed years on the reporting date."},
        {"name": "Age Band", "expr": "age_band"},
        {"name": "Gender", "expr": "gender"},
        {"name": "State", "expr": "home_state", "comment": "Two-letter code."},
        {"name": "Region", "expr": "region", "comment": "Region of the home branch."},
        {"name": "Segment", "expr": "segment"},
        {"name": "Acquisition Channel", "expr": "acquisition_channel"},
        {"name": "Source Bank", "expr": "source_bank",
         "comment": "Former bank of a switch-in customer, NULL for others."},
        {"name": "Moved From Bank", "expr": "moved_from_bank",
         "comment": "TRUE for customers who came with a switch kit."},
        {"name": "Customer Status", "expr": "customer_status"},
        {"name": "Retained", "expr": "is_retained",
         "comment": "TRUE unless the customer has left."},
    ],
    "measures": [
        {"name": "Customer Count", "expr": "COUNT(1)"},
        {"name": "Average Balance",
         "expr": "CAST(SUM(CAST(total_balance AS DECIMAL(18, 2))) AS DOUBLE) / COUNT(total_balance)",
         "comment": "Mean of the customers' total balances."},
        {"name": "Total Balance", "expr": "CAST(SUM(CAST(total_balance AS DECIMAL(18, 2))) AS DOUBLE)"},
        {"name": "Median Balance", "expr": "PERCENTILE(total_balance, 0.5)"},
        {"name": "Debit Card Swipes", "expr": "SUM(debit_swipe_count)"},
        {"name": "Total Transactions", "expr": "SUM(txn_count)"},
        {"name": "Total Spend", "expr": "CAST(SUM(CAST(total_spend AS DECIMAL(18, 2))) AS DOUBLE)"},
        {"name": "Retained Customers", "expr": "SUM(CASE WHEN is_retained THEN 1 ELSE 0 END)"},
        {"name": "Retention Rate",
         "expr": "AVG(CASE WHEN is_retained THEN 1.0D ELSE 0.0D END)",
         "comment": "Share of customers who stayed; an unknown status counts as not retained."},
        {"name": "Attrition Rate",
         "expr": "AVG(CASE WHEN customer_status = 'attrited' THEN 1.0D ELSE 0.0D END)"},
    ],
}
BANKING = MetricView.from_dict(BANKING_DEFINITION)


def segment_comparison(c360: DataFrame) -> DataFrame:
    """Segments by size, balance, swipes per customer and retention; the per-customer figure is
    a ratio of two measures taken after aggregation."""
    out = BANKING.query(c360, ["Customer Count", "Average Balance", "Debit Card Swipes",
                               "Retention Rate"], by=["Segment"])
    return out.withColumn("Swipes per Customer",
                          F.col("Debit Card Swipes") / F.col("Customer Count"))
