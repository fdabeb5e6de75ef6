"""Exact money arithmetic.

Amounts are doubles in the tables. Sums run over ``decimal(18,2)``, so they neither depend on
the order in which partitions are merged nor overflow, and only the result becomes a double.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import ColumnLike, as_column


def to_money(col: ColumnLike) -> Column:
    """The amount with exactly two decimals, NULL where it cannot be written that way."""
    return as_column(col).try_cast("decimal(18,2)")


def money_sum(col: ColumnLike) -> Column:
    """Exact total as a decimal; combine further with ``F.sum`` or turn into a double."""
    return F.sum(as_column(col).cast("decimal(18,2)"))


def money_average(total: ColumnLike, n: ColumnLike) -> Column:
    """``total/n`` rounded half away from zero to cents, as a double; NULL when ``n`` is 0."""
    cents = (as_column(total) * 100).cast("decimal(38,0)")
    count = as_column(n).cast("decimal(20,0)")
    size = F.call_function("div", F.abs(cents) * 2 + count, F.nullif(count * 2, F.lit(0)))
    return F.when(cents < 0, -size).otherwise(size) / F.lit(100.0)


def whole_average(total: ColumnLike, n: ColumnLike) -> Column:
    """``total/n`` of non-negative money rounded half up to whole units."""
    cents = (as_column(total) * 100).cast("decimal(38,0)")
    count = as_column(n).cast("decimal(20,0)")
    return F.call_function(
        "div", cents + count * 50, F.nullif(count * 100, F.lit(0))).cast("double")
