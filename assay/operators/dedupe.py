"""Keeping one or a few rows per key.

``row_number() <= n`` over a partition makes Spark add a WindowGroupLimit before the shuffle:
each map task sends at most ``n`` rows per key, so a key that holds a third of the table costs
its reducer ``n`` rows per map task and no more.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import ColumnLike, as_column

_RANK = "__rank"


def _keep(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn(_RANK, F.row_number().over(window))
              .filter(F.col(_RANK) <= n).drop(_RANK))


def dedupe_latest(df: DataFrame, keys: Sequence[str], order_by: ColumnLike,
                  tie_break: Sequence[str] = ()) -> DataFrame:
    """The row with the greatest ``order_by`` per key; equal ones are told apart by
    ``tie_break``, ascending. NULL counts as oldest."""
    return _keep(df, keys, [as_column(order_by).desc(), *[F.col(c).asc() for c in tie_break]], 1)


def dedupe_first(df: DataFrame, keys: Sequence[str], order_by: ColumnLike,
                 tie_break: Sequence[str] = ()) -> DataFrame:
    """The row with the smallest ``order_by`` per key; NULL counts as smallest."""
    return _keep(df, keys, [as_column(order_by).asc(), *[F.col(c).asc() for c in tie_break]], 1)


def top_n_per_group(df: DataFrame, group: Sequence[str], by: Sequence[ColumnLike],
                    n: int) -> DataFrame:
    """The first ``n`` rows of each group in the order of ``by`` (names sort ascending)."""
    return _keep(df, group, [as_column(c) for c in by], n)


def top_k(df: DataFrame, by: Sequence[ColumnLike], k: int) -> DataFrame:
    """The first ``k`` rows of the whole table: a top-k heap per task, then a merge."""
    return df.orderBy(*[as_column(c) for c in by]).limit(k)
