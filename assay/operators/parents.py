"""Foreign-key joins.

None of these forces a broadcast: Spark broadcasts the parent when its measured size is below
the session's threshold and otherwise runs a shuffle join whose hot child keys AQE splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_parent(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows whose key exists in ``parent``; repeated parent keys do not multiply rows."""
    return child.join(parent.select(key), key, "left_semi").select(*child.columns)


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows whose key is NULL or exists nowhere in ``parent``."""
    return child.join(parent.select(key), key, "left_anti").select(*child.columns)


def tag_orphans(child: DataFrame, parent: DataFrame, key: str,
                out: str = "is_orphan") -> DataFrame:
    """Every child row with a flag that says whether its parent is missing.

    A semi and an anti join on the parents as they are: both sides are shuffles that AQE can
    split, which an aggregate that makes the parents unique would prevent. Spark shuffles the
    children once for the two.
    """
    return with_parent(child, parent, key).withColumn(out, F.lit(False)).unionAll(
        orphans(child, parent, key).withColumn(out, F.lit(True)))


def orphan_count(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    return orphans(child, parent, key).agg(F.count("*").alias("orphans"))
