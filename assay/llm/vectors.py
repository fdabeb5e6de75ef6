"""What the two vector searches share: classes of equal vectors, merging of partial results, and
the answers per query.

Rows with equal vectors have equal scores, so they are searched as one class. A class holds its
smallest ids, one more than a query asks for: no other row of it can be among a query's nearest.
Query rows with equal vectors are one query until the answers are given out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import rows_per_partition, stage

FOUND = "query long, ids array<long>, scores array<double>"
FOUND_EXACT = "query long, ids array<long>, scores array<long>"


def valid_vectors(df: DataFrame, change: Callable[[Column], Column], zeros: bool) -> DataFrame:
    """(vec_id, vec) of the distinct rows of ``df`` (vec_id, embedding) whose vector is whole and
    finite and, if not ``zeros``, has a component other than zero. ``change`` is applied to each
    component, as a double, first. Vectors without components have no measure and go."""
    real = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    rows = df.where(F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & real)
    if not zeros:
        rows = rows.where(F.exists("embedding", lambda x: x != 0))
    return rows.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.transform("embedding", lambda x: change(x.cast("double")).cast("double")).alias("vec")
    ).distinct()


def by_length(rows: DataFrame, every: int, search: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``search`` of the rows of each length of vector that holds a query, together: vectors of
    different lengths have no inner product."""
    lengths = rows.groupBy(F.size("vec").alias("n")).agg(
        F.count_if(F.col("vec_id") % every == 0).alias("asked")).where("asked > 0")
    found = [search(rows.where(F.size("vec") == r["n"])) for r in lengths.orderBy("n").collect()]
    return reduce(DataFrame.unionAll, found) if found else search(rows.limit(0))


def classes(rows: DataFrame, keep: int) -> DataFrame:
    """(id, ids, vec): each distinct vector with its ``keep`` smallest ids and the first of them.
    The limit per vector is applied before the shuffle, so a vector that a third of all rows share
    sends a few rows per task."""
    rank = F.row_number().over(Window.partitionBy("vec").orderBy("vec_id"))
    few = rows.withColumn("n", rank).where(F.col("n") <= keep).groupBy("vec").agg(
        F.array_sort(F.collect_list("vec_id")).alias("ids"))
    return stage(few.select(F.col("ids")[0].alias("id"), "ids", "vec"), "vector-classes")


def queries(rows: DataFrame, of: DataFrame, every: int = 20) -> DataFrame:
    """(query_id, query): the rows whose id is divisible by ``every``, and their classes."""
    return stage(rows.where(F.col("vec_id") % every == 0).join(of.select("vec", "id"), "vec")
                 .select(F.col("vec_id").alias("query_id"), F.col("id").alias("query")),
                 "vector-queries")


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def best_rows(scores: np.ndarray, members: Sequence[np.ndarray], keep: int
              ) -> tuple[np.ndarray, np.ndarray]:
    """The ``keep`` best rows (ids, scores) of some classes: by score, then by id."""
    order = np.lexsort(([m[0] for m in members], -scores))[:keep]
    ids = np.concatenate([members[i] for i in order]) if len(order) else np.empty(0, np.int64)
    each = np.repeat(scores[order], [len(members[i]) for i in order])
    first = np.lexsort((ids, -each))[:keep]
    return ids[first], each[first]


def found_batch(rows: list[tuple[int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    query, ids, scores = zip(*rows)
    kind = pa.int64() if scores[0].dtype == np.int64 else pa.float64()
    return pa.RecordBatch.from_arrays(
        [pa.array(query, pa.int64()), pa.array(ids, pa.list_(pa.int64())),
         pa.array(scores, pa.list_(kind))], ["query", "ids", "scores"])


def merge(found: DataFrame, keep: int, schema: str = FOUND) -> DataFrame:
    """One row per query with the ``keep`` best of its partial results, without repeats. A query's
    rows come one after another, so only its best so far are held."""
    none = np.empty(0, np.int64 if schema == FOUND_EXACT else np.float64)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, ids, scores, out = None, np.empty(0, np.int64), none, []
        for batch in batches:
            for query, new, values in zip(batch.column(0).to_pylist(), batch.column(1),
                                          batch.column(2)):
                new, values = (x.values.to_numpy(zero_copy_only=False) for x in (new, values))
                if query != last:
                    if last is not None:
                        out.append((last, ids, scores))
                    last, ids, scores = query, np.empty(0, np.int64), none
                ids, scores = np.concatenate([ids, new]), np.concatenate([scores, values])
                order = np.lexsort((ids, -scores))
                ids, scores = ids[order], scores[order]
                fresh = np.r_[True, (ids[1:] != ids[:-1]) | (scores[1:] != scores[:-1])]
                ids, scores = ids[fresh[:len(ids)]][:keep], scores[fresh[:len(ids)]][:keep]
            if out:
                yield found_batch(out)
                out = []
        if last is not None:
            yield found_batch([(last, ids, scores)])

    n = rows_per_partition(found, 0, 1)
    return found.repartition(n, "query").sortWithinPartitions("query").mapInArrow(walk, schema)


def answers(asked: DataFrame, best: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best rows for each query but its own."""
    others = F.filter(F.arrays_zip("ids", "scores"), lambda x: x["ids"] != F.col("query_id"))
    return asked.join(best, "query").select(
        "query_id", F.posexplode(F.slice(others, 1, k)).alias("rank", "x")).select(
        "query_id", (F.col("rank") + 1).alias("rank"), F.col("x.ids").alias("vec_id"),
        F.col("x.scores").alias("score"))
