"""Exact top-k inner products of integer vectors, norm-sorted with SVD-rotated partial sums.

Vectors are sorted by descending length and packed into blocks; queries are packed by how long a
vector must be to reach them. By Cauchy-Schwarz a block cannot hold an answer for a query if the
product of their lengths is below the query's k-th best score so far, and such pairs of blocks are
never joined. The first, longest blocks give each query its first k-th best score. Inside a pair,
vectors come by descending length and are rotated so that the first coordinates carry most of the
products (the right singular vectors of a bounded sample: they decide how early a sum is cut, never
what is found). Partial sums over a growing part of the coordinates, plus the product of the lengths
of the rest, bound the product from above; pairs whose bound stays below the k-th best score are cut
there, the others are multiplied exactly.

Scores are exact at any size. Blocks whose lengths multiply to less than 2^53 are multiplied in
doubles; beyond that doubles only bound the products, and the pairs that the bounds leave are
multiplied in 64-bit, beyond 2^62 in unlimited integers. A score that 64 bits cannot hold becomes
2^63 - 1 or its negative. Components may be as large as single precision goes. Vectors null, without
components, or with null or non-finite ones take no part, nor do rows without ``vec_id``; repeated
rows count once. Vectors are only compared with others of as many components.
Equal scores come by ascending ``vec_id``. An empty table, or one without queries, has no rows. Other
columns, whatever they are called, are not looked at. There are no texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import rows_per_partition, stage
from .vectors import (FOUND_EXACT, answers, best_rows, by_length, classes, found_batch, matrix, merge,
                      queries, valid_vectors)

SCALE = 64
BLOCK_ROWS = 8_192
QUERY_ROWS = 512
CHUNK_ROWS = 2_048
FIRST_BLOCKS = 4
PAIR_ROWS = 65_536  # pairs that are multiplied at a time
WIDEST = (1 << 63) - 1
STEPS = (0.25, 0.5, 0.75)  # parts of the coordinates after which sums are bounded
SAMPLE_ROWS = 4_096


def _below(scores: np.ndarray) -> np.ndarray:
    """Doubles that are not above the scores, and equal to those below 2^53."""
    near = scores.astype(np.float64)
    low = np.where(np.abs(near) < 2 ** 53, near, np.nextafter(near, -np.inf))
    return np.where(scores <= -WIDEST, -np.inf, low)


def _lengths(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt((vectors * vectors).sum(axis=1))


def _pack(rows: int):
    """Rows (id, ids, vec, least) in order to blocks of up to ``rows``: the task and the place in
    it, the greatest length, the least length that any row needs in a vector to reach its ``least``
    score, and the rows."""
    names = ["part", "seq", "high", "need", "id", "ids", "vecs", "least"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, held = TaskContext.get().partitionId(), 0, []

        def block(table: pa.Table) -> pa.RecordBatch:
            id_, ids, vec, least = (c.combine_chunks() for c in table.columns)
            vectors, least = matrix(vec), least.to_numpy()
            length = _lengths(vectors)
            need = np.where(least > 0, least, 0) / np.where(length > 0, length, np.inf)
            return pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([seq], pa.int32()),
                pa.array([length.max()]), pa.array([need.min()]),
                pa.array([id_.to_pylist()], pa.list_(pa.int64())),
                pa.array([ids.to_pylist()], pa.list_(pa.list_(pa.int64()))),
                pa.array([vectors.tobytes()], pa.binary()),
                pa.array([least.tolist()], pa.list_(pa.float64()))], names)

        for batch in batches:
            held.append(batch)
            whole = pa.Table.from_batches(held)
            while whole.num_rows >= rows:
                yield block(whole.slice(0, rows))
                seq, whole = seq + 1, whole.slice(rows)
            held = whole.to_batches()
        if held and (whole := pa.Table.from_batches(held)).num_rows:
            yield block(whole)

    return pack


BLOCK = ("part int, seq int, high double, need double, id array<long>, ids array<array<long>>, "
         "vecs binary, least array<double>")


def exact_products(asked: np.ndarray, items: np.ndarray, query: np.ndarray, item: np.ndarray,
                   bound: float) -> np.ndarray:
    """The inner products of pairs of rows of whole numbers, as 64-bit integers. ``bound`` is at
    least the product of the lengths of any pair."""
    kind = np.float64 if bound < 2 ** 53 else np.int64 if bound < 2 ** 62 else object
    if kind is object:
        whole = np.frompyfunc(int, 1, 1)
        asked, items = whole(asked), whole(items)
    else:
        asked, items = asked.astype(kind), items.astype(kind)
    out = np.empty(len(query), np.int64)
    step = PAIR_ROWS if kind is not object else PAIR_ROWS // 16
    for begin in range(0, len(query), step):
        part = slice(begin, begin + step)
        if kind is object:
            sums = (asked[query[part]] * items[item[part]]).sum(axis=1)
            out[part] = [max(-WIDEST, min(WIDEST, x)) for x in sums]
        else:
            out[part] = np.einsum("nd,nd->n", asked[query[part]], items[item[part]])
    return out


def block_best(asked: np.ndarray, least: np.ndarray, items: np.ndarray, rotation: np.ndarray,
               keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, item, score) of the products that may be among a query's ``keep`` best: all of its
    ``keep`` best in ``items`` that reach ``least``. Items come by descending length."""
    d = asked.shape[1]
    cuts = sorted({0, *(math.ceil(d * s) for s in STEPS)})
    turned, turned_items = asked @ rotation, items @ rotation
    length, item_length = _lengths(asked), _lengths(items)
    bound = length.max() * item_length.max() * (1 + 1e-9)
    least = least.copy()
    pool = tuple(np.empty(0, np.int64) for _ in range(3))
    for begin in range(0, len(items), CHUNK_ROWS):
        part = slice(begin, begin + CHUNK_ROWS)
        slack = 1e-9 * (length[:, None] * item_length[None, part] + 1)
        alive = length[:, None] * item_length[None, part] + slack >= least[:, None]
        sums = np.zeros(alive.shape)
        for a, b in zip(cuts, cuts[1:]):
            if not alive.any():
                break
            sums += turned[:, a:b] @ turned_items[part, a:b].T
            rest = _lengths(turned[:, b:])[:, None] * _lengths(turned_items[part, b:])[None, :]
            alive &= sums + rest + slack >= least[:, None]
        if bound < 2 ** 53 and alive.mean() > 0.2:
            scores = asked @ items[part].T
            query, item = np.nonzero(alive & (scores >= least[:, None]))
            found = scores[query, item].astype(np.int64)
        else:
            query, item = np.nonzero(alive)
            found = exact_products(asked, items[part], query, item, bound)
            reach = found >= least[query]
            query, item, found = query[reach], item[reach], found[reach]
        query, item, found = (np.concatenate([old, new]) for old, new in
                              zip(pool, (query, item + begin, found)))
        order = np.lexsort((-found, query))
        query, item, found = query[order], item[order], found[order]
        starts = np.searchsorted(query, np.arange(len(asked)))
        rank = np.arange(len(query)) - starts[query]
        at = rank == keep - 1
        least[query[at]] = np.maximum(least[query[at]], _below(found[at]))
        stay = found >= least[query]  # ties stay: their order is by id
        pool = query[stay], item[stay], found[stay]
    return pool


def _compare(rotation: np.ndarray, keep: int):
    """Pairs of a block of queries and one of vectors to each query's best rows there."""
    d = len(rotation)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for names, least, vecs, ids, items in zip(*batch.columns):
                asked = np.frombuffer(vecs.as_py()).reshape(-1, d)
                names, members = names.values.to_numpy(), ids.as_py()
                query, item, score = block_best(asked, least.values.to_numpy(), np.frombuffer(
                    items.as_py()).reshape(-1, d), rotation, keep)
                cuts = np.searchsorted(query, np.arange(len(asked) + 1))
                out = [(names[i], *best_rows(score[a:b], [np.array(members[j]) for j in item[a:b]],
                                             keep))
                       for i, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
                if out:
                    yield found_batch(out)

    return compare


def top_products(df: DataFrame, k: int = 20, every: int = 20, scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows of ``df`` (vec_id, embedding) whose id is
    divisible by ``every``: the ``k`` other rows of the largest inner product, where a component x
    counts as floor(scale * x). Vectors of each length are searched on their own."""
    def scaled(x: Column) -> Column:
        # Doubles from 2^52 on are whole, and may be beyond the range of floor().
        return F.when(F.abs(x * scale) < 2.0 ** 52, F.floor(x * scale).cast("double")) \
            .otherwise(x * scale)

    return by_length(valid_vectors(df, scaled, zeros=True), every,
                     lambda rows: _top_products(rows, k, every))


def _top_products(rows: DataFrame, k: int, every: int) -> DataFrame:
    keep = k + 1
    of = classes(rows, keep)
    asked = queries(rows, of, every)
    n = of.count()
    share = min(1.0, SAMPLE_ROWS / max(n, 1))
    sample = of.where(F.pmod(F.xxhash64(F.lit("topk"), "id"), F.lit(1 << 30))
                      <= int(share * (1 << 30))).select("vec").collect()
    if not sample:
        return answers(asked, of.sparkSession.createDataFrame([], FOUND_EXACT), k)
    vectors = np.array([r.vec for r in sample])
    rotation = np.linalg.eigh(vectors.T @ vectors)[1][:, ::-1].copy()

    squares = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)
    width = rows_per_partition(of, n, BLOCK_ROWS)
    tasks = -(-n // BLOCK_ROWS)  # so that blocks are full however many partitions there are
    blocks = stage(of.withColumn("norm", F.sqrt(squares)).repartitionByRange(width, F.desc("norm"))
                   .coalesce(tasks).sortWithinPartitions(F.desc("norm"))
                   .select("id", "ids", "vec", F.lit(0.0).alias("least"))
                   .mapInArrow(_pack(BLOCK_ROWS), BLOCK), "topk-blocks")
    items = blocks.select("part", "seq", "high", "ids", F.col("vecs").alias("items"))
    unique = of.join(asked.select(F.col("query").alias("id")).distinct(), "id") \
               .withColumn("norm", F.sqrt(squares))

    n_asked = unique.count()

    def packed(some: DataFrame) -> DataFrame:
        """Blocks of queries (id, vec, norm, least), those in one of about the same need."""
        need = F.when((F.col("norm") > 0) & (F.col("least") > 0), F.col("least") / F.col("norm"))
        return stage(some.withColumn("need", F.coalesce(need, F.lit(0.0)))
                     .repartitionByRange(rows_per_partition(of, n_asked, QUERY_ROWS), "need", "id")
                     .coalesce(max(1, -(-n_asked // QUERY_ROWS))).sortWithinPartitions("need")
                     .select("id", F.array().cast("array<bigint>").alias("ids"), "vec", "least")
                     .mapInArrow(_pack(QUERY_ROWS), BLOCK), "topk-queries") \
            .select(F.struct("part", "seq").alias("name"), "need", "id", "least", "vecs")

    def compared(pairs: DataFrame) -> DataFrame:
        return stage(merge(pairs.select("id", "least", "vecs", "ids", "items").mapInArrow(
            _compare(rotation, keep), FOUND_EXACT), keep, FOUND_EXACT), "topk-found")

    first = [(r.part, r.seq) for r in
             items.select("part", "seq").orderBy("part", "seq").limit(FIRST_BLOCKS).collect()]
    places = F.array(*[F.struct(F.lit(p).alias("part"), F.lit(s).alias("seq")) for p, s in first])
    start = packed(unique.withColumn("least", F.lit(float("-inf"))))
    begun = compared(start.select("id", "least", "vecs", F.explode(places).alias("to"))
                     .select("id", "least", "vecs", "to.*").join(
                         items.select("part", "seq", "ids", "items"), ["part", "seq"]))
    # Lowered by more than the cast may have raised it; below 2^53 the cast is exact.
    worst = F.get("scores", F.lit(keep - 1)).cast("double")
    lowered = F.when(F.abs(worst) < 2.0 ** 53, worst) \
        .when(worst > -2.0 ** 63, worst - F.abs(worst) * 2.0 ** -50)
    known = unique.join(begun.select(F.col("query").alias("id"), "scores"), "id", "left") \
        .withColumn("least", F.coalesce(lowered, F.lit(float("-inf")))).drop("scores")
    later = packed(known)
    heads = items.select("part", "seq", "high").where(~F.struct("part", "seq").isin(
        *[F.struct(F.lit(p), F.lit(s)) for p, s in first]))
    # The task numbers of the vectors' blocks are a fixed range, over which pairs are dealt out.
    pairs = later.select("name", "need", F.explode(F.sequence(
        F.lit(0), F.lit(tasks - 1))).alias("part")).join(heads, "part") \
        .where(F.col("high") * (1 + 1e-9) >= F.col("need")).select("name", "part", "seq")
    loaded = pairs.join(later.select("name", "id", "least", "vecs"), "name") \
                  .join(items.select("part", "seq", "ids", "items"), ["part", "seq"])
    return answers(asked, merge(begun.unionAll(compared(loaded)), keep, FOUND_EXACT), k)
