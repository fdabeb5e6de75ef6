"""Approximate nearest neighbours by largest inner product: multiprobe p-stable hashing.

Largest inner product is turned into smallest distance: with M the largest length, a vector x
becomes (x, sqrt(M^2 - |x|^2)) / M and a query q becomes (q, 0) / |q|. Each table has KEYS p-stable
hashes floor((a x + b) / W), which together name a bucket. A query visits its own bucket and others
in which some hashes are one lower or higher, in the order of their estimated success: a set of
perturbations is scored by the expected squared distances of the query to the bucket's borders (Lv
et al., 2007, whose template of sets is the same for every query; what differs is which hash's
border is the nearest). All vectors of the visited buckets are scored, tables are merged, and the
best are ranked by their exact inner products.

Buckets are dealt to cells of about CELL_ROWS vectors; a query goes to the cells that hold its
buckets. A cell that hot buckets make larger is split by vector, and its queries go to every part.
A task holds one part and streams the queries.

The number of buckets that a query visits per table is fitted on a bounded sample: the least of
PROBES that reaches TARGET recall for SAMPLE_QUERIES queries among SAMPLE_ROWS vectors. Neighbours
within a sample are farther away than within the whole table, so recall there is higher. Every
vector is indexed. Scores are products summed with a single rounding.

Vectors null, zero, without components, or with null or non-finite ones take no part, nor do rows
without ``vec_id``; repeated rows count once. Vectors are only compared with others of as many
components. Equal scores come by ascending ``vec_id``. An empty table, or one without queries, has no
rows. Other columns, whatever they are called, are not looked at. There are no texts.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .vectors import (FOUND, answers, best_rows, by_length, classes, found_batch, matrix, merge,
                      queries, valid_vectors)

TABLES = 8
KEYS = 6
W = 1.5
PROBES = (16, 32, 64, 128, 256, 512, 1024)
TARGET = 0.95
SAMPLE_ROWS = 4_096
SAMPLE_QUERIES = 128
CELL_ROWS = 16_384
QUERY_BATCH = 256
SEED = 11


def perturbations(keys: int, most: int) -> list[tuple[int, ...]]:
    """Sets of ranks 1..2 keys (1: the border that is nearest) in the order of their expected sum
    of squared distances; a set never moves one hash both ways."""
    def expected(j: int) -> float:
        if j <= keys:
            return j * (j + 1) / (4 * (keys + 1) * (keys + 2))
        i = 2 * keys + 1 - j
        return 1 - i / (keys + 1) + i * (i + 1) / (4 * (keys + 1) * (keys + 2))

    sets: list[tuple[int, ...]] = [()]
    heap = [(expected(1), (1,))]
    while heap and len(sets) < most:
        total, ranks = heapq.heappop(heap)
        last = ranks[-1]
        if not any(2 * keys + 1 - r in ranks for r in ranks):
            sets.append(ranks)
        if last < 2 * keys:
            step = expected(last + 1)
            heapq.heappush(heap, (total - expected(last) + step, (*ranks[:-1], last + 1)))
            heapq.heappush(heap, (total + step, (*ranks, last + 1)))
    return sets


@dataclass(frozen=True)
class Index:
    """The hashes of all tables: directions (tables, dimensions + 1, keys), offsets, and odd factors
    that make one number of a bucket's hashes; the largest length; buckets to visit per table."""

    directions: np.ndarray
    offsets: np.ndarray
    factors: np.ndarray
    longest: float
    probes: int

    def _scaled(self, vectors: np.ndarray, as_query: bool) -> np.ndarray:
        length = np.linalg.norm(vectors, axis=1, keepdims=True)
        if as_query:
            return np.hstack([vectors / length, np.zeros_like(length)])
        rest = np.sqrt(np.maximum(self.longest ** 2 - length ** 2, 0))
        return np.hstack([vectors, rest]) / self.longest

    def buckets(self, vectors: np.ndarray) -> np.ndarray:
        """(tables, vectors): each vector's bucket in each table."""
        places = np.einsum("nd,tdk->tnk", self._scaled(vectors, False), self.directions)
        cells = np.floor((places + self.offsets[:, None, :]) / W).astype(np.int64)
        return (cells * self.factors[:, None, :]).sum(axis=2)

    def visited(self, vectors: np.ndarray, probes: int) -> np.ndarray:
        """(tables, queries, probes): the buckets to visit, in the order of estimated success."""
        sets = perturbations(KEYS, probes)
        chosen = np.zeros((len(sets), 2 * KEYS), np.int64)
        for i, ranks in enumerate(sets):
            chosen[i, [r - 1 for r in ranks]] = 1
        places = (np.einsum("nd,tdk->tnk", self._scaled(vectors, True), self.directions)
                  + self.offsets[:, None, :]) / W
        cells = np.floor(places)
        inside = places - cells
        nearest = np.argsort(np.concatenate([inside, 1 - inside], axis=2), axis=2)
        factors = np.broadcast_to(self.factors[:, None, :], inside.shape)
        moves = np.take_along_axis(np.concatenate([-factors, factors], axis=2), nearest, axis=2)
        own = (cells.astype(np.int64) * self.factors[:, None, :]).sum(axis=2)
        return own[:, :, None] + np.einsum("tqr,sr->tqs", moves, chosen)


def fit(sample: np.ndarray, longest: float, k: int) -> Index:
    rng = np.random.default_rng(SEED)
    d = sample.shape[1] + 1
    index = Index(rng.normal(size=(TABLES, d, KEYS)), rng.uniform(0, W, (TABLES, KEYS)),
                  rng.integers(1, 1 << 62, (TABLES, KEYS)) * 2 + 1, longest, PROBES[-1])
    asked = sample[:SAMPLE_QUERIES]
    scores = asked @ sample.T
    scores[np.arange(len(asked)), np.arange(len(asked))] = -np.inf
    nearest = np.argsort(-scores, axis=1)[:, :min(k, max(len(sample) - 1, 0))]
    held, visited = index.buckets(sample), index.visited(asked, PROBES[-1])
    for probes in PROBES:
        seen = np.zeros(scores.shape, bool)
        for t in range(TABLES):
            for i in range(len(asked)):
                seen[i] |= np.isin(held[t], visited[t, i, :probes])
        if not nearest.size or np.take_along_axis(seen, nearest, axis=1).mean() >= TARGET:
            return Index(index.directions, index.offsets, index.factors, longest, probes)
    return index


def _cell(buckets: np.ndarray, table: int, cells: int) -> np.ndarray:
    """The cell of a bucket: tables have cells of their own."""
    mixed = (buckets.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
    return (table * cells + mixed % np.uint64(cells)).astype(np.int64)


def _deal(index: Index, cells: int, as_query: bool):
    """Classes (id, ids, vec) to rows (cell, id, ids, vec, buckets), one per table for vectors, one
    per cell with visited buckets for queries."""
    names = ["cell", "id", "ids", "vec", "buckets"]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, QUERY_BATCH if as_query else 8192):
                batch = whole.slice(begin, QUERY_BATCH if as_query else 8192)
                vectors = matrix(batch.column(2))
                if as_query:
                    every = index.visited(vectors, index.probes)
                else:
                    every = index.buckets(vectors)[:, :, None]
                for table, buckets in enumerate(every):
                    row = np.repeat(np.arange(len(buckets)), buckets.shape[1])
                    cell, flat = _cell(buckets.ravel(), table, cells), buckets.ravel()
                    order = np.lexsort((cell, row))
                    row, cell, flat = row[order], cell[order], flat[order]
                    new = np.flatnonzero(np.r_[True, (row[1:] != row[:-1])
                                               | (cell[1:] != cell[:-1])])
                    taken = batch.take(pa.array(row[new]))
                    lists = pa.ListArray.from_arrays(
                        pa.array(np.r_[new, len(flat)], pa.int32()), pa.array(flat))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cell[new]), *taken.columns, lists], names)

    return deal


def _search(keep: int):
    """Vectors and then queries of each part of a cell, to each query's best rows there."""
    def results(vectors, members, held, rows):
        order = np.argsort(held, kind="stable")
        vectors, members = vectors[order], [members[i] for i in order]
        names, starts = np.unique(held[order], return_index=True)
        ends = np.r_[starts[1:], len(order)]
        length = np.linalg.norm(vectors, axis=1).max()
        for begin in range(0, len(rows), QUERY_BATCH):
            some = rows[begin:begin + QUERY_BATCH]
            asked = np.array([r[1] for r in some])
            sizes = [len(r[2]) for r in some]
            who, what = np.repeat(np.arange(len(some)), sizes), np.concatenate([r[2] for r in some])
            at = np.searchsorted(names, what)
            there = (at < len(names)) & (names[np.minimum(at, len(names) - 1)] == what)
            who, at = who[there], at[there]
            by = np.argsort(at, kind="stable")
            who, at = who[by], at[by]
            cuts = np.flatnonzero(np.r_[True, at[1:] != at[:-1], True]) if len(at) else []
            scores = np.full((len(some), len(vectors)), -np.inf)
            for a, b in zip(cuts[:-1], cuts[1:]):
                bucket = slice(starts[at[a]], ends[at[a]])
                scores[who[a:b], bucket] = asked[who[a:b]] @ vectors[bucket].T
            out = []
            for (query, vector, _), row in zip(some, scores):
                if len(row) > keep:
                    least = np.partition(row, len(row) - keep)[len(row) - keep]
                else:
                    least = -np.inf
                slack = 1e-12 * length * np.linalg.norm(vector)
                near = np.flatnonzero((row >= least - slack) & (row > -np.inf))
                exact = np.array([math.fsum((vectors[i] * vector).tolist()) for i in near])
                if len(near):
                    out.append((query, *best_rows(exact, [members[i] for i in near], keep)))
            if out:
                yield found_batch(out)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, members, vectors, ready = None, [], [], [], None
        for batch in batches:
            columns = dict(zip(batch.schema.names, batch.columns))
            cell, salt = (columns[c].to_numpy() for c in ("cell", "salt"))
            asks = columns["asks"].to_numpy(zero_copy_only=False)
            mat = matrix(columns["vec"])
            runs = np.flatnonzero(np.r_[True, (cell[1:] != cell[:-1]) | (salt[1:] != salt[:-1])
                                        | (asks[1:] != asks[:-1]), True])
            for a, b in zip(runs, runs[1:]):
                if (cell[a], salt[a]) != part:
                    part, held, members, vectors, ready = (cell[a], salt[a]), [], [], [], None
                lists = [columns["buckets"][i].values.to_numpy() for i in range(a, b)]
                if not asks[a]:
                    held += [x[0] for x in lists]
                    members += [columns["ids"][i].values.to_numpy() for i in range(a, b)]
                    vectors.append(mat[a:b].copy())
                elif vectors:
                    if ready is None:
                        ready = np.concatenate(vectors), members, np.array(held)
                    rows = list(zip(columns["id"].to_pylist()[a:b], mat[a:b], lists))
                    yield from results(*ready, rows)

    return search


def nearest(df: DataFrame, k: int = 20, every: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows of ``df`` (vec_id, embedding) whose id is
    divisible by ``every``: the ``k`` rows found with the largest inner products. Vectors of each
    length are searched on their own."""
    return by_length(valid_vectors(df, lambda x: x, zeros=False), every,
                     lambda rows: _nearest(rows, k, every))


def _nearest(rows: DataFrame, k: int, every: int) -> DataFrame:
    of = classes(rows, k + 1)
    asked = queries(rows, of, every)
    n, longest = of.agg(F.count("*"), F.max(F.sqrt(F.aggregate(
        "vec", F.lit(0.0), lambda a, x: a + x * x)))).first()
    share = min(1.0, SAMPLE_ROWS / max(n, 1))
    sample = of.where(F.pmod(F.xxhash64(F.lit("ann"), "id"), F.lit(1 << 30))
                      <= int(share * (1 << 30))).select("vec").collect()
    if not sample:
        return answers(asked, of.sparkSession.createDataFrame([], FOUND), k)
    index = fit(np.array([r.vec for r in sample]), longest, k)
    cells = -(-n // CELL_ROWS)
    schema = "cell long, id long, ids array<long>, vec array<double>, buckets array<long>"
    vectors = of.mapInArrow(_deal(index, cells, False), schema)
    unique = asked.select(F.col("query").alias("id")).distinct()
    probes = of.join(unique, "id").select("id", F.array().cast("array<bigint>").alias("ids"),
                                          "vec").mapInArrow(_deal(index, cells, True), schema)
    parts = vectors.groupBy("cell").agg(F.ceil(F.count("*") / (2 * CELL_ROWS)).alias("parts"))
    placed = vectors.join(parts, "cell").select(
        "cell", F.pmod(F.xxhash64("id"), F.col("parts")).alias("salt"), F.lit(False).alias("asks"),
        "id", "ids", "vec", "buckets")
    sent = probes.join(parts, "cell").select(
        "cell", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("salt"),
        F.lit(True).alias("asks"), "id", "ids", "vec", "buckets")
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = placed.unionAll(sent).repartition(tasks, "cell", "salt") \
        .sortWithinPartitions("cell", "salt", "asks").mapInArrow(_search(k + 1), FOUND)
    return answers(asked, merge(found, k + 1), k)
