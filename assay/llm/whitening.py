"""Whitening of vectors: pivoted Cholesky of the centred scatter, then one-sided Jacobi on the factor.

Vectors are put on an integer grid first, so that their sums and deviations are exact. Each task
adds up the moments of its rows (number, exact sums, and the scatter about its own mean) and moments
are merged pairwise, in two steps of a tree. One small matrix per vector length is then factored:
its rows, scaled back, are the components. Two more scans apply them: one that measures how far the
whitened covariance is from the identity, and one that returns the rows. Vectors are never shuffled.

Rows whose vector is null or holds a null, infinite or NaN entry are left out. All other rows come
out, repeated ones and null ids too. Vectors of each length are a fit of their own. A component whose
variance is zero (beyond rounding) cannot be scaled to one and is left out, so equal vectors, a single
vector, or vectors without entries give no rows, nor does an empty table. Entries whose grid number
would lie beyond 2^61 are set there. ``deviation`` is null where it does not fit a long. Components of
equal variance are numbered in the order in which the rotation left them; their sign is free. Columns
other than ``vec_id`` and ``embedding`` are not looked at, whatever they are called. There are no
texts.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, stage

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
LIMIT = 2 ** 61
FAN = 64                 # shares of each length's moments that are merged before the whole
HELD_BYTES = 64 << 20    # of moments in a task, or of fits sent with a scan
SWEEPS = 60
MOMENTS = "length int, moments binary"


@dataclass
class Moments:
    """Number, sums, and scatter about the mean of some vectors; sums are exact if integers."""

    n: int
    sums: list
    scatter: np.ndarray

    def pack(self) -> bytes:
        return pickle.dumps((self.n, self.sums, self.scatter))

    @staticmethod
    def of(x: np.ndarray) -> Moments:
        n = len(x)
        if x.dtype == np.int64:
            safe = np.abs(x).max(initial=0) * n < 2 ** 62 if n < 2 ** 31 else False
            sums = x.sum(axis=0).tolist() if safe else [sum(c) for c in x.T.tolist()]
        else:
            sums = x.sum(axis=0).tolist()
        away = centred(x, n, sums)
        return Moments(n, sums, away.T @ away)

    def __add__(self, other: Moments) -> Moments:
        n, m = self.n, other.n
        apart = np.array([(b * n - a * m) / (n * m) for a, b in zip(self.sums, other.sums)])
        return Moments(n + m, [a + b for a, b in zip(self.sums, other.sums)],
                       self.scatter + other.scatter + np.outer(apart, apart) * (n * m / (n + m)))


def centred(x: np.ndarray, n: int, sums: list) -> np.ndarray:
    """``x`` less sums / n; integers lose the whole part of it before they become doubles."""
    if x.dtype != np.int64:
        return x - np.array(sums) / n
    return (x - np.array([s // n for s in sums], np.int64)) - np.array([s % n / n for s in sums])


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """L with ``a`` = L L', its columns in the order of the pivots, greatest first; as many as the
    rank of ``a``. With the rows in that order too, L is lower triangular."""
    d = len(a)
    left = a.diagonal().copy()
    least = 16 * d * np.finfo(float).eps * left.max(initial=0)
    factor, open_rows = np.zeros((d, d)), np.ones(d, bool)
    for j in range(d):
        pivot = int(np.argmax(np.where(open_rows, left, -np.inf)))
        if not left[pivot] > least:
            return factor[:, :j]
        root = np.sqrt(left[pivot])
        column = (a[:, pivot] - factor[:, :j] @ factor[pivot, :j]) / root
        column[~open_rows], column[pivot] = 0, root
        open_rows[pivot] = False
        factor[:, j] = column
        left -= column ** 2
    return factor


def orthogonal_columns(factor: np.ndarray) -> np.ndarray:
    """The columns of ``factor``, rotated two by two until all are orthogonal. Each round rotates
    pairs that share no column, and a sweep is a tournament in which every pair meets once."""
    g = factor.T.copy()
    r = len(g)
    near = max(factor.shape, default=1) * np.finfo(float).eps
    for _ in range(SWEEPS if r > 1 else 0):
        seats, worst = np.arange(r + r % 2), 0.0
        for _ in range(len(seats) - 1):
            a, b = seats[:len(seats) // 2], seats[len(seats) // 2:][::-1]
            real = (a < r) & (b < r)
            a, b = a[real], b[real]
            x, y = g[a], g[b]
            xx, yy, xy = (np.einsum("ij,ij->i", *p) for p in ((x, x), (y, y), (x, y)))
            angle = np.abs(xy) / np.sqrt(xx * yy)
            worst = max(worst, angle.max())
            turn = angle > near
            a, b, x, y, xx, yy, xy = (v[turn] for v in (a, b, x, y, xx, yy, xy))
            zeta = (yy - xx) / (2 * xy)
            tangent = np.copysign(1, zeta) / (np.abs(zeta) + np.hypot(1, zeta))
            cos = (1 / np.hypot(1, tangent))[:, None]
            sin = cos * tangent[:, None]
            g[a], g[b] = cos * x - sin * y, sin * x + cos * y
            seats = np.r_[seats[0], seats[-1], seats[1:-1]]
        if worst <= near:
            return g.T
    if r > 1:
        raise ArithmeticError(f"the rotations did not settle in {SWEEPS} sweeps")
    return g.T


@dataclass
class Fit:
    """``components`` has a column per component, of variance ``variances``."""

    n: int
    sums: list
    components: np.ndarray
    variances: np.ndarray
    explained: np.ndarray
    identity_error: float = float("nan")

    def pack(self) -> bytes:
        return pickle.dumps((self.n, self.sums, self.components, self.variances, self.explained))

    @staticmethod
    def of(m: Moments, components: int) -> Fit:
        columns = orthogonal_columns(pivoted_cholesky(m.scatter))
        squares = (columns ** 2).sum(axis=0)
        first = np.argsort(-squares, kind="stable")[:components]
        trace = m.scatter.trace()
        return Fit(m.n, m.sums, columns[:, first] / np.sqrt(squares[first]),
                   squares[first] / m.n, squares[first] / trace if trace else squares[first])

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return centred(x, self.n, self.sums) @ self.components / np.sqrt(self.variances)

    def deviations(self, x: np.ndarray) -> np.ma.MaskedArray:
        """The sum of (n * x - sums)^2 for each row, exactly; masked where it is too large."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([s % self.n for s in self.sums], np.int64)
        away = x - whole
        reach = (float(np.abs(away).max(initial=0)) + 1) * self.n
        if reach * reach * max(x.shape[1], 1) < 2 ** 62:
            return np.ma.array(((away * self.n - rest) ** 2).sum(axis=1), mask=False)
        exact = [sum((a * self.n - r) ** 2 for a, r in zip(row, rest.tolist()))
                 for row in away.tolist()]
        return np.ma.array([v if v < 2 ** 63 else 0 for v in exact], np.int64,
                           mask=[v >= 2 ** 63 for v in exact])


def whole_vectors(df: DataFrame) -> DataFrame:
    """(vec_id, embedding as doubles) of the rows whose vector is there, whole and finite."""
    real = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.select(F.col("vec_id").cast("bigint").alias("vec_id"),
                     F.col("embedding").cast("array<double>").alias("embedding")).where(
        F.col("embedding").isNotNull() & real)


def _grids(batch: pa.RecordBatch, scale: int, offset: int
           ) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per length of vector: the length, the rows that have it, and their numbers on the grid."""
    lists = batch.column(batch.schema.get_field_index("embedding"))
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    starts = np.cumsum(lengths) - lengths
    for length in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == length)
        values = flat[starts[rows][:, None] + np.arange(length)]
        with np.errstate(over="ignore"):
            x = np.clip(np.floor(values * scale), -float(LIMIT), float(LIMIT))
        yield length, rows, x.astype(np.int64) + offset


def _state(length: list[int], moments: list[Moments]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(length, pa.int32()), pa.array([m.pack() for m in moments], pa.binary())],
        ["length", "moments"])


def _summed(df: DataFrame, vectors: Callable[[int, np.ndarray], np.ndarray | None], scale: int,
            offset: int) -> DataFrame:
    """(length, moments) of what ``vectors`` makes of each length's grid numbers: a row per task
    and length, or several where a task meets more lengths than it may hold."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Moments] = {}
        size = 0
        for batch in batches:
            for length, _, x in _grids(batch, scale, offset):
                if (x := vectors(length, x)) is None:
                    continue
                new = Moments.of(x)
                if length in held:
                    held[length] += new
                    continue
                held[length] = new
                size += new.scatter.nbytes
                if size > HELD_BYTES:
                    for key in list(held):
                        yield _state([key], [held.pop(key)])
                    size = 0
        for key in list(held):
            yield _state([key], [held.pop(key)])

    return df.mapInArrow(add, MOMENTS)


def _merged(parts: DataFrame, finish: Callable[[Moments], bytes]) -> DataFrame:
    """(length, moments) with one row per length: ``finish`` of all its moments together."""
    def merge(last: bool) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            length, total = None, None
            done = finish if last else (lambda m: m.pack())

            def out() -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays(
                    [pa.array([length], pa.int32()), pa.array([done(total)], pa.binary())],
                    ["length", "moments"])

            for batch in batches:
                for key, state in zip(batch.column(0).to_pylist(), batch.column(1)):
                    new = Moments(*pickle.loads(state.as_buffer()))
                    if key != length:
                        if total is not None:
                            yield out()
                        length, total = key, new
                    else:
                        total = total + new
            if total is not None:
                yield out()
        return run

    dealt = parts.withColumn("deal", F.spark_partition_id() % FAN)
    some = (dealt.repartition("length", "deal").sortWithinPartitions("length", "deal")
            .select("length", "moments").mapInArrow(merge(False), MOMENTS))
    return some.repartition("length").sortWithinPartitions("length").mapInArrow(
        merge(True), MOMENTS)


def fit_whitening(df: DataFrame, components: int = COMPONENTS, scale: int = SCALE,
                  offset: int = OFFSET) -> DataFrame:
    """(length, moments) with a pickled ``Fit`` per vector length, written to the shared folder, so
    that every later scan uses the same one. It is fitted on all rows."""
    small_batches(df.sparkSession)
    parts = _summed(whole_vectors(df), lambda _, x: x if x.shape[1] else None, scale, offset)
    return stage(_merged(parts, lambda m: Fit.of(m, components).pack()), "whitening")


def _groups(fits: DataFrame) -> Iterator[dict[int, Fit]]:
    """The fits, a bounded number of bytes at a time, in the order of their lengths."""
    sizes = fits.select("length", F.octet_length("moments").alias("size")).orderBy("length")
    group: list[int] = []
    held = 0
    cuts = []
    for row in sizes.toLocalIterator():
        if group and held + row["size"] > HELD_BYTES:
            cuts.append(group)
            group, held = [], 0
        group, held = [*group[:1], row["length"]], held + row["size"]
    if group:
        cuts.append(group)
    for cut in cuts:
        rows = fits.where(F.col("length").between(cut[0], cut[-1])).collect()
        yield {r["length"]: Fit(*pickle.loads(r["moments"])) for r in rows}


def whiten(df: DataFrame, components: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET
           ) -> DataFrame:
    """A row per remaining vector of ``df`` (vec_id, embedding) and component: (vec_id, component
    from 1, n, deviation, whitened, explained, identity_error).

    Fits go with the scans, at most HELD_BYTES of them with one; if vectors have so many lengths
    that there are more, the table is read once for each group of lengths.
    """
    vectors = whole_vectors(df)
    found = None
    for fits in _groups(fit_whitening(df, components, scale, offset)):
        fits = {length: fit for length, fit in fits.items() if len(fit.variances)}
        if not fits:
            continue
        rows = vectors.where(F.size("embedding").between(min(fits), max(fits)))
        part = _applied(rows, _measured(rows, fits, scale, offset), scale, offset)
        found = part if found is None else found.unionAll(part)
    return _applied(vectors.limit(0), {}, scale, offset) if found is None else found


def _measured(rows: DataFrame, fits: dict[int, Fit], scale: int, offset: int) -> dict[int, Fit]:
    """The fits with the largest entry of the whitened covariance less the identity."""
    def whitened(length: int, x: np.ndarray) -> np.ndarray | None:
        return fits[length].whiten(x) if length in fits else None

    def error(m: Moments) -> bytes:
        return pickle.dumps(float(np.abs(m.scatter / m.n - np.eye(len(m.scatter))).max()))

    errors = _merged(_summed(rows, whitened, scale, offset), error)
    for row in errors.collect():  # a number per length
        fits[row["length"]].identity_error = pickle.loads(row["moments"])
    return fits


def _applied(rows: DataFrame, fits: dict[int, Fit], scale: int, offset: int) -> DataFrame:
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("vec_id"))
            for length, at, x in _grids(batch, scale, offset):
                if length not in fits:
                    continue
                fit = fits[length]
                k, m = len(fit.variances), len(x)
                each = pa.array(np.repeat(np.arange(m), k))
                away = fit.deviations(x)
                yield pa.RecordBatch.from_arrays([
                    ids.take(pa.array(at)).take(each),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, fit.n, np.int64)),
                    pa.array(away.data, mask=np.ma.getmaskarray(away)).take(each),
                    pa.array(fit.whiten(x).ravel()), pa.array(np.tile(fit.explained, m)),
                    pa.array(np.full(m * k, fit.identity_error))], names)

    return rows.mapInArrow(apply, "vec_id long, component int, n long, deviation long, "
                                  "whitened double, explained double, identity_error double")
