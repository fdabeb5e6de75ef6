"""Whitening against numpy over all rows at once."""

import math

import numpy as np
import pytest

from assay.llm import whitening as w
from assay.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, n string, whitened int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA)


def brute(vectors, k=32):
    """(grid numbers, sums, covariance, eigenvalues falling, eigenvectors)."""
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for v in vectors]
    sums = [sum(c) for c in zip(*x)]
    away = np.array([[a - s / len(x) for a, s in zip(row, sums)] for row in x])
    cov = away.T @ away / len(x)
    values, axes = np.linalg.eigh(cov)
    return x, sums, cov, away, values[::-1][:k], axes[:, ::-1][:, :k]


def check(rows, vectors, k=32):
    x, sums, cov, away, values, axes = brute(vectors, k)
    n = len(x)
    assert len(rows) == n * len(values)
    by = {}
    for r in rows:
        by.setdefault((r.vec_id, r.component), []).append(r)
    assert {c for _, c in by} == set(range(1, len(values) + 1))
    want = away @ axes / np.sqrt(values)
    for c in range(len(values)):
        got = np.array([by[i, c + 1][0].whitened for i in range(n)])
        sign = np.sign(got @ want[:, c])
        assert np.allclose(got * sign, want[:, c], rtol=1e-7, atol=1e-7)
        assert by[0, c + 1][0].explained == pytest.approx(values[c] / cov.trace(), rel=1e-9)
    for i in range(n):
        exact = sum((n * a - s) ** 2 for a, s in zip(x[i], sums))
        assert by[i, 1][0].deviation == exact and by[i, 1][0].n == n
    assert len({r.identity_error for r in rows}) == 1 and rows[0].identity_error < 1e-9


def test_query_matches_numpy(spark):
    table = spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()
    ids = {r.vec_id: i for i, r in enumerate(table)}
    df = QUERIES["op11_whitening"](spark, FOLDER)
    assert dict(df.dtypes) == {
        "vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint",
        "whitened": "double", "explained": "double", "identity_error": "double"}
    back = spark.createDataFrame(list(ids.items()), "vec_id long, i long")
    rows = df.join(back, "vec_id").drop("vec_id").withColumnRenamed("i", "vec_id").collect()
    check(rows, [r.embedding for r in table])


def test_odd_rows(spark):
    rng = np.random.default_rng(3)
    good = [[*map(float, row), float(row[0] * 2), 5.0] for row in rng.integers(-9, 9, (60, 4))]
    rows = list(enumerate(good))
    rows += [(90, None), (91, [math.nan] * 6), (92, [None] + [1.0] * 5), (93, [math.inf] * 6),
             (94, [])]
    other = rng.normal(size=(40, 3)).tolist()
    short = [(200 + i, v) for i, v in enumerate(other)]
    got = w.whiten(frame(spark, rows + short)).collect()
    # Six dimensions, of which one repeats another and one is constant: four components.
    long = [r for r in got if r.vec_id < 100]
    assert len(long) == 60 * 4 and all(r.n == 60 for r in long)
    assert {r.component for r in long} == {1, 2, 3, 4}
    assert sum({r.component: r.explained for r in long}.values()) == pytest.approx(1, rel=1e-12)
    assert long[0].identity_error < 1e-9
    values = np.array([[r.whitened for r in sorted(long, key=lambda r: r.vec_id)
                        if r.component == c] for c in (1, 2, 3, 4)])
    assert np.allclose(values @ values.T / 60, np.eye(4), atol=1e-9)
    three = [r for r in got if r.vec_id >= 200]
    check([type("R", (), {**r.asDict(), "vec_id": r.vec_id - 200}) for r in three], other)


def test_repeats_nulls_and_empty(spark):
    same = [(1, [1.0, 2.0])] * 5
    assert w.whiten(frame(spark, same)).count() == 0
    assert w.whiten(frame(spark, same[:1])).count() == 0
    assert w.whiten(frame(spark, same).limit(0)).count() == 0
    got = w.whiten(frame(spark, [*same, (None, [3.0, 0.0]), (7, [0.0, 1.0])])).collect()
    assert sorted(str(r.vec_id) for r in got) == sorted(["1"] * 10 + ["None"] * 2 + ["7"] * 2)
    assert all(r.n == 7 for r in got)


def test_huge_entries(spark):
    got = w.whiten(frame(spark, [(1, [3e38, 1.0]), (2, [0.0, 2.0]), (3, [1.0, 4.0])])).collect()
    assert len(got) >= 3 and all(r.deviation is None for r in got)
    far = w.whiten(frame(spark, [(1, [1e6, 1.0]), (2, [0.0, 2.0]), (3, [1.0, 4.0])])).collect()
    x = [[64_000_000, 64], [0, 128], [64, 256]]
    sums = [sum(c) for c in zip(*x)]
    assert {r.vec_id: r.deviation for r in far} == {
        i + 1: sum((3 * a - s) ** 2 for a, s in zip(row, sums)) for i, row in enumerate(x)}


def test_many_lengths_and_many_parts(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=2 + i % 5).tolist()) for i in range(200)]
    df = frame(spark, rows).repartition(11)
    once = {(r.vec_id, r.component): r for r in w.whiten(df).collect()}
    monkeypatch.setattr(w, "HELD_BYTES", 300)
    again = {(r.vec_id, r.component): r for r in w.whiten(df).collect()}
    assert len(once) == sum(40 * d for d in range(2, 7)) and set(once) == set(again)
    assert all(abs(once[k].whitened) == pytest.approx(abs(again[k].whitened), abs=1e-9)
               and once[k].deviation == again[k].deviation for k in once)


def test_factor_and_rotations():
    rng = np.random.default_rng(1)
    a = rng.normal(size=(40, 9)) * 10.0 ** -np.arange(9)
    a = np.c_[a, a[:, :3]]
    scatter = a.T @ a
    factor = w.pivoted_cholesky(scatter)
    assert np.allclose(factor @ factor.T, scatter, rtol=1e-12, atol=1e-12)
    turned = w.orthogonal_columns(w.pivoted_cholesky(scatter[:5, :5]))
    assert np.allclose(np.sort((turned ** 2).sum(axis=0)),
                       np.linalg.eigvalsh(scatter[:5, :5]), rtol=1e-6)
