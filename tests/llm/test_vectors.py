"""Vector searches against brute force over all rows."""

import math

import numpy as np
import pytest

from assay.llm.ann import nearest, perturbations
from assay.llm.queries import QUERIES
from assay.llm.topk import WIDEST, block_best, top_products

FOLDER = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, label int, id string, score double"


def brute(rows, change, zeros, k=20):
    """{query id: [(vec_id, score), ...]} and whether a vector takes part."""
    good = {(i, tuple(change(float(x)) for x in v)) for i, v in rows
            if i is not None and v is not None
            and all(x is not None and math.isfinite(x) for x in v) and (zeros or any(v))}
    good = sorted(g for g in good if g[1])
    out = {}
    for i, q in good:
        if i % 20 == 0:
            scored = [(-math.fsum(a * b for a, b in zip(q, v)), j) for j, v in good
                      if j != i and len(v) == len(q)]
            if scored:
                out[i] = [(j, -s) for s, j in sorted(scored)[:k]]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def odd_rows():
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(300)]
    rows += [(i, [1.0, 2.0, 0.0, 0.0, 0.5, 0.0, 0.0, -1.0]) for i in range(300, 380)]
    rows += [(400, None), (420, [math.nan] * 8), (440, [None] + [1.0] * 7), (460, [0.0] * 8),
             (461, [0.0] * 8), (480, [math.inf] + [1.0] * 7), (500, [1.0, 2.0]), (None, [1.0] * 8),
             (20, rows[20][1]), (520, [-0.0] * 8)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 0.5) for i, v in rows], SCHEMA)


def test_products_are_exact(spark):
    rows = odd_rows()
    got = found(top_products(frame(spark, rows)))
    assert got == brute(rows, lambda x: math.floor(64 * x), zeros=True)
    assert top_products(frame(spark, rows).limit(0)).count() == 0
    alone = frame(spark, [(20, [1.0, 2.0])])
    assert top_products(alone).count() == 0


def test_each_length_is_a_search_of_its_own(spark):
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=(8, 3, 5)[i % 3]).astype(np.float32).tolist()) for i in range(240)]
    rows += [(1000, [1.0] * 7), (1001, [2.0] * 9), (1020, []), (1021, [])]
    assert found(top_products(frame(spark, rows))) == brute(
        rows, lambda x: math.floor(64 * x), zeros=True)
    want, got = brute(rows, float, zeros=False), found(nearest(frame(spark, rows)))
    assert set(got) == set(want) and {len(v) for v in want.values()} == {20}
    hits = sum(len(set(got[q]) & set(want[q])) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))


@pytest.mark.parametrize("most", [4, 7, 9, 37])
def test_products_of_long_vectors_are_exact(spark, most):
    """Lengths that multiply to over 2^53, 2^62 and 2^63, mixed with short ones."""
    rng = np.random.default_rng(most)
    rows = [(i, (rng.normal(size=6) * 10.0 ** rng.uniform(0, most)).astype(np.float32).tolist())
            for i in range(200)]
    rows += [(i, rows[i - 200][1]) for i in range(200, 230)]
    rows += [(300, [3e38 if most > 9 else 1.0] * 6), (301, [0.0] * 6)]
    whole = [(i, [math.floor(64 * x) for x in v]) for i, v in rows]
    want = {}
    for i, q in whole:
        if i % 20 == 0:
            scores = [(max(-WIDEST, min(WIDEST, sum(a * b for a, b in zip(q, v)))), j)
                      for j, v in whole if j != i]
            want[i] = [(j, s) for s, j in sorted(scores, key=lambda x: (-x[0], x[1]))[:20]]
    assert found(top_products(frame(spark, rows))) == want


def test_lengths_prune_nothing_that_counts():
    rng = np.random.default_rng(7)
    items = np.floor(rng.normal(size=(5_000, 12)) * rng.pareto(1, (5_000, 1)) * 20)
    items = items[np.argsort(-(items ** 2).sum(axis=1))]
    asked = np.floor(rng.normal(size=(40, 12)) * 50)
    rotation = np.linalg.eigh(items.T @ items)[1][:, ::-1]
    query, item, score = block_best(asked, np.full(40, -np.inf), items, rotation, 21)
    for i, scores in enumerate(asked @ items.T):
        want = np.sort(scores)[-21:]
        assert np.array_equal(np.sort(score[query == i])[-21:], want)
        assert set(np.flatnonzero(scores >= want[0])) == set(item[query == i])


def test_nearest_on_odd_rows(spark):
    rows = odd_rows()
    want, got = brute(rows, float, zeros=False), found(nearest(frame(spark, rows)))
    assert set(got) == set(want)
    hits = sum(len(set(got[q]) & set(want[q])) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    exact = {q: {j: s for j, s in all_} for q, all_ in brute(rows, float, False, 10**6).items()}
    assert all(exact[q][j] == s for q in got for j, s in got[q])
    assert got[300] == want[300]  # its copies, smallest ids first
    assert nearest(frame(spark, rows).limit(0)).count() == 0
    assert nearest(frame(spark, [(20, [1.0, 2.0])])).count() == 0


def test_recall_and_order(spark):
    rows = [(r.vec_id, r.embedding) for r in
            spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()]
    want, got = brute(rows, float, zeros=False), found(QUERIES["op1_nearest"](spark, FOLDER))
    hits = sum(len(set(got[q]) & set(want[q])) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    assert all(got[q] == sorted(got[q], key=lambda x: (-x[1], x[0])) for q in got)


def test_perturbations_come_in_order():
    sets = perturbations(3, 30)
    assert sets[:3] == [(), (1,), (2,)] and len(sets) == len(set(sets)) == 27
    assert all(7 - r not in s for s in sets for r in s)
