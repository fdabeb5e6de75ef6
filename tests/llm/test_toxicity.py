"""Toxicity: held-out accuracy, what a score may depend on, odd rows."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from assay.llm import toxicity
from assay.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    labels = {r.doc_id: r.toxic for r in
              spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    rows = QUERIES["op6_toxicity"](spark, FOLDER).collect()
    assert len(rows) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    caught = [p for p, t in held if t == 1]
    wrong = [p for p, t in held if t == 0]
    # Toxic words of the smaller languages are too rare in this table to be learnt in full.
    assert len(caught) > 50 and np.mean(caught) >= 0.75
    assert np.mean(wrong) <= 0.01


def make(spark, n=600):
    rows = []
    for i in range(n):
        bad = i % 5 == 0
        rows.append((i, f"plain text number{i % 37} here " + ("vile " if bad else "") + "end",
                     int(bad)))
    docs = spark.createDataFrame([(i, t, "toxic") for i, t, _ in rows],
                                 "doc_id long, text string, toxic string")
    labels = spark.createDataFrame([(i, b) for i, _, b in rows if i % 2 == 0],
                                   "doc_id long, toxic int")
    return docs, labels


def test_held_out_labels_do_not_matter(spark):
    docs, labels = make(spark)
    turned = labels.withColumn("toxic", F.when(
        toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (toxicity.fit_toxicity(docs, x) for x in (labels, turned))
    assert np.array_equal(a.features, b.features) and np.array_equal(a.weights, b.weights)
    kept = toxicity.keep_clean(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i in range(600) if i % 5}


def test_odd_rows(spark):
    docs, labels = make(spark)
    odd = docs.unionAll(spark.createDataFrame(
        [(None, "vile"), (9_001, None), (9_002, ""), (9_003, "word " * 100_000 + "VILE!"),
         (9_004, "..."), (0, "same id"), (0, "same id")],
        "doc_id long, text string").withColumn("toxic", F.lit("x")))
    noise = labels.unionAll(spark.createDataFrame(
        [(None, 1), (3, None), (0, 0), (0, 1)], "doc_id long, toxic int"))
    scores = {(r.doc_id, (r.text or "")[:9]): r["__score"]
              for r in toxicity.score_docs(odd, noise).collect()}
    assert len(scores) == 606
    assert scores[None, "vile"] >= 0.3 and scores[9_003, "word word"] >= 0.3
    assert scores[9_001, ""] == scores[9_002, ""] == scores[9_004, "..."] < 0.3
    none = toxicity.score_docs(docs, labels.limit(0)).agg(F.max("__score")).first()[0]
    assert none == 0.0
    assert toxicity.score_docs(docs.limit(0), labels).count() == 0


def test_gradients_are_those_of_the_risk():
    rng = np.random.default_rng(3)
    prior, theta = 0.3, rng.normal(size=6)
    dense = [(rng.random((n, 5)) < 0.4).astype(float) for n in (7, 11)]
    weights = [rng.random(len(x)) for x in dense]
    weights = [w / w.sum() for w in weights]
    sets = [(*np.nonzero(x), len(x), w) for x, w in zip(dense, weights)]

    def parts(t):
        z_pos, z_unl = (x @ t[:-1] + t[-1] for x in dense)
        sure = [1 / (1 + np.exp(-z)) for z in (z_pos, z_unl)]
        return (weights[1] @ sure[1] - prior * (weights[0] @ sure[0]),
                prior * (weights[0] @ np.log1p(np.exp(-z_pos))))

    value, rest, positive = toxicity.gradients(theta, *sets, prior)
    assert np.isclose(value, parts(theta)[0])
    steps = [(parts(theta + h), parts(theta - h)) for h in np.eye(6) * 1e-6]
    for k, got in enumerate((rest, positive)):
        assert np.allclose(got, [(a[k] - b[k]) / 2e-6 for a, b in steps], atol=1e-8)


def test_frequencies_cover_all_rows(spark):
    rng = np.random.default_rng(5)
    words = [f"word{i}" for i in range(30)] + ["Vile!", "vile", "plain"]
    texts = [" ".join(rng.choice(words, 6)) for _ in range(400)] + [None, "", "vile " * 50_000]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(7)
    features = np.unique(np.concatenate([toxicity.text_features(w) for w in words[5:]]))
    got = toxicity.frequencies(docs, features)
    held = [set(toxicity.text_features(t).tolist()) for t in texts]
    assert got.tolist() == [sum(f in h for h in held) for f in features.tolist()]
    assert len(toxicity.frequencies(docs, features[:0])) == 0


def test_features_are_those_that_positives_hold_more_often():
    rng = np.random.default_rng(6)
    pos = [np.unique(np.r_[rng.integers(0, 400, 8), 1000 + np.flatnonzero(rng.random(3) < 0.6)])
           for _ in range(60)]
    found = toxicity.candidates(pos)
    kept = toxicity.originals(pos)
    assert found.docs == len(kept)
    assert dict(zip(found.features.tolist(), found.held.tolist())) == {
        f: n for f in {int(x) for d in kept for x in d}
        if (n := sum(f in d for d in kept)) >= toxicity.MIN_DOCS}
    counts = np.where(found.features >= 1000, 40, 100)
    assert toxicity.choose(found, counts, 5_000, 0.01).tolist() == [1000, 1001, 1002]


def test_a_repeated_id_does_not_fill_the_sample(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "MAX_POSITIVES", 100)
    monkeypatch.setattr(toxicity, "MAX_UNLABELLED", 200)
    docs, labels = make(spark)
    docs = docs.select("doc_id", "text").unionAll(spark.range(6_000).selectExpr(
        "10 AS doc_id", "concat('vile other text ', if(id % 2 = 0, '', string(id))) AS text"))
    n, rows = toxicity.samples(docs, labels.where("toxic = 1"))
    sizes = {r.pos: r["count"] for r in rows.groupBy("pos").count().collect()}
    # 3,000 of the rows are one row; it may be chosen once.
    assert n == 6_600 and 20 <= sizes[True] <= 100 and 60 <= sizes[False] <= 200
