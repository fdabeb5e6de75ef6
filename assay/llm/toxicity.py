"""Toxicity scores from non-negative positive-unlabelled learning.

The positives are documents confirmed toxic; the unlabelled set is drawn from all documents open to
training, whatever their labels, so toxic ones are in it at the class prior. The prior is the share
of toxic rows among all labelled rows open to training. Words and their beginnings are features; the
corrected rate of a feature among clean documents is (unlabelled rate - prior * positive rate) /
(1 - prior), at least zero, and only features that positives hold far more often, and more often than
chance can explain, take part; near copies of a positive count once. Linear
numpy classifiers are then trained on the risk

    prior * E_pos[loss+] + max(0, E_unl[loss-] - prior * E_pos[loss-])

and where the second part turns negative, a step goes against it (Kiryo et al., 2017). loss- is the
sigmoid loss, so a sure positive cannot outweigh the unlabelled part; loss+ is logistic, so no
confirmed document is given up.

Features are chosen by how many of all open documents hold them. Only the gradient steps read
bounded samples, about MAX_POSITIVES and MAX_UNLABELLED different rows chosen by a hash of id and
text, so that an id or a row that very many rows repeat does not fill them. The prior and the scores
cover all rows. Neither labels nor any column but ``text`` enters a score.

Null and empty texts get the score of a text without features; long texts count whole. Without toxic
labels, as with an empty table of labels, every score is 0; an empty table of documents has no rows.
Labels that contradict each other count as toxic; null ids and labels teach nothing, and rows with a
null id are scored like others. Repeated rows score alike. Features of equal surprise are taken by
their hashes. Other columns stay as they are, whatever they are called, but for ``__score``.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches, stage

MAX_POSITIVES = 4_000
MAX_UNLABELLED = 8_000
MAX_FEATURES = 4_096
MIN_DOCS = 3       # positives that hold a feature
PSEUDO = 3.0       # unlabelled documents added to those that hold a feature
CHANCE = 1.0       # features that may pass by chance, of all that are tried
MIN_RATIO = 3.0    # of the positive rate to the corrected clean rate
RARE = 0.02        # share of documents that a rare feature may be in
ODD = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93,
       0xA0761D6478BD642F, 0xE7037ED1A0B428DB)  # multipliers of the hashes
CLASSIFIERS = 3
STEPS = 400
RATE = 0.1
DECAY = 1e-6
THRESHOLD = 0.3
CACHE = 1 << 18

_EDGES = re.compile(r"^\W+|\W+$")


def word_features(word: str) -> list[int]:
    """Hashes of a word, without marks at its ends, and of its first letters."""
    word = _EDGES.sub("", word.lower())
    parts = [word, *[f"{word[:n]}*" for n in (4, 5, 6) if len(word) >= n]] if word else []
    return [xxhash.xxh64_intdigest(p) - (1 << 63) for p in parts]


def text_features(text: str | None) -> np.ndarray:
    return np.array(sorted({f for w in set((text or "").split()) for f in word_features(w)}),
                    dtype=np.int64)


@dataclass(frozen=True)
class Model:
    """Feature hashes, and for each classifier their weights and a bias; none: always 0."""

    features: np.ndarray
    weights: np.ndarray
    biases: np.ndarray


class _Known(dict):
    """Words to their places in the model's features, found when a word is first met."""

    def __init__(self, model: Model):
        self.places = {int(f): i for i, f in enumerate(model.features)}

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= CACHE:
            self.clear()
        found = tuple(i for f in word_features(word) if (i := self.places.get(f)) is not None)
        self[word] = found
        return found


def score_text(text: str | None, model: Model, known: dict) -> float:
    if not len(model.biases):
        return 0.0
    at = sorted({i for w in set((text or "").split()) for i in known[w]})
    logits = model.biases + model.weights[:, at].sum(axis=1)
    return float(np.mean(1 / (1 + np.exp(-np.clip(logits, -40, 40)))))


def score(text: Column, model: Model) -> Column:
    known = _Known(model)

    @F.arrow_udf("double")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array([score_text(t.as_py(), model, known) for t in texts], pa.float64())

    return of(text)


def originals(docs: list[np.ndarray]) -> list[np.ndarray]:
    """``docs`` without near copies of earlier ones, which would make a chance word look frequent:
    those that have the smallest rare feature under two of the hashes in common with one."""
    ids, counts = np.unique(np.concatenate([np.empty(0, np.int64), *docs]), return_counts=True)
    rare = ids[counts <= max(2, RARE * len(docs))]
    seen: dict[tuple[int, int], list[int]] = {}
    kept = []
    for i, doc in enumerate(docs):
        own = doc[np.isin(doc, rare, assume_unique=True)].view(np.uint64)
        marks = [(k, int((own * np.uint64(odd)).min())) for k, odd in enumerate(ODD)] \
            if len(own) else []
        shared = Counter(chain.from_iterable(seen.get(m, []) for m in marks))
        if max(shared.values(), default=0) < 2:
            kept.append(doc)
            for mark in marks:
                seen.setdefault(mark, []).append(i)
    return kept


@dataclass(frozen=True)
class Candidates:
    """Features that enough positives hold, how many of ``docs`` positives hold each, and how many
    features there are in all."""

    features: np.ndarray
    held: np.ndarray
    docs: int
    tried: int


def candidates(pos: list[np.ndarray]) -> Candidates:
    pos = originals(pos)
    ids, held = np.unique(np.concatenate(pos), return_counts=True)
    often = held >= MIN_DOCS
    return Candidates(ids[often], held[often], len(pos), max(len(ids), 1))


def choose(found: Candidates, n_unl: np.ndarray, docs: int, prior: float) -> np.ndarray:
    """The features to train on. ``n_unl`` of all ``docs`` unlabelled documents hold each."""
    ids, n_pos = found.features, found.held
    rate_pos, rate_unl = n_pos / found.docs, (n_unl + PSEUDO) / (docs + PSEUDO)
    expected = rate_unl * found.docs
    # Chernoff's bound on the chance that a feature as common as among unlabelled documents is in
    # so many positives, as a negative logarithm.
    surprise = np.where(n_pos > expected, n_pos * np.log(n_pos / expected) - n_pos + expected, 0)
    clean = np.maximum(rate_unl - prior * rate_pos, 0) / max(1 - prior, 1e-9)
    good = (surprise >= np.log(found.tried / CHANCE)) \
        & (rate_pos >= MIN_RATIO * (clean + 1 / (docs + 1)))
    order = np.lexsort((ids, -surprise))
    return np.sort(ids[order[good[order]][:MAX_FEATURES]])


def _rows(docs: list[np.ndarray], features: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Row and column of each of the sorted ``features`` that a document holds, and the number of
    documents."""
    columns = [np.empty(0, np.int64)]
    for doc in docs:
        at = np.minimum(np.searchsorted(features, doc), max(len(features) - 1, 0))
        columns.append(at[features[at] == doc] if len(features) else columns[0])
    row = np.repeat(np.arange(len(docs)), [len(c) for c in columns[1:]])
    return row, np.concatenate(columns), len(docs)


def gradients(theta: np.ndarray, pos: tuple, unl: tuple, prior: float
              ) -> tuple[float, np.ndarray, np.ndarray]:
    """The unlabelled part of the risk, E_unl[loss-] - prior * E_pos[loss-], its gradient, and that
    of the positive part, prior * E_pos[loss+]. ``theta`` are the weights, then the bias; a set is
    (row, column, number of rows, weight of each row)."""
    def chance(part: tuple) -> np.ndarray:  # also the loss against 0
        row, col, n, _ = part
        return 1 / (1 + np.exp(-np.clip(theta[-1] + np.bincount(row, theta[col], n), -40, 40)))

    def gradient(part: tuple, slope: np.ndarray) -> np.ndarray:
        return np.r_[np.bincount(part[1], slope[part[0]], len(theta) - 1), slope.sum()]

    (p_pos, w_pos), (p_unl, w_unl) = ((chance(s), s[3]) for s in (pos, unl))
    rest = gradient(unl, w_unl * p_unl * (1 - p_unl)) \
        - prior * gradient(pos, w_pos * p_pos * (1 - p_pos))
    return w_unl @ p_unl - prior * (w_pos @ p_pos), rest, prior * gradient(pos, w_pos * (p_pos - 1))


def train(pos: tuple, unl: tuple, width: int, prior: float, seed: int) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear classifier by Adam on the non-negative risk; each classifier
    sees its own resampling of both sets."""
    rng = np.random.default_rng(seed)
    sets = []
    for row, col, n in (pos, unl):
        times = np.bincount(rng.integers(0, n, n), minlength=n).astype(float)
        sets.append((row, col, n, times / times.sum()))
    theta = np.zeros(width + 1)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        value, rest, positive = gradients(theta, *sets, prior)
        grad = positive + rest if value >= 0 else -rest
        grad[:-1] += DECAY * theta[:-1]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        theta -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return theta[:-1], float(theta[-1])


def fit(pos: list[np.ndarray], unl: list[np.ndarray], features: np.ndarray, prior: float) -> Model:
    parts = _rows(originals(pos), features), _rows(unl, features)
    trained = [train(*parts, len(features), prior, seed) for seed in range(CLASSIFIERS)]
    return Model(features, np.array([w for w, _ in trained]), np.array([b for _, b in trained]))


def held_out(doc_id: Column) -> Column:
    """Whether a document's label is kept from training."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def _sampled(df: DataFrame, n: int, most: int, *key: str) -> DataFrame:
    """About ``most`` of the ``n`` rows, or fewer, by a hash of ``key``."""
    share = min(1.0, most / max(n, 1))
    return df.where(F.pmod(F.xxhash64(F.lit("toxicity"), *key), F.lit(1 << 30))
                    <= int(share * (1 << 30)))


def samples(open_docs: DataFrame, toxic: DataFrame) -> tuple[int, DataFrame]:
    """The number of rows of ``open_docs`` (doc_id, text), and (pos, text) of the rows to train on.
    Copies of a row are dropped after the choice, so that they cannot exceed the bounds."""
    # At most about MAX_POSITIVES ids of eight bytes, so the broadcast has a fixed bound.
    chosen = F.broadcast(_sampled(toxic, toxic.count(), MAX_POSITIVES, "doc_id")
                         .select("doc_id", F.lit(True).alias("pos")))
    n, n_pos = open_docs.join(chosen, "doc_id", "left").agg(F.count("*"), F.count("pos")).first()
    unlabelled = open_docs.withColumn("pos", F.lit(False))
    return n, reduce(DataFrame.unionAll, [
        _sampled(rows, size, most, "doc_id", "text").select("doc_id", "pos", "text")
        .dropDuplicates() for rows, size, most in
        [(open_docs.join(chosen, "doc_id"), n_pos, MAX_POSITIVES),
         (unlabelled, n, MAX_UNLABELLED)]]).select("pos", "text")


def frequencies(docs: DataFrame, features: np.ndarray) -> np.ndarray:
    """How many rows of ``docs`` hold each of ``features`` in their ``text``. A task adds its rows
    up before anything is shuffled."""
    model = Model(features, np.empty((0, 0)), np.empty(0))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, held = _Known(model), np.zeros(len(features), np.int64)
        for batch in batches:
            for text in batch.column(0):
                at = {i for w in set((text.as_py() or "").split()) for i in known[w]}
                held[np.fromiter(at, np.int64, len(at))] += 1
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(held[some])], ["at", "n"])

    total = np.zeros(len(features), np.int64)
    if len(features):
        # One row per feature, of which the sample of positives holds a bounded number.
        for row in docs.select("text").mapInArrow(count, "at long, n long").groupBy("at").agg(
                F.sum("n").alias("n")).collect():
            total[row["at"]] = row["n"]
    return total


def fit_toxicity(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from the rows of ``labels`` (doc_id, toxic) that are open to training."""
    small_batches(docs.sparkSession)
    empty = Model(np.empty(0, np.int64), np.empty((0, 0)), np.empty(0))
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(
        F.max("toxic").alias("toxic")).where(~held_out(F.col("doc_id")))
    n, toxic = known.agg(F.count("*"), F.sum((F.col("toxic") == 1).cast("long"))).first()
    if not toxic:
        return empty
    prior = toxic / n
    open_docs = docs.where("doc_id IS NOT NULL").where(~held_out(F.col("doc_id"))) \
                    .select("doc_id", "text")
    n_docs, rows = samples(open_docs, known.where("toxic = 1"))

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [text_features(t.as_py()).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())],
                                             ["pos", "ids"])

    def sides(batches: Iterator[pa.RecordBatch]) -> dict[bool, list[np.ndarray]]:
        held: dict[bool, list[bytes]] = {True: [], False: []}
        for batch in batches:
            for is_pos, ids in zip(batch.column(0).to_pylist(), batch.column(1)):
                held[is_pos].append(ids.as_py())
        # In an order that does not depend on which part came first.
        return {k: [np.frombuffer(x, np.int64) for x in sorted(v)] for k, v in held.items()}

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if pos := sides(batches)[True]:
            found = candidates(pos)
            yield pa.RecordBatch.from_arrays(
                [pa.array([x]) for x in (found.features.tobytes(), found.held.tobytes(),
                                         found.docs, found.tried)],
                ["features", "held", "docs", "tried"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = sides(batches)
        if held[True] and held[False]:
            model = fit(held[True], held[False], features, prior)
            yield pa.RecordBatch.from_arrays(
                [pa.array([x.tobytes()], pa.binary()) for x in (model.weights, model.biases)],
                ["weights", "biases"])

    # The sample is bounded, so one task may hold it.
    sample = stage(rows.mapInArrow(featurise, "pos boolean, ids binary"), "toxicity-sample")
    row = sample.where("pos").repartition(1).mapInArrow(
        look, "features binary, held binary, docs long, tried long").first()
    if row is None:
        return empty
    found = Candidates(np.frombuffer(row.features, np.int64), np.frombuffer(row.held, np.int64),
                       row.docs, row.tried)
    features = choose(found, frequencies(open_docs, found.features), n_docs, prior)
    row = sample.repartition(1).mapInArrow(learn, "weights binary, biases binary").first()
    if row is None:
        return empty
    biases = np.frombuffer(row.biases)
    return Model(features, np.frombuffer(row.weights).reshape(len(biases), len(features)), biases)


def score_docs(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every row of ``docs`` with ``__score``, from 0 to 1."""
    return docs.withColumn("__score", score(F.col("text"), fit_toxicity(docs, labels)))


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``."""
    return score_docs(docs, labels).where(F.col("__score") < threshold).select(*docs.columns)
