"""Lexical search against a plain count over all documents, and its bounds."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from assay.llm import lexical as x

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, term string, score double"
ITEMS = "item_id long, text string, doc_id int"


def fold(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=10):
    bags = [(i, Counter(fold(t))) for i, t in docs]
    bags = [(i, b, b.total()) for i, b in bags if b]
    n, total = len(bags), sum(c for _, _, c in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    out = []
    for item, text in {(i, t) for i, t in items}:
        scored = []
        for doc, bag, size in bags:
            m = 10 + 90 * size * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                    * (1_000_000_000 * bag[t] // (1000 * bag[t] + 8 * m))
                    for t in set(fold(text)) if bag[t])
            if s > 0:
                scored.append((-s, doc is None, doc or 0, doc))
        scored.sort(key=lambda r: r[:3])
        out += [(item, r + 1, doc, -s) for r, (s, _, _, doc) in enumerate(scored[:k])]
    return sorted(out, key=repr)


def found(spark, docs, items, k=10, parts=3):
    d = spark.createDataFrame([(i, t, "clash", 0.5) for i, t in docs], DOCS).repartition(parts)
    q = spark.createDataFrame([(i, t, 1) for i, t in items], ITEMS)
    got = x.search(x.build_index(d), q, k)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, got.collect()), key=repr)


def some_docs(n=400, words=300, seed=2):
    rng = np.random.default_rng(seed)
    pick = lambda size: rng.zipf(1.3, size) % words
    return [(i, " ".join(f"w{v}" for v in pick(rng.integers(1, 60)))) for i in range(n)]


ODD_DOCS = [
    (1, None), (2, ""), (3, " .,\n\t;"), (4, "Ärger ärger ARGER\x00b\x7fc"), (5, "a-b_c d'E"),
    (6, "日本語 の　テキスト"), (7, "tie one"), (8, "tie one"), (8, "tie one"), (None, "tie one"),
    (9, "tie " * 3_000 + "x" * 5_000 + " end"), (10, "\U0001f642a 12 ½"), (11, "ONE two")]
ODD_ITEMS = [
    (1, "tie one"), (1, "tie one"), (1, "arger B"), (2, None), (3, ""), (4, "nothing here"),
    (None, "c two"), (5, "ärger 日本語 12"), (6, "　テキスト END"), (7, "x" * 5_000)]


@pytest.mark.parametrize("small", [False, True])
def test_odd_rows(spark, monkeypatch, small):
    if small:
        monkeypatch.setattr(x, "BLOCK_BYTES", 40)
        monkeypatch.setattr(x, "PIECE_BYTES", 7)
        monkeypatch.setattr(x, "ITEM_BYTES", 60)
    assert found(spark, ODD_DOCS, ODD_ITEMS) == brute(ODD_DOCS, ODD_ITEMS)


@pytest.mark.parametrize("k", [1, 10])
def test_skipping_loses_nothing(spark, monkeypatch, k):
    monkeypatch.setattr(x, "WINDOW", 16)
    monkeypatch.setattr(x, "BLOCK_BYTES", 20_000)
    docs = some_docs()
    items = [(i, t) for i, t in some_docs(30, 320, 5)]
    assert found(spark, docs, items, k) == brute(docs, items, k)


def test_empty_tables(spark):
    docs, items = some_docs(20), some_docs(3)
    assert found(spark, [], items) == [] and found(spark, docs, []) == []
    assert found(spark, [(1, None), (2, "!")], items) == []


def test_copies_beyond_k(spark):
    docs = [(i, "same words here") for i in range(500)] + [(900, "other words")]
    got = found(spark, docs, [(1, "same here")])
    assert [r[2] for r in sorted(got, key=lambda r: r[1])] == list(range(10))


def test_windows_are_skipped(monkeypatch):
    """Windows that cannot reach the best so far are not looked into, and nothing is lost by it."""
    monkeypatch.setattr(x, "WINDOW", 8)
    rng = np.random.default_rng(0)
    block = object.__new__(x._Block)
    block.windows, block.weights, block.ids = 50, {}, None
    dense = {t: rng.integers(1, 50, 400) * (rng.random(400) < p) for t, p in
             ((b"a", .9), (b"b", .5), (b"c", .3), (b"d", .01), (b"e", .005))}
    block.code = dict.fromkeys(dense, 0)
    block.lists = {t: x._List(np.flatnonzero(v), v[v > 0], 50) for t, v in dense.items()}
    seen = []
    plain = x._List.window
    monkeypatch.setattr(x._List, "window",
                        lambda self, w: seen.append(w) or plain(self, w))
    places, scores = block.best(list(dense), 1, 5)
    total = sum(dense.values())
    want = np.sort(total)[-5:]
    assert np.array_equal(np.sort(scores)[-5:], want)
    assert set(np.flatnonzero(total >= want[0])) == set(places) and len(set(seen)) < 50


def test_cut_texts_count_the_same(monkeypatch):
    text = ("Käse " * 50 + "x" * 90 + " -End.\nA " * 30).encode()
    whole = x.count_terms(text)
    monkeypatch.setattr(x, "PIECE_BYTES", 11)
    assert x.count_terms(text) == whole
    assert whole == Counter(t.encode() for t in fold(text.decode()))
