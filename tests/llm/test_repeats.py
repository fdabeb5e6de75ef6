"""Substring dedup against windows compared one by one."""

import hashlib
import re

import numpy as np
import pytest

from assay.llm.repeats import (anchors, drop_repeats, internal_nodes, suffix_order, word_ranks)
from assay.llm.repeats import _solve as solve


def plain(rows, width):
    words = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    first = {}
    for doc, w in words:
        if doc is not None:
            for i in range(len(w) - width + 1):
                key = tuple(w[i:i + width])
                first[key] = min(first.get(key, doc), doc)
    out = []
    for doc, w in words:
        gone = set()
        if doc is not None:
            for i in range(len(w) - width + 1):
                if first[tuple(w[i:i + width])] < doc:
                    gone.update(range(i, i + width))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def run(spark, rows, **options):
    df = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, at int")
    out = []
    for r in drop_repeats(df, **options).collect():
        assert r.n_removed == sum(s.end - s.start for s in r.spans)
        out.append((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept).hexdigest()))
    return sorted(out, key=repr)


def corpus():
    rng = np.random.default_rng(3)
    new = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 400, n))
    passage, other = new(120), new(70)
    rows = [(i, f"{new(30)} {passage} {new(rng.integers(1, 60))}") for i in range(40, 70)]
    rows += [(i, f"{other} {new(20)} {other}") for i in (5, 90, 12)]
    rows += [(100 + i, passage) for i in range(5)] + [(30, new(400)), (31, None), (32, "")]
    rows += [(33, "la " * 200), (34, "la " * 90), (2, "la " * 50), (None, passage), (None, passage)]
    rows += [(40, passage), (40, passage), (35, new(49)), (36, "\t\n "),
             (37, passage.replace("w", "é", 1)), (38, passage.upper())]
    return rows


@pytest.mark.parametrize("group", [32_768, 6])
def test_matches_plain_windows(spark, group):
    """With a small group the common prefixes take the way of whole windows."""
    rows = corpus()
    assert run(spark, rows, group=group) == plain(rows, 50)


def test_other_width_and_empty(spark):
    rows = corpus()
    assert run(spark, rows, width=17) == plain(rows, 17)
    assert run(spark, []) == []
    long = [(1, "a b c d " * 30_000), (2, "x " + "a b c d " * 30 + "y")]
    assert run(spark, long) == plain(long, 50)


def test_anchor_is_that_of_the_window():
    """A window has the same anchor wherever it stands, and every window has one."""
    rng = np.random.default_rng(1)
    words = rng.integers(0, 6, 900).astype(np.uint64)
    begin, end, key = anchors(words, 50)
    assert begin[0] == 0 and end[-1] == 851 and (begin[1:] == end[:-1]).all()
    for i in range(0, 851, 7):
        _, _, alone = anchors(words[i:i + 50], 50)
        assert alone[0] == key[np.searchsorted(end, i, side="right")]


def rows_of_words(seed, n=14, letters=2):
    rng = np.random.default_rng(seed)
    shared = rng.integers(0, letters, 12)
    return [(int(rng.integers(0, 6)), np.concatenate([rng.integers(0, letters, rng.integers(8, 25)),
                                                      shared[:rng.integers(4, 12)]])) for _ in range(n)]


@pytest.mark.parametrize("seed", range(4))
def test_internal_nodes_are_the_repeats_that_more_words_follow(seed):
    """Below a node stand all places of one sequence of words, and no longer sequence has them all."""
    width, rows = 5, rows_of_words(seed)
    words = np.concatenate([x for i, (_, w) in enumerate(rows) for x in (w, [100 + i])])
    places = np.array([i for i in range(len(words) - width) if words[i:i + width].max() < 100])
    order, shared = suffix_order(word_ranks(words, width), places, 40)
    suffixes = [tuple(words[places[i]:places[i] + 40]) for i in order]
    assert suffixes == sorted(suffixes)
    lcp = lambda a, b: next(i for i, (x, y) in enumerate(zip(a, b)) if x != y)
    assert shared.tolist() == [lcp(a, b) for a, b in zip(suffixes, suffixes[1:])]
    depth, first, end, parent, leaf = internal_nodes(shared, width)
    groups = {}
    for i, suffix in enumerate(suffixes):
        for n in range(width, len(suffix)):
            if max(suffix[:n]) < 100:
                groups.setdefault(suffix[:n], set()).add(i)
    longest = {}
    for string, members in groups.items():
        if len(members) > 1:
            longest[frozenset(members)] = max(longest.get(frozenset(members), 0), len(string))
    nodes = {frozenset(range(a, b)): d for d, a, b in zip(*map(np.ndarray.tolist, (depth, first, end)))}
    assert nodes == longest and len(nodes) == len(depth)
    above = [min((m for m in longest if m > set(range(a, b))), key=len, default=None)
             for a, b in zip(first, end)]
    assert [None if p < 0 else frozenset(range(first[p], end[p])) for p in parent] == above
    assert [None if p < 0 else frozenset(range(first[p], end[p])) for p in leaf] == [
        min((m for m in longest if i in m), key=len, default=None) for i in range(len(places))]


@pytest.mark.parametrize("seed", range(4))
def test_spans_are_maximal_repeats(seed):
    """Each span stands in a smaller document, no span can be longer to either side, and all
    repeated windows are covered."""
    width, rows = 5, rows_of_words(seed, letters=3)
    row, start, end = solve([(d, " ".join(map(str, w)).encode()) for d, w in rows], width)
    held = {}
    for doc, w in rows:
        for a in range(len(w)):
            for b in range(a + width, len(w) + 1):
                held[tuple(w[a:b])] = min(doc, held.get(tuple(w[a:b]), doc))
    want = set()
    for i, (doc, w) in enumerate(rows):
        earlier = lambda a, b: 0 <= a and b <= len(w) and held[tuple(w[a:b])] < doc
        want |= {(i, a, b) for a in range(len(w)) for b in range(a + width, len(w) + 1)
                 if earlier(a, b) and not earlier(a - 1, b) and not earlier(a, b + 1)}
    assert want and set(zip(row.tolist(), start.tolist(), end.tolist())) == want
