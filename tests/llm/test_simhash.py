"""SimHash near-dedup against brute force over all pairs."""

import re

import numpy as np
import pytest
import xxhash

from assay.llm import simhash
from assay.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def brute_fingerprint(text, words=3):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    tokens = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not tokens:
        return 0
    shingles = [" ".join(tokens[i:i + words]) for i in range(max(1, len(tokens) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(nodes, near):
    """{node: smallest node that it reaches}."""
    group = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a in nodes:
            for b in nodes:
                if near(a, b) and group[a] != group[b]:
                    group[a] = group[b] = min(group[a], group[b])
                    changed = True
    return group


def expected(docs):
    fps = {i: brute_fingerprint(t) for i, t in docs.items()}
    groups = brute_groups(sorted(docs), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 3)
    return {(i, f"{fps[i]:016x}", groups[i]) for i in docs}


def test_query_matches_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    found = QUERIES["op3_simhash"](spark, FOLDER).collect()
    assert len(found) == len(docs)
    assert {tuple(r) for r in found} == expected(docs)


@pytest.mark.parametrize("page", [16, 64])
def test_links_over_many_pages(spark, page):
    """Clusters that chain through several leads, at all distances around the limit."""
    rng = np.random.default_rng(5)
    fps = set()
    for centre in rng.integers(0, 1 << 63, 60):
        at = int(centre)
        for _ in range(6):
            fps.add(at)
            for bit in rng.choice(64, rng.integers(1, 6), replace=False):
                at ^= 1 << int(bit)
    signed = sorted(f - (1 << 64) if f >> 63 else f for f in fps)
    near = {(a, b) for a in signed for b in signed if ((a ^ b) & (2**64 - 1)).bit_count() <= 3}
    want = brute_groups(signed, lambda a, b: (a, b) in near)
    frame = spark.createDataFrame([(f,) for f in signed], "fp long")
    roots = simhash.components(simhash.links(frame, 3, page))
    got = {f: f for f in signed} | {r.u: r.v for r in roots.collect()}
    assert got == want


def test_odd_rows(spark):
    rows = [(1, None, "x"), (2, "", "y"), (3, " \t ", "z"), (4, "one two", "x"),
            (4, "one two", "x"), (None, "One TWO", "x"), (9, "one two", "x"),
            (10, "word " * 20_000, "x"), (11, "É é", None), (12, "é é", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = sorted((r.doc_id or 0, r.component_id) for r in simhash.near_duplicates(docs).collect())
    assert got == [(0, None), (1, 1), (2, 1), (3, 1), (4, 4), (4, 4), (9, 4), (10, 10), (11, 11),
                   (12, 12)]
    kept = simhash.one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 4, 10, 11, 12]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
