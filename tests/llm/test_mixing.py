"""Pfair mixing: windows, deviation, whole results. Its query is also compared with SQL."""

import hashlib
from collections import Counter

import pytest

import corpus_pipeline
from assay.llm import mixing
from assay.llm.mixing import BLOCK_DOCS, in_mixed_order, mix
from assay.llm.mixing import WEIGHTS as DEFAULTS
from assay.llm.queries import QUERIES

WEIGHTS = {"a": 5, "b": 3, "c": 1}


def frame(spark, counts, extra=()):
    rows = [(i, s) for i, s in enumerate(s for s, n in counts.items() for _ in range(n))]
    return spark.createDataFrame([*rows, *extra], "doc_id long, source string")


@pytest.mark.parametrize("counts", [{"a": 500, "b": 300, "c": 100}, {"a": 37, "b": 200, "c": 5},
                                    {"a": 3, "z": 50, None: 14}, {"c": 11}])
@pytest.mark.parametrize("block_docs", [1, 4])
def test_less_than_a_block_away(spark, counts, block_docs):
    rows = mix(frame(spark, counts), WEIGHTS, rest=2, block_docs=block_docs).select(
        "doc_id", "source", "__mix.*").collect()
    assert Counter(r.source for r in rows) == counts
    assert len({r.position for r in rows}) == len(rows)
    assert all(r.release <= r.slot < r.deadline for r in rows)
    slots = {}
    for r in rows:
        pool = r.source if r.source in WEIGHTS else "rest"
        assert slots.setdefault(r.slot, (pool, r.block)) == (pool, r.block)
    assert sorted(slots) == list(range(len(slots)))
    left = Counter(p for p, _ in slots.values())
    weights = {p: WEIGHTS.get(p, 2) for p in left}
    done, at = Counter(), 0
    while +left:  # round by round, each with even shares at its end
        size = {p: min(weights[p], left[p]) for p in left if left[p]}
        total, inside = sum(size.values()), Counter()
        for i in range(total):
            inside[slots[at][0]] += 1
            at += 1
            assert all(abs(inside[p] - size[p] * (i + 1) / total) < 1 for p in size)
        assert inside == size
        left.subtract(inside)
        done.update(inside)


def check_every_source(rows, weights, block_docs):
    """Each source on its own is less than a block away from its share, in every round."""
    assert len({r.position for r in rows}) == len(rows)
    assert all(r.release <= r.slot < r.deadline for r in rows)
    slots, docs = {}, Counter()
    for r in rows:
        assert slots.setdefault(r.slot, (r.source, r.block)) == (r.source, r.block)
        docs[r.source, r.block] += 1
    assert sorted(slots) == list(range(len(slots)))
    assert len(set(slots.values())) == len(slots) and max(docs.values()) <= block_docs
    left, at = Counter(s for s, _ in slots.values()), 0
    assert left == {s: -(-n // block_docs) for s, n in Counter(r.source for r in rows).items()}
    while +left:
        size = {s: min(weights.get(s, 1), n) for s, n in left.items() if n}
        total, inside = sum(size.values()), Counter()
        for i in range(total):
            inside[slots[at][0]] += 1
            at += 1
            assert all(abs(inside[s] - size[s] * (i + 1) / total) < 1 for s in size)
        assert inside == size
        left.subtract(inside)


@pytest.mark.parametrize("counts", [
    {"a": 500, "b": 300, "c": 100}, {"a": 37, "b": 200, "c": 5}, {"c": 11},
    {"a": 3, "z": 50, None: 14, "": 9}, {"hot": 400, "y": 20, "z": 20, None: 20, "a": 60},
    {f"s{i}": 1 + i % 7 for i in range(60)} | {"a": 40, "b": 9},
    {f"s{i}": 1 + i for i in range(80)} | {"a": 70}])
@pytest.mark.parametrize("block_docs", [1, 4])
def test_sources_not_named_are_scheduled_too(spark, counts, block_docs):
    rows = mix(frame(spark, counts), WEIGHTS, rest=None, block_docs=block_docs).select(
        "doc_id", "source", "__mix.*").collect()
    assert Counter(r.source for r in rows) == counts
    check_every_source(rows, WEIGHTS, block_docs)


def test_pipeline_schedules_every_supplied_source(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "source")
    rows = mix(docs, rest=None).select("doc_id", "source", "__mix.*").collect()
    check_every_source(rows, DEFAULTS, BLOCK_DOCS)
    assert {r.source for r in rows} - set(DEFAULTS)
    staged = corpus_pipeline.mix_sources(spark, docs, "")
    assert [r.doc_id for r in staged.collect()] == [
        r.doc_id for r in sorted(rows, key=lambda r: r.position)]


def test_rounds_meet_documents_by_ranges(spark, monkeypatch):
    """Short ranges and prefixes, so that a group lies in several of both, change nothing."""
    docs = frame(spark, {"a": 400, "b": 90, "y": 60, "z": 7, None: 33})
    whole = sorted(map(str, mix(docs, WEIGHTS, rest=None, block_docs=1).collect()))
    monkeypatch.setattr(mixing, "SPAN", 3)
    monkeypatch.setattr(mixing, "ROWS_PER_PREFIX", 8)
    assert sorted(map(str, mix(docs, WEIGHTS, rest=None, block_docs=1).collect())) == whole


def test_query_schedules_every_supplied_source(spark):
    folder = "/root/testdata/sf0.01"
    rows = QUERIES["op5_mixing"](spark, folder).collect()
    check_every_source(rows, DEFAULTS, BLOCK_DOCS)
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()


def test_odd_rows_of_sources_not_named(spark):
    odd = frame(spark, {"a": 3}, [(None, "a"), (None, None), (1, "y"), (1, "y")])
    assert in_mixed_order(odd, rest=None).count() == 7
    assert mix(odd.limit(0), rest=None).count() == 0
    with pytest.raises(ValueError):
        mix(odd, {"a": 0}, rest=None)


def test_order_inside_a_source_is_by_hash(spark):
    rows = mix(frame(spark, {"a": 60}), WEIGHTS).orderBy("__mix.position").collect()
    assert [r.doc_id for r in rows] == sorted(
        range(60), key=lambda i: hashlib.md5(str(i).encode()).hexdigest())


def test_odd_rows(spark):
    odd = frame(spark, {"a": 3}, [(None, "a"), (None, None), (1, "a"), (1, "a")])
    got = in_mixed_order(odd.selectExpr("*", "'x' AS __pool_", "1 AS rank"))
    assert got.columns == ["doc_id", "source", "__pool_", "rank"] and got.count() == 7
    assert mix(odd.limit(0)).count() == 0
    with pytest.raises(ValueError):
        mix(odd, {"a": 0})
    with pytest.raises(ValueError):
        mix(odd, {"a": 5_000})
