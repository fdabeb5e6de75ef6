"""SimHash near-dedup with a Gray-order hierarchical index.

Fingerprints are 64-bit majorities over the hashes of word shingles. The distinct ones are sorted
by their rank in the binary-reflected Gray code, so that neighbours share many bits, and cut into
pages. The index has a node for each leading bit pattern, below it a node for each page, and inside
a page nodes of 16, 256, ... neighbours. A node holds the bits that all of its fingerprints share,
without those that a node above it already holds. Walking down, the differences to these patterns
add up; where they exceed the limit, the whole group is left out. The two upper levels are joins
over small node rows, the lower ones run inside tasks, a pair of pages at a time.

A task returns, for the linked fingerprints of its pair of pages, the smallest one that they reach
there, so large groups of near copies give rows in proportion to their size, and no link between
different fingerprints is lost. Star contraction over these rows gives the components.

Null or empty text, and text of blanks only, has fingerprint zero, which links like any other.
Texts shorter than a shingle have one, the whole sequence. Rows with a null ``doc_id`` get a
fingerprint but no component. Repeated rows each come out.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, islice, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import rows_per_partition, small_batches, stage
from .components import components

SEED = 42
PAGE = 32_768   # fingerprints in a page, 256 kB
FAN = 16
CHUNK = 1 << 16  # hashes whose bits are counted at once
FRONTIER = 1 << 21  # nodes that a walk may hold at once


def simhash(text: str | None, words: int) -> int:
    tokens = (text or "").encode().lower().split()  # of bytes, both are ASCII only
    if not tokens:
        return 0
    if len(tokens) < words:
        shingles = iter([b" ".join(tokens)])
    else:
        shingles = map(b" ".join, zip(*(islice(tokens, i, None) for i in range(words))))
    n, ones = 0, np.zeros(64, dtype=np.int64)
    while chunk := list(islice(shingles, CHUNK)):
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, chunk, repeat(SEED)), dtype="<u8",
                             count=len(chunk))
        n += len(hashes)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(
            axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n).view("<i8")[0])


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """(doc_id, fp) for each row of ``docs``."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = pa.array([simhash(t.as_py(), words) for t in batch.column(1)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), fps], ["doc_id", "fp"])

    small_batches(docs.sparkSession)
    rows = docs.select("doc_id", "text")
    return rows.mapInArrow(of, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fp long")


def gray_rank(fp: Column) -> Column:
    """Place of ``fp`` in the binary-reflected Gray code, ordered as a signed long."""
    for shift in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, shift))
    return fp.bitwiseXOR(F.lit(-(1 << 63)))


def _pages(distinct: DataFrame, bits: int, size: int) -> DataFrame:
    """Runs of at most ``size`` neighbours in Gray order that agree in the leading ``bits``: the page's
    first fingerprint as its name, the leading bits, the shared bits, and the fingerprints."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = np.empty(0, np.uint64)
        for batch in batches:
            fps = np.concatenate([left, batch.column(0).to_numpy().view(np.uint64)])
            ends = _ends(fps, bits, size)
            left = fps[ends[-2]:]
            if len(ends) > 2:
                yield _page_rows(fps, ends[:-1], bits)
        if len(left):
            yield _page_rows(left, _ends(left, bits, size), bits)

    n = rows_per_partition(distinct, 0, 1)
    ordered = distinct.select("fp", gray_rank(F.col("fp")).alias("rank")) \
                      .repartitionByRange(n, "rank").sortWithinPartitions("rank")
    return ordered.select("fp").mapInArrow(
        cut, "page long, lead long, mask long, pattern long, fps binary")


def _lead(fps: np.ndarray, bits: int) -> np.ndarray:
    return fps >> np.uint64(64 - bits) if bits else np.zeros_like(fps)


def _ends(fps: np.ndarray, bits: int, size: int) -> np.ndarray:
    """Where pages of ``fps`` begin, and the end of the last."""
    lead = _lead(fps, bits)
    runs = np.flatnonzero(np.r_[True, lead[1:] != lead[:-1], True])
    return np.r_[np.concatenate([np.arange(a, b, size) for a, b in zip(runs, runs[1:])]),
                 len(fps)]


def _page_rows(fps: np.ndarray, ends: np.ndarray, bits: int) -> pa.RecordBatch:
    parts = [fps[a:b] for a, b in zip(ends, ends[1:])]
    every = np.array([np.bitwise_and.reduce(p) for p in parts])
    some = np.array([np.bitwise_or.reduce(p) for p in parts])
    mask = ~(every ^ some)
    first = np.array([p[0] for p in parts])
    longs = [pa.array(x.view(np.int64)) for x in (first, _lead(first, bits), mask, every & mask)]
    return pa.RecordBatch.from_arrays([*longs, pa.array([p.tobytes() for p in parts],
                                                        pa.binary())],
                                      ["page", "lead", "mask", "pattern", "fps"])


def _tree(fps: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """From the top: each level's own bits (shared in the node, not in one above) and pattern."""
    every, some = [fps], [fps]
    while len(every[-1]) > FAN:
        at = np.arange(0, len(every[-1]), FAN)
        every.append(np.bitwise_and.reduceat(every[-1], at))
        some.append(np.bitwise_or.reduceat(some[-1], at))
    levels, above = [], None
    for a, o in zip(reversed(every), reversed(some)):
        shared = ~(a ^ o)
        own = shared if above is None else shared & ~np.repeat(above, FAN)[:len(shared)]
        levels.append((own, a & own))
        above = shared
    return levels


def _near(queries: np.ndarray, tree: list, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (query, leaf) that differ in at most ``limit`` bits, some queries at a time."""
    step = max(1, FRONTIER // (64 * FAN))
    for begin in range(0, len(queries), step):
        some = queries[begin:begin + step]
        top = len(tree[0][0])
        todo = [(0, np.repeat(np.arange(len(some)), top), np.tile(np.arange(top), len(some)),
                 np.zeros(len(some) * top, np.uint8))]
        while todo:
            depth, q, node, differs = todo.pop()
            own, pattern = tree[depth]
            differs = differs + np.bitwise_count((some[q] ^ pattern[node]) & own[node])
            keep = differs <= limit
            q, node, differs = q[keep], node[keep], differs[keep]
            if depth + 1 == len(tree):
                yield q + begin, node
                continue
            width = len(tree[depth + 1][0])
            for at in range(0, len(q), FRONTIER // FAN):
                part = slice(at, at + FRONTIER // FAN)
                child = (node[part, None] * FAN + np.arange(FAN)).ravel()
                real = child < width
                todo.append((depth + 1, np.repeat(q[part], FAN)[real], child[real],
                             np.repeat(differs[part], FAN)[real]))


def _unite(parent: np.ndarray, u: np.ndarray, v: np.ndarray) -> None:
    """Union by minimum of all pairs (u, v) in the forest ``parent``, which ends fully pressed."""
    while len(u):
        u, v = parent[u], parent[v]
        apart = u != v
        u, v = u[apart], v[apart]
        np.minimum.at(parent, np.maximum(u, v), np.minimum(u, v))
        while (parent[parent] != parent).any():
            parent[:] = parent[parent]


def page_links(a: np.ndarray, b: np.ndarray | None, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """The fingerprints of ``a`` (and ``b``) with a link between them, each with the smallest that
    it reaches through such links."""
    both = a if b is None else np.concatenate([a, b])
    rank = np.argsort(both.view(np.int64), kind="stable")  # numbers nodes as the tables order them
    place = np.empty_like(rank)
    place[rank] = np.arange(len(rank))
    parent = np.arange(len(both))
    for q, leaf in _near(a, _tree(a if b is None else b), limit):
        if b is None:
            q, leaf = q[q < leaf], leaf[q < leaf]
        else:
            leaf = leaf + len(a)
        _unite(parent, place[q], place[leaf])
    low = np.flatnonzero(parent != np.arange(len(both)))
    return both[rank[low]], both[rank[parent[low]]]


def links(distinct: DataFrame, limit: int = 3, page: int = PAGE) -> DataFrame:
    """For a column ``fp`` of distinct fingerprints: edges (u, v) with the same components as all
    pairs that differ in at most ``limit`` bits."""
    n, bits = distinct.count(), 0
    while n > page << bits:
        bits += 1
    pages = stage(_pages(distinct, bits, page), "simhash-pages")
    heads = pages.drop("fps")
    flips = [sum(1 << i for i in c) for k in range(min(limit, bits) + 1)
             for c in combinations(range(bits), k)]
    left = heads.select(F.col("page").alias("a"), F.col("mask").alias("a_mask"),
                        F.col("pattern").alias("a_pattern"), F.col("lead").alias("a_lead"),
                        F.explode(F.expr(f"array({', '.join(f'{x}L' for x in flips)})"))
                        .alias("flip"))
    right = heads.withColumnsRenamed({"page": "b", "lead": "b_lead"})
    shared = F.col("a_mask").bitwiseAND(F.col("mask"))
    differs = F.bit_count(F.col("a_pattern").bitwiseXOR(F.col("pattern")).bitwiseAND(shared))
    pairs = left.withColumn("b_lead", F.col("a_lead").bitwiseXOR(F.col("flip"))) \
                .join(right, "b_lead").where((F.col("a") <= F.col("b")) & (differs <= limit)) \
                .select("a", "b")
    loaded = pairs.join(pages.select(F.col("page").alias("a"), F.col("fps").alias("a_fps")), "a") \
                  .join(pages.select(F.col("page").alias("b"), F.col("fps").alias("b_fps")), "b")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for same, x, y in zip(*(batch.column(i).to_pylist() for i in range(3))):
                u, v = page_links(np.frombuffer(x, np.uint64),
                                  None if same else np.frombuffer(y, np.uint64), limit)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])

    # Random places spread the pairs of a hot lead; a pair row is two pages.
    spread = loaded.select((F.col("a") == F.col("b")).alias("same"), "a_fps",
                           F.when(F.col("a") != F.col("b"), F.col("b_fps")).alias("b_fps"),
                           F.xxhash64("a", "b").alias("at")) \
                   .repartition(rows_per_partition(distinct, 0, 1), "at").drop("at")
    return spread.mapInArrow(search, "u long, v long")


def near_duplicates(docs: DataFrame, words: int = 3, limit: int = 3) -> DataFrame:
    """(doc_id, fp, component_id) for each row of ``docs``: the component is the smallest
    ``doc_id`` that links of at most ``limit`` differing bits reach, the row's own included."""
    fps = stage(fingerprints(docs, words), "fingerprints")
    firsts = stage(fps.where("doc_id IS NOT NULL").groupBy("fp").agg(
        F.min("doc_id").alias("first")), "distinct-fingerprints")
    roots = components(links(firsts.select("fp"), limit))
    rooted = firsts.join(roots.select(F.col("u").alias("fp"), "v"), "fp", "left") \
                   .withColumn("root", F.coalesce("v", "fp"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    of = rooted.join(least, "root").select("fp", "component_id")
    return fps.join(of, "fp", "left").select(
        "doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component_id"))
        .alias("component_id"))


def one_per_group(docs: DataFrame, words: int = 3, limit: int = 3) -> DataFrame:
    """The rows of ``docs`` whose ``doc_id`` names their component, one row of each; rows with a
    null ``doc_id`` all stay."""
    kept = near_duplicates(docs, words, limit).where("doc_id = component_id") \
        .select(F.col("doc_id").alias("__kept")).distinct()
    named = docs.join(kept, F.col("doc_id") == F.col("__kept"))
    first = F.row_number().over(Window.partitionBy("doc_id").orderBy(
        F.xxhash64(*[f"`{c}`" for c in docs.columns])))
    return named.withColumn("__n", first).where("__n = 1").select(*docs.columns).unionAll(
        docs.where("doc_id IS NULL"))
