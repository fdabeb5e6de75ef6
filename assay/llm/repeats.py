"""Substring dedup through prefix-partitioned suffix trees.

A window is ``width`` consecutive words. Of all suffixes of the corpus, only those can begin a
repeat whose prefix occurs in two documents, so suffixes are first dealt out by a short prefix: the
GRAM words at their anchor, which is the place in a window whose GRAM words hash lowest. Equal
windows have equal anchors, and neighbouring windows share theirs, so one row stands for a run of
windows. Prefixes that only one document holds end there. A prefix with up to GROUP occurrences is
a group that fits a task. A prefix with more is lengthened to the whole window, by whose digest
its suffixes are then counted, pre-aggregated.

A task builds the suffix trees of some groups: the words' ranks at depths 1, 2, 4, ... order the
suffixes, the words that neighbours in this order share give the internal nodes, and those of a
depth of at least ``width`` are the repeats. Climbing from a suffix to the first node below which a
smaller document lies gives the longest repeat that starts there; where the suffix one word before
has it too, it is not maximal and left out. The maximal ones, as spans of words, cover exactly the
words of repeated windows. Copies of whole documents never reach the trees, since their first one
stands for all.

Texts are stored once, in compressed blocks of documents in a table bucketed by block, and are not
shuffled: only prefixes, and the words around shared anchors, are.

Null text has no words. Rows with a null ``doc_id`` have no place in the order of documents and
neither lose words nor make others lose any. Rows that share a ``doc_id`` don't make each other
lose any, and each comes out. ``doc_id`` is an integer.
"""

from __future__ import annotations

import hashlib
import secrets
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import new_folder
from .common import small_batches, stage

WIDTH = 50
GRAM = 8
GROUP = 32_768           # occurrences of a prefix that one task may hold
TREE_WORDS = 1 << 19     # words of the groups that go into one tree, if they are several
BLOCK_BYTES = 4 << 20
CACHE_WORDS = 1 << 17
CHUNK = 1 << 22          # windows whose anchors are found at once
SEPARATOR = b"\xff"      # in no UTF-8 text

_SPANS = "array<struct<at:int,start:bigint,end:bigint>>"


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found


def _mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    x = left * np.uint64(0x9E3779B97F4A7C15) + right
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def anchors(hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each run of windows with the same anchor: the first window, the one after the last, and
    the hash of the GRAM words at the anchor. ``hashes`` are the words' own."""
    out = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64))]
    for begin in range(0, len(hashes) - width + 1, CHUNK):
        grams = hashes[begin:begin + CHUNK + width - 1]
        n, size = len(grams) - width + 1, 1
        while size < GRAM:
            grams, size = _mixed(grams[:-size], grams[size:]), 2 * size
        # The low bits hold the place, so that of equal hashes the first is least.
        low = np.uint64((1 << 24) - 1)
        least = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
        span, size = width - GRAM + 1, 1
        while 2 * size <= span:
            least, size = np.minimum(least[:-size], least[size:]), 2 * size
        if size < span:
            least = np.minimum(least[:size - span], least[span - size:])
        at = (least & low).astype(np.int64)
        cuts = np.flatnonzero(np.r_[True, at[1:] != at[:-1], True])
        out.append((begin + cuts[:-1], begin + cuts[1:], grams[at[cuts[:-1]]]))
    return tuple(np.concatenate(x) for x in zip(*out))


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    names = ["block", "doc_ids", "sizes", "digests", "keys", "counts", "texts"]
    known = _Hashes()
    docs, size = [], 0

    def block() -> pa.RecordBatch:
        ids, sizes, digests, keys, counts, texts = zip(*docs)
        return pa.RecordBatch.from_arrays([
            pa.array([secrets.randbits(63)], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
            pa.array([sizes], pa.list_(pa.int64())), pa.array([digests], pa.list_(pa.binary())),
            pa.array([keys], pa.list_(pa.list_(pa.int64()))),
            pa.array([counts], pa.list_(pa.list_(pa.int64()))),
            pa.array([zstandard.compress(SEPARATOR.join(texts), 3)], pa.binary())], names)

    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            words = (text.as_py() or "").encode().split()  # of bytes: at ASCII blanks only
            joined = b" ".join(words)
            keys = counts = np.empty(0, np.int64)
            if doc is not None and len(words) >= width:
                hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
                keys, counts = np.unique(anchors(hashes, width)[2].view(np.int64),
                                         return_counts=True)
            docs.append((doc, len(words), hashlib.sha256(joined).digest(), keys, counts, joined))
            size += len(joined) + 1
            if size >= BLOCK_BYTES:
                yield block()
                docs, size = [], 0
    if docs:
        yield block()


def _stored(docs: DataFrame, width: int) -> DataFrame:
    """The table of blocks: per document its id, number of words, digest of its words, and its
    prefixes with their counts; and the words of all."""
    spark = docs.sparkSession
    small_batches(spark)
    made = docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        lambda batches: _blocks(batches, width),
        "block long, doc_ids array<long>, sizes array<long>, digests array<binary>, "
        "keys array<array<long>>, counts array<array<long>>, texts binary")
    name = f"repeats_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    made.write.bucketBy(buckets, "block").option("path", new_folder(spark, name)) \
        .option("compression", "zstd").saveAsTable(name)
    stored = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay, and the frame knows them
    return stored


def _copies(stored: DataFrame, width: int) -> DataFrame:
    """(block, copies): places of documents of at least a window whose words are, as a whole, those
    of a document with a smaller id."""
    each = stored.select("block", F.posexplode(F.arrays_zip("doc_ids", "sizes", "digests"))
                         .alias("at", "d")).select("block", "at", "d.*") \
                 .where((F.col("sizes") >= width) & F.col("doc_ids").isNotNull())
    # Staged, so that a hot digest's partition of the join can be split.
    firsts = stage(each.groupBy("digests").agg(
        F.min("doc_ids").alias("first"), F.max("doc_ids").alias("last")).where("first < last")
        .select("digests", "first"), "repeats-firsts")
    return each.join(firsts, "digests").where("doc_ids > first") \
               .groupBy("block").agg(F.collect_list("at").alias("copies"))


def _segments(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """From blocks (block, doc_ids, wanted: (place, key), texts) the words of each run of windows
    with a wanted prefix."""
    known = _Hashes()
    names = ["key", "doc_id", "block", "at", "first", "words"]
    for batch in batches:
        for block, ids, wanted, texts in zip(*(c for c in batch.columns)):
            keys: dict[int, list[int]] = {}
            for place, key in zip(*(wanted.values.field(i).to_pylist() for i in range(2))):
                keys.setdefault(place, []).append(key)
            rows: list[tuple] = []
            docs = zstandard.decompress(texts.as_py()).split(SEPARATOR)
            for place, own in keys.items():
                words = docs[place].split()
                hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
                begin, end, key = anchors(hashes, width)
                key = key.view(np.int64)
                for i in np.flatnonzero(np.isin(key, own)).tolist():
                    rows.append((int(key[i]), ids[place].as_py(), block.as_py(), place,
                                 int(begin[i]), b" ".join(words[begin[i]:end[i] + width - 1])))
            for at in range(0, len(rows), 4096):
                part = list(zip(*rows[at:at + 4096]))
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array(c, pa.int64()) for c in part[:3]], pa.array(part[3], pa.int32()),
                     pa.array(part[4], pa.int64()), pa.array(part[5], pa.binary())], names)


def word_ranks(words: np.ndarray, width: int) -> list[np.ndarray]:
    """For depths 1, 2, 4, ... up to ``width`` the rank of every place by the words that follow, as
    many as the depth; what lies beyond the end comes first."""
    ranks, depth = [np.unique(words, return_inverse=True)[1].astype(np.int64)], 1
    while 2 * depth <= width:
        last = ranks[-1]
        pair = last * (int(last.max()) + 2)
        pair[:-depth] += last[depth:] + 1
        ranks.append(np.unique(pair, return_inverse=True)[1].astype(np.int64))
        depth *= 2
    return ranks


def suffix_order(ranks: list[np.ndarray], places: np.ndarray,
                 longest: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of the suffixes at ``places``, and how many words each shares with the next.
    Each suffix ends, after ``longest`` words at most, in a number that occurs once."""
    end, top, step = len(ranks[0]) - 1, ranks[-1], 1 << (len(ranks) - 1)
    order = np.lexsort([top[np.minimum(places + at, end)]
                        for at in range(longest - longest % step, -1, -step)])
    a, b = places[order[:-1]], places[order[1:]]
    shared, open_ = np.zeros(len(a), np.int64), np.arange(len(a))
    while len(open_):
        x, y = (np.minimum(p[open_] + shared[open_], end) for p in (a, b))
        open_ = open_[top[x] == top[y]]
        shared[open_] += step
    for level, rank in reversed(list(enumerate(ranks[:-1]))):
        x, y = (np.minimum(p + shared, end) for p in (a, b))
        shared[rank[x] == rank[y]] += 1 << level
    return order, shared


def internal_nodes(shared: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """The suffix tree's internal nodes of a depth of at least ``width``: depth, first suffix, end,
    parent (-1: none so deep); and the parent of each suffix."""
    depth, first, end, parent, leaf, stack = [], [], [], [], [], []
    before = 0
    for i, h in enumerate([*shared.tolist(), 0]):
        h = h if h >= width else 0
        top, left, popped = stack[-1] if stack else -1, i, -1
        while stack and depth[stack[-1]] > h:
            popped = stack.pop()
            end[popped], left = i + 1, first[popped]
            if stack and depth[stack[-1]] >= h:
                parent[popped], popped = stack[-1], -1
        if h and (not stack or depth[stack[-1]] < h):
            if popped >= 0:
                parent[popped] = len(depth)
            stack.append(len(depth))
            for column, value in ((depth, h), (first, left), (end, 0), (parent, -1)):
                column.append(value)
        leaf.append(top if h < before else stack[-1] if h else -1)
        before = h
    return tuple(np.array(c, np.int64) for c in (depth, first, end, parent, leaf))


def repeat_lengths(ranks: list[np.ndarray], places: np.ndarray, docs: np.ndarray, longest: int,
                   width: int) -> np.ndarray:
    """For the suffixes at ``places`` of ``docs`` the length of the longest repeat that they begin
    and that a smaller document holds; 0 below ``width``."""
    order, shared = suffix_order(ranks, places, longest)
    depth, first, end, parent, node = internal_nodes(shared, width)
    docs, out = docs[order], np.zeros(len(places), np.int64)
    if len(depth):
        bounds = np.stack([first, end], axis=1).ravel()
        least = np.minimum.reduceat(np.r_[docs, np.iinfo(np.int64).max], bounds)[::2]
        climbing = np.flatnonzero(node >= 0)
        while len(climbing):
            at = node[climbing]
            found = least[at] < docs[climbing]
            out[order[climbing[found]]] = depth[at[found]]
            node[climbing] = parent[at]
            climbing = climbing[~found & (parent[at] >= 0)]
    return out


def _solve(rows: list[tuple], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For rows (doc_id, words): row, first and end word of each maximal repeat of ``width`` words
    or more that the row of a smaller document holds."""
    numbers: dict[bytes, int] = {}
    parts = [np.fromiter((numbers.setdefault(w, len(numbers)) for w in words.split(b" ")),
                         np.int64) for _, words in rows]
    sizes = np.array([len(p) for p in parts])
    starts = np.cumsum(sizes + 1) - sizes - 1
    runs = sizes - width + 1
    row = np.repeat(np.arange(len(rows)), runs)
    place = np.arange(len(row)) - np.repeat(np.cumsum(runs) - runs, runs)
    words = np.concatenate([x for i, p in enumerate(parts) for x in (p, [len(numbers) + i])])
    ranks = word_ranks(words, width)
    docs = np.array([d for d, _ in rows], dtype=np.int64)
    # Suffixes whose first words only one document holds are leaves above all deep nodes.
    at, top = starts[row] + place, ranks[-1]
    begins = top[at] * (int(top.max()) + 1) + top[at + width - (1 << (len(ranks) - 1))]
    order = np.argsort(begins, kind="stable")
    cuts = np.flatnonzero(np.r_[True, begins[order][1:] != begins[order][:-1]])
    sizes_of = np.diff(np.r_[cuts, len(order)])
    several = np.minimum.reduceat(docs[row[order]], cuts) < np.maximum.reduceat(docs[row[order]], cuts)
    some = np.sort(order[np.repeat(several, sizes_of)])
    length = np.zeros(len(row), np.int64)
    if len(some):
        length[some] = repeat_lengths(ranks, at[some], docs[row[some]], int(sizes.max()) + 1, width)
    longer = np.r_[False, (row[1:] == row[:-1]) & (length[:-1] > length[1:])]
    hit = np.flatnonzero((length > 0) & ~longer)
    return row[hit], place[hit], place[hit] + length[hit]


def _trees(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Runs of repeated windows in segments that come in the order of their keys."""
    def solve(rows: list[tuple]) -> pa.RecordBatch:
        row, start, end = _solve([(r[1], r[5]) for r in rows], width)
        begin = np.array([r[4] for r in rows], dtype=np.int64)[row]
        return pa.RecordBatch.from_arrays([
            pa.array([rows[i][2] for i in row], pa.int64()),
            pa.array([rows[i][3] for i in row], pa.int32()),
            pa.array(begin + start), pa.array(begin + end)], ["block", "at", "start", "end"])

    rows, held, last = [], 0, None
    for batch in batches:
        for record in zip(*(c.to_pylist() for c in batch.columns)):
            if record[0] != last and held > TREE_WORDS:
                yield solve(rows)
                rows, held = [], 0
            last = record[0]
            rows.append(record)
            held += record[5].count(b" ") + 1
    if rows:
        yield solve(rows)


def _long_prefixes(segments: DataFrame, width: int) -> DataFrame:
    """The same for prefixes with too many occurrences: each window is its own prefix."""
    words = F.split(F.col("words").cast("string"), " ")
    each = segments.select("block", "at", "doc_id", "first", words.alias("w")).select(
        "block", "at", "doc_id", "first", F.posexplode(F.transform(
            F.sequence(F.lit(1), F.size("w") - (width - 1)),
            lambda i: F.sha2(F.array_join(F.slice("w", i, width), " "), 256))))
    # Staged, so that a hot window's partition of the join can be split.
    least = stage(each.groupBy("col").agg(F.min("doc_id").alias("least")), "repeats-windows")
    return each.join(least, "col").where("doc_id > least").select(
        "block", "at", (F.col("first") + F.col("pos")).alias("start"),
        (F.col("first") + F.col("pos") + width).alias("end"))


def _cut(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """The kept words of each document of a block (doc_ids, copies, spans, texts)."""
    names = ["doc_id", "n_words", "n_removed", "spans", "kept"]
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        for ids, copies, spans, texts in zip(*batch.columns):
            copies = set(copies.as_py() or [])
            own: dict[int, list[tuple[int, int]]] = {}
            for s in spans.as_py() or []:
                own.setdefault(s["at"], []).append((s["start"], s["end"]))
            rows = []
            docs = zstandard.decompress(texts.as_py()).split(SEPARATOR)
            for at, (doc, joined) in enumerate(zip(ids.values.to_pylist(), docs)):
                n = joined.count(b" ") + bool(joined)
                merged: list[dict] = [{"start": 0, "end": n}] if at in copies else []
                for start, end in [] if merged else sorted(own.get(at, [])):
                    if merged and start <= merged[-1]["end"]:
                        merged[-1]["end"] = max(end, merged[-1]["end"])
                    else:
                        merged.append({"start": start, "end": end})
                if merged:
                    words = joined.split(b" ")
                    for span in reversed(merged):
                        del words[span["start"]:span["end"]]
                    joined = b" ".join(words)
                rows.append((doc, n, sum(s["end"] - s["start"] for s in merged), merged, joined))
            columns = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(c, pa.int64()) for c in columns[:3]], pa.array(columns[3], span_type),
                 pa.array(columns[4], pa.binary())], names)


def drop_repeats(docs: DataFrame, width: int = WIDTH, group: int = GROUP) -> DataFrame:
    """For each row of ``docs`` (doc_id, text): ``n_words``, ``n_removed``, the removed ``spans`` of
    words, and the ``kept`` words as UTF-8 joined by a space.

    A word goes if a window that covers it also starts in a document with a smaller ``doc_id``.
    """
    stored = _stored(docs, width)
    copies = stage(_copies(stored, width), "repeats-copies")
    each = stored.select("block", "doc_ids", "keys", "counts").join(copies, "block", "left").select(
        "block", F.col("copies"), F.posexplode(F.arrays_zip("doc_ids", "keys", "counts"))
        .alias("at", "d")).where(~F.coalesce(F.array_contains("copies", F.col("at")), F.lit(False)))
    keys = each.select("block", "at", F.col("d.doc_ids").alias("doc_id"), F.explode(
        F.arrays_zip(F.col("d.keys").alias("key"), F.col("d.counts").alias("n"))).alias("k")) \
        .select("block", "at", "doc_id", "k.*")
    shared = stage(keys.groupBy("key").agg(
        F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.sum("n").alias("n"))
        .where("first < last").select("key", (F.col("n") > group).alias("long")), "repeats-keys")

    def segments(some: DataFrame) -> DataFrame:
        wanted = keys.join(some.select("key"), "key").groupBy("block").agg(
            F.collect_list(F.struct("at", "key")).alias("wanted"))
        return stored.join(wanted, "block").select("block", "doc_ids", "wanted", "texts") \
            .mapInArrow(lambda batches: _segments(batches, width), "key long, doc_id long, "
                        "block long, at int, first long, words binary")

    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spans = segments(shared.where("NOT long")).repartition(tasks, "key") \
        .sortWithinPartitions("key").mapInArrow(
        lambda batches: _trees(batches, width), "block long, at int, start long, end long")
    if not shared.where("long").isEmpty():
        spans = spans.unionAll(_long_prefixes(segments(shared.where("long")), width))
    by_block = spans.groupBy("block").agg(
        F.collect_list(F.struct("at", "start", "end")).cast(_SPANS).alias("spans"))
    return stored.select("block", "doc_ids", "texts").join(copies, "block", "left") \
        .join(by_block, "block", "left").select("doc_ids", "copies", "spans", "texts").mapInArrow(
        lambda batches: _cut(batches, width), "doc_id long, n_words long, n_removed long, "
        "spans array<struct<start:bigint,end:bigint>>, kept binary")
