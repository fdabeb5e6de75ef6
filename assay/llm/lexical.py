"""Ranked lexical search: accumulators for short lists, document-at-a-time skipping over long ones.

The index is a table of blocks of documents. A block holds the inverted lists of its own documents,
so no list of a common term is ever gathered in one place, and does not depend on what will be asked.
Numbers that need the whole table (documents, their terms, documents per asked term) are sums over
blocks. Items go with the scan of the index, a bounded number of bytes at a time; a task keeps the best
documents of each item over all of its blocks, and the tasks' results are merged per item.

Within a block the short lists of an item are added up first, term by term, into sorted accumulators.
These then count as one more list with a greatest score. The lists are walked together in the order of
documents, a window at a time. A window whose greatest scores add up to less than the worst of the best
so far is skipped. In the others, lists whose greatest scores together stay below that are only looked
up for documents that the remaining lists have brought far enough.

Each row of the table is a document of its own, so repeated rows rank one after another. Documents
of equal score come by ascending id, a null id last. Null and empty texts have no terms and are never
found, nor counted. A text of any length is indexed whole, some bytes at a time. Item rows that are equal
are one item; rows that share an id but not the text are ranked on their own. Items without terms, an
empty table of items, and a table without terms have no rows. Other columns, whatever they are called,
are not looked at.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import lower_ascii, small_batches, stage

# The term, of maximal length: anything but ASCII other than letters and digits.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# Fixed values of the score: see ``weight`` and ``_Block``.
ONE, PER_TF, LENGTH_WEIGHT, LENGTH_SHARE, PERCENT = 1_000_000_000, 1000, 8, 90, 100

BLOCK_BYTES = 8 << 20
DOC_BYTES = 16             # what a document counts beside its text
PIECE_BYTES = 1 << 20
ITEM_BYTES = 8 << 20       # of items sent with one scan of the index
WINDOW = 256               # documents
SHORT = 32                 # a list is short if it holds less than one document in so many

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or chr(c).isalnum() else 32
              for c in range(256))


def _pack(numbers: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(numbers, "<u4").tobytes(), 3)


def _unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), "<u4").astype(np.int64)


class _Codes(dict):
    def __missing__(self, term: bytes) -> int:
        code = self[term] = len(self)
        return code


def count_terms(text: bytes) -> Counter:
    """Occurrences of each term of a text in UTF-8."""
    counts, at = Counter(), 0
    while at < len(text):
        end = len(text)
        if end - at > PIECE_BYTES:
            # No byte of a longer character is a separator, so a cut there is safe.
            cut = _next_space(text, at + PIECE_BYTES)
            end = at + PIECE_BYTES + cut if cut >= 0 else end
        counts.update(text[at:end].translate(_FOLD).split())
        at = end
    return counts


def _next_space(text: bytes, at: int) -> int:
    """How far from ``at`` the next separator is, or -1."""
    for begin in range(at, len(text), PIECE_BYTES):
        if (found := text[begin:begin + PIECE_BYTES].translate(_FOLD).find(b" ")) >= 0:
            return begin - at + found
    return -1


def _index(batches: Iterator[pa.RecordBatch], id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    names = ["doc_ids", "lengths", "n_docs", "n_terms", "terms", "sizes", "places", "counts"]
    ids, lengths, codes, counts, vocabulary, held = [], [], [], [], _Codes(), 0

    def block() -> pa.RecordBatch:
        flat = np.concatenate(codes)
        order = np.argsort(flat, kind="stable")
        places = np.repeat(np.arange(len(ids)), [len(c) for c in codes])
        return pa.RecordBatch.from_arrays([
            pa.array([ids], pa.list_(id_type)), pa.array([lengths], pa.list_(pa.int64())),
            pa.array([sum(n > 0 for n in lengths)], pa.int64()),
            pa.array([sum(lengths)], pa.int64()),
            pa.array([zstandard.compress(b" ".join(vocabulary), 3)], pa.binary()),
            pa.array([_pack(np.bincount(flat, minlength=len(vocabulary)))], pa.binary()),
            pa.array([_pack(places[order])], pa.binary()),
            pa.array([_pack(np.concatenate(counts)[order])], pa.binary())], names)

    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            data = text.as_buffer().to_pybytes() if text.is_valid else b""
            found = count_terms(data)
            ids.append(doc)
            lengths.append(found.total())
            codes.append(np.fromiter(map(vocabulary.__getitem__, found), np.uint32, len(found)))
            counts.append(np.fromiter(found.values(), np.int64, len(found)))
            held += len(data) + DOC_BYTES
            if held >= BLOCK_BYTES:
                yield block()
                ids, lengths, codes, counts, vocabulary, held = [], [], [], [], _Codes(), 0
    if ids:
        yield block()


def build_index(docs: DataFrame) -> DataFrame:
    """The index of ``docs`` (doc_id, text), a row per block, written to the shared folder: the
    ``doc_ids``, the number of terms of each (``lengths``), the block's distinct ``terms``, how
    many documents hold each (``sizes``), and term by term which (``places``) and how often
    (``counts``)."""
    small_batches(docs.sparkSession)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    id_type = rows.limit(0).toArrow().schema.field("doc_id").type
    return stage(rows.mapInArrow(
        lambda batches: _index(batches, id_type),
        f"doc_ids array<{kind}>, lengths array<long>, n_docs long, n_terms long, terms binary, "
        "sizes binary, places binary, counts binary"), "lexical-index")


def weight(documents: int, holding: Column) -> Column:
    """Weight of a term that ``holding`` of the documents hold."""
    share = F.lit(2.0 * documents + 2) / (2 * holding + 1)
    return F.floor(1000 * F.log(share)).cast("bigint")


def _holding(index: DataFrame, asked: DataFrame) -> DataFrame:
    """(term, holding): how many documents hold each of the ``asked`` terms."""
    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for terms, counts in zip(batch.column(0), batch.column(1)):
                spelled = zstandard.decompress(terms.as_py()).split()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(spelled, pa.binary()).cast(pa.string()),
                     pa.array(_unpack(counts.as_py()))], ["term", "size"])

    per_block = index.select("terms", "sizes").mapInArrow(sizes, "term string, size long")
    return per_block.join(asked, "term", "left_semi").groupBy("term").agg(
        F.sum("size").alias("holding"))


def weighed_items(index: DataFrame, items: DataFrame, documents: int) -> DataFrame:
    """(item_id, terms, weights) of each distinct row of ``items`` (item_id, text) that holds a term
    of the index, with the number of the scan it goes with (``scan``)."""
    found = F.array_distinct(F.regexp_extract_all(lower_ascii(F.col("text")), F.lit(TERM), 0))
    rows = stage(items.select("item_id", F.col("text").cast("string").alias("text")).distinct()
                 .select("item_id", F.xxhash64("text").alias("a"), F.md5("text").alias("b"),
                         F.explode(found).alias("term")), "lexical-items")
    weights = _holding(index, rows.select("term").distinct()).select(
        "term", weight(documents, F.col("holding")).alias("weight"))
    grouped = rows.join(weights, "term").groupBy("item_id", "a", "b").agg(
        F.collect_list(F.struct("term", "weight")).alias("t"))
    known = stage(grouped.select("item_id", "a", "b", "t.term", "t.weight"), "lexical-weights")
    size = known.agg(F.sum(F.aggregate("term", F.lit(0).cast("bigint"),
                                       lambda s, t: s + F.octet_length(t) + DOC_BYTES))).first()[0]
    scans = max(1, -(-(size or 0) // ITEM_BYTES))
    return known.withColumn("scan", F.pmod(F.xxhash64("item_id", "a", "b"), F.lit(scans)))


class _List:
    """Documents in ascending order with their scores, and the greatest score of each window."""

    def __init__(self, places: np.ndarray, scores: np.ndarray, windows: int):
        self.places, self.scores = places, scores
        self.most = int(scores.max())
        self.starts = np.searchsorted(places, np.arange(windows + 1) * WINDOW)
        full = np.flatnonzero(np.diff(self.starts))
        self.peaks = np.zeros(windows, np.int64)
        self.peaks[full] = np.maximum.reduceat(scores, self.starts[full])

    def __len__(self) -> int:
        return len(self.places)

    def window(self, w: int) -> tuple[np.ndarray, np.ndarray]:
        cut = slice(self.starts[w], self.starts[w + 1])
        return self.places[cut] - w * WINDOW, self.scores[cut]


def accumulate(lists: list[_List], windows: int) -> _List:
    """The sum of some lists, as a list."""
    places = np.concatenate([x.places for x in lists])
    order = np.argsort(places, kind="stable")
    places = places[order]
    first = np.flatnonzero(np.r_[True, places[1:] != places[:-1]])
    sums = np.add.reduceat(np.concatenate([x.scores for x in lists])[order], first)
    return _List(places[first], sums, windows)


class _Block:
    """An index block, decoded as far as the asked terms need it."""

    def __init__(self, row: dict[str, pa.Scalar], weights: dict[bytes, int], documents: int,
                 terms: int):
        self.ids = row["doc_ids"].values
        n = row["lengths"].values.to_numpy(zero_copy_only=False)
        if LENGTH_SHARE * int(n.max(initial=0)) * documents < 2 ** 63:
            share = LENGTH_SHARE * n * documents // terms
        else:
            share = np.array([LENGTH_SHARE * x * documents // terms for x in n.tolist()])
        self.length = PERCENT - LENGTH_SHARE + share
        self.windows = -(-len(n) // WINDOW)
        spelled = zstandard.decompress(row["terms"].as_py()).split()
        self.code = {t: i for i, t in enumerate(spelled) if t in weights}
        self.ends = np.cumsum(_unpack(row["sizes"].as_py()))
        self.places, self.counts = (_unpack(row[c].as_py()) for c in ("places", "counts"))
        self.weights = weights
        self.lists: dict[bytes, _List] = {}

    def list(self, term: bytes) -> _List:
        """The documents that hold ``term`` and what it adds to the score of each."""
        if term not in self.lists:
            i = self.code[term]
            cut = slice(self.ends[i - 1] if i else 0, self.ends[i])
            places, tf = self.places[cut], self.counts[cut]
            part = ONE * tf // (PER_TF * tf + LENGTH_WEIGHT * self.length[places])
            self.lists[term] = _List(places, self.weights[term] * part, self.windows)
        return self.lists[term]

    def first(self, places: np.ndarray, scores: np.ndarray, k: int
              ) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` best by score and id of what ``best`` found, where ids are whole numbers:
        it may hold any number of equal scores."""
        if len(places) <= k or self.ids.null_count or not pa.types.is_integer(self.ids.type):
            return places, scores
        ids = self.ids.to_numpy(zero_copy_only=False)[places]
        order = np.lexsort((ids, -scores))[:k]
        return places[order], scores[order]

    def best(self, terms: list[bytes], least: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, scores) of at least the ``k`` best documents that score ``least`` or more."""
        lists = sorted((self.list(t) for t in terms if t in self.code), key=len)
        limit = self.windows * WINDOW // SHORT
        short = [x for x in lists if len(x) < limit]
        lists = lists[len(short):]
        if short:
            lists.append(accumulate(short, self.windows))
        lists.sort(key=lambda x: x.most)
        below = np.cumsum([x.most for x in lists])
        places, scores = np.empty(0, np.int64), np.empty(0, np.int64)
        reach = sum((x.peaks for x in lists), np.zeros(self.windows, np.int64))
        for w in np.flatnonzero(reach >= least).tolist():
            if reach[w] < least:
                continue
            # The first lists cannot lift a document that no other list holds.
            rest = int(np.searchsorted(below, least))
            sums = np.zeros(WINDOW, np.int64)
            for x in lists[rest:]:
                at, s = x.window(w)
                sums[at] += s
            left = int(below[rest - 1]) if rest else 0
            some = np.flatnonzero(sums)
            for x in reversed(lists[:rest]):
                some = some[sums[some] + left >= least]
                at, s = x.window(w)
                where = np.searchsorted(at, some)
                hit = np.flatnonzero(where < len(at))
                hit = hit[at[where[hit]] == some[hit]]
                sums[some[hit]] += s[where[hit]]
                left -= x.most
            some = some[sums[some] >= least]
            if len(some):
                places = np.r_[places, some + w * WINDOW]
                scores = np.r_[scores, sums[some]]
                if len(scores) >= k:
                    least = max(least, int(np.partition(scores, -k)[-k]))
                    keep = scores >= least
                    places, scores = places[keep], scores[keep]
        return places, scores


def search(index: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """(item_id, rank from 1, doc_id, score) of the ``k`` best documents of ``index`` (see
    ``build_index``) for each item of ``items`` (item_id, text)."""
    small_batches(index.sparkSession)
    totals = index.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    documents, terms = (int(x or 0) for x in totals)
    known = weighed_items(index, items, documents)
    kind = index.schema["doc_ids"].dataType.elementType.simpleString()
    id_type = index.limit(0).toArrow().schema.field("doc_ids").type.value_type
    found = None
    for row in known.select("scan").distinct().orderBy("scan").toLocalIterator():
        group = known.where(F.col("scan") == row["scan"]).collect()  # ITEM_BYTES, about
        keys = index.sparkSession.createDataFrame(
            [(i, r["item_id"]) for i, r in enumerate(group)],
            f"item int, item_id {items.schema['item_id'].dataType.simpleString()}")
        asked = [[t.encode() for t in r["term"]] for r in group]
        weights = {t: w for a, r in zip(asked, group) for t, w in zip(a, r["weight"]) if w > 0}
        scored = index.mapInArrow(
            _walk(asked, weights, documents, terms, k, id_type),
            f"item int, doc_id {kind}, score long")
        order = Window.partitionBy("item").orderBy(
            F.desc("score"), F.col("doc_id").asc_nulls_last())
        ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        part = ranked.join(keys, "item").select("item_id", "rank", "doc_id", "score")
        found = part if found is None else found.unionAll(part)
    if found is None:
        item_kind = items.schema["item_id"].dataType.simpleString()
        return index.sparkSession.createDataFrame(
            [], f"item_id {item_kind}, rank int, doc_id {kind}, score long")
    return found


def _walk(asked: list[list[bytes]], weights: dict[bytes, int], documents: int, terms: int, k: int,
          id_type: pa.DataType):
    """The task: the ``k`` best documents of each item over all blocks that come."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[int, bool, object]]] = [[] for _ in asked]
        for batch in batches:
            for i in range(batch.num_rows):
                block = _Block({c: batch.column(c)[i] for c in batch.schema.names}, weights,
                               documents, terms)
                for item, own in enumerate(asked):
                    top = best[item]
                    least = -top[-1][0] if len(top) == k else 1
                    places, scores = block.best(own, least, k)
                    if len(places):
                        places, scores = block.first(places, scores, k)
                        ids = block.ids.take(pa.array(places)).to_pylist()
                        top += [(-s, d is None, d) for s, d in zip(scores.tolist(), ids)]
                        top.sort(key=lambda x: x[:2] if x[1] else x)
                        del top[k:]
        for begin in range(0, len(best), 1024):
            part = best[begin:begin + 1024]
            yield pa.RecordBatch.from_arrays([
                pa.array([begin + i for i, top in enumerate(part) for _ in top], pa.int32()),
                pa.array([x[2] for top in part for x in top], id_type),
                pa.array([-x[0] for top in part for x in top], pa.int64())],
                ["item", "doc_id", "score"])

    return run
