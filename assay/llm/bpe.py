"""Byte-level BPE encoding and decoding with a global shuffle of distinct words.

Texts are cut into blocks of documents. Each block explodes its documents into pre-tokens, keeps
their positions as codes into the block's own list of distinct words, and sends the words, dealt
out by hash, to the tasks that encode: there the words of all blocks meet and each distinct one is
encoded once. The ids go back to their blocks by a join on the block, and documents are put
together again by position. Codes are stored once, in a table bucketed by block, and do not move:
only distinct words and their ids are shuffled. A word that is in every text costs one entry per
block.

Decoding joins ids with the token-byte table position by position. The table has one row per entry
of the vocabulary, at most MAX_VOCABULARY, and therefore goes to every task.

Null text is empty and has no ids. A text of any length is encoded whole, some characters at a time.
Rows are told apart by their place in a block, so null and repeated ``doc_id`` values each come out.
"""

from __future__ import annotations

import base64
import heapq
import uuid
import zlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import new_folder
from .common import small_batches

MAX_VOCABULARY = 1 << 20
BLOCK_CHARS = 4 << 20
PIECE_CHARS = 1 << 20
BATCH_BYTES = 8 << 20
CACHE_WORDS = 1 << 18
SEPARATOR = b"\xff"  # in no UTF-8 text

# A space between two other characters that are not white space always begins a pre-token, so a
# text may be cut there.
_CUT = regex.compile(r"(?<=\S) (?=\S)")
_OTHER_SPACE = regex.compile(
    r"[\t\r\x0b\x0c\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def read_ranks(path: str) -> bytes:
    """The rank file, to be sent with the tasks: base64 bytes and their rank on each line."""
    with open(path, "rb") as file:
        data = file.read()
    if data.count(b"\n") > MAX_VOCABULARY:
        raise ValueError(f"the vocabulary has more than {MAX_VOCABULARY} entries")
    return data


def parse_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in
            (line.split() for line in data.splitlines() if line)}


def encode_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Merge the neighbours of lowest rank, the first of equals, until none is left. A heap of
    pairs and links between parts keep long words from taking quadratic time."""
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    end = list(range(1, n + 1))  # of the part that begins here; 0 when merged away
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i:i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = after[i]
        if not end[i] or j >= n or end[j] != stop:
            continue
        end[i], end[j] = stop, 0
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            if (r := ranks.get(word[i:end[k]])) is not None:
                heapq.heappush(heap, (r, i, end[k]))
        if (h := before[i]) >= 0 and (r := ranks.get(word[h:stop])) is not None:
            heapq.heappush(heap, (r, h, stop))
    return [ranks[word[i:e]] for i, e in enumerate(end) if e]


class _Codes(dict):
    """Things to numbers in the order in which they come."""

    def __missing__(self, key):
        code = self[key] = len(self)
        return code


class _Chunks(dict):
    """What follows a space, to the codes of its pre-tokens and the space's."""

    def __init__(self, split: Callable[[str], list[str]], codes: _Codes):
        self.split, self.codes = split, codes

    def __missing__(self, part: str) -> tuple[int, ...]:
        found = self[part] = tuple([self.codes[w] for w in self.split(" " + part)])
        return found


def _pieces(text: str) -> Iterator[str]:
    at = 0
    while at < len(text):
        cut = _CUT.search(text, at + PIECE_CHARS) if len(text) - at > PIECE_CHARS else None
        end = cut.start() if cut else len(text)
        yield text[at:end]
        at = end


def text_codes(text: str, split: Callable, words: _Codes, chunks: _Chunks) -> np.ndarray:
    """The code of each pre-token of ``text``, by position."""
    found = [np.empty(0, np.uint32)]
    for piece in _pieces(text):
        if "  " in piece or "\n " in piece or " \n" in piece or _OTHER_SPACE.search(piece):
            found.append(np.fromiter(map(words.__getitem__, split(piece)), np.uint32))
        else:
            first, *rest = piece.split(" ")
            head = [words[w] for w in split(first)]
            found.append(np.fromiter(chain(head, chain.from_iterable(
                map(chunks.__getitem__, rest))), np.uint32))
    return np.concatenate(found)


def _pack(codes: np.ndarray) -> bytes:
    """Numbers, compressed byte plane by byte plane."""
    planes = np.ascontiguousarray(codes.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.compress(planes.tobytes(), 3)


def _unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _explode(batches: Iterator[pa.RecordBatch], pattern: str, parts: int, id_type: pa.DataType
             ) -> Iterator[pa.RecordBatch]:
    """Blocks of documents (doc_id, text): see ``blocks``."""
    split = regex.compile(pattern).findall
    names = ["block", "doc_ids", "sizes", "codes", "deal", "words"]

    def block(ids: list, codes: list[np.ndarray], words: _Codes) -> pa.RecordBatch:
        spelled = [w.encode() for w in words]
        deal = np.array([zlib.crc32(w) % parts for w in spelled], dtype=np.uint32)
        dealt: list[list[bytes]] = [[] for _ in range(parts)]
        for part, word in zip(deal.tolist(), spelled):
            dealt[part].append(word)
        blobs = [zstandard.compress(SEPARATOR.join(p), 3) if p else None for p in dealt]
        return pa.RecordBatch.from_arrays([
            pa.array([uuid.uuid4().hex]), pa.array([ids], pa.list_(id_type)),
            pa.array([[len(c) for c in codes]], pa.list_(pa.int64())),
            pa.array([_pack(np.concatenate(codes))], pa.binary()),
            pa.array([_pack(deal)], pa.binary()),
            pa.array([blobs], pa.list_(pa.binary()))], names)

    ids, codes, size = [], [], 0
    words = _Codes()
    chunks = _Chunks(split, words)
    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = text.as_py() or ""
            ids.append(doc)
            codes.append(text_codes(text, split, words, chunks))
            size += len(text)
            if size >= BLOCK_CHARS:
                yield block(ids, codes, words)
                ids, codes, size = [], [], 0
                words = _Codes()
                chunks = _Chunks(split, words)
    if ids:
        yield block(ids, codes, words)


def blocks(docs: DataFrame, pattern: str) -> DataFrame:
    """A table of blocks, bucketed by ``block``: the ``doc_ids``, the number of pre-tokens of each
    (``sizes``), all ``codes`` by position, the task to which each distinct word goes (``deal``),
    and for each such task its ``words`` in the order of their codes."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType
    id_type = rows.limit(0).toArrow().schema.field("doc_id").type
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    made = rows.mapInArrow(
        lambda batches: _explode(batches, pattern, parts, id_type),
        f"block string, doc_ids array<{kind.simpleString()}>, sizes array<long>, codes binary, "
        "deal binary, words array<binary>")
    name = f"bpe_{uuid.uuid4().hex}"
    made.write.bucketBy(parts, "block").option("path", new_folder(spark, name)) \
        .option("compression", "zstd").saveAsTable(name)
    stored = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay, and the frame knows them
    return stored


def encode_words(words: DataFrame, ranks: bytes) -> DataFrame:
    """Words of blocks (block, part, words) to their ids (block, part, ids): all rows of a part
    meet in one task, which encodes each distinct word once."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = parse_ranks(ranks)
        known: dict[bytes, np.ndarray] = {}
        for batch in batches:
            out = []
            for blob in batch.column(2):
                found = []
                for word in zstandard.decompress(blob.as_py()).split(SEPARATOR):
                    ids = known.get(word)
                    if ids is None:
                        if len(known) >= CACHE_WORDS:
                            known.clear()
                        ids = known[word] = encode_word(word, table)
                    found.append(ids)
                counts = np.fromiter(map(len, found), np.uint32, len(found))
                flat = np.fromiter(chain.from_iterable(found), np.uint32)
                out.append(_pack(np.concatenate([[len(counts)], counts, flat])))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(out, pa.binary())],
                ["block", "part", "ids"])

    parts = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return words.repartition(parts, "part").mapInArrow(
        encode, "block string, part int, ids binary")


def _gather(starts: np.ndarray, counts: np.ndarray, flat: np.ndarray) -> np.ndarray:
    """The runs flat[start:start + count], one after another."""
    ends = np.cumsum(counts, dtype=np.int64)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(starts - (ends - counts), counts) + np.arange(total)]


def _offsets(counts: np.ndarray) -> np.ndarray:
    return np.cumsum(counts, dtype=np.int64) - counts


def _coded(docs: DataFrame, ranks: bytes, pattern: str) -> DataFrame:
    """Blocks with the ids of their words: ``doc_ids``, ``sizes``, ``codes``, ``deal`` and, for each
    task to which words went, their ``ids``."""
    stored = blocks(docs, pattern)
    words = stored.select("block", F.posexplode("words").alias("part", "words")) \
                  .where("words IS NOT NULL")
    back = encode_words(words, ranks).groupBy("block").agg(
        F.array_sort(F.collect_list(F.struct("part", "ids"))).alias("parts"))
    return stored.drop("words").join(back, "block", "left").select(
        "doc_ids", "sizes", "codes", "deal", "parts.ids")


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Coded blocks to (doc_id, ids)."""
    for batch in batches:
        for doc_ids, sizes, codes, deal, parts in zip(*batch.columns):
            found = [_unpack(p) for p in parts.as_py() or []]
            dealt = np.concatenate([np.empty(0, np.uint32),
                                    *[f[1:1 + f[0]] for f in found]]).astype(np.int64)
            flat = np.concatenate([np.empty(0, np.uint32), *[f[1 + f[0]:] for f in found]])
            place = np.argsort(_unpack(deal.as_py()), kind="stable")
            counts, starts = np.empty_like(dealt), np.empty_like(dealt)
            counts[place], starts[place] = dealt, _offsets(dealt)
            codes, at, done, rows, held = _unpack(codes.as_py()), 0, 0, [], 0
            for n in sizes.as_py():
                own = codes[at:at + n]
                at += n
                rows.append(_gather(starts[own], counts[own], flat).astype("<u4").tobytes())
                held += len(rows[-1])
                if held > BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays(
                        [doc_ids.values.slice(done, len(rows)), pa.array(rows, pa.binary())],
                        ["doc_id", "ids"])
                    done, rows, held = done + len(rows), [], 0
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [doc_ids.values.slice(done, len(rows)), pa.array(rows, pa.binary())],
                    ["doc_id", "ids"])


def _decode(batches: Iterator[pa.RecordBatch], ranks: bytes) -> Iterator[pa.RecordBatch]:
    """(doc_id, ids) with the bytes of the ids."""
    table = sorted((rank, token) for token, rank in parse_ranks(ranks).items())
    lengths = np.zeros(table[-1][0] + 1 if table else 0, np.int64)
    lengths[[rank for rank, _ in table]] = [len(token) for _, token in table]
    flat = np.frombuffer(b"".join(token for _, token in table), np.uint8)
    starts = _offsets(lengths)
    for batch in batches:
        begin, held, rows = 0, 0, []
        for ids in batch.column(1):
            ids = np.frombuffer(ids.as_buffer(), "<u4")
            rows.append(b"".join(
                _gather(starts[part], lengths[part], flat).tobytes()
                for part in (ids[i:i + PIECE_CHARS] for i in range(0, len(ids), PIECE_CHARS))))
            held += 5 * len(rows[-1])
            if held > BATCH_BYTES or begin + len(rows) == batch.num_rows:
                part = batch.slice(begin, len(rows))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(rows, pa.binary())],
                    ["doc_id", "ids", "decoded"])
                begin, held, rows = begin + len(rows), 0, []


def _kind(docs: DataFrame) -> str:
    return docs.schema["doc_id"].dataType.simpleString()


def encode(docs: DataFrame, ranks: bytes, pattern: str) -> DataFrame:
    """(doc_id, ids) for each row of ``docs``: the ids as little-endian unsigned 32-bit integers."""
    return _coded(docs, ranks, pattern).mapInArrow(_assemble, f"doc_id {_kind(docs)}, ids binary")


def decode(encoded: DataFrame, ranks: bytes) -> DataFrame:
    """(doc_id, ids) with ``decoded``, the bytes of the ids one after another."""
    return encoded.select("doc_id", "ids").mapInArrow(
        lambda batches: _decode(batches, ranks),
        f"doc_id {_kind(encoded)}, ids binary, decoded binary")


def round_trip(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(doc_id, ids, decoded) for each row of ``docs``.

    ``encode`` and ``decode`` in one: the tasks that put the ids together decode them too. A step of
    its own would hold a second Python worker, and its batches in the JVM, for every running task.
    """
    ranks = read_ranks(ranks_path)
    return _coded(docs, ranks, pattern).mapInArrow(
        lambda batches: _decode(_assemble(batches), ranks),
        f"doc_id {_kind(docs)}, ids binary, decoded binary")
