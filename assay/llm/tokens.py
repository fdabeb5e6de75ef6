"""Token counts by the whole-token shortcut.

Before any text is read, every entry of the vocabulary is put through the merges on its own. Those
that come out as one token are the whole tokens: a pre-token equal to one of them counts one, without
a merge, since a pre-token's merges depend on nothing around it. Only the remaining pre-tokens are
merged, and each task keeps the counts of those it has met, in tables of bounded size. Counting
shuffles nothing.

The file is one of the tokenizers library, with byte-level BPE; other kinds are refused by name.
Strings of its added tokens count one token wherever they stand in a text, as is that library's default,
and what lies between them is split on its own.

Null text is empty and has no tokens. A text of any length is counted whole, some characters at a time;
a pre-token of any length is merged whole. Every row comes out, with its ``doc_id`` as it is, null or
repeated; an empty table has no rows. Other columns, whatever they are called, are not looked at. There
are no ties: counts do not depend on the order of rows.
"""

from __future__ import annotations

import heapq
import json
import sys
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import pairwise

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers.pre_tokenizers import ByteLevel

from .common import small_batches

BITS = 20                  # of an id
MAX_VOCABULARY = 1 << BITS
MASK, NEVER = MAX_VOCABULARY - 1, 1 << 60
SHORT = 48                 # bytes of a word whose pairs are looked through
LIMIT = 1024
PIECE_CHARS = 1 << 20
CACHED = 1 << 17           # entries of a task's table
LONG = 256                 # characters of a text that no table keeps
WHOLE = 1 << 40            # whole tokens are counted above, all tokens below

# A space between two other characters that are not white space always begins a pre-token, so a
# text may be cut there.
_CUT = regex.compile(r"(?<=\S) (?=\S)")
_BLANKS = regex.compile(r"  |\n | \n|[^\S \n]")
_SYMBOL = "☃"         # a character that is neither letter nor digit nor white space


def byte_letters() -> list[str]:
    """The character by which the file spells each byte: visible Latin-1 characters stand for
    themselves, the other bytes follow from U+0100 on in their order."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(others)) for b in range(256)]


def later_letters() -> str:
    """A character class of the letters and digits that only regex takes for such: the library's
    tables are of an older Unicode and split them off as symbols. Only characters that unicodedata
    does not know either can be among them, so only these are tried."""
    split = ByteLevel(add_prefix_space=False).pre_tokenize_str
    unknown = "".join(c for c in map(chr, range(sys.maxunicode + 1))
                      if unicodedata.category(c) == "Cn")
    odd = [ord(m[0]) for m in regex.finditer(r"(\p{L})|\p{N}", unknown)
           if len(split(("a" if m[1] else "1") + m[0])) > 1]
    known = set(odd)
    starts = [c for c in odd if c - 1 not in known]
    ends = [c for c in odd if c + 1 not in known]
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(starts, ends))


def merged_count(word: bytes, letters: list[int], pairs: dict[int, int]) -> int:
    """How many tokens are left of ``word`` when the pair of lowest rank, the first of equals, is
    merged until there is none."""
    parts = [letters[b] for b in word]
    return (_merge_short if len(parts) <= SHORT else _merge_long)(parts, pairs)


def _merge_short(parts: list[int], pairs: dict[int, int]) -> int:
    """Looks through all pairs for each merge."""
    ranks = [pairs.get(a << BITS | b, NEVER) for a, b in pairwise(parts)]
    while ranks and (least := min(ranks)) != NEVER:
        i = ranks.index(least)
        new = parts[i] = least & MASK
        del parts[i + 1], ranks[i]
        if i < len(ranks):
            ranks[i] = pairs.get(new << BITS | parts[i + 1], NEVER)
        if i:
            ranks[i - 1] = pairs.get(parts[i - 1] << BITS | new, NEVER)
    return len(parts)


def _merge_long(parts: list[int], pairs: dict[int, int]) -> int:
    """A heap of places and links between parts keep the time from growing quadratically."""
    n = left = len(parts)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [found >> BITS << 40 | i for i, (a, b) in enumerate(pairwise(parts))
            if (found := pairs.get(a << BITS | b)) is not None]
    heapq.heapify(heap)
    while heap:
        rank, i = divmod(heapq.heappop(heap), 1 << 40)
        j = after[i]
        if parts[i] < 0 or j >= n:
            continue
        found = pairs.get(parts[i] << BITS | parts[j])
        if found is None or found >> BITS != rank:
            continue
        parts[i], parts[j] = found & MASK, -1
        left -= 1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            if (found := pairs.get(parts[i] << BITS | parts[k])) is not None:
                heapq.heappush(heap, found >> BITS << 40 | i)
        if (h := before[i]) >= 0 and (found := pairs.get(parts[h] << BITS | parts[i])) is not None:
            heapq.heappush(heap, found >> BITS << 40 | h)
    return left


@dataclass
class Vocabulary:
    """What a task needs: the ids of the single bytes, the rank and result of each pair as one
    number, the whole tokens, and the patterns that find added tokens, pre-tokens and later letters."""

    letters: list[int]
    pairs: dict[int, int]
    whole: frozenset[str]
    added: str
    pattern: str
    later: str


def _refuse(path: str, spec: dict) -> None:
    model, split = spec["model"], spec.get("pre_tokenizer") or {}
    wrong = [name for name, bad in {
        "no BPE model": model.get("type") != "BPE",
        "dropout": model.get("dropout"), "unk_token": model.get("unk_token"),
        "a subword prefix": model.get("continuing_subword_prefix"),
        "a word suffix": model.get("end_of_word_suffix"),
        "a normalizer": spec.get("normalizer"),
        "another pre-tokenizer than ByteLevel": split.get("type") != "ByteLevel"
        or split.get("add_prefix_space") or not split.get("use_regex", True),
        "added tokens that take in their surroundings": any(
            t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]),
        f"more than {MAX_VOCABULARY} entries": len(model["vocab"]) > MAX_VOCABULARY,
    }.items() if bad]
    if wrong:
        raise ValueError(f"{path} cannot be counted: it has {', '.join(wrong)}")


@lru_cache(4)
def read_vocabulary(path: str, pattern: str) -> Vocabulary:
    """The file's tables and the proof of its whole tokens. ``pattern`` splits text before the
    merges."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    _refuse(path, spec)
    model, spelling = spec["model"], byte_letters()
    ids = model["vocab"]
    letters = [ids[c] for c in spelling]
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    pairs = {ids[a] << BITS | ids[b]: rank << BITS | ids[a + b]
             for rank, (a, b) in reversed(list(enumerate(merges)))}
    byte = {c: b for b, c in enumerate(spelling)}
    whole = set()
    for token in ids:
        if not all(c in byte for c in token):
            continue
        word = bytes(byte[c] for c in token)
        if model.get("ignore_merges") or merged_count(word, letters, pairs) == 1:
            try:
                whole.add(word.decode())
            except UnicodeDecodeError:
                pass  # no pre-token is a part of a character
    added = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
    return Vocabulary(letters, pairs, frozenset(whole), "|".join(map(regex.escape, added)), pattern,
                      later_letters())


class _Table(dict):
    """Counts of texts met before, emptied when it is full."""

    def __init__(self, count: Callable[[str], int]):
        self.count = count

    def __missing__(self, text: str) -> int:
        found = self.count(text)
        if len(text) <= LONG:
            if len(self) >= CACHED:
                self.clear()
            self[text] = found
        return found


class Counter:
    """Counts texts: all tokens, and WHOLE for each pre-token that is a whole token."""

    def __init__(self, vocabulary: Vocabulary):
        v = self.v = vocabulary
        self.split_words = regex.compile(v.pattern)
        self.added = regex.compile(v.added) if v.added else None
        self.later = regex.compile(f"[{v.later}]") if v.later else None
        self.merged = _Table(self.merge)
        self.chunks = _Table(self.chunk)

    def merge(self, word: str) -> int:
        return merged_count(word.encode(), self.v.letters, self.v.pairs)

    def chunk(self, part: str) -> int:
        """What follows a space: letters are one pre-token with it."""
        word = " " + part
        if part.isalpha():
            return 1 + WHOLE if word in self.v.whole else self.merge(word)
        return self.words(word)

    def words(self, text: str) -> int:
        if self.later and not text.isascii() and self.later.search(text):
            shadow = self.later.sub(_SYMBOL, text)
            words = [text[m.start():m.end()] for m in self.split_words.finditer(shadow)]
        else:
            words = self.split_words.findall(text)
        whole, merged = self.v.whole, self.merged
        return sum([1 + WHOLE if w in whole else merged[w] for w in words])

    def piece(self, text: str) -> int:
        if _BLANKS.search(text):
            return self.words(text)
        first, *rest = text.split(" ")
        return self.words(first) + sum(map(self.chunks.__getitem__, rest))

    def stretch(self, text: str) -> int:
        at = total = 0
        while at < len(text):
            cut = _CUT.search(text, at + PIECE_CHARS) if len(text) - at > PIECE_CHARS else None
            end = cut.start() if cut else len(text)
            total += self.piece(text[at:end])
            at = end
        return total

    def text(self, text: str) -> tuple[int, int]:
        """(tokens, pre-tokens that were whole tokens)"""
        if self.added:
            stretches = self.added.split(text)
            total = len(stretches) - 1 + sum(map(self.stretch, stretches))
        else:
            total = self.stretch(text)
        return total % WHOLE, total // WHOLE


def token_counts(docs: DataFrame, path: str, pattern: str, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, n_whole, over_limit) for each row of ``docs`` (doc_id, text):
    ``n_whole`` pre-tokens needed no merge, and ``over_limit`` says whether there are more than
    ``limit`` tokens."""
    small_batches(docs.sparkSession)
    vocabulary = read_vocabulary(path, pattern)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(vocabulary)
        for batch in batches:
            sizes, totals = [], []
            for text in batch.column(1):
                data = text.as_buffer() if text.is_valid else b""
                sizes.append(len(data))
                totals.append(counter.text(str(data, "utf-8", "replace")))
            tokens, whole = zip(*totals) if totals else ((), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64()),
                 pa.array(whole, pa.int64())], ["doc_id", "n_bytes", "n_tokens", "n_whole"])

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        count, f"doc_id {kind}, n_bytes long, n_tokens long, n_whole long").withColumn(
        "over_limit", F.col("n_tokens") > limit)
