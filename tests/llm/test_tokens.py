"""Token counts against the tokenizers library."""

import json
import random
import sys

import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from assay.llm import tokens as t
from assay.llm.queries import QUERIES

from .test_bpe import ODD

FOLDER = "/root/testdata/sf0.01"
PATH = P.path("byte_bpe_50k.json")
MORE = ["<|endoftext|>", "x <|endoftext|> y<|endoftext|><|endoftext|>  ", "<|endoftext|", "<|ENDOFTEXT|>",
        " \n\n\t <|endoftext|>\n a", "१२ ३ ⅷ ² x²", "'S 'll'LL 're", "a՘b \U00032400x 1\U00016d70",
        " a　 b ﻿c", "x" * 300 + " " + "y" * 300, "aaaa" * 400 + "é" * 300]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocabulary():
    return t.read_vocabulary(PATH, P.PATTERN)


def lengths(library, texts):
    return [len(e.ids) for e in library.encode_batch([x or "" for x in texts],
                                                     add_special_tokens=False)]


def test_query_matches_library(spark, library):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    want = dict(zip([r.doc_id for r in docs], lengths(library, [r.text for r in docs])))
    df = QUERIES["op13_tokens"](spark, FOLDER)
    assert df.columns == ["doc_id", "n_bytes", "n_tokens", "n_whole", "over_limit"]
    got = df.collect()
    assert {r.doc_id: r.n_tokens for r in got} == want and len(got) == len(docs)
    sizes = {r.doc_id: len((r.text or "").encode()) for r in docs}
    assert all(r.n_bytes == sizes[r.doc_id] and r.over_limit == (r.n_tokens > 1024)
               and 0 <= r.n_whole <= r.n_tokens for r in got)


@pytest.mark.parametrize("small", [False, True])
def test_odd_texts(spark, library, monkeypatch, small):
    if small:
        monkeypatch.setattr(t, "PIECE_CHARS", 50)
        monkeypatch.setattr(t, "CACHED", 3)
        monkeypatch.setattr(t, "LONG", 5)
    texts = [*ODD, *MORE]
    rows = [(i, x, "c", 1) for i, x in enumerate(texts)] + [(3, "again", "c", 1), (None, "none", "c", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_bytes string, n_tokens int")
    got = t.token_counts(docs, PATH, P.PATTERN).collect()
    want = lengths(library, [r[1] for r in rows])
    assert sorted((str(r.doc_id), r.n_tokens, r.n_bytes) for r in got) == sorted(
        (str(r[0]), n, len((r[1] or "").encode())) for r, n in zip(rows, want))
    assert t.token_counts(docs.limit(0), PATH, P.PATTERN).count() == 0


def test_every_character_splits_as_in_the_library(library, vocabulary):
    counter = t.Counter(vocabulary)
    split = library.pre_tokenizer.pre_tokenize_str
    points = [c for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    for begin in range(0, len(points), 20_000):
        text = "".join(f"a{chr(c)}1{chr(c)}- {chr(c)}" for c in points[begin:begin + 20_000])
        shadow = counter.later.sub(t._SYMBOL, text)
        ours = [m.span() for m in counter.split_words.finditer(shadow)]
        assert ours == [span for _, span in split(text)]


def test_whole_tokens_are_proven(library, vocabulary):
    whole = sorted(vocabulary.whole)
    assert len(whole) > 40_000
    model = library.model
    spelling = t.byte_letters()
    for word in whole[::7]:
        assert len(model.tokenize("".join(spelling[b] for b in word.encode()))) == 1


def test_entries_that_do_not_encode_alone_are_left_out(tmp_path):
    spec = json.load(open(PATH))
    # "hex" is in the vocabulary, but h and e merge first and nothing merges "he" with "x".
    letters = {c: i for i, c in enumerate(t.byte_letters())}
    spec["model"]["vocab"] = {**letters, "he": 256, "ex": 257, "hex": 258}
    spec["model"]["merges"] = [["h", "e"], ["e", "x"], ["h", "ex"]]
    spec["added_tokens"] = []
    path = tmp_path / "odd.json"
    path.write_text(json.dumps(spec))
    v = t.read_vocabulary(str(path), P.PATTERN)
    assert "hex" not in v.whole and {"he", "ex", "h"} <= v.whole
    ours = t.Counter(v).text("hex he ex hexhe")
    theirs = Tokenizer.from_file(str(path)).encode("hex he ex hexhe")
    assert ours[0] == len(theirs.ids)
    assert t.Counter(v).text("he") == (1, 1)


def test_both_merges_agree(vocabulary):
    rng = random.Random(4)
    for n in (1, 2, 3, 20, 60, 400):
        for _ in range(60):
            parts = [vocabulary.letters[rng.choice(b"aeinst 'xthe\xc3\xa9")] for _ in range(n)]
            assert t._merge_short(parts[:], vocabulary.pairs) == t._merge_long(
                parts[:], vocabulary.pairs)


def test_other_kinds_are_refused():
    with pytest.raises(ValueError, match="normalizer"):
        t.read_vocabulary(P.path("word_bpe_49k.json"), P.PATTERN)
