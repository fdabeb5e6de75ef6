"""BPE against the tiktoken library, and exact round trips."""

import base64
import hashlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from assay.llm import bpe
from assay.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def digests(text, library):
    ids = library.encode_ordinary(text or "")
    return (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256((text or "").encode()).hexdigest())


def test_query_matches_library(spark, library):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op4_bpe"](spark, FOLDER).collect()}
    assert got == {r.doc_id: digests(r.text, library) for r in docs}


ODD = [None, "", " ", "  ", "\n", " \n ", "a", "a ", " a", "a  b", "a\n b", "a \nb",
       "x\x1cy \x1d z", " wide　 space  x", "nb\xa0 sp \xa0x   y ", "a \x85b",
       "don't we'll I'VE it's", "\xc4\xd6 \xe9 \xf1 12 \xbd ٣٤", "<|endoftext|> a",
       "日本語 の テキスト", "\U0001f469‍\U0001f467 \U0001f642",
       "a" * 5_000, "ab" * 3_000 + " " + "\xe9" * 3_000, "-" * 2_000, "word " * 50_000,
       "line one\nline two\n\n\nline\tthree\r\nend", "\xe9 ​ z"]


def test_odd_texts(spark, library, monkeypatch):
    monkeypatch.setattr(bpe, "PIECE_CHARS", 1_000)
    monkeypatch.setattr(bpe, "BLOCK_CHARS", 9_000)
    monkeypatch.setattr(bpe, "BATCH_BYTES", 3_000)
    rows = [(i, t, "clash") for i, t in enumerate(ODD)] + [(3, "again", "c"), (None, "none", "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, block string")
    got = bpe.round_trip(docs, PATH, P.PATTERN).collect()
    want = sorted((str(i), tuple(library.encode_ordinary(t or "")), (t or "").encode())
                  for i, t, _ in rows)
    assert sorted((str(r.doc_id), tuple(np.frombuffer(r.ids, "<u4").tolist()), bytes(r.decoded))
                  for r in got) == want
    assert bpe.round_trip(docs.limit(0), PATH, P.PATTERN).count() == 0
    ranks = bpe.read_ranks(PATH)
    steps = bpe.decode(bpe.encode(docs, ranks, P.PATTERN), ranks).collect()
    assert sorted(map(repr, steps)) == sorted(map(repr, got))


def test_ids_are_decoded_where_they_are_put_together(spark):
    """One Python step after the join, so a running task holds one worker."""
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    plan = bpe.round_trip(docs, PATH, P.PATTERN)._jdf.queryExecution().optimizedPlan().toString()
    assert plan[:plan.index("Join")].count("MapInArrow") == 1
