"""The pipeline against plain versions of its stages."""

import hashlib

import numpy as np

import corpus_pipeline

from .test_bpe import library  # noqa: F401
from .test_lines import plain as plain_lines
from .test_simhash import brute_fingerprint, brute_groups

FOLDER = "/root/testdata/sf0.001"


def read(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages(spark, library, tmp_path):  # noqa: F811
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    outs = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, outs[-1], FOLDER).write.parquet(f"{tmp_path}/{name}")
        outs.append(spark.read.parquet(f"{tmp_path}/{name}"))
        if name != "bpe":
            assert outs[-1].columns == docs.columns and outs[-1].schema == docs.schema
    start, clean, lines, kept, mixed, ids = map(read, outs)
    assert set(clean) <= set(start)
    assert not [d for d in set(start) - set(clean) if labels.get(d, 1) != 1]
    want = {d: (t, len(t)) for d, t, _, _ in plain_lines([(d, r.text) for d, r in clean.items()])}
    assert {d: (r.text, r.n_chars) for d, r in lines.items()} == want
    fps = {d: brute_fingerprint(r.text) for d, r in lines.items()}
    groups = brute_groups(sorted(fps), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 3)
    assert kept == {d: lines[d] for d in lines if groups[d] == d}
    assert mixed == kept
    assert {d: (r.n_tokens, np.frombuffer(r.ids, "<u4").tolist(), r.decoded_sha256)
            for d, r in ids.items()} == {
        d: (len(t := library.encode_ordinary(r.text)), t,
            hashlib.sha256(r.text.encode()).hexdigest()) for d, r in mixed.items()}
    order = [r.doc_id for r in sorted(ids.values(), key=lambda r: (r.part, r.row))]
    assert order == [r.doc_id for r in outs[4].collect()]


def test_run(spark):
    assert corpus_pipeline.ORACLE_SQL is None
    out = corpus_pipeline.run(spark, FOLDER)
    assert out.columns == ["doc_id", "part", "row", "n_tokens", "ids", "decoded_sha256"]
    assert out.count() > 100


def test_odd_rows(spark, tmp_path):
    """Each stage with nulls, empty and repeated rows, extra columns, and no rows."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, row string"
    rows = [(1, None, None, None, None, "x"), (2, "", "en", "s", 0, "x"),
            (3, "a b c " * 9_000, "en", "s", 1, "x"), (3, "a b c " * 9_000, "en", "s", 1, "x"),
            (None, "some text", "en", "s", 9, "x"), (4, "some text", None, "t", 9, None)]
    for k, some in enumerate((rows, [])):
        spark.createDataFrame(some, schema).write.parquet(f"{tmp_path}/{k}")
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, spark.read.parquet(f"{tmp_path}/{k}"), FOLDER)
            assert out.count() in ((6, 3, 4) if some else (0,)), name
