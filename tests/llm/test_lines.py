"""Line dedup on hand-made rows and against a plain version."""

import hypothesis.strategies as st
from hypothesis import HealthCheck, given, settings
from pyspark.sql import functions as F

from assay.llm.lines import dedup_lines

SCHEMA = "doc_id long, text string, first string, pos int"


def plain(rows, min_docs=2):
    def key(line):
        line = line.strip(" \t\n\x0b\x0c\r")
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line)

    holders = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if doc is not None and len(key(line)) >= 10:
                holders.setdefault(key(line), set()).add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if doc is None or len(holders.get(key(x), ())) < min_docs
                or min(holders[key(x)]) == doc]
        out.append((doc, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def run(spark, rows, **options):
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], SCHEMA)
    got = dedup_lines(df, **options)
    assert got.columns == [*df.columns, "__n_lines", "__n_dropped"]
    return sorted([(r.doc_id, r.text, r[4], r[5]) for r in got.collect()], key=repr)


def test_odd_rows(spark):
    line = "A Shared line here"
    rows = [(5, f"{line}\nown five\n {line.upper()}\t"), (3, f"x\n{line}"), (9, None), (8, ""),
            (None, line), (None, line), (3, f"x\n{line}"), (7, f"{line}\n{line}"),
            (4, "short\nshort"), (6, "short"), (10, "\x85" + line), (11, line + "\x85"),
            (12, "\xc9t\xe9 \xe9t\xe9 ABC"), (13, "\xe9t\xe9 \xe9t\xe9 abc"),
            (14, "\n".join([line, "unique words of fourteen"] * 20_000))]
    assert run(spark, rows) == plain(rows)
    assert run(spark, rows, min_docs=3) == plain(rows, 3)
    assert run(spark, []) == []


LINES = st.sampled_from(["", " ", "alpha beta gamma", "ALPHA beta gamma ", "tiny", "delta epsilon z",
                         "\tdelta epsilon Z", "unlike others 1", "unlike others 2"])


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 5), st.lists(LINES, max_size=5).map("\n".join)),
                min_size=1, max_size=8))
def test_any_rows(spark, rows):
    assert run(spark, rows) == plain(rows)


def test_a_hot_line_is_split(spark):
    """The join that finds the lines to drop splits the partition of a line in a third of all rows."""
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20kb",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10kb",
            "spark.sql.adaptive.forceOptimizeSkewedJoin": "true"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, value in keys.items():
        spark.conf.set(k, value)
    try:
        docs = spark.range(12_000).repartition(8).select(
            F.col("id").alias("doc_id"),
            F.when(F.col("id") % 3 == 0, "the line that everybody has")
             .otherwise(F.concat(F.lit("a line of its own "), (F.col("id") / 2).cast("int")))
             .alias("text"))
        kept = dedup_lines(docs)
        kept.collect()
        assert "skew=true" in kept._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, value in old.items():
            spark.conf.unset(k) if value is None else spark.conf.set(k, value)
