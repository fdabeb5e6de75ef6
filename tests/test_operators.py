import random

import pytest
from pyspark.sql import functions as F

from assay.operators import defects as d
from assay.operators import parents, profile, quality, ranks
from assay.operators.dedupe import dedupe_first, dedupe_latest, top_k, top_n_per_group

from .helpers import rows


# Dedup.

def test_dedupe_latest_ties_and_nulls(spark):
    df = spark.createDataFrame([
        ("a", 1, "x"), ("a", 2, "z"), ("a", 2, "y"), ("b", None, "p"), ("b", 1, "q"),
        ("c", None, "r"), (None, 1, "s"), (None, 2, "t")], "k string, o int, v string")
    assert rows(dedupe_latest(df, ["k"], "o", ["v"])) == [
        ("a", 2, "y"), ("b", 1, "q"), ("c", None, "r"), (None, 2, "t")]


def test_dedupe_first_and_empty(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y")],
                               "k string, o int, v string")
    assert rows(dedupe_first(df, ["k"], "o", ["v"])) == [("a", 1, "y")]
    assert dedupe_first(df.limit(0), ["k"], "o").count() == 0


def test_top_n_and_top_k(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), "id")
    top = top_n_per_group(df, ["g"], [F.col("id").desc()], 2)
    assert rows(top) == [(0, 96), (0, 99), (1, 94), (1, 97), (2, 95), (2, 98)]
    assert [r.id for r in top_k(df, [F.col("id").desc()], 3).collect()] == [99, 98, 97]


# Foreign keys.

def test_parent_joins(spark):
    child = spark.createDataFrame([(1, "a"), (2, "x"), (3, None), (4, "a")], "id int, k string")
    parent = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    assert rows(parents.with_parent(child, parent, "k")) == [(1, "a"), (4, "a")]
    assert rows(parents.orphans(child, parent, "k")) == [(2, "x"), (3, None)]
    assert rows(parents.tag_orphans(child, parent, "k")) == [
        (1, "a", False), (2, "x", True), (3, None, True), (4, "a", False)]
    assert parents.orphan_count(child, parent, "k").first()[0] == 2


# Expectations.

RULES = [quality.Rule("positive", "x > 0", "drop", "not_positive"),
         quality.Rule("small", "x < 10"), quality.Rule("even", "x % 2 = 0", "warn")]


def numbers(spark):
    return spark.createDataFrame([(-1,), (2,), (3,), (12,), (None,)], "x int")


def test_expect_actions(spark):
    df = numbers(spark)
    assert rows(quality.expect(df, {"positive": "x > 0"})) == [(12,), (2,), (3,)]
    assert rows(quality.expect(df, {"positive": "x > 0"}, "warn")) == [
        (-1, False), (12, True), (2, True), (3, True), (None, False)]
    assert quality.expect(df.filter("x > 0"), {"positive": "x > 0"}, "fail").count() == 3
    for bad in (df, df.filter("x IS NULL")):
        with pytest.raises(Exception, match="expectation failed: positive"):
            quality.expect(bad, {"positive": "x > 0"}, "fail").count()
    with pytest.raises(ValueError):
        quality.expect(df, {"p": "x > 0"}, "ignore")


def test_judge_and_metrics(spark):
    judged = quality.judge(numbers(spark), RULES)
    assert rows(quality.quarantined_rows(judged)) == [
        (-1, "not_positive"), (12, "small"), (None, "not_positive")]
    assert rows(quality.clean_rows(judged)) == [(2,), (3,)]
    assert rows(quality.expectation_metrics(numbers(spark), RULES, "t")) == [
        ("t", "even", "warn", 2, 3), ("t", "positive", "drop", 3, 2),
        ("t", "small", "drop", 3, 2)]
    assert rows(quality.quarantine(numbers(spark), [("neg", "x >= 0"), ("big", "x < 10")])) == [
        (-1, "neg"), (12, "big"), (None, "neg")]


def test_conservation(spark):
    mk = lambda keys: spark.createDataFrame([(k,) for k in keys], "k string")
    ok = quality.conservation(mk("aab"), mk("aa"), mk("b"), ["k"]).first()
    assert tuple(ok) == (3, 2, 1, 0, 0, 0)
    bad = quality.conservation(mk("abc"), mk("ab"), mk("bd"), ["k"]).first()
    assert tuple(bad) == (3, 2, 2, 1, 1, 1)
    assert tuple(quality.conservation(mk(""), mk(""), mk(""), ["k"]).first()) == (0,) * 6


def test_compare_metrics(spark):
    schema = "table_name string, expectation string, failed long"
    before = spark.createDataFrame([("t", "a", 1), ("t", "b", 2)], schema)
    after = spark.createDataFrame([("t", "a", 4), ("t", "c", 5)], schema)
    assert rows(quality.compare_metrics(before, after)) == [
        ("t", "a", 1, 4, 3), ("t", "b", 2, 0, -2), ("t", "c", 0, 5, 5)]


def test_unexplained(spark):
    df = numbers(spark)
    seen = quality.quarantine(df, [("neg", "x >= 0")]).select("x")
    left = quality.unexplained(df, seen, F.col("x").isin(-1, 12), ["x"])
    assert rows(left) == [(12,)]


# Profiling.

def test_profile(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 2)], "s string, n int")
    expected = [("n", 3, 1, 2), ("s", 3, 1, 1)]
    assert rows(profile.profile(df, approx=False)) == expected
    assert rows(profile.profile(df)) == expected


def test_duplicates_and_checks(spark):
    df = spark.createDataFrame(
        [("a", "TN", "5"), ("a", "Texas", "-1"), ("b", "", "x"), ("c", None, "99")],
        "k string, s string, b string")
    assert rows(profile.duplicate_keys(df, ["k"])) == [("a", 2)]
    assert tuple(profile.duplicate_summary(df, ["k"]).first()) == (4, 3, 1, 1)
    assert profile.count_nonmatching(df, "s", "^[A-Z]{2}$").first()[0] == 1
    assert rows(profile.missing_count(df, ["k", "s"])) == [("k", 0), ("s", 2)]
    assert tuple(profile.range_violations(df, "b", 0, 50).first()) == (1, 1)
    assert profile.distinct_count(df, ["k"]).first()[0] == 3
    assert profile.distinct_count(df, ["k"], approx=True).first()[0] == 3
    assert profile.sample_rows(df, 2).count() == 2


def test_label_summary(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (None,)], "y int")
    row = profile.label_summary(df, "y").first()
    assert (row.labelled, row.unlabelled, row.positives, row.classes) == (3, 1, 1, 2)
    assert row.base_rate == pytest.approx(1 / 3)


def test_ranges_and_spread(spark):
    wide = spark.createDataFrame([("r", 3, 0.5), ("s", 9, None)], "g string, a int, b double")
    long = profile.unpivot_metrics(wide, ["g"], ["a", "b"])
    assert rows(profile.metric_spread(long)) == [("a", 2, 3.0, 9.0), ("b", 1, 0.5, 0.5)]
    checked = profile.check_ranges(long.filter("g = 'r'"), {"a": (1, 2), "b": (0, 1), "z": (0, 1)})
    assert rows(checked) == [("a", 3.0, 1.0, 2.0, False), ("b", 0.5, 0.0, 1.0, True),
                             ("z", None, 0.0, 1.0, False)]


# Ranks.

def brute_percentile(values, q):
    xs = sorted(values)
    pos = q * (len(xs) - 1)
    lo = int(pos)
    hi = min(lo + 1, len(xs) - 1)
    return xs[lo] + (xs[hi] - xs[lo]) * (pos - lo)


@pytest.mark.parametrize("q", [0.0, 0.25, 0.5, 0.9, 1.0])
def test_exact_percentile_against_brute_force(spark, q):
    rng = random.Random(3)
    data = [(rng.choice(["a", "b", None]),
             rng.choice([5.0, round(rng.uniform(-5e6, 5e6), 2), round(rng.uniform(0, 9), 2), None]))
            for _ in range(900)] + [("one", 7.25)] + [("hot", 1.5)] * 500
    df = spark.createDataFrame(data, "g string, x double")
    got = {r.g: r.percentile for r in ranks.exact_percentile(df, ["g"], "x", q).collect()}
    for g in {"a", "b", None, "one", "hot"}:
        values = [x for k, x in data if k == g and x is not None]
        assert got[g] == pytest.approx(brute_percentile(values, q), abs=1e-9)
    every = ranks.exact_percentile(df, [], "x", q).first()[0]
    assert every == pytest.approx(
        brute_percentile([x for _, x in data if x is not None], q), abs=1e-9)


def test_exact_percentile_matches_spark(spark):
    df = spark.range(5000).select(
        (F.col("id") % 7).alias("g"),
        (F.round(F.rand(5) * 1e9) / 100).alias("x"))
    df = spark.createDataFrame(df.collect(), df.schema)
    ours = ranks.exact_percentile(df, ["g"], "x")
    theirs = df.groupBy("g").agg(F.expr("percentile(x, 0.5)").alias("percentile"))
    a, b = dict(rows(ours)), dict(rows(theirs))
    assert a.keys() == b.keys() and all(a[k] == pytest.approx(b[k], abs=1e-6) for k in a)


def test_average_rank(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (0.2,), (0.9,), (None,)], "s double")
    assert rows(ranks.average_rank(df, "s")) == [(0.1, 1, 1.0), (0.2, 2, 2.5), (0.9, 1, 4.0)]


def auc(spark, pairs):
    df = spark.createDataFrame(pairs, "s double, y int")
    return tuple(ranks.rank_auc(df, "s", "y").first())


def test_rank_auc(spark):
    assert auc(spark, [(0.9, 1), (0.8, 1), (0.1, 0)]) == (2, 1, 1.0)
    assert auc(spark, [(0.1, 1), (0.8, 0)]) == (1, 1, 0.0)
    assert auc(spark, [(0.5, 1), (0.5, 0), (0.5, 0)]) == (1, 2, 0.5)
    pos, neg, value = auc(spark, [(0.5, 1), (0.6, 1)])
    assert (pos, neg) == (2, 0) and value != value
    rng = random.Random(1)
    pairs = [(round(rng.random(), 2) * rng.choice([1, 50]), rng.randint(0, 1)) for _ in range(400)]
    brute = [(1.0 if p > n else 0.5 if p == n else 0.0)
             for p, a in pairs if a for n, b in pairs if not b]
    assert auc(spark, pairs)[2] == pytest.approx(sum(brute) / len(brute))


# Planted defects.

def test_plant_counts_what_it_plants(spark):
    df = spark.range(4000).select(F.concat(F.lit("K"), "id").alias("k"), F.lit("5").alias("v"))
    rules = [d.Defect("negative", "v", "concat('-', v)", 0.05), d.Defect("blank", "v", "''", 0.01)]
    damaged = d.plant(df, "k", rules, seed=1)
    counts = dict(rows(d.planted_counts(df, "k", rules, 1, {"copies": 0.02})))
    assert 120 < counts["negative"] < 280 and 10 < counts["blank"] < 80
    assert damaged.filter("v = ''").count() == counts["blank"]
    assert damaged.filter("v <> '5'").count() >= max(counts["negative"], counts["blank"])
    assert damaged.columns == df.columns
    copied = d.plant_copies(df, "k", "copies", 0.02, 1, {"v": "'old'"})
    assert copied.count() == 4000 + counts["copies"]
    assert copied.filter("v = 'old'").count() == counts["copies"]
    again = d.plant(df, "k", rules, seed=1)
    assert damaged.exceptAll(again).count() == 0
    assert damaged.exceptAll(d.plant(df, "k", rules, seed=2)).count() > 0


def test_caught_counts(spark):
    df = spark.range(2000).select(F.concat(F.lit("K"), "id").alias("k"), F.lit("5").alias("v"))
    rules = [d.Defect("seen", "v", "'x'", 0.05), d.Defect("unseen", "v", "'9'", 0.02)]
    damaged = d.plant(df, "k", rules, seed=4)
    bad = damaged.filter("v = 'x'")
    got = {r.defect: r for r in d.caught_counts(df, "k", rules, 4, bad.unionAll(bad)).collect()}
    counts = dict(rows(d.planted_counts(df, "k", rules, 4)))
    assert {n: r.planted for n, r in got.items()} == counts
    both = df.filter(d.hits(rules[0], "k", 4) & d.hits(rules[1], "k", 4)).count()
    assert (got["seen"].caught, got["unseen"].caught) == (counts["seen"] - both, 0)


def test_watched_writes_count_what_a_scan_counts(spark, tmp_path):
    df = spark.createDataFrame([(i, None if i % 7 == 0 else float(i - 20)) for i in range(200)],
                               "id long, x double").repartition(5)
    rules = [quality.Rule("not_negative", "x >= 0"), quality.Rule("small", "x < 100", "warn")]
    counted, watch = quality.watch(df, rules, "t")
    counted.write.parquet(str(tmp_path / "t"))
    assert rows(quality.watched_metrics(spark, [watch])) == rows(
        quality.expectation_metrics(df, rules, "t"))
    counted, watch = quality.watch(df, rules, "t", seen="id < 50")
    counted.write.parquet(str(tmp_path / "u"))
    assert watch.rows() == [("t", "not_negative", "drop", 25, 25), ("t", "small", "warn", 42, 8)]
    counted, watch = quality.watch(df.limit(0), rules, "t")
    counted.write.parquet(str(tmp_path / "v"))
    assert [r[3:] for r in watch.rows()] == [(0, 0), (0, 0)]


def test_watched_build_needs_no_further_scan(spark):
    """The counts of a build come from its writes: one aggregate less, and no plan of their own."""
    df = spark.range(100).withColumn("x", F.col("id") % 5)
    counted, _ = quality.watch(df, [quality.Rule("r", "x > 0")], "t")
    assert "CollectMetrics" in counted._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in counted._jdf.queryExecution().executedPlan().toString()


def test_coverage_pairs_defects_with_rules(spark):
    df = spark.createDataFrame(
        [(True, False, 1), (True, True, 5), (False, True, 9), (False, False, 9),
         (False, False, 1), (None, False, None)], "a boolean, b boolean, x int")
    got = quality.coverage(df, {"a": F.col("a"), "b": F.col("b")},
                           {"high": F.col("x") > 4, "top": F.col("x") > 8})
    assert rows(got, "planted", "fired", "n") == [
        ("a", "high", 1), ("a", "none", 1), ("b", "high", 2), ("b", "top", 1),
        ("none", "high", 1), ("none", "none", 2), ("none", "top", 1)]
    assert quality.coverage(df.limit(0), {"a": F.col("a")}, {"h": F.col("x") > 4}).count() == 0


def test_a_run_is_entered_once(spark, tmp_path):
    ledger = str(tmp_path / "ledger")
    metric = lambda x: spark.createDataFrame([("n", x), ("share", None)], "metric string, value double")
    assert profile.record_run(metric(1.0), ledger, "a")
    assert not profile.record_run(metric(5.0), ledger, "a")
    (tmp_path / "ledger" / "run=b").mkdir()          # a run that was cut short
    (tmp_path / "ledger" / "run=b" / "part-0.parquet").write_bytes(b"half")
    assert profile.record_run(metric(3.0), ledger, "b")
    assert rows(profile.recorded_runs(spark, ledger)) == [
        ("a", "n", 1.0), ("a", "share", None), ("b", "n", 3.0), ("b", "share", None)]
    assert rows(profile.metric_spread(profile.recorded_runs(spark, ledger))) == [
        ("n", 2, 1.0, 3.0), ("share", 0, None, None)]
    for bad in ("", "a/b", "../x", "a=b"):
        with pytest.raises(ValueError, match="named"):
            profile.record_run(metric(1.0), ledger, bad)
