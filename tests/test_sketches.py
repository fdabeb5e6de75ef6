import math

from pyspark.sql import functions as F

from assay.operators import profile, sketches

from .helpers import rows


def table(spark, n=60_000):
    return spark.range(n).select(
        F.when(F.col("id") % 10 == 0, None).otherwise(F.col("id") * 7 % n).alias("few_null"),
        F.concat(F.lit("k"), F.col("id") % 5_000).alias("text"),
        F.when(F.col("id") % 4 == 0, float("nan")).otherwise(F.col("id").cast("double"))
        .alias("x"), F.lit(3).alias("same"), F.lit(None).cast("string").alias("none"))


def told(sketched):
    return {r.column_name: r for r in sketches.estimates(
        sketched, {"low": 0.1, "median": 0.5, "high": 0.99}).collect()}


def test_estimates_keep_their_bounds(spark):
    df = table(spark)
    got = told(sketches.sketch(df))
    error = 4 * 1.04 / math.sqrt(2 ** sketches.LG_BUCKETS)
    for r in profile.profile(df, approx=False).collect():
        mine = got[r.column_name]
        assert (mine.row_count, mine.null_count) == (r.row_count, r.null_count)
        assert abs(mine.distinct_count - r.distinct_count) <= error * r.distinct_count
    for q, name in ((0.1, "low"), (0.5, "median"), (0.99, "high")):
        real = df.where("NOT isnan(x)")
        rank = real.where(F.col("x") <= got["x"][name]).count() / real.count()
        assert abs(rank - q) < 0.015
    assert got["same"].median == 3.0 and got["text"].median is None
    assert got["none"].distinct_count == 0 and got["none"].null_count == 60_000


def test_merged_parts_equal_one_pass(spark, tmp_path):
    df, folder = table(spark), str(tmp_path / "kept")
    whole = told(sketches.sketch(df))
    for i in range(3):
        sketches.store(df.where(F.xxhash64("text") % 3 == i - 1), folder, f"p{i}")
    rest = df.where((F.xxhash64("text") % 3).isin(-2, 2))
    sketches.store(rest.limit(10), folder, "rest")
    sketches.store(rest, folder, "rest")   # the repeated run replaces what it left
    sketches.store(df.limit(0), folder, "empty")
    merged = told(sketches.stored(spark, folder))
    for name, one in whole.items():
        assert merged[name][:3] == one[:3]
        assert abs(merged[name].distinct_count - one.distinct_count) <= 0.01 * one.distinct_count
    assert abs(merged["x"].median - whole["x"].median) < 0.03 * 60_000


def test_empty_table(spark):
    got = rows(sketches.estimates(sketches.sketch(table(spark).limit(0)), {"median": 0.5}))
    assert len(got) == 5 and all(r[1:] == (0, 0, 0, None) for r in got)
