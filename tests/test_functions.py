import datetime as dt

import pytest
from pyspark.sql import functions as F

from assay.functions import columns as c
from assay.functions import money
from assay.functions import values as v
from assay.functions.features import churn_features, scorecard

from .helpers import rows


def one(spark, column, value, kind="string"):
    df = spark.createDataFrame([(value,)], f"x {kind}")
    return df.select(column).first()[0]


@pytest.mark.parametrize("text,expected", [
    ("2020-02-29", dt.date(2020, 2, 29)), ("02/29/2020", dt.date(2020, 2, 29)),
    ("1999-12-31", dt.date(1999, 12, 31)), ("", None), (None, None), ("2020-13-40", None),
    ("31/12/1999", None), ("02/29/2021", None), ("abc", None),
])
def test_parse_date(spark, text, expected):
    assert one(spark, c.parse_date("x", v.DATE_FORMATS), text) == expected


@pytest.mark.parametrize("text,expected", [
    ("TN", "TN"), ("tn", "TN"), ("Tennessee", "TN"), ("TENNESSEE", "TN"), ("ZZ", "ZZ"),
    ("north carolina", "NC"), (None, None),
])
def test_standardize(spark, text, expected):
    assert one(spark, c.standardize("x", v.STATE_CODES), text) == expected


def test_lookup_quotes(spark):
    mapping = {"it's": "a\\b", "plain": "p"}
    df = spark.createDataFrame([("it's",), ("plain",), ("none",)], "x string")
    assert rows(df.select("x", c.lookup("x", mapping))) == [
        ("it's", "a\\b"), ("none", None), ("plain", "p")]


@pytest.mark.parametrize("dob,age", [
    # A year has 365.25 days, so only birthdays that are multiples of four years old are exact.
    ("2006-09-01", 20), ("2006-09-02", 19), ("2008-08-31", 18), ("2008-09-01", 17),
    ("1906-09-01", 120), ("1915-08-31", 111), ("1915-09-02", 110), (None, None),
])
def test_age(spark, dob, age):
    assert one(spark, c.age_at(F.col("x").cast("date"), v.AS_OF), dob) == age


@pytest.mark.parametrize("age,label", [
    (17, None), (18, "18-25"), (25, "18-25"), (26, "26-35"), (75, "66-75"), (76, "76+"),
    (110, "76+"), (None, None),
])
def test_band(spark, age, label):
    assert one(spark, c.band("x", v.AGE_BANDS), age, "int") == label


def test_years_between(spark):
    assert one(spark, c.years_between(F.col("x").cast("date"), v.AS_OF), "2016-09-01") == 10.0
    assert one(spark, c.years_between(F.col("x").cast("date"), v.AS_OF), "2026-08-31") == 0.0


@pytest.mark.parametrize("num,den,scale,expected", [
    (1, 3, 4, 0.3333), (2, 3, 4, 0.6667), (1, 32, 4, 0.0313), (5, 5, 3, 1.0), (0, 7, 4, 0.0),
    (1, 0, 4, None),
])
def test_ratio(spark, num, den, scale, expected):
    df = spark.createDataFrame([(num, den)], "a long, b long")
    assert df.select(c.ratio("a", "b", scale)).first()[0] == expected


@pytest.mark.parametrize("amounts,total,average", [
    ([0.01, 0.02], 0.03, 0.02), ([1.0, 2.0, 2.0], 5.0, 1.67), ([0.1] * 10, 1.0, 0.1),
    ([-0.01, -0.02], -0.03, -0.02), ([9999999.99] * 3, 29999999.97, 9999999.99),
])
def test_money(spark, amounts, total, average):
    df = spark.createDataFrame([(a,) for a in amounts], "x double")
    out = df.agg(money.money_sum("x").alias("t"), F.count("*").alias("n"))
    got = out.select(F.col("t").cast("double"), money.money_average("t", "n")).first()
    assert tuple(got) == (total, average)


def test_money_sum_is_exact_beyond_a_long_of_cents(spark):
    df = spark.range(2000).select(F.lit(9.9e15).alias("x"))
    assert df.agg(money.money_sum("x").alias("t")).first()[0] == 2000 * 9900000000000000


def test_average_of_nothing_is_null(spark):
    df = spark.createDataFrame([], "x double").agg(
        money.money_sum("x").alias("t"), F.count("*").alias("n"))
    assert df.select(money.money_average("t", "n"), money.whole_average("t", "n")).first() == (
        None, None)


def test_typed_keeps_rows_that_do_not_parse(spark):
    df = spark.createDataFrame([("1", "2020-01-01", "x"), ("z", "no", "1.5")], "a string, b string, c string")
    out = c.typed(df, {"a": "int", "b": "date", "c": "double"})
    assert rows(out) == [(1, dt.date(2020, 1, 1), None), (None, None, 1.5)]


def test_defaults_and_cleaning(spark):
    df = spark.createDataFrame(
        [("", None, float("inf")), ("a", 1, float("nan")), (None, 2, 2.5)],
        "s string, n int, d double")
    assert rows(c.null_if_empty(df, ["s"]), "s") == [("a",), (None,), (None,)]
    assert rows(c.fill_defaults(df, {"n": 0}), "n") == [(0,), (1,), (2,)]
    assert rows(c.clean_numeric(df, ["n", "d"]), "n", "d") == [
        (1.0, None), (2.0, 2.5), (None, None)]


def test_risk_bands(spark):
    df = spark.createDataFrame([(x,) for x in (0.6, 0.59, 0.35, 0.34, None)], "x double")
    assert [r[0] for r in df.select(c.threshold_band("x", v.RISK_BANDS)).collect()] == [
        "high", "medium", "medium", "low", None]


def test_scorecard(spark):
    df = spark.createDataFrame(
        [(20.0, 10.0, 50, 29, "switch_kit", "private", 1)],
        "tenure_years double, total_balance double, txn_count long, age int, "
        "acquisition_channel string, segment string, num_accounts long")
    row = scorecard(churn_features(df), v.SCORECARD_INTERCEPT, v.SCORECARD).first()
    import math
    z = (1.65 - 0.46 * 15 - 1.15 * (math.log10(50) - 3.5) - 0.15 * 30 + 1.55 + 0.88 - 1.10 + 0.82)
    assert row["z"] == pytest.approx(z)
    assert row["z_probability"] == pytest.approx(1 / (1 + math.exp(-z)))
