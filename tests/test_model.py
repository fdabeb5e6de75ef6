import pytest
from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import Observation
from pyspark.sql import functions as F

from assay.functions import values as v
from assay.functions.features import churn_features
from assay.operators import model as m
from assay.operators import preparation as prep
from assay.session import new_folder, stage

from .helpers import rows


@pytest.fixture(scope="module")
def rows_(spark):
    x = F.col("id")
    risk = F.rand(11)
    df = spark.range(1200).select(
        F.concat(F.lit("C"), x).alias("customer_id"),
        (x % 17).cast("double").alias("tenure_years"), (x * 37 % 991).cast("double")
        .alias("total_balance"),
        F.when(x % 50 == 0, float("inf")).otherwise((x % 7).cast("double"))
        .alias("avg_account_balance"),
        (x % 3).alias("num_accounts"), (x % 23).alias("txn_count"),
        (x % 5).alias("debit_swipe_count"), (x % 11).cast("double").alias("total_spend"),
        (x % 60 + 20).alias("age"),
        F.when(x % 4 == 0, "private").otherwise("mass_market").alias("segment"),
        F.when(x % 9 == 0, None).otherwise("branch").alias("acquisition_channel"),
        F.lit("East").alias("region"), F.lit("TN").alias("home_state"),
        F.when(x % 10 == 9, None)
         .otherwise((risk < F.when(x % 17 < 6, 0.8).otherwise(0.2)).cast("int"))
         .alias("attrition_flag"),
        F.lit("active").alias("customer_status"))
    return stage(m.with_split(m.feature_table(df)), "model-test")


@pytest.fixture(scope="module")
def fitted(rows_):
    labelled, _ = m.split_labelled(rows_)
    return m.fit_churn(labelled.filter("split = 'train'"), trees=5)


def test_feature_table_cleans_and_refuses_leaks(spark, rows_):
    assert rows_.filter("avg_account_balance = double('Infinity')").count() == 0
    assert rows_.filter("acquisition_channel = 'unknown'").count() > 0
    for leak in v.CHURN_LEAKS:
        with pytest.raises(ValueError, match=leak):
            m.feature_table(rows_, numeric=[leak])


def test_split_is_stratified_and_repeatable(rows_):
    labelled, open_rows = m.split_labelled(rows_)
    assert labelled.count() + open_rows.count() == rows_.count()
    train, test = m.stratified_split(labelled.drop("split"))
    assert train.count() + test.count() == labelled.count()
    shares = [r[1] for r in labelled.groupBy("attrition_flag").agg(
        F.avg((F.col("split") == "test").cast("int"))).collect()]
    assert all(0.18 < s < 0.32 for s in shares)
    again = m.stratified_split(labelled.drop("split"))[1]
    assert test.exceptAll(again).count() == 0
    assert test.join(train, "customer_id").count() == 0


def test_fit_score_and_evaluate(rows_, fitted):
    labelled, open_rows = m.split_labelled(rows_)
    scored = m.score(fitted, open_rows)
    assert scored.count() == open_rows.count()
    assert scored.filter("churn_score NOT BETWEEN 0 AND 1").count() == 0
    wrong = scored.filter("""risk_band <> CASE WHEN churn_score >= 0.6 THEN 'high'
                             WHEN churn_score >= 0.35 THEN 'medium' ELSE 'low' END""")
    assert wrong.count() == 0
    result = m.evaluate(fitted, labelled.filter("split = 'test'")).first()
    assert 0.65 < result.auc < 0.95 and result.verdict in ("ok", "weak features")
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    spark_auc = BinaryClassificationEvaluator(
        labelCol="attrition_flag", rawPredictionCol="probability", numBins=0).evaluate(
            fitted.transform(labelled.filter("split = 'test'")))
    assert result.auc == pytest.approx(spark_auc, abs=1e-6)


def test_unseen_category_is_scored(rows_, fitted):
    odd = rows_.limit(3).withColumn("segment", F.lit("never seen"))
    assert m.score(fitted, odd).count() == 3


def test_importances_name_every_slot(rows_, fitted):
    top = m.importances(fitted, rows_, 10).collect()
    assert top[0].feature == "tenure_years"
    assert top == sorted(top, key=lambda r: -r.importance)
    names = m._feature_names(fitted, rows_)
    assert {"age", "segment_private", "segment_mass_market"} <= set(names)


def test_reload_gives_the_same_scores(spark, rows_, fitted):
    path = new_folder(spark, "model")
    m.save_model(fitted, path)
    a = m.score(fitted, rows_).select("customer_id", "churn_score")
    b = m.score(m.load_model(path), rows_).select("customer_id", "churn_score")
    assert a.exceptAll(b).count() == 0


def test_baseline_and_guards(rows_):
    labelled, _ = m.split_labelled(rows_)
    from assay.functions.features import churn_features
    model = m.fit_baseline(labelled.filter("split = 'train'"))
    named = m.coefficients(model, churn_features(rows_)).collect()
    assert named[0].feature == "tenure_clipped" and named[0].coefficient < 0
    assert len(named) == len(v.SCORECARD)
    with pytest.raises(ValueError, match="two classes"):
        m.fit_churn(labelled.filter("attrition_flag = 1"))
    with pytest.raises(ValueError, match="algorithm"):
        m.fit_churn(labelled, "forest")


def test_exact_split_takes_a_quarter_of_each_class(spark, rows_):
    whole = rows_.drop("split")
    got = m.exact_split(whole)
    assert got.columns == [*whole.columns, "split"]
    counts = got.groupBy("attrition_flag").agg(
        F.count("*").alias("n"), F.count_if(F.col("split") == "test").alias("test")).collect()
    assert {r.attrition_flag for r in counts} == {0, 1, None}
    assert all(0 <= r.test - r.n / 4 < 1 for r in counts)
    again = m.exact_split(whole.repartition(5))
    assert got.exceptAll(again).count() == 0 and got.drop("split").exceptAll(whole).count() == 0
    twice = m.exact_split(whole.union(whole).union(whole))  # keys that repeat
    n, test = twice.agg(F.count("*"), F.count_if(F.col("split") == "test")).first()
    assert n == 3600 and 900 <= test < 903
    other = m.exact_split(whole, seed=7)
    assert other.exceptAll(got).count() > 0
    assert m.exact_split(whole.limit(0)).count() == 0


def test_medians_are_exact_and_saved(spark, tmp_path):
    df = spark.createDataFrame(
        [(1.0, None, None), (2.0, 5.0, None), (10.0, float("nan"), None), (4.0, 7.0, None)],
        "a double, b double, c double")
    fitted = prep.MedianImputer(inputCols=["a", "b", "c"], outputCols=["x", "y", "z"]).fit(df)
    want = [(1.0, 6.0, 0.0), (2.0, 5.0, 0.0), (4.0, 7.0, 0.0), (10.0, 6.0, 0.0)]
    assert sorted(rows(fitted.transform(df), "x", "y", "z")) == want
    assert fitted.getOrDefault(fitted.medians) == [3.0, 6.0, 0.0]
    fitted.save(str(tmp_path / "imputer"))
    again = prep.MedianImputerModel.load(str(tmp_path / "imputer"))
    assert sorted(rows(again.transform(df), "x", "y", "z")) == want
    same = prep.MedianImputer(inputCols=["a"], outputCols=["a"]).fit(df).transform(df)
    assert same.columns == df.columns


def test_fifty_thousand_categories(spark, tmp_path):
    n = 50_000
    df = spark.range(n + 3 * n // 2).select(
        F.concat(F.lit("c"), F.col("id") % n).alias("many"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise("cold").alias("few"))
    fitted = prep.CategoryIndexer(inputCols=["many", "few"], outputCols=["i", "j"]).fit(df)
    assert fitted.getOrDefault(fitted.sizes) == [n, 2]
    table = fitted.categories(spark).where("column = 0")
    bounds = table.agg(F.min("index"), F.max("index"), F.count_distinct("index")).first()
    assert tuple(bounds) == (0, n - 1, n)
    first = table.orderBy("index").first()
    assert (first.category, first.n) == ("c0", 3)
    odd = spark.createDataFrame([("c1", "hot"), ("new", None)], "many string, few string")
    assert rows(fitted.transform(odd), "i", "j") == [(1.0, 1.0), (float(n), 2.0)]
    fitted.save(str(tmp_path / "index"))
    again = prep.CategoryIndexerModel.load(str(tmp_path / "index"))
    assert rows(again.transform(odd), "i", "j") == [(1.0, 1.0), (float(n), 2.0)]
    assert str(tmp_path) in again.getOrDefault(again.table)
    hot = OneHotEncoder(inputCols=["i"], outputCols=["v"], handleInvalid="keep").fit(
        fitted.transform(odd)).transform(fitted.transform(odd))
    assert [r.v.size for r in hot.collect()] == [n, n]
    assert sorted(r.v.numNonzeros() for r in hot.collect()) == [0, 1]


def test_permuting_a_feature_that_counts_costs_auc(spark):
    df = spark.range(800).select(
        F.concat(F.lit("k"), "id").alias("customer_id"), (F.col("id") % 10).alias("good"),
        (F.col("id") % 7).alias("noise"), (F.col("id") % 10 > 4).cast("int").alias("attrition_flag"))
    got = {r.feature: r for r in m.permutation_importance(
        df, ["good", "noise"], lambda x: x.withColumn("s", F.col("good") + 0 * F.col("noise")),
        "s").collect()}
    assert got["good"].auc == got["noise"].auc == 1.0
    assert got["noise"].drop == 0.0 and 0.35 < got["good"].drop < 0.65


def test_fit_reads_as_many_pieces_as_cores(spark, monkeypatch):
    assert [m.fit_pieces(n, 12) for n in (0, 1, 20_000, 20_001, 200_000, 900_000, 30_000_000)] \
        == [1, 1, 1, 2, 10, 12, 30]
    written = []
    monkeypatch.setattr(m, "ROWS_TO_SPLIT", 100)
    monkeypatch.setattr(m, "stage", lambda df, name: written.append(stage(df, name)) or written[-1])
    rows = spark.range(900).select(
        F.col("id").cast("string").alias("customer_id"), F.rand(1).alias("x"),
        (F.col("id") % 2).cast("int").alias("attrition_flag"))
    m.fit_churn(stage(rows, "pieces"), "logistic", ["x"], ())
    counts = [r["count"] for r in written[0].groupBy(F.input_file_name()).count().collect()]
    assert len(counts) == spark.sparkContext.defaultParallelism == 4 and max(counts) < 300


def test_logistic_model_scores_in_a_session_that_observed(spark, rows_):
    """A watched write gives the session an observation manager, which no task can be sent."""
    seen = Observation()
    spark.range(3).observe(seen, F.count("*").alias("n")).write.parquet(
        new_folder(spark, "observed"))
    assert seen.get == {"n": 3}
    labelled = m.split_labelled(rows_)[0]
    model = m.fit_baseline(labelled.filter("split = 'train'"))
    scored = stage(m.score(model, churn_features(labelled)), "scored")
    assert scored.count() == labelled.count()
