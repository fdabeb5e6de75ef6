"""Churn model on Spark ML: features, split, fit, evaluate, score."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import OneHotEncoder, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import values as v
from ..functions.columns import clean_numeric, fill_defaults, threshold_band, whole_share
from ..functions.features import churn_features
from ..session import new_folder, stage
from .preparation import CategoryIndexer, CategoryIndexerModel, MedianImputer
from .ranks import _match, rank_auc, totals_before


ROWS_TO_SPLIT = 20_000
ROWS_PER_PIECE = 1_000_000


def feature_table(df: DataFrame, numeric: Sequence[str] = v.CHURN_NUMERIC,
                  categorical: Sequence[str] = v.CHURN_CATEGORICAL,
                  label: str = v.CHURN_LABEL, key: str = "customer_id") -> DataFrame:
    """Key, features and label. Columns that give the label away are refused."""
    leaks = sorted(v.CHURN_LEAKS & {*numeric, *categorical})
    if leaks:
        raise ValueError(f"not allowed as features: {leaks}")
    table = clean_numeric(df.select(key, *numeric, *categorical, label), numeric)
    return fill_defaults(table, {c: "unknown" for c in categorical})


def split_labelled(df: DataFrame, label: str = v.CHURN_LABEL) -> tuple[DataFrame, DataFrame]:
    """Rows with an outcome, and the rows to be scored."""
    return df.filter(F.col(label).isNotNull()), df.filter(F.col(label).isNull())


def with_split(df: DataFrame, label: str = v.CHURN_LABEL, key: str = "customer_id",
               test: float = 0.25, seed: int = 42) -> DataFrame:
    """Add ``split``: train or test, drawn per row by a hash of label and key.

    Every class gets the same share without sorting or counting it; the draw is the same in
    every run.
    """
    share = whole_share(F.concat_ws(":", F.col(label).cast("string"), F.col(key)), f"{seed}:")
    return df.withColumn("split", F.when(share < F.lit(float(test)), "test").otherwise("train"))


def stratified_split(df: DataFrame, label: str = v.CHURN_LABEL, key: str = "customer_id",
                     test: float = 0.25, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    split = with_split(df, label, key, test, seed)
    return (split.filter("split = 'train'").drop("split"),
            split.filter("split = 'test'").drop("split"))


def exact_split(df: DataFrame, label: str = v.CHURN_LABEL, key: str = "customer_id",
                test: float = 0.25, seed: int = 42) -> DataFrame:
    """Add ``split``: of each class, the first ``test`` of the rows in the order of a hash of label
    and key are test rows, so its share is missed by less than one row. Rows without a label are a
    class too. No class is sorted in one task (``ranks.totals_before``)."""
    place = F.concat(F.md5(F.concat(F.lit(f"{seed}:"), F.concat_ws(
        ":", F.col(label).cast("string"), F.col(key)))), F.lit(":"), F.col(key))
    ranked = totals_before(df.withColumns({"__place": place, "__one": F.lit(1)}), [label],
                           "__place", ["__one"])
    sizes = ranked.groupBy(label).agg(F.count("*").alias("__size"))
    first = F.col("__one_before") < F.col("__size") * F.lit(float(test))
    return _match(ranked, sizes, [label]).select(
        *df.columns, F.when(first, "test").otherwise("train").alias("split"))


def _check_classes(train: DataFrame, label: str) -> None:
    seen = train.agg(F.min(label).alias("low"), F.max(label).alias("high")).first()
    if seen["low"] is None or seen["low"] == seen["high"]:
        raise ValueError("the label has fewer than two classes")


def fit_pieces(rows: int, cores: int) -> int:
    """In how many pieces a fit reads its rows. It has hundreds of passes: each shall keep all cores
    busy, but not with tasks of a few rows, and no piece shall outgrow a task."""
    return max(1, min(cores, -(-rows // ROWS_TO_SPLIT)), -(-rows // ROWS_PER_PIECE))


def fit_churn(train: DataFrame, algo: str = "gbt", numeric: Sequence[str] = v.CHURN_NUMERIC,
              categorical: Sequence[str] = v.CHURN_CATEGORICAL, label: str = v.CHURN_LABEL,
              trees: int = 100, seed: int = 42) -> PipelineModel:
    """Exact medians for missing numbers, one-hot categories of any number (unseen ones get no
    column) and a classifier.

    Stage the training table first: several steps of the preparation read it.
    """
    if algo not in ("gbt", "logistic"):
        raise ValueError(f"unknown algorithm: {algo}")
    _check_classes(train, label)
    assembled = [f"{c}_num" for c in numeric]
    steps = [MedianImputer(inputCols=list(numeric), outputCols=assembled)]
    if categorical:
        steps += [
            CategoryIndexer(inputCols=list(categorical),
                            outputCols=[f"{c}_idx" for c in categorical]),
            # The place for unseen categories is the last, which is dropped.
            OneHotEncoder(inputCols=[f"{c}_idx" for c in categorical], handleInvalid="keep",
                          outputCols=[f"{c}_hot" for c in categorical]),
        ]
        assembled = assembled + [f"{c}_hot" for c in categorical]
    steps.append(VectorAssembler(inputCols=assembled, outputCol="raw_features"))
    prepared = Pipeline(stages=steps).fit(train)
    # The joins of the preparation run once, and every pass of the fit reads what they left.
    vectors = prepared.transform(train).select(label, "raw_features")
    pieces = fit_pieces(train.count(), train.sparkSession.sparkContext.defaultParallelism)
    ready = stage(vectors.repartition(pieces) if pieces > 1 else vectors.hint("rebalance"),
                  "prepared")
    if algo == "gbt":
        last = [GBTClassifier(featuresCol="raw_features", labelCol=label, maxIter=trees,
                              maxDepth=3, stepSize=0.1, seed=seed)]
    else:
        last = [
            StandardScaler(inputCol="raw_features", outputCol="features", withMean=True,
                           withStd=True),
            LogisticRegression(featuresCol="features", labelCol=label, maxIter=400, tol=1e-11,
                               regParam=1e-4, elasticNetParam=0.0, standardization=False),
        ]
    fitted = Pipeline(stages=last).fit(ready)
    if algo == "logistic":
        # A fresh logistic model keeps its training summary, and with it the session, which tasks
        # cannot be sent once anything was observed in it. A loaded model has its weights alone.
        path = new_folder(train.sparkSession, "fitted")
        save_model(fitted, path)
        fitted = load_model(path)
    return PipelineModel([*prepared.stages, *fitted.stages])


def fit_baseline(train: DataFrame, label: str = v.CHURN_LABEL) -> PipelineModel:
    """Logistic regression on the seven scorecard features, standardised on the training rows."""
    return fit_churn(churn_features(train), "logistic", list(v.SCORECARD), (), label)


def risk_band(df: DataFrame, score: str = "churn_score", out: str = "risk_band") -> DataFrame:
    return df.withColumn(out, threshold_band(score, v.RISK_BANDS))


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """The input with the probability of leaving and its risk band."""
    scored = model.transform(df).withColumn(
        "churn_score", vector_to_array("probability")[1])
    return risk_band(scored.select(*df.columns, "churn_score"))


def evaluate(model: PipelineModel, test: DataFrame, label: str = v.CHURN_LABEL) -> DataFrame:
    """Exact AUC on the test rows, with a verdict on suspicious values."""
    auc = rank_auc(score(model, test), "churn_score", label)
    return auc.withColumn(
        "verdict",
        F.when(F.isnan("auc"), "one class only")
         .when(F.col("auc") > v.AUC_LEAK, "probable leakage")
         .when(F.col("auc") < v.AUC_WEAK, "weak features").otherwise("ok"))


def _feature_names(model: PipelineModel, df: DataFrame) -> list[str]:
    """Names of the assembled vector's slots, one-hot columns by their categories; as many as the
    model has weights."""
    names = {}
    for step in model.stages:
        if isinstance(step, CategoryIndexerModel):
            columns = step.getInputCols()
            names = {f"{columns[r['column']]}_hot_{int(r['index'])}":
                     f"{columns[r['column']]}_{r['category']}"
                     for r in step.categories(df.sparkSession).collect()}
    metadata = model.transform(df.limit(0)).schema["raw_features"].metadata["ml_attr"]["attrs"]
    slots = sorted((a["idx"], a["name"]) for group in metadata.values() for a in group)
    return [names.get(name) or name.removesuffix("_num") for _, name in slots]


def importances(model: PipelineModel, df: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` most important features; one short vector that the model already holds."""
    weights = model.stages[-1].featureImportances.toArray()
    return _ranked(df.sparkSession, _feature_names(model, df), weights, "importance", k)


def coefficients(model: PipelineModel, df: DataFrame, k: int | None = None) -> DataFrame:
    """Named standardised coefficients of a logistic model, greatest size first; all of them
    unless ``k`` asks for fewer."""
    weights = model.stages[-1].coefficients.toArray()
    return _ranked(df.sparkSession, _feature_names(model, df), weights, "coefficient", k)


def _ranked(spark: SparkSession, names, weights, out: str, k: int | None) -> DataFrame:
    pairs = [(n, float(w)) for n, w in zip(names, weights, strict=True)]
    ranked = (spark.createDataFrame(pairs, f"feature string, {out} double")
              .orderBy(F.abs(out).desc(), "feature"))
    return ranked if k is None else ranked.limit(k)


def permutation_importance(df: DataFrame, features: Sequence[str],
                           score: Callable[[DataFrame], DataFrame], out: str,
                           label: str = v.CHURN_LABEL, key: str = "customer_id", seed: int = 42
                           ) -> DataFrame:
    """(feature, auc, permuted_auc, drop): how much the exact AUC of ``score(df)[out]`` loses when
    one feature's values are dealt out anew.

    The row that comes n-th by its key gets the value of the row that comes n-th by a hash of feature
    and key. Both orders are distributed ranks, and a join on n brings them together; all features
    are scored in one pass over the rows.
    """
    df = df.withColumns({f: F.col(f).cast("double") for f in features})
    rows = totals_before(df.withColumn("__one", F.lit(1)), [], key, ["__one"])
    values = df.select(F.col(key).alias("__key"), F.inline(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f).alias("__value")) for f in features],
        F.struct(F.lit("").alias("feature"), F.lit(0.0).alias("__value")))))  # rows as they are
    place = F.concat(F.md5(F.concat(F.lit(f"{seed}:"), "feature", F.lit(":"), "__key")),
                     F.lit(":"), F.col("__key"))
    donors = totals_before(values.withColumns({"__place": place, "__n": F.lit(1)}), ["feature"],
                           "__place", ["__n"]).select("feature", "__n_before", "__value")
    dealt = rows.join(donors, F.col("__one_before") == F.col("__n_before")).withColumns({
        f: F.when(F.col("feature") == f, F.col("__value")).otherwise(F.col(f)) for f in features})
    scored = rank_auc(score(dealt), out, label, by=["feature"]).groupBy().agg(
        F.collect_list(F.struct("feature", "auc")).alias("all"))  # a row per feature
    whole = F.filter("all", lambda x: x["feature"] == "")[0]["auc"]
    return scored.select(whole.alias("auc"), F.explode(
        F.filter("all", lambda x: x["feature"] != "")).alias("one")).select(
        "one.feature", "auc", F.col("one.auc").alias("permuted_auc"),
        (F.col("auc") - F.col("one.auc")).alias("drop"))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
