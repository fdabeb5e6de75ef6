"""Steps of a feature pipeline that Spark ML has only in approximate or bounded form: exact medians
and categories without a limit. Both can be saved and loaded with the pipeline they are part of."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import (
    DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter,
    MLReadable, MLReader, MLWritable, MLWriter,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_folder
from .ranks import exact_percentile, totals_before


class _InOut(HasInputCols, HasOutputCols):
    def _pairs(self) -> list[tuple[str, str]]:
        return list(zip(self.getInputCols(), self.getOutputCols(), strict=True))


def _long(df: DataFrame, columns: list[str], kind: str) -> DataFrame:
    """(column, value): all values of some columns, by the place of the column."""
    return df.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("column"), F.col(c).cast(kind).alias("value"))
        for i, c in enumerate(columns)])))


class MedianImputer(Estimator, _InOut, DefaultParamsReadable, DefaultParamsWritable):
    """Puts the exact median of the training rows, interpolated between the middle two, where a
    number is NULL or NaN. A column without any number gets 0."""

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, outputCols: list[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> MedianImputerModel:
        values = _long(dataset, self.getInputCols(), "double")
        found = {r["column"]: r["median"] for r in
                 exact_percentile(values, ["column"], "value", 0.5, "median").collect()}
        model = MedianImputerModel(
            medians=[found.get(i, 0.0) for i in range(len(self.getInputCols()))])
        return self._copyValues(model)


class MedianImputerModel(Model, _InOut, DefaultParamsReadable, DefaultParamsWritable):
    medians = Param(Params._dummy(), "medians", "median of each input column",
                    TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, medians: list[float] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        medians = self.getOrDefault(self.medians)
        return dataset.withColumns({
            out: F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")),
                            F.lit(m))
            for (c, out), m in zip(self._pairs(), medians)})


class CategoryIndexer(Estimator, _InOut, DefaultParamsReadable, DefaultParamsWritable):
    """Numbers the categories of each column from 0, the most frequent first, equal ones in their
    own order. There may be any number of them: they are counted, ranked and kept as a table."""

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, outputCols: list[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> CategoryIndexerModel:
        counts = (_long(dataset, self.getInputCols(), "string").where("value IS NOT NULL")
                  .groupBy("column", "value").agg(F.count("*").alias("n"))
                  .withColumns({"place": F.struct(-F.col("n"), "value"), "one": F.lit(1)}))
        ranked = totals_before(counts, ["column"], "place", ["one"]).select(
            "column", F.col("value").alias("category"), "n",
            F.col("one_before").cast("double").alias("index"))
        path = new_folder(dataset.sparkSession, "categories")
        ranked.write.parquet(path)
        sizes = dict(dataset.sparkSession.read.schema(ranked.schema).parquet(path)
                     .groupBy("column").count().collect())
        model = CategoryIndexerModel(
            table=path, sizes=[sizes.get(i, 0) for i in range(len(self.getInputCols()))])
        return self._copyValues(model)


class CategoryIndexerModel(Model, _InOut, MLWritable, MLReadable):
    """A category that the training rows lack, or NULL, gets the number after the last."""

    table = Param(Params._dummy(), "table", "path of the numbered categories",
                  TypeConverters.toString)
    sizes = Param(Params._dummy(), "sizes", "number of categories of each input column",
                  TypeConverters.toListInt)

    @keyword_only
    def __init__(self, *, table: str | None = None, sizes: list[int] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def categories(self, spark: SparkSession) -> DataFrame:
        """(column, category, n, index), ``column`` being the place of the input column."""
        return spark.read.schema("column int, category string, n long, index double").parquet(
            self.getOrDefault(self.table))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        known = self.categories(dataset.sparkSession)
        for i, ((c, out), size) in enumerate(zip(self._pairs(), self.getOrDefault(self.sizes))):
            own = known.where(F.col("column") == i).select(
                F.col("category").alias("__category"), F.col("index").alias("__index"))
            # The number of categories tells the encoder its width, so it needs no pass.
            kind = {"ml_attr": {"type": "nominal", "name": out, "num_vals": max(size, 1)}}
            dataset = dataset.join(
                own, F.col(c).cast("string") == F.col("__category"), "left").withColumn(
                out, F.coalesce("__index", F.lit(float(size))).alias(out, metadata=kind)).drop(
                "__category", "__index")
        return dataset

    def write(self) -> MLWriter:
        return _IndexWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _IndexReader(cls)


class _IndexWriter(DefaultParamsWriter):
    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        self.instance.categories(self.sparkSession).write.parquet(f"{path}/categories")


class _IndexReader(DefaultParamsReader):
    def load(self, path: str) -> CategoryIndexerModel:
        model = super().load(path)
        return model._set(table=f"{path}/categories")
