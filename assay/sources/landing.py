"""Landing folders: one folder per source, CSV with a header or JSON lines.

Bronze is a faithful copy: every value lands as text, CSV columns are found by the names in each
file's header, and a line that cannot be read keeps its raw text in ``_corrupt_record``.
"""

from __future__ import annotations

import csv
from collections.abc import Sequence
from functools import reduce
from itertools import islice
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.values import (
    ACCOUNT_FIELDS, BRANCH_FIELDS, CUSTOMER_FIELDS, EVENT_FIELDS, TRANSACTION_FIELDS,
)

CORRUPT = "_corrupt_record"

# Columns of each CSV source; everything lands as text.
CSV_SOURCES = {
    "customers": CUSTOMER_FIELDS, "accounts": ACCOUNT_FIELDS, "branches": BRANCH_FIELDS,
    "customer_events": EVENT_FIELDS,
}
JSON_SOURCES = {"card_transactions": TRANSACTION_FIELDS}


def source_fields(source: str) -> list[str]:
    return list(CSV_SOURCES.get(source) or JSON_SOURCES[source])


def landing_schema(source: str) -> StructType:
    """Declared schema, all text, with the raw text of lines that cannot be read."""
    return StructType([StructField(f, StringType()) for f in [*source_fields(source), CORRUPT]])


def with_lineage(df: DataFrame) -> DataFrame:
    """Add the file a row came from and the time it was read; for frames on files only."""
    return df.select("*", F.col("_metadata.file_path").alias("_source_file"),
                     F.current_timestamp().alias("_ingested_at"))


# Far above any file's size: with it each file is one piece, and each piece a task of its own.
_WHOLE_FILE = str(1 << 50)


def first_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(file, line): the first line of every file that has one, by one job.

    Each task opens one file and stops after its first line, so the work grows with the number of
    files and not with their bytes. The settings that deal files out belong to a session of its
    own; the caller's stay.
    """
    own = spark.newSession()
    for name, value in {"spark.sql.files.maxPartitionBytes": _WHOLE_FILE,
                        "spark.sql.files.openCostInBytes": _WHOLE_FILE,
                        "spark.sql.execution.arrow.maxRecordsPerBatch": "1"}.items():
        own.conf.set(name, value)

    def first(batches):
        yield from islice((b for b in batches if b.num_rows), 1)

    lines = own.read.text(paths if isinstance(paths, str) else list(paths))
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line")) \
                .mapInArrow(first, "file string, line string")


def header_groups(spark: SparkSession, paths: str | Sequence[str]
                  ) -> list[tuple[list[str], list[str]]]:
    """(names, files) for each different first line of some files; empty files are in none."""
    groups = first_lines(spark, paths).groupBy("line").agg(
        F.array_sort(F.collect_list("file")).alias("files")).orderBy("line").collect()
    return [(next(csv.reader([g["line"].removeprefix("\ufeff")]), []),
             [unquote(f) for f in g["files"]]) for g in groups]


def header_fault(names: Sequence[str], schema: StructType) -> str | None:
    """Why a header cannot be read by name, if so."""
    known = [n for n in names if n in schema.names]
    if not known:
        return "no_declared_column"
    return "repeated_column" if len(known) > len(set(known)) else None


def read_by_name(spark: SparkSession, names: Sequence[str], files: Sequence[str],
                 schema: StructType, lineage: bool = False) -> DataFrame:
    """CSV files with the header ``names``, as the columns of ``schema``: those that the files lack
    are NULL, others are left out."""
    places = {n: i for i, n in reversed(list(enumerate(names)))}
    # Columns are told apart by place, so odd, empty or repeated names do no harm.
    found = StructType([StructField(f"_c{i}", StringType()) for i in range(len(names))]
                       + [StructField(CORRUPT, StringType())])
    part = (spark.read.schema(found).option("header", True)
            .option("columnNameOfCorruptRecord", CORRUPT).csv(list(files)))
    part = with_lineage(part) if lineage else part
    return part.select(*[
        F.col(CORRUPT) if f == CORRUPT else
        (F.col(f"_c{places[f]}") if f in places else F.lit(None).cast("string")).alias(f)
        for f in schema.names], *(["_source_file", "_ingested_at"] * lineage))


def read_landing_csv(spark: SparkSession, path: str | Sequence[str], schema: StructType,
                     lineage: bool = False) -> DataFrame:
    """Every CSV file of a folder (or of a list), columns by name; empty fields become NULL.

    One job looks at the first line of each file beforehand, and files with equal headers are
    read together. Columns that a file lacks are NULL, columns that are not declared are left out.
    A file whose header names no declared column, or one of them twice, ends the read with an error.
    """
    parts = []
    for names, files in header_groups(spark, path):
        if fault := header_fault(names, schema):
            raise ValueError(f"{fault}: {files[0]} has the header {names}")
        parts.append(read_by_name(spark, names, files, schema, lineage))
    if not parts:
        none = spark.createDataFrame([], schema)
        return none.selectExpr("*", "'' AS _source_file", "current_timestamp() AS _ingested_at") \
            if lineage else none
    return reduce(DataFrame.unionByName, parts)


def read_landing_json(spark: SparkSession, path: str, schema: StructType,
                      lineage: bool = False) -> DataFrame:
    """Every JSON-lines shard of a folder."""
    df = spark.read.schema(schema).option("columnNameOfCorruptRecord", CORRUPT).json(path)
    return with_lineage(df) if lineage else df


def read_source(spark: SparkSession, landing: str, source: str,
                lineage: bool = False) -> DataFrame:
    read = read_landing_csv if source in CSV_SOURCES else read_landing_json
    return read(spark, f"{landing}/{source}", landing_schema(source), lineage)


def export_landing(df: DataFrame, path: str, fields: Sequence[str], fmt: str = "csv",
                   shards: int | None = None) -> None:
    """Write only the declared fields. NULL and '' are written as an empty CSV field.

    ``shards`` fixes the number of files; without it every task writes its own.
    """
    out = df.select(*fields)
    if shards is not None:
        out = out.repartition(shards)
    writer = out.write.mode("append")
    if fmt == "csv":
        writer.option("header", True).option("nullValue", "").option("emptyValue", "").csv(path)
    else:
        writer.json(path)


def export_source(df: DataFrame, landing: str, source: str, shards: int | None = None) -> None:
    export_landing(df, f"{landing}/{source}", source_fields(source),
                   "csv" if source in CSV_SOURCES else "json", shards)


def _listing(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """The files of a folder and their bytes, empty ones included; none if there is no folder."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(place):
        return []
    return [(s.getPath().toUri().toString(), s.getLen()) for s in system.listStatus(place)
            if s.isFile() and not s.getPath().getName().startswith(("_", "."))]


def _plain(uri) -> Column:
    """A file's address with one slash after the scheme, however it was written."""
    return F.regexp_replace(uri, "^([^:/]+):/+", "$1:/")


def landing_manifest(spark: SparkSession, landing: str, sources: Sequence[str]) -> DataFrame:
    """Files, bytes, rows and smallest file per expected source.

    Files come from a listing, so shards without rows count. A source whose folder is absent or
    empty is listed with zeros; ``landed`` says whether it has any row.
    """
    parts = []
    for source in sources:
        files = _listing(spark, f"{landing}/{source}")
        if not files:
            continue
        listed = spark.createDataFrame(files, "file string, length long").select(
            _plain("file").alias("file"), "length")
        held = read_source(spark, landing, source, lineage=True).groupBy(
            _plain("_source_file").alias("file")).agg(F.count("*").alias("row_count"))
        parts.append(listed.join(held, "file", "left").select(
            F.lit(source).alias("source"), "length",
            F.coalesce("row_count", F.lit(0).cast("bigint")).alias("row_count")))
    expected = spark.createDataFrame([(s,) for s in sources], "source string")
    none = expected.limit(0).selectExpr("source", "0L AS length", "0L AS row_count")
    totals = reduce(DataFrame.unionByName, parts, none).groupBy("source").agg(
        F.count("*").alias("files"), F.sum("length").alias("bytes"),
        F.sum("row_count").alias("row_count"),
        F.min("row_count").alias("smallest_file_rows"))
    zero = F.lit(0).cast("bigint")
    return (expected.join(totals, "source", "left")
            .select("source", *[F.coalesce(F.col(c), zero).alias(c) for c in
                                ("files", "bytes", "row_count", "smallest_file_rows")])
            .withColumn("landed", F.col("row_count") > 0))
