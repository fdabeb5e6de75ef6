"""Landing folder -> bronze, new files only.

The checkpoint holds the list of files already taken, so a run without new files adds nothing
and a run after a failure continues where the last committed batch ended. Each batch is committed
as a whole; readers of the folder never see a part of one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from ..operators.dedupe import dedupe_first
from ..sources.landing import (
    CORRUPT, CSV_SOURCES, header_fault, header_groups, landing_schema, read_by_name, with_lineage,
)

# How much older than the newest file a file may be and still be taken: longer than any delivery
# is late, so that backfills and copies that keep their times are not passed over.
MAX_FILE_AGE = "36500d"
FILE_GROUPS = 1024


def _options(reader, max_files: int | None, max_file_age: str):
    reader = reader.option("maxFileAge", max_file_age)
    return reader if max_files is None else reader.option("maxFilesPerTrigger", max_files)


def landing_stream(spark: SparkSession, path: str, schema: StructType,
                   max_files: int | None = None, max_file_age: str = MAX_FILE_AGE) -> DataFrame:
    """JSON-lines files of a folder as they come."""
    reader = spark.readStream.schema(schema).option("columnNameOfCorruptRecord", CORRUPT)
    return _options(reader, max_files, max_file_age).json(path)


def file_stream(spark: SparkSession, path: str, max_files: int | None = None,
                max_file_age: str = MAX_FILE_AGE) -> DataFrame:
    """(path) of the files of a folder as they come. Their content is not read."""
    reader = _options(spark.readStream.format("binaryFile").schema(
        "path string, modificationTime timestamp, length long, content binary"),
        max_files, max_file_age)
    return reader.load(path).select("path")


def _finish(writer: DataStreamWriter, checkpoint: str) -> StreamingQuery:
    """Take everything that is there now, however long it takes, then stop."""
    query = (writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def _run(df: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    return _finish(df.writeStream.format("parquet").outputMode("append").option("path", out),
                   checkpoint)


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def batch_folder(spark: SparkSession, out: str, checkpoint: str, batch: int) -> str:
    """Where a micro-batch belongs. The place follows from the checkpoint and the number of the
    batch, so a batch that is run again replaces what its first run left there."""
    run = spark.read.schema("id string").json(f"{checkpoint}/metadata").first()["id"]
    return f"{out}/run={run}/batch={batch}"


def read_batches(spark: SparkSession, out: str, schema: StructType) -> DataFrame:
    """All micro-batches below ``out``; an empty frame if there is none yet."""
    if not _exists(spark, out):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(out).select(*schema.names)


REJECTED = StructType([StructField(n, StringType())
                       for n in ("_source_file", "reason", "line")])


def rejected_folder(out: str) -> str:
    return out.rstrip("/") + "_rejected"


def csv_to_bronze(spark: SparkSession, path: str, schema: StructType, out: str, checkpoint: str,
                  max_files: int | None = None) -> DataFrame:
    """Append the CSV files that are new since the last run, each read by the names in its own
    header; returns the whole bronze table.

    The stream carries only the names of the files. Each micro-batch looks at their first lines by
    one job, reads files with equal headers together, and writes all rows to a folder of its own
    (``batch_folder``), so that a batch that is run again after a failure leaves each row once.
    A file whose header names no declared column, or one of them twice, is set aside: its lines go as
    they are to ``rejected_folder(out)`` with the reason, and the stream carries on.
    """
    def take(files: DataFrame, batch: int) -> None:
        own = files.sparkSession
        paths = [r["path"] for r in files.collect()]  # the source's own list of this batch's files
        good, bad = [], []
        for names, group in header_groups(own, paths) if paths else []:
            if fault := header_fault(names, schema):
                bad.append(own.read.text(group).select(
                    F.col("_metadata.file_path").alias("_source_file"),
                    F.lit(fault).alias("reason"), F.col("value").alias("line")))
            else:
                good.append(read_by_name(own, names, group, schema, lineage=True))
        for parts, folder in ((good, out), (bad, rejected_folder(out))):
            if parts:
                reduce(DataFrame.unionByName, parts).write.mode("overwrite").parquet(
                    batch_folder(own, folder, checkpoint, batch))

    _finish(file_stream(spark, path, max_files).writeStream.foreachBatch(take), checkpoint)
    return read_batches(spark, out, bronze_schema(schema))


def rejected_lines(spark: SparkSession, out: str) -> DataFrame:
    """(_source_file, reason, line) of the files that ``csv_to_bronze`` set aside beside ``out``."""
    return read_batches(spark, rejected_folder(out), REJECTED)


def json_to_bronze(spark: SparkSession, path: str, schema: StructType, out: str, checkpoint: str,
                   max_files: int | None = None) -> DataFrame:
    """Append the JSON-lines files that are new since the last run; returns the whole table."""
    _run(with_lineage(landing_stream(spark, path, schema, max_files)), out, checkpoint)
    return spark.read.schema(bronze_schema(schema)).parquet(out)


def source_to_bronze(spark: SparkSession, landing: str, source: str, out: str,
                     checkpoint: str, max_files: int | None = None) -> DataFrame:
    take = csv_to_bronze if source in CSV_SOURCES else json_to_bronze
    return take(spark, f"{landing}/{source}", landing_schema(source), out, checkpoint, max_files)


def bronze_schema(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField("_source_file", StringType()),
                       StructField("_ingested_at", TimestampType())])


def stream_dedupe(spark: SparkSession, path: str, schema: StructType, key: str, out: str,
                  checkpoint: str, within: str = "30 days",
                  max_files: int | None = None) -> DataFrame:
    """Append each key once: the first row to arrive stays.

    Time is the moment of ingestion, so neither old events nor files with old times are ever late;
    a key that comes again within ``within`` of its first arrival is dropped, and state older than that is released.
    The batch dedup keeps the first row by its own time instead.

    Keys are made unique per group of files first: a key that fills a large part of the input is
    then spread over as many state partitions as there are groups, and sends one row per group on to
    the step that compares them. A group is a number, since the state keeps it beside every key.
    """
    rows = landing_stream(spark, path, schema, max_files).select(
        "*", F.current_timestamp().alias("_landed_at"),
        F.pmod(F.hash("_metadata.file_path"), F.lit(FILE_GROUPS)).alias("_files"))
    once = (rows.withWatermark("_landed_at", within)
                .dropDuplicatesWithinWatermark([key, "_files"])
                .dropDuplicatesWithinWatermark([key]))
    _run(once.drop("_landed_at", "_files"), out, checkpoint)
    return spark.read.schema(schema).parquet(out)


def stream_first(spark: SparkSession, path: str, schema: StructType, key: str, order_by: str,
                 table: str, out: str, checkpoint: str, buckets: int | None = None,
                 max_files: int | None = None) -> DataFrame:
    """The row with the smallest ``order_by`` per key over all files ever taken, whenever they
    come; ties are broken by the other columns, as the batch dedup does. Nothing is forgotten.

    Each micro-batch adds its own first row per key to ``table``, a table at ``out`` bucketed and
    sorted by ``key``; the first of these per key is the answer. Adding a row twice changes no answer,
    so a batch that is run again does no harm. Only new rows are shuffled: the table is compared
    bucket by bucket where it lies. ``compact_first`` leaves one row per key again.

    A new table gets as many buckets as the session has shuffle partitions, unless told otherwise:
    the width follows the input (``fit_shuffles``), so a bucket stays of a size one task can sort, and
    each task of a batch writes into one bucket.
    """
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    others = [c for c in schema.names if c not in (key, order_by)]
    spark.sql(_first_table(table, schema, key, buckets, out))

    def add(rows: DataFrame, batch: int) -> None:
        dedupe_first(rows, [key], order_by, others).write.insertInto(table)

    stream = landing_stream(spark, path, schema, max_files)
    _finish(stream.writeStream.foreachBatch(add), checkpoint)
    spark.catalog.refreshTable(table)  # its files were added by the stream's own session
    return dedupe_first(spark.table(table), [key], order_by, others)


def _first_table(table: str, schema: StructType, key: str, buckets: int, out: str) -> str:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return (f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet "
            f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{out}'")


def compact_first(spark: SparkSession, schema: StructType, key: str, order_by: str, table: str,
                  out: str, buckets: int = 64) -> DataFrame:
    """Rewrite ``stream_first``'s table with one row per key at ``out``, a path of its own, and point
    the table at it. Run it between two runs of the stream; the old path can be removed then."""
    others = [c for c in schema.names if c not in (key, order_by)]
    new = f"{table}_compacted"
    spark.sql(f"DROP TABLE IF EXISTS {new}")
    spark.sql(_first_table(new, schema, key, buckets, out))
    dedupe_first(spark.table(table), [key], order_by, others).write.mode("overwrite").insertInto(new)
    spark.sql(f"DROP TABLE {new}")    # both are external: only their entries go
    spark.sql(f"DROP TABLE {table}")
    spark.sql(_first_table(table, schema, key, buckets, out))
    return spark.table(table)
