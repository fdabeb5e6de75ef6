"""Named tables: overwrite, promotion between databases, row counts."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Promotion levels and their tables in build order; each one includes the levels
# before it.
LEVELS = {
    "medallion": [
        "bronze_customers", "bronze_accounts", "bronze_branches", "bronze_customer_events",
        "bronze_card_transactions", "silver_customers", "silver_customers_quarantine",
        "silver_accounts", "silver_accounts_quarantine", "silver_card_transactions",
        "silver_txn_quarantine",
        "silver_customer_events", "silver_branches", "gold_customer_360",
        "gold_transaction_facts", "gold_balance_by_age_band", "gold_retention_summary",
    ],
    "scored": ["gold_customers_scored"],
}


# Ids and amounts shrink to about half of what the default codec makes of them.
COMPRESSED = {"compression": "zstd", "parquet.compression.codec.zstd.level": "1"}


def level_tables(level: str) -> list[str]:
    if level not in LEVELS:
        raise ValueError(f"unknown level {level!r}; known: {list(LEVELS)}")
    names = list(LEVELS)
    return [t for name in names[:names.index(level) + 1] for t in LEVELS[name]]


def create_database(spark: SparkSession, name: str, location: str | None = None) -> str:
    """Make the database where it is not there yet, in the warehouse unless told otherwise; its
    folder."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{place}")
    return spark.catalog.getDatabase(name).locationUri.rstrip("/")


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def _location(spark: SparkSession, name: str) -> str | None:
    """Where an existing table's data is."""
    if not spark.catalog.tableExists(name):
        return None
    rows = spark.sql(f"DESCRIBE FORMATTED {name}").where("col_name = 'Location'").collect()
    return rows[0].data_type if rows else None


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Replace the table, schema included, and return it as read back."""
    df.write.mode("overwrite").option("overwriteSchema", "true").options(**COMPRESSED).saveAsTable(
        name)
    return df.sparkSession.table(name)


def write_split(df: DataFrame, name: str, folder: str, keep: Column, columns: Sequence[str]
                ) -> tuple[DataFrame, DataFrame]:
    """Write ``df`` once, as the table ``name`` of the rows for which ``keep`` holds and a frame
    of the others.

    Both are folders of the one write, so neither the plan nor the data is gone through twice.
    The table shows only ``columns``. The write goes to a path of its own below ``folder``; then
    the table is pointed at it, and what it showed before is removed.
    """
    spark = df.sparkSession
    path = f"{folder}/judged-{uuid.uuid4().hex}"
    df.withColumn("__keep", F.coalesce(keep, F.lit(False))).write.partitionBy("__keep").options(
        **COMPRESSED).parquet(path)
    schema = df.select(*columns).schema
    old = _location(spark, name)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.catalog.createTable(name, path=f"{path}/__keep=true", source="parquet", schema=schema)
    if old and "/judged-" in old:
        _delete(spark, old.rpartition("/__keep=")[0])
    whole = spark.read.schema(df.schema.add("__keep", "boolean")).parquet(path)
    return spark.table(name), whole.filter(~F.col("__keep")).drop("__keep")


def missing_tables(spark: SparkSession, database: str, tables: Sequence[str]) -> list[str]:
    present = {t.name for t in spark.catalog.listTables(database)}
    return [t for t in tables if t not in present]


def promote(spark: SparkSession, src: str, dst: str, tables: Sequence[str]) -> DataFrame:
    """Copy tables from one database to another and report their rows.

    Nothing is copied when any of them is missing in the source.
    """
    absent = missing_tables(spark, src, tables)
    if absent:
        raise ValueError(f"{src} lacks {absent}")
    return table_counts({t: write_table(spark.table(f"{src}.{t}"), f"{dst}.{t}") for t in tables})


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table; each branch is a count that sends one row per task."""
    counts = [df.agg(F.count("*").alias("row_count"))
                .select(F.lit(name).alias("table_name"), "row_count")
              for name, df in tables.items()]
    return reduce(DataFrame.unionAll, counts)
