"""Plan shape: what must hold for a query to survive a thousand times the data."""

import pytest
from pyspark.sql import functions as F

from assay.plans import gold, silver
from assay.plans.medallion import Medallion
from assay.registry import QUERIES, lake
from assay.sources import supplied

from .helpers import bronze

FOLDER = "/root/testdata/sf0.001"
# These run jobs of their own while they are built.
EAGER = {n for n in QUERIES if n.startswith(("bronze_", "stream_"))} | {
    "reordered_accounts", "damaged_transactions", "rebuild_counts", "observed_expectations",
    "metric_spread_runs", "imputed_features", "category_index",
    "landing_manifest", "landing_rows", "table_counts", "promote_tables",
    "promote_scored", "churn_gbt_eval",
    "customers_scored", "risk_band_summary", "churn_watchlist", "churn_watchlist_groups",
    "feature_importance", "logistic_baseline", "logistic_eval", "model_reload_scores",
    "scored_invariants"}


def plan(df, final=False):
    if final:
        df.write.format("noop").mode("overwrite").save()
        df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


@pytest.fixture
def no_broadcast(spark):
    keys = ["spark.sql.autoBroadcastJoinThreshold",
            "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, value in old.items():
        spark.conf.unset(k) if value is None else spark.conf.set(k, value)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_no_cross_join_and_no_python(spark, no_broadcast, name):
    text = plan(QUERIES[name](spark, FOLDER))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
                     "ArrowEvalPython", "MapInPandas"):
        assert operator not in text


def test_dedup_limits_each_key_before_the_shuffle(spark):
    text = plan(silver.silver_card_transactions(bronze(spark, "card_transactions", {})))
    assert text.count("WindowGroupLimit") == 2
    exchange = text.index("Exchange hashpartitioning(txn_id")
    assert text.index("WindowGroupLimit") < exchange < text.rindex("WindowGroupLimit")


def test_semi_join_needs_no_distinct(spark, no_broadcast):
    t = lake(spark, FOLDER)
    text = plan(t.accounts)
    assert "LeftSemi" in text and "HashAggregate" not in text


def test_balance_report_reads_no_transactions(spark, no_broadcast):
    text = plan(lake(spark, FOLDER).balance_by_age_band)
    assert "lineitem.parquet" not in text and "nation.parquet" not in text
    assert text.count("FileScan") == 2


def test_scan_reads_only_the_columns_it_needs(spark):
    text = plan(QUERIES["range_violations"](spark, FOLDER))
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in text or (
        "FileScan parquet [o_orderkey" in text and "o_orderdate" not in text)


def test_transactions_are_shuffled_once_after_dedup(spark, no_broadcast):
    text = plan(lake(spark, FOLDER).facts)
    assert text.count("Exchange hashpartitioning(txn_id") == 1
    # One shuffle of either side on the account, none of the transactions on the customer.
    assert text.count("Exchange hashpartitioning(account_id") == 2


def test_running_totals_are_taken_range_by_range(spark, no_broadcast):
    """The only window without a key runs over the totals of the ranges."""
    text = plan(QUERIES["rank_auc"](spark, FOLDER), final=True)
    assert "lineitem" not in text  # the counts were staged once
    alone = text.index("Exchange SinglePartition, ENSURE")
    assert "HashAggregate(keys=[__range" in text[alone:]


@pytest.fixture
def small_skew(spark):
    """Thresholds at which test-sized partitions count as skewed."""
    settings = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
                "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, value in settings.items():
        spark.conf.set(k, value)
    yield
    for k, value in old.items():
        spark.conf.unset(k) if value is None else spark.conf.set(k, value)


def test_hot_account_is_split(spark, no_broadcast, small_skew):
    """One account holds a third of the transactions: the join reads it in several tasks."""
    n = 30000
    txns = spark.range(0, n, 1, 8).select(
        F.concat(F.lit("T"), "id").alias("txn_id"), F.current_date().alias("txn_date"),
        F.when(F.col("id") % 3 == 0, "A0")
         .otherwise(F.concat(F.lit("A"), F.col("id") % 500)).alias("account_id"),
        F.lit("debit").alias("card_type"), F.lit("swipe").alias("channel"),
        F.lit("gas").alias("merchant_category"), F.lit(1.0).alias("amount"))
    accounts = spark.range(500).select(F.concat(F.lit("A"), "id").alias("account_id"),
                                       F.concat(F.lit("C"), "id").alias("customer_id"))
    people = spark.range(500).select(
        F.concat(F.lit("C"), "id").alias("customer_id"), F.lit(30).alias("age"),
        *[F.lit("x").alias(c) for c in ("age_band", "segment", "home_state", "region")])
    facts = gold.transaction_facts(txns, accounts, people)
    facts.collect()
    assert "skew=true" in plan(facts)
    assert facts.count() == n


def test_hot_customer_is_split_below_an_aggregate(spark, no_broadcast, small_skew):
    """One customer holds a third of the accounts: the parent check is split although the
    rollup that follows groups by the same key."""
    n = 30000
    accounts = spark.range(0, n, 1, 8).select(
        F.concat(F.lit("A"), "id").alias("account_id"),
        F.when(F.col("id") % 3 == 0, "C0").otherwise(F.concat(F.lit("C"), F.col("id") % 500))
         .alias("customer_id"),
        *[F.lit(x).alias(c) for c, x in (
            ("account_type", "cd"), ("open_date", "2020-01-01"), ("account_status", "open"))],
        F.round(F.rand(3) * 1e6, 2).cast("string").alias("balance"))
    people = spark.range(400).select(F.concat(F.lit("C"), "id").alias("customer_id"))
    rollup = gold.balance_by_customer(silver.silver_accounts(accounts, people))
    got = {r.customer_id: r.num_accounts for r in rollup.collect()}
    assert "skew=true" in plan(rollup)
    assert len(got) == 400 and got["C0"] == n // 3 + sum(
        i % 500 == 0 and i % 3 != 0 for i in range(n))


@pytest.fixture
def hot_lake(spark):
    """The real tables, with one customer who holds a third of the accounts."""
    raw = dict(supplied.raw_sources(spark, "/root/testdata/sf0.01"))
    hot = raw["customers"].agg(F.min("customer_id")).first()[0]
    # Only what several map tasks have written can be split.
    raw["accounts"] = raw["accounts"].repartition(8).withColumn("customer_id", F.when(
        F.pmod(F.xxhash64("account_id"), F.lit(3)) == 0, hot).otherwise(F.col("customer_id")))
    return Medallion(raw)


@pytest.mark.parametrize("frame", ["judged_accounts", "facts"])
def test_hot_customer_is_split_in_the_real_tables(spark, hot_lake, small_skew, frame):
    """Branches are small enough to be broadcast, the rest is not."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "2KB")
    try:
        df = getattr(hot_lake, frame)
        df.collect()
        assert "skew=true" in plan(df)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
