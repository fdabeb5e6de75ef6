"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from assay.registry import QUERIES
from assay.session import tune

HEADLINE = [
    "silver_customers", "silver_customers_quarantine", "silver_accounts",
    "silver_accounts_quarantine", "silver_card_transactions", "silver_customer_events",
    "gold_customer_360", "gold_transaction_facts", "gold_balance_by_age_band",
    "gold_retention_summary", "profile_columns", "defect_report", "expectation_metrics",
    "conservation_check", "dq_before_after", "metric_by_region", "metric_medians",
    "kpi_overview", "swipes_by_age_band", "anchor_balance_61_65", "anchor_swipes_21_25",
    "anchor_moved_stayed", "churn_scorecard", "rank_auc", "bronze_card_transactions",
    "stream_bronze_card_transactions", "table_counts", "churn_gbt_eval",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = sys.argv[1:] or HEADLINE
    scratch = tempfile.mkdtemp(prefix="assay-bench-")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("assay-bench")
             .config("spark.ui.enabled", "false")
             .config("spark.python.sql.dataFrameDebugging.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", cpus)
             .config("spark.driver.memory", "16g")
             .config("spark.checkpoint.dir", f"{scratch}/checkpoints")
             .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    tune(spark)
    # Start the JVM's compilers and the file caches once, outside the measurement.
    for name in ("gold_retention_summary", "gold_transaction_facts"):
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in chosen:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": os.path.basename(folder.rstrip("/"))}))


if __name__ == "__main__":
    main()
