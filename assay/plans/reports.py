"""Report datasets over the gold tables.

Reports on customers take a segment; ``medallion.SegmentView`` narrows any report, those on rollups
and events too. A production report reads the tables that ``build`` has written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import values as v
from ..functions.columns import categorize, ratio
from ..functions.money import money_sum, whole_average
from ..operators.dedupe import top_k, top_n_per_group
from .gold import retention_by


def for_segment(gold: DataFrame, segment: str | None) -> DataFrame:
    return gold if segment is None else gold.filter(F.col("segment") == segment)


def kpi_overview(c360: DataFrame, segment: str | None = None) -> DataFrame:
    """Customers, total balance, switch-in retention and debit swipes in one pass."""
    moved = F.coalesce(F.col("moved_from_bank"), F.lit(False))
    totals = for_segment(c360, segment).agg(
        F.count("*").alias("total_customers"),
        money_sum("total_balance").cast("double").alias("total_balance"),
        F.count_if(moved & F.col("is_retained")).alias("__stayed"),
        F.count_if(moved).alias("__moved"),
        F.sum("debit_swipe_count").alias("total_debit_swipes"))
    return totals.select("total_customers", "total_balance",
                         ratio("__stayed", "__moved", 4).alias("switch_in_retention"),
                         "total_debit_swipes")


def swipes_by_band(facts: DataFrame, segment: str | None = None) -> DataFrame:
    """Debit swipes per age band, from the transactions."""
    swipes = for_segment(facts, segment).filter("card_type = 'debit' AND channel = 'swipe'")
    return swipes.groupBy("age_band").agg(F.count("*").alias("debit_swipes"))


def average_balance_by_band(by_band: DataFrame) -> DataFrame:
    return by_band.select("age_band", "avg_balance")


def retention_outcomes(retention: DataFrame) -> DataFrame:
    """Two rows per source bank, one for each outcome."""
    return retention.select("source_bank", "stayed", "left_us").unpivot(
        ["source_bank"], ["stayed", "left_us"], "outcome", "customers")


def customers_by_state(c360: DataFrame, segment: str | None = None) -> DataFrame:
    return for_segment(c360, segment).groupBy("home_state").agg(
        F.count("*").alias("customer_count"))


def retention_table(retention: DataFrame) -> DataFrame:
    """Source banks by the number of customers they lost to us."""
    return retention.select("source_bank", "moved_in", "stayed", "left_us", "retention_rate"
                            ).orderBy(F.col("moved_in").desc(), "source_bank")


def retention_rate_by_bank(retention: DataFrame) -> DataFrame:
    return retention.select("source_bank", "retention_rate")


def retention_by_segment(c360: DataFrame) -> DataFrame:
    """Share of retained customers per segment, over all customers."""
    return (c360.groupBy("segment")
            .agg(F.count("*").alias("customer_count"),
                 F.count_if("is_retained").alias("retained"))
            .withColumn("retention_rate", ratio("retained", "customer_count", 4)))


def attrited_count(c360: DataFrame, segment: str | None = None) -> DataFrame:
    return for_segment(c360, segment).filter("customer_status = 'attrited'").agg(
        F.count("*").alias("attrited_customers"))


def anchor_balance(c360: DataFrame, low: int = 61, high: int = 65) -> DataFrame:
    """Average balance of an age range in whole units, with the number of customers."""
    totals = c360.filter(F.col("age").between(low, high)).agg(
        money_sum("total_balance").alias("__total"), F.count("*").alias("n"))
    return totals.select(whole_average("__total", "n").alias("avg_balance"), "n")


def anchor_swipes(c360: DataFrame, low: int = 21, high: int = 25) -> DataFrame:
    zero = F.lit(0).cast("bigint")
    return c360.filter(F.col("age").between(low, high)).agg(
        F.coalesce(F.sum("debit_swipe_count"), zero).alias("debit_swipes"))


def anchor_swipes_from_facts(facts: DataFrame, low: int = 21, high: int = 25) -> DataFrame:
    return facts.filter(F.col("age").between(low, high)).filter(
        "card_type = 'debit' AND channel = 'swipe'").agg(F.count("*").alias("debit_swipes"))


def swipes_two_paths(c360: DataFrame, facts: DataFrame) -> DataFrame:
    """The same question asked of both gold tables; the answers must agree."""
    return (anchor_swipes_from_facts(facts).withColumn("path", F.lit("facts"))
            .unionByName(anchor_swipes(c360).withColumn("path", F.lit("customer_360"))))


def anchor_moved(c360: DataFrame) -> DataFrame:
    return (c360.filter("moved_from_bank")
            .agg(F.count("*").alias("moved_in"), F.count_if("is_retained").alias("stayed"))
            .withColumn("retention_rate", ratio("stayed", "moved_in", 3)))


def retention_for_segment(c360: DataFrame, segment: str) -> DataFrame:
    """The retention summary of one segment: any report can be narrowed this way."""
    return retention_by(for_segment(c360, segment), "source_bank")


def bucketed_reasons(events: DataFrame) -> DataFrame:
    """Events of customers who left, with the bucket of their reason."""
    return events.filter("event_type = 'attrited'").withColumn(
        "bucket", categorize("reason", v.REASON_BUCKETS))


def churn_reason_buckets(events: DataFrame) -> DataFrame:
    return bucketed_reasons(events).groupBy("bucket").agg(F.count("*").alias("n"))


def churn_reason_examples(events: DataFrame, n: int = 5) -> DataFrame:
    """``n`` events per bucket, the latest first."""
    return top_n_per_group(
        bucketed_reasons(events), ["bucket"], [F.col("event_date").desc(), "event_id"], n
    ).select("bucket", "event_id", "customer_id", "event_date", "reason")


def churn_watchlist(scored: DataFrame, k: int = 20, segment: str | None = None) -> DataFrame:
    """The ``k`` high-risk customers with the greatest churn score."""
    high = for_segment(scored, segment).filter("risk_band = 'high'")
    return top_k(high.select("customer_id", "segment", "region", "churn_score", "risk_band"),
                 [F.col("churn_score").desc(), "customer_id"], k)


def watchlist_by_group(scored: DataFrame) -> DataFrame:
    """High-risk customers per segment and region."""
    return (scored.filter("risk_band = 'high'").groupBy("segment", "region")
            .agg(F.count("*").alias("customers"),
                 F.round(F.avg("churn_score"), 3).alias("avg_score")))


def band_summary(scored: DataFrame) -> DataFrame:
    """Customers and mean score per risk band, riskiest first."""
    return (scored.groupBy("risk_band")
            .agg(F.count("*").alias("n"), F.round(F.avg("churn_score"), 3).alias("avg_score"))
            .orderBy(F.col("avg_score").desc()))
