"""All tables of the product, as lazy frames or as a database of written tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.values import AS_OF
from ..operators import model, quality
from ..operators.parents import with_parent
from ..session import stage
from ..sources.tables import create_database, write_split, write_table
from . import gold, silver


class Medallion:
    """Every silver and gold table as a lazy frame over the five bronze frames.

    Nothing runs until a frame is used, and then only the columns and joins it needs.
    """

    def __init__(self, bronze: Mapping[str, DataFrame], as_of=AS_OF):
        self.bronze = bronze
        self.as_of = as_of

    @cached_property
    def judged_customers(self) -> DataFrame:
        return silver.judge_customers(self.bronze["customers"], self.as_of)

    @cached_property
    def judged_accounts(self) -> DataFrame:
        return silver.judge_accounts(self.bronze["accounts"], self.bronze["customers"])

    @cached_property
    def judged_transactions(self) -> DataFrame:
        return silver.judge_transactions(self.bronze["card_transactions"])

    @cached_property
    def customers(self) -> DataFrame:
        return silver.clean_customers(self.judged_customers)

    @cached_property
    def customers_quarantine(self) -> DataFrame:
        return silver.customers_quarantine(self.judged_customers)

    @cached_property
    def accounts(self) -> DataFrame:
        return silver.silver_accounts(self.bronze["accounts"], self.bronze["customers"])

    @cached_property
    def valid_accounts(self) -> DataFrame:
        """Accounts that meet the balance rules, orphans included.

        The gold tables join accounts to customers anyway, and that join drops the same orphans
        as the parent check, so they skip its extra pass and shuffle.
        """
        rules = {r.name: r.predicate for r in silver.ACCOUNT_RULES}
        return quality.expect(silver.parse_accounts(self.bronze["accounts"]), rules)

    @cached_property
    def accounts_quarantine(self) -> DataFrame:
        return silver.accounts_quarantine(self.judged_accounts)

    @cached_property
    def transactions(self) -> DataFrame:
        return silver.clean_transactions(self.judged_transactions)

    @cached_property
    def transactions_quarantine(self) -> DataFrame:
        return silver.transactions_quarantine(self.judged_transactions)

    @cached_property
    def events(self) -> DataFrame:
        return silver.silver_customer_events(self.bronze["customer_events"])

    @cached_property
    def branches(self) -> DataFrame:
        return silver.silver_branches(self.bronze["branches"])

    @cached_property
    def customer_360(self) -> DataFrame:
        return gold.customer_360(self.customers, self.branches, self.valid_accounts,
                                 self.transactions)

    @cached_property
    def facts(self) -> DataFrame:
        return gold.transaction_facts(
            self.transactions, self.valid_accounts, self.customer_360)

    @cached_property
    def balance_by_age_band(self) -> DataFrame:
        return gold.balance_by_band(self.customer_360)

    @cached_property
    def retention_summary(self) -> DataFrame:
        return gold.retention_summary(self.customer_360)


class SegmentView(Medallion):
    """The gold tables and events of one customer segment, so that every report can be narrowed to
    it: rollups are taken anew over the segment's customers."""

    def __init__(self, lake: Medallion, segment: str):
        super().__init__(lake.bronze, lake.as_of)
        self.lake = lake
        self.segment = segment

    @cached_property
    def customer_360(self) -> DataFrame:
        return self.lake.customer_360.filter(F.col("segment") == self.segment)

    @cached_property
    def facts(self) -> DataFrame:
        return self.lake.facts.filter(F.col("segment") == self.segment)

    @cached_property
    def events(self) -> DataFrame:
        """Events of the segment's customers."""
        known = self.lake.customers.filter(F.col("segment") == self.segment)
        return with_parent(self.lake.events, known, "customer_id")


def build(spark: SparkSession, bronze: Mapping[str, DataFrame], database: str,
          as_of=AS_OF, location: str | None = None) -> list[str]:
    """Write all bronze, silver and gold tables in dependency order and return their names.

    ``location`` is the folder of a new database, by default one in the warehouse. A build that is
    repeated replaces every table and removes the data it had.

    Every layer reads the written tables of the layer before it. A judged frame is written once,
    clean and quarantined rows into folders of their own, so neither the dedup nor the
    foreign-key join runs for both. The same write counts the rows that pass and fail each
    expectation, which make the table ``expectation_metrics`` beside the others.
    """
    folder = create_database(spark, database, location)
    names: list[str] = []
    watches: list[quality.Watch] = []

    def put(name: str, df: DataFrame) -> DataFrame:
        names.append(name)
        return write_table(df, f"{database}.{name}")

    def split(name: str, judged: DataFrame, columns, rules, seen: str = "true"
              ) -> tuple[DataFrame, DataFrame]:
        names.append(name)
        judged, watch = quality.watch(judged, rules, name, seen)
        watches.append(watch)
        return write_split(judged, f"{database}.{name}", f"{folder}/{name}",
                           F.col(quality.REASON).isNull(), columns)

    lazy = Medallion({source: put(f"bronze_{source}", df) for source, df in bronze.items()},
                     as_of)
    customers, bad = split("silver_customers", lazy.judged_customers, silver.CUSTOMER_COLUMNS,
                           silver.CUSTOMER_RULES)
    put("silver_customers_quarantine", silver.customers_quarantine(bad))
    accounts, bad = split("silver_accounts", lazy.judged_accounts, silver.ACCOUNT_COLUMNS,
                          silver.ACCOUNT_RULES, silver.HAS_PARENT)
    put("silver_accounts_quarantine", silver.accounts_quarantine(bad))
    transactions, bad = split("silver_card_transactions", lazy.judged_transactions,
                              silver.TRANSACTION_COLUMNS, silver.TRANSACTION_RULES)
    put("silver_txn_quarantine", silver.transactions_quarantine(bad))
    put("silver_customer_events", lazy.events)
    branches = put("silver_branches", lazy.branches)

    c360 = put("gold_customer_360",
               gold.customer_360(customers, branches, accounts, transactions))
    put("gold_transaction_facts", gold.transaction_facts(transactions, accounts, c360))
    put("gold_balance_by_age_band", gold.balance_by_band(c360))
    put("gold_retention_summary", gold.retention_summary(c360))
    write_table(quality.watched_metrics(spark, watches), f"{database}.expectation_metrics")
    return names


def build_scored(spark: SparkSession, database: str, trees: int = 100) -> DataFrame:
    """Train on the labelled customers of a built database and write the scores of the others."""
    rows = stage(model.exact_split(
        model.feature_table(spark.table(f"{database}.gold_customer_360"))), "features")
    labelled, open_rows = model.split_labelled(rows)
    fitted = model.fit_churn(labelled.filter("split = 'train'"), trees=trees)
    return write_table(model.score(fitted, open_rows.drop("split")),
                       f"{database}.gold_customers_scored")
