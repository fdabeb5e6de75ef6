"""Gold: one row per customer, one row per transaction, and two rollups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import fill_defaults, ratio
from ..functions.money import money_average, money_sum

CUSTOMER_360 = [
    "customer_id", "age", "age_band", "gender", "home_state", "region", "segment",
    "acquisition_channel", "source_bank", "moved_from_bank", "join_date", "tenure_years",
    "customer_status", "is_retained", "attrition_flag", "num_accounts", "total_balance",
    "avg_account_balance", "txn_count", "debit_swipe_count", "debit_txn_count", "total_spend",
]
FACTS = [
    "txn_id", "txn_date", "card_type", "channel", "merchant_category", "amount", "customer_id",
    "age", "age_band", "segment", "home_state", "region",
]
_COUNTS = ["txn_count", "debit_swipe_count", "debit_txn_count"]


def balance_by_customer(accounts: DataFrame) -> DataFrame:
    """Accounts, total and average balance per customer."""
    return (accounts.groupBy("customer_id")
            .agg(F.count("*").alias("num_accounts"), money_sum("balance").alias("__balance"))
            .select("customer_id", "num_accounts",
                    F.col("__balance").cast("double").alias("total_balance"),
                    money_average("__balance", "num_accounts").alias("avg_account_balance")))


def activity_by_account(txns: DataFrame) -> DataFrame:
    """Card activity per account, spend as an exact decimal.

    Aggregating on the account before any join shrinks the largest table first and takes the
    weight out of an account that holds a large part of all transactions.
    """
    debit = F.col("card_type") == "debit"
    return txns.groupBy("account_id").agg(
        F.count("*").alias("txn_count"),
        F.count_if(debit & (F.col("channel") == "swipe")).alias("debit_swipe_count"),
        F.count_if(debit).alias("debit_txn_count"),
        money_sum("amount").alias("__spend"))


def activity_by_customer(txns: DataFrame, accounts: DataFrame) -> DataFrame:
    """Card activity per customer that has any."""
    owned = activity_by_account(txns).join(accounts.select("account_id", "customer_id"),
                                           "account_id")
    return (owned.groupBy("customer_id")
            .agg(*[F.sum(n).alias(n) for n in _COUNTS], F.sum("__spend").alias("__spend"))
            .select("customer_id", *_COUNTS,
                    F.col("__spend").cast("double").alias("total_spend")))


def rollup_by_customer(accounts: DataFrame, txns: DataFrame) -> DataFrame:
    """Balances and activity per customer from one pass over the accounts.

    Accounts without transactions keep their balance and transactions without an account drop
    out, as in two separate rollups; but accounts are read, joined and grouped once. A query that
    needs only balances loses the transaction side altogether, because the optimizer removes a
    left join on a unique key whose columns are unused.
    """
    joined = accounts.select("account_id", "customer_id", "balance").join(
        activity_by_account(txns), "account_id", "left")
    return joined.groupBy("customer_id").agg(
        F.count("*").alias("num_accounts"), money_sum("balance").alias("__balance"),
        *[F.sum(n).alias(n) for n in _COUNTS], F.sum("__spend").alias("__spend"))


def with_region(customers: DataFrame, branches: DataFrame) -> DataFrame:
    """Add the region of the home branch.

    Grouping the branches by their id keeps one row per customer should an id ever repeat, and
    lets the optimizer drop the join where nobody asks for the region.
    """
    region = branches.groupBy(F.col("branch_id").alias("home_branch_id")).agg(
        F.min("branch_region").alias("region"))
    return customers.join(region, "home_branch_id", "left")


def customer_360(customers: DataFrame, branches: DataFrame, accounts: DataFrame,
                 txns: DataFrame) -> DataFrame:
    """One row per customer with balances, activity, tenure and retention flags."""
    joined = with_region(
        customers.join(rollup_by_customer(accounts, txns), "customer_id", "left"), branches)
    measured = joined.withColumns({
        "total_balance": F.col("__balance").cast("double"),
        "avg_account_balance": money_average("__balance", "num_accounts"),
        "total_spend": F.col("__spend").cast("double"),
    })
    defaults = {"num_accounts": 0, "total_balance": 0.0, "avg_account_balance": 0.0,
                **{n: 0 for n in _COUNTS}, "total_spend": 0.0}
    return fill_defaults(measured, defaults).select(*CUSTOMER_360)


def transaction_facts(txns: DataFrame, accounts: DataFrame, c360: DataFrame) -> DataFrame:
    """One row per transaction of a known customer, with the customer's attributes.

    Attributes are joined to the accounts first, so transactions are shuffled once. The customers'
    key is computed anew, which hides that they are partitioned by it already: AQE splits a hot
    customer's accounts only where both sides of the join come straight from a shuffle.
    """
    people = c360.select(F.concat("customer_id", F.lit("")).alias("__customer"),
                         "age", "age_band", "segment", "home_state", "region")
    owners = accounts.select("account_id", "customer_id").join(
        people, F.col("customer_id") == F.col("__customer"))
    return txns.join(owners, "account_id").select(*FACTS)


def balance_by_band(c360: DataFrame) -> DataFrame:
    """Customers, average and total balance per age band."""
    return (c360.groupBy("age_band")
            .agg(F.count("*").alias("customer_count"),
                 money_sum("total_balance").alias("__total"))
            .select("age_band", "customer_count",
                    money_average("__total", "customer_count").alias("avg_balance"),
                    F.col("__total").cast("double").alias("total_balance")))


def retention_by(c360: DataFrame, col: str, default: str = "unknown") -> DataFrame:
    """Of the customers who moved in: how many stayed and left, per value of ``col``.

    A customer whose status is unknown has moved in but neither stayed nor left.
    """
    return (c360.filter("moved_from_bank")
            .groupBy(F.coalesce(F.col(col), F.lit(default)).alias(col))
            .agg(F.count("*").alias("moved_in"),
                 F.count_if("is_retained").alias("stayed"),
                 F.count_if(~F.col("is_retained")).alias("left_us"))
            .withColumn("retention_rate", ratio("stayed", "moved_in", 4)))


def retention_summary(c360: DataFrame) -> DataFrame:
    return retention_by(c360, "source_bank")
