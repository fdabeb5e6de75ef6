import datetime as dt

import pytest
from pyspark.sql import functions as F

from assay.plans import gold, reports, silver
from assay.plans.medallion import Medallion

from .helpers import bronze, rows


def test_customers_latest_parsed_and_judged(spark):
    raw = bronze(
        spark, "customers",
        dict(customer_id="A", updated_at="2026-05-01", customer_status="dormant"),
        dict(customer_id="A", home_state="Tennessee", date_of_birth="05/06/1980",
             acquisition_channel="switch_kit", source_bank="Metro Savings"),
        dict(customer_id="B", date_of_birth=""),
        dict(customer_id="C", date_of_birth=None),
        dict(customer_id="D", date_of_birth="1900-01-01"),
        dict(customer_id="E", date_of_birth="2012-01-01"),
        dict(customer_id="F", date_of_birth="31/12/1999"),
        dict(customer_id="G", home_state=None, customer_status=None, attrition_flag="",
             join_date="not a date", updated_at="?"))
    judged = silver.judge_customers(raw)
    clean = silver.clean_customers(judged)
    a, g = clean.orderBy("customer_id").collect()
    assert (a.customer_id, a.home_state, a.date_of_birth) == ("A", "TN", dt.date(1980, 5, 6))
    assert (a.age, a.age_band, a.tenure_years) == (46, "46-55", 10.0)
    assert (a.customer_status, a.moved_from_bank, a.is_retained) == ("active", True, True)
    assert (a.source_bank, a.attrition_flag) == ("Metro Savings", 0)
    assert (g.home_state, g.is_retained, g.attrition_flag, g.tenure_years) == (None,) * 4
    assert (g.source_bank, g.updated_at) == (None, None)
    assert rows(silver.customers_quarantine(judged)) == [
        ("B", "", "missing_or_unparseable_dob"), ("C", None, "missing_or_unparseable_dob"),
        ("D", "1900-01-01", "implausible_age"), ("E", "2012-01-01", "implausible_age"),
        ("F", "31/12/1999", "missing_or_unparseable_dob")]
    assert silver.silver_customers(raw).count() == 2
    assert silver.silver_customers_quarantine(raw).count() == 5


def test_customers_as_of_is_an_argument(spark):
    raw = bronze(spark, "customers", dict(date_of_birth="2000-01-01"))
    assert silver.silver_customers(raw, "2018-01-02").first()["age"] == 18
    assert silver.silver_customers(raw, "2017-01-02").count() == 0


@pytest.mark.parametrize("balance,customer,reason", [
    ("0", "C1", None), ("9999999.99", "C1", None), ("-0.01", "C1", "negative_balance"),
    ("10000000", "C1", "balance_outlier_100x"), ("abc", "C1", "unparseable_balance"),
    (None, "C1", "unparseable_balance"), ("NaN", "C1", "balance_outlier_100x"),
    ("5", "X", "orphan_customer_id"), ("-5", "X", "orphan_customer_id"),
    ("5", None, "orphan_customer_id"),
])
def test_account_reasons(spark, balance, customer, reason):
    raw = bronze(spark, "accounts", dict(balance=balance, customer_id=customer))
    parents = bronze(spark, "customers", {}, {})
    judged = silver.judge_accounts(raw, parents)
    assert judged.first()["quarantine_reason"] == reason
    clean = silver.silver_accounts(raw, parents)
    assert clean.count() == silver.clean_accounts(judged).count() == (reason is None)
    assert silver.silver_accounts_quarantine(raw, parents).count() == (reason is not None)


def test_transactions_dedup_before_the_limit(spark):
    raw = bronze(
        spark, "card_transactions",
        dict(txn_id="T1", amount=200000.0, txn_ts="2026-01-01"),
        dict(txn_id="T1", amount=5.0, txn_ts="2026-01-02"),
        dict(txn_id="T2", amount=99999.99), dict(txn_id="T2", amount=99999.99),
        dict(txn_id="T3", amount=100000.0), dict(txn_id="T4", amount=-3.0),
        dict(txn_id="T5", amount=None), dict(txn_id="T6", amount=float("-inf")))
    assert rows(silver.silver_card_transactions(raw), "txn_id", "amount") == [
        ("T2", 99999.99), ("T4", -3.0)]
    assert rows(silver.silver_txn_quarantine(raw), "txn_id", "quarantine_reason") == [
        ("T1", "amount_outlier_100x"), ("T3", "amount_outlier_100x"),
        ("T5", "unparseable_amount"), ("T6", "unparseable_amount")]


def test_branches_and_events(spark):
    assert silver.silver_branches(bronze(spark, "branches", {})).first()["opened_date"] == (
        dt.date(2001, 2, 3))
    events = silver.silver_customer_events(
        bronze(spark, "customer_events", {}, dict(source_bank="Union Trust", event_date="x")))
    assert rows(events, "event_date", "source_bank") == [
        (None, "Union Trust"), (dt.date(2026, 2, 2), None)]


def lake(spark, **over):
    sources = {
        "customers": bronze(
            spark, "customers",
            dict(customer_id="C1"),
            dict(customer_id="C2", acquisition_channel="switch_kit", home_branch_id="B9",
                 date_of_birth="2003-01-01"),
            dict(customer_id="C3", acquisition_channel="switch_kit", customer_status="attrited",
                 source_bank="Union Trust"),
            dict(customer_id="C4", acquisition_channel="switch_kit", customer_status=None,
                 source_bank="Union Trust"),
            dict(customer_id="C5", date_of_birth="")),
        "accounts": bronze(
            spark, "accounts", dict(account_id="A1", customer_id="C1", balance="10.01"),
            dict(account_id="A2", customer_id="C1", balance="0.02"),
            dict(account_id="A3", customer_id="C2", balance="7"),
            dict(account_id="A5", customer_id="C5"), dict(account_id="A6", customer_id="X"),
            dict(account_id="A7", customer_id="C1", balance="-1")),
        "branches": bronze(spark, "branches", {}, dict(branch_region="Zone")),
        "customer_events": bronze(spark, "customer_events", {}),
        "card_transactions": bronze(
            spark, "card_transactions",
            dict(txn_id="1", account_id="A1", amount=0.1), dict(txn_id="2", account_id="A1",
                                                              amount=0.2),
            dict(txn_id="3", account_id="A2", card_type="credit"),
            dict(txn_id="4", account_id="A3", channel="atm"),
            dict(txn_id="5", account_id="A3"), dict(txn_id="6", account_id="A5"),
            dict(txn_id="7", account_id="A6"), dict(txn_id="8", account_id="A7"),
            dict(txn_id="9", account_id=None)),
        **over}
    return Medallion(sources)


def test_customer_360(spark):
    t = lake(spark)
    got = {r.customer_id: r for r in t.customer_360.collect()}
    assert sorted(got) == ["C1", "C2", "C3", "C4"]
    one = got["C1"]
    assert (one.num_accounts, one.total_balance, one.avg_account_balance) == (2, 10.03, 5.02)
    assert (one.txn_count, one.debit_swipe_count, one.debit_txn_count) == (3, 2, 2)
    assert one.total_spend == 10.3 and one.region == "South"
    assert (got["C2"].region, got["C2"].debit_txn_count, got["C2"].debit_swipe_count) == (
        None, 2, 1)
    assert (got["C3"].num_accounts, got["C3"].total_balance, got["C3"].total_spend) == (0, 0, 0)
    assert t.customer_360.columns == gold.CUSTOMER_360


def test_rollups_agree_with_separate_operators(spark):
    t = lake(spark)
    balances = {r.customer_id: r for r in gold.balance_by_customer(t.accounts).collect()}
    activity = {r.customer_id: r for r in
                gold.activity_by_customer(t.transactions, t.accounts).collect()}
    for r in t.customer_360.collect():
        b, a = balances.get(r.customer_id), activity.get(r.customer_id)
        assert r.num_accounts == (b.num_accounts if b else 0)
        assert r.total_balance == (b.total_balance if b else 0)
        assert r.avg_account_balance == (b.avg_account_balance if b else 0)
        assert r.txn_count == (a.txn_count if a else 0)
        assert r.total_spend == (a.total_spend if a else 0)


def test_facts_drop_unowned_transactions(spark):
    t = lake(spark)
    assert rows(t.facts, "txn_id", "customer_id") == [
        ("1", "C1"), ("2", "C1"), ("3", "C1"), ("4", "C2"), ("5", "C2")]
    assert t.facts.columns == gold.FACTS


def test_retention_with_unknown_status(spark):
    assert rows(lake(spark).retention_summary) == [
        ("Union Trust", 2, 0, 1, 0.0), ("unknown", 1, 1, 0, 1.0)]


def test_reports(spark):
    t = lake(spark)
    assert tuple(reports.kpi_overview(t.customer_360).first()) == (4, 17.03, 0.3333, 3)
    assert tuple(reports.kpi_overview(t.customer_360, "private").first()) == (0, None, None, None)
    assert rows(reports.swipes_two_paths(t.customer_360, t.facts)) == [
        (1, "customer_360"), (1, "facts")]
    assert rows(reports.retention_outcomes(t.retention_summary)) == [
        ("Union Trust", "left_us", 1), ("Union Trust", "stayed", 0), ("unknown", "left_us", 0),
        ("unknown", "stayed", 1)]
    assert tuple(reports.anchor_moved(t.customer_360).first()) == (3, 1, 0.333)
    assert reports.attrited_count(t.customer_360).first()[0] == 1
    assert [r.source_bank for r in reports.retention_table(t.retention_summary).collect()] == [
        "Union Trust", "unknown"]


def test_reason_buckets(spark):
    events = silver.silver_customer_events(bronze(
        spark, "customer_events", *[dict(event_id=f"E{i}", reason=r) for i, r in enumerate(
            ["fees", "rate", "service", "relocation", "competitor_offer", "else", None])]))
    assert rows(reports.churn_reason_buckets(events)) == [
        ("competitor", 1), ("life_event", 1), ("other", 2), ("pricing", 2), ("service", 1)]
    assert rows(reports.churn_reason_examples(events, 1), "bucket", "event_id") == [
        ("competitor", "E4"), ("life_event", "E3"), ("other", "E5"), ("pricing", "E0"),
        ("service", "E2")]


def test_empty_sources(spark):
    empty = {s: bronze(spark, s, {}).limit(0) for s in (
        "customers", "accounts", "branches", "customer_events", "card_transactions")}
    t = Medallion(empty)
    for df in (t.customers, t.accounts, t.accounts_quarantine, t.transactions, t.customer_360,
               t.facts, t.balance_by_age_band, t.retention_summary):
        assert df.count() == 0
    assert reports.kpi_overview(t.customer_360).first()[0] == 0


def test_hot_account_and_hot_customer(spark):
    """A third of all rows under one key changes nothing in the results."""
    n = 3000
    txns = spark.range(n).select(
        F.concat(F.lit("T"), "id").alias("txn_id"),
        F.when(F.col("id") % 3 == 0, "A1").otherwise(F.concat(F.lit("Z"), "id"))
         .alias("account_id"),
        F.lit("debit").alias("card_type"), F.lit("swipe").alias("channel"),
        F.lit("gas").alias("merchant_category"), F.lit(1.01).alias("amount"),
        F.lit("2026-01-01").alias("txn_ts"))
    accounts = spark.range(n).select(
        F.when(F.col("id") == 0, "A1").otherwise(F.concat(F.lit("Z"), "id")).alias("account_id"),
        F.when(F.col("id") % 3 == 0, "C1").otherwise(F.lit("C2")).alias("customer_id"),
        F.lit("checking").alias("account_type"), F.lit("2020-01-01").alias("open_date"),
        F.lit("").alias("close_date"), F.lit("2.50").alias("balance"),
        F.lit("open").alias("account_status"))
    t = lake(spark, card_transactions=txns, accounts=accounts)
    got = {r.customer_id: r for r in t.customer_360.collect()}
    assert (got["C1"].txn_count, got["C1"].total_spend) == (n // 3, 1010.0)
    assert (got["C2"].num_accounts, got["C2"].total_balance) == (2 * n // 3, 5000.0)
    assert t.facts.count() == n
