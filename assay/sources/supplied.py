"""Landing view of the supplied tables: banking sources with known defects.

Every view is a projection of one table (branches: of two small ones), so it scans only the
columns it needs and works at any size. Rules are in FIXTURES.md, part B.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

from ..functions.values import AS_OF, MERCHANT_CATEGORIES, SOURCE_BANKS, STATES
from ..session import fit_shuffles


def _array(values) -> str:
    return "array(" + ", ".join(f"'{v}'" for v in values) + ")"


_CODES = _array(code for code, _ in STATES)
_NAMES = _array(name for _, name in STATES)
_BANKS = _array(SOURCE_BANKS)
_AS_OF = f"DATE'{AS_OF}'"


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return fit_shuffles(spark.read.parquet(f"{folder}/{table}.parquet"))


def raw_customers(spark: SparkSession, folder: str) -> DataFrame:
    base = _read(spark, folder, "customer").selectExpr(
        "c_custkey AS k", "c_nationkey",
        "date_add(DATE'1938-10-01', int(c_custkey * 7919 % 25000)) AS dob",
        "date_add(DATE'2008-10-01', int(c_custkey * 104729 % 6500)) AS joined",
        "CASE WHEN c_custkey % 11 <= 1 THEN 'switch_kit' WHEN c_custkey % 11 <= 5 THEN 'branch'"
        " WHEN c_custkey % 11 <= 8 THEN 'online' WHEN c_custkey % 11 = 9 THEN 'referral'"
        " ELSE 'employer' END AS acquisition_channel",
        "CASE WHEN c_mktsegment IN ('HOUSEHOLD', 'BUILDING', 'FURNITURE') THEN 'mass_market'"
        " WHEN c_mktsegment = 'MACHINERY' THEN 'affluent' ELSE 'private' END AS segment")
    outcome = base.selectExpr(
        "*", f"datediff({_AS_OF}, joined) AS days",
        f"1.2D - 0.30D * least(datediff({_AS_OF}, joined) / 365.25D, 15.0D)"
        f" + 1.55D * double(datediff({_AS_OF}, dob) / 365.25D < 30)"
        " + 0.88D * double(acquisition_channel = 'switch_kit')"
        " - 1.10D * double(segment <> 'mass_market') AS z",
        "bigint(conv(substring(md5(concat('L', k)), 1, 7), 16, 10)) / 268435456D AS u")
    flagged = outcome.selectExpr(
        "*", "CASE WHEN days < 270 THEN '' WHEN u < 1D / (1D + exp(-z)) THEN '1' ELSE '0' END"
             " AS attrition_flag")
    copied = flagged.selectExpr(
        "*",
        "CASE WHEN attrition_flag = '1' AND k % 17 = 0 THEN 'reactivated'"
        " WHEN attrition_flag = '1' THEN 'attrited' WHEN k % 9 = 1 THEN 'dormant'"
        " ELSE 'active' END AS status",
        "explode(CASE WHEN k % 100 = 0 THEN array(false, true) ELSE array(false) END) AS stale")
    return copied.selectExpr(
        "concat('CUST', k) AS customer_id", "concat('First', k % 38) AS first_name",
        "concat('Last', k % 36) AS last_name",
        "CASE WHEN k % 250 = 7 THEN ''"
        " WHEN k % 500 = 11 THEN string(date_add(DATE'1900-01-01', int(k % 300)))"
        " WHEN k % 20 = 3 THEN date_format(dob, 'MM/dd/yyyy') ELSE string(dob) END"
        " AS date_of_birth",
        "array('F', 'M', 'F', 'M', 'X')[int(k % 5)] AS gender",
        f"CASE WHEN k % 19 = 0 THEN {_NAMES}[int(k % 12)] ELSE {_CODES}[int(k % 12)] END"
        " AS home_state",
        "string(k * 31 % 90000 + 10000) AS home_zip",
        "concat('BR', c_nationkey) AS home_branch_id", "segment", "acquisition_channel",
        f"CASE WHEN acquisition_channel = 'switch_kit' AND k % 37 <> 0 THEN {_BANKS}[int(k % 8)]"
        " ELSE '' END AS source_bank",
        "string(joined) AS join_date",
        "CASE WHEN NOT stale THEN status WHEN status = 'active' THEN 'dormant' ELSE 'active' END"
        " AS customer_status",
        "attrition_flag",
        "CASE WHEN stale THEN '2026-05-01' ELSE '2026-09-01' END AS updated_at")


def raw_accounts(spark: SparkSession, folder: str) -> DataFrame:
    return _read(spark, folder, "orders").selectExpr(
        "concat('ACC', o_orderkey) AS account_id",
        "CASE WHEN o_orderkey % 500 = 2 THEN concat('CUST9', o_custkey + 1000000)"
        " ELSE concat('CUST', o_custkey) END AS customer_id",
        "CASE substring(o_orderpriority, 1, 1) WHEN '2' THEN 'savings'"
        " WHEN '3' THEN 'money_market' WHEN '4' THEN 'cd' ELSE 'checking' END AS account_type",
        "string(date(o_orderdate)) AS open_date", "'' AS close_date",
        "string(cast(CASE WHEN o_orderkey % 300 = 0 THEN -o_totalprice"
        " WHEN o_orderkey % 1250 = 1 THEN o_totalprice * 100 ELSE o_totalprice END"
        " AS DECIMAL(20, 2))) AS balance",
        "'open' AS account_status")


def raw_card_transactions(spark: SparkSession, folder: str) -> DataFrame:
    return _read(spark, folder, "lineitem").selectExpr(
        "concat('TXN', l_orderkey, '-', l_linenumber) AS txn_id",
        "concat('ACC', l_orderkey) AS account_id",
        "CASE WHEN l_returnflag = 'R' THEN 'credit' ELSE 'debit' END AS card_type",
        "array('online', 'atm', 'swipe', 'contactless')[int(l_partkey % 4)] AS channel",
        f"{_array(MERCHANT_CATEGORIES)}[int(l_suppkey % 9)] AS merchant_category",
        "l_extendedprice AS amount", "string(date(l_shipdate)) AS txn_ts")


def raw_customer_events(spark: SparkSession, folder: str) -> DataFrame:
    return (_read(spark, folder, "events")
            .selectExpr(
                "concat('EVT', event_id) AS event_id", "concat('CUST', user_id) AS customer_id",
                "CASE event_type WHEN 'signup' THEN 'acquired' WHEN 'error' THEN 'attrited'"
                " WHEN 'purchase' THEN 'reactivated' WHEN 'view' THEN 'statement_viewed'"
                " ELSE 'offer_opened' END AS event_type",
                "string(date(ts)) AS event_date",
                f"CASE WHEN event_type = 'signup' AND event_id % 5 = 0"
                f" THEN {_BANKS}[int(event_id % 8)] ELSE '' END AS source_bank",
                "CASE event_type WHEN 'signup' THEN 'switch' WHEN 'error' THEN array('fees',"
                " 'rate', 'service', 'relocation', 'competitor_offer')[int(event_id % 5)]"
                " WHEN 'purchase' THEN 'win_back_offer' ELSE '' END AS reason"))


def raw_branches(spark: SparkSession, folder: str) -> DataFrame:
    return (_read(spark, folder, "nation")
            .withColumnRenamed("n_regionkey", "r_regionkey")
            .join(_read(spark, folder, "region"), "r_regionkey")
            .selectExpr(
                "concat('BR', n_nationkey) AS branch_id",
                "concat(n_name, ' Branch') AS branch_name",
                f"{_CODES}[int(n_nationkey % 12)] AS branch_state", "r_name AS branch_region",
                "string(date_add(DATE'2005-01-01', int(n_nationkey * 283 % 7000)))"
                " AS opened_date"))


SOURCES = {
    "customers": raw_customers, "accounts": raw_accounts, "branches": raw_branches,
    "customer_events": raw_customer_events, "card_transactions": raw_card_transactions,
}


class LandingViews(Mapping):
    """The five views by source name; a view is made when it is first asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self._make = {name: lambda view=view: view(spark, folder)
                      for name, view in SOURCES.items()}
        self._made: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._make[name]()
        return self._made[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._make)

    def __len__(self) -> int:
        return len(self._make)


def raw_sources(spark: SparkSession, folder: str) -> LandingViews:
    return LandingViews(spark, folder)
