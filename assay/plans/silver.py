"""Silver: typed, deduplicated, judged.

Each ``judge_*`` function returns the parsed rows with their quarantine reason; the clean table
and its quarantine are two filters on that one frame, so they add up to the input and the costly
part (dedup or foreign-key join) is written once. All of them read bronze frames whose columns
are text as landed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as c
from ..functions import money
from ..functions import values as v
from ..operators import quality as q
from ..operators.dedupe import dedupe_first, dedupe_latest
from ..operators.parents import tag_orphans, with_parent
from ..sources.landing import CORRUPT

CUSTOMER_RULES = [
    q.Rule("valid_dob", "date_of_birth IS NOT NULL", "drop", "missing_or_unparseable_dob"),
    q.Rule("plausible_age", f"age BETWEEN {v.MIN_AGE} AND {v.MAX_AGE}", "drop",
           "implausible_age"),
    q.Rule("known_state", "home_state IS NOT NULL", "warn"),
]
ACCOUNT_RULES = [
    q.Rule("non_negative_balance", "balance >= 0", "drop", "negative_balance"),
    q.Rule("plausible_balance", f"balance < {v.BALANCE_LIMIT}", "drop",
           "balance_outlier_100x"),
    q.Rule("has_customer", "customer_id IS NOT NULL", "drop", "orphan_customer_id"),
]
TRANSACTION_RULES = [
    q.Rule("plausible_amount", f"amount < {v.AMOUNT_LIMIT}", "drop", "amount_outlier_100x"),
]

# Order in which the reason of a bad account is looked for.
_ACCOUNT_REASONS = [
    q.Rule("has_customer", "NOT is_orphan", reason="orphan_customer_id"),
    q.Rule("readable_balance", "balance IS NOT NULL", reason="unparseable_balance"),
    ACCOUNT_RULES[0], ACCOUNT_RULES[1],
]
# The accounts that the expectations look at.
HAS_PARENT = f"coalesce({q.REASON}, '') <> '{_ACCOUNT_REASONS[0].reason}'"
_TRANSACTION_REASONS = [
    q.Rule("has_id", "txn_id IS NOT NULL", reason="missing_txn_id"),
    q.Rule("readable_amount", "is_money", reason="unparseable_amount"), TRANSACTION_RULES[0],
]

CUSTOMER_COLUMNS = [
    "customer_id", "first_name", "last_name", "date_of_birth", "gender", "home_state",
    "home_zip", "home_branch_id", "segment", "acquisition_channel", "source_bank", "join_date",
    "customer_status", "attrition_flag", "updated_at", "age", "age_band", "tenure_years",
    "moved_from_bank", "is_retained",
]
ACCOUNT_COLUMNS = [
    "account_id", "customer_id", "account_type", "open_date", "account_status", "balance",
]
TRANSACTION_COLUMNS = [
    "txn_id", "account_id", "card_type", "channel", "merchant_category", "amount", "txn_date",
]


# Branches and events: typed only.

def silver_branches(bronze: DataFrame) -> DataFrame:
    return c.typed(bronze.select(*v.BRANCH_FIELDS), {"opened_date": "date"})


def silver_customer_events(bronze: DataFrame) -> DataFrame:
    events = c.typed(bronze.select(*v.EVENT_FIELDS), {"event_date": "date"})
    return c.null_if_empty(events, ["source_bank"])


# Customers.

def parse_customers(bronze: DataFrame, as_of=v.AS_OF) -> DataFrame:
    """Latest row per customer, typed, standardised, with derived columns and the raw dob."""
    raw = bronze.select(*v.CUSTOMER_FIELDS)
    latest = dedupe_latest(
        raw, ["customer_id"], F.col("updated_at").try_cast("date"),
        [f for f in v.CUSTOMER_FIELDS if f not in ("customer_id", "updated_at")])
    parsed = latest.withColumns({
        "dob_raw": F.col("date_of_birth"),
        "date_of_birth": c.parse_date("date_of_birth", v.DATE_FORMATS),
        "home_state": c.standardize("home_state", v.STATE_CODES),
    })
    parsed = c.null_if_empty(parsed, ["source_bank"])
    parsed = c.typed(parsed, {
        "join_date": "date", "attrition_flag": "int", "updated_at": "date"})
    return (parsed
            .withColumn("age", c.age_at("date_of_birth", as_of))
            .withColumns({
                "age_band": c.band("age", v.AGE_BANDS),
                "tenure_years": c.years_between("join_date", as_of),
                "moved_from_bank": F.col("acquisition_channel") == "switch_kit",
                "is_retained": F.col("customer_status") != "attrited",
            })
            .select(*CUSTOMER_COLUMNS, "dob_raw"))


def judge_customers(bronze: DataFrame, as_of=v.AS_OF) -> DataFrame:
    return q.judge(parse_customers(bronze, as_of), CUSTOMER_RULES)


def clean_customers(judged: DataFrame) -> DataFrame:
    return q.clean_rows(judged).select(*CUSTOMER_COLUMNS)


def customers_quarantine(judged: DataFrame) -> DataFrame:
    return q.quarantined_rows(judged).select("customer_id", "dob_raw", q.REASON)


def silver_customers(bronze: DataFrame, as_of=v.AS_OF) -> DataFrame:
    return clean_customers(judge_customers(bronze, as_of))


def silver_customers_quarantine(bronze: DataFrame, as_of=v.AS_OF) -> DataFrame:
    return customers_quarantine(judge_customers(bronze, as_of))


# Accounts. ``parents`` is the table that makes an account known: bronze customers by default,
# silver customers for the stricter reading.

def parse_accounts(bronze: DataFrame) -> DataFrame:
    return c.typed(bronze.select(*ACCOUNT_COLUMNS), {"open_date": "date", "balance": "double"})


def judge_accounts(bronze: DataFrame, parents: DataFrame) -> DataFrame:
    tagged = tag_orphans(parse_accounts(bronze), parents, "customer_id")
    return q.judge(tagged, _ACCOUNT_REASONS).drop("is_orphan")


def clean_accounts(judged: DataFrame) -> DataFrame:
    return q.clean_rows(judged).select(*ACCOUNT_COLUMNS)


def accounts_quarantine(judged: DataFrame) -> DataFrame:
    return q.quarantined_rows(judged).select("account_id", "customer_id", "balance", q.REASON)


def silver_accounts(bronze: DataFrame, parents: DataFrame) -> DataFrame:
    """Clean accounts alone: filter first, then a semi join, with no distinct on the parents."""
    rules = {r.name: r.predicate for r in ACCOUNT_RULES}
    return with_parent(q.expect(parse_accounts(bronze), rules), parents, "customer_id")


def silver_accounts_quarantine(bronze: DataFrame, parents: DataFrame) -> DataFrame:
    return accounts_quarantine(judge_accounts(bronze, parents))


# Card transactions: the first row per id, then the expectation on that row.

def parse_transactions(bronze: DataFrame) -> DataFrame:
    """The first row per id, typed; ``raw_text`` holds what could not be read, the line or the
    amount. Rows without an id are no copies of each other and all stay."""
    corrupt = F.col(CORRUPT) if CORRUPT in bronze.columns else F.lit(None).cast("string")
    raw = bronze.select(
        *v.TRANSACTION_FIELDS, corrupt.alias("__corrupt"),
        F.when(F.col("txn_id").isNull(), F.monotonically_increasing_id()).alias("__lone"))
    first = dedupe_first(
        raw, ["txn_id", "__lone"], "txn_ts",
        ["account_id", "card_type", "channel", "merchant_category", "amount"])
    amount = F.col("amount").try_cast("double")
    return (first
            .withColumn("raw_text", F.coalesce(
                "__corrupt", F.when(amount.isNull(), F.col("amount").cast("string"))))
            .withColumn("amount", amount)
            .withColumn("txn_date", F.col("txn_ts").try_cast("date"))
            .select(*TRANSACTION_COLUMNS, "raw_text"))


def judge_transactions(bronze: DataFrame) -> DataFrame:
    """Lines that could not be read and rows without an id are quarantined, and so is an amount
    that has no exact form in cents (NULL, NaN, infinite, beyond 16 digits), so that sums over
    silver are exact."""
    parsed = parse_transactions(bronze).withColumn(
        "is_money", money.to_money("amount").isNotNull())
    return q.judge(parsed, _TRANSACTION_REASONS).drop("is_money")


def clean_transactions(judged: DataFrame) -> DataFrame:
    return q.clean_rows(judged).select(*TRANSACTION_COLUMNS)


def transactions_quarantine(judged: DataFrame) -> DataFrame:
    return q.quarantined_rows(judged).select("txn_id", "account_id", "amount", "raw_text", q.REASON)


def silver_card_transactions(bronze: DataFrame) -> DataFrame:
    return clean_transactions(judge_transactions(bronze))


def silver_txn_quarantine(bronze: DataFrame) -> DataFrame:
    return transactions_quarantine(judge_transactions(bronze))
