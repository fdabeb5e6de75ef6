"""Registered queries: every one reads the supplied tables in full."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import columns as c
from .functions import values as v
from .functions.features import churn_features, scorecard
from .operators import defects as d
from .operators import model as m
from .operators import parents, profile, quality, ranks, sketches
from .operators.dedupe import dedupe_first, dedupe_latest, top_k
from .operators.preparation import CategoryIndexer, MedianImputer
from .plans import gold, metrics, reports, silver
from .plans.medallion import Medallion, SegmentView, build, build_scored
from .session import new_folder, stage, tune
from .sources import landing, supplied, tables
from .streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SEED = 7
SEEDS = (7, 8, 9)
PLANTED_CUSTOMERS = [
    d.Defect("long_form_state", "home_state",
             "CASE home_state " + " ".join(
                 f"WHEN '{code}' THEN '{name}'" for code, name in v.STATES)
             + " ELSE home_state END", 0.05, "length(home_state) = 2"),
    d.Defect("alt_date_format_dob", "date_of_birth",
             "date_format(try_cast(date_of_birth AS DATE), 'MM/dd/yyyy')", 0.05,
             "try_cast(date_of_birth AS DATE) IS NOT NULL"),
    d.Defect("missing_dob", "date_of_birth", "''", 0.004),
]
PLANTED_ACCOUNTS = [
    d.Defect("negative_balance", "balance",
             "cast(-abs(cast(balance AS DECIMAL(20,2))) AS STRING)", 0.003),
    d.Defect("balance_outlier_100x", "balance",
             "cast(cast(cast(balance AS DECIMAL(20,2)) * 100 AS DECIMAL(22,2)) AS STRING)",
             0.0008),
    d.Defect("orphan_account_customer", "customer_id", "concat('GONE', account_id)", 0.002),
]
PLANTED_TRANSACTIONS = [
    d.Defect("txn_amount_outlier_100x", "amount", "amount * 100", 0.0004),
]
CUSTOMER_COPY_RATE, TRANSACTION_COPY_RATE = 0.01, 0.0014
# A stale copy is older and carries another status.
STALE = {
    "updated_at": "cast(date_sub(cast(updated_at AS DATE), 200) AS STRING)",
    "customer_status": "CASE customer_status WHEN 'active' THEN 'dormant' ELSE 'active' END",
}
# Wide ranges that hold at every size of the supplied data.
EXPECTED_RANGES = {
    "customers": (1, 1e15), "retention_rate": (0.5, 0.95), "quarantine_share": (0.0, 0.02),
    "unlabelled_share": (0.0, 0.06), "base_rate": (0.2, 0.3), "age_bands": (7, 7),
}


def register(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def lake(spark: SparkSession, folder: str) -> Medallion:
    return Medallion(supplied.raw_sources(tune(spark), folder))


# Silver.

@register
def silver_branches(spark, folder):
    return lake(spark, folder).branches


@register
def silver_customers(spark, folder):
    return lake(spark, folder).customers


@register
def silver_customers_quarantine(spark, folder):
    return lake(spark, folder).customers_quarantine


@register
def silver_accounts(spark, folder):
    return lake(spark, folder).accounts


@register
def silver_accounts_strict_parent(spark, folder):
    """The same accounts checked against the clean customers instead of all known ones."""
    t = lake(spark, folder)
    return silver.silver_accounts(t.bronze["accounts"], t.customers)


@register
def silver_accounts_quarantine(spark, folder):
    return lake(spark, folder).accounts_quarantine


@register
def silver_card_transactions(spark, folder):
    return lake(spark, folder).transactions


@register
def silver_txn_quarantine(spark, folder):
    return lake(spark, folder).transactions_quarantine


@register
def silver_customer_events(spark, folder):
    return lake(spark, folder).events


# Gold.

@register
def gold_customer_360(spark, folder):
    return lake(spark, folder).customer_360


@register
def gold_transaction_facts(spark, folder):
    return lake(spark, folder).facts


@register
def gold_balance_by_age_band(spark, folder):
    return lake(spark, folder).balance_by_age_band


@register
def gold_retention_summary(spark, folder):
    return lake(spark, folder).retention_summary


@register
def balance_by_customer(spark, folder):
    return gold.balance_by_customer(lake(spark, folder).accounts)


@register
def activity_by_customer(spark, folder):
    t = lake(spark, folder)
    return gold.activity_by_customer(t.transactions, t.accounts)


# Scalar functions, dedup and joins on their own.

@register
def parsed_dates(spark, folder):
    raw = supplied.raw_customers(tune(spark), folder)
    return raw.select(
        "customer_id", "updated_at", "date_of_birth",
        c.parse_date("date_of_birth", v.DATE_FORMATS).alias("parsed"),
        c.parse_date("date_of_birth", ["MM/dd/yyyy"]).alias("parsed_us_only"))


@register
def standardized_states(spark, folder):
    raw = supplied.raw_customers(tune(spark), folder)
    return (raw.groupBy("home_state", c.standardize("home_state", v.STATE_CODES).alias("code"))
               .agg(F.count("*").alias("n")))


@register
def ages_and_bands(spark, folder):
    """Age, age band and tenure of the latest customer rows, implausible ages included."""
    parsed = silver.parse_customers(supplied.raw_customers(tune(spark), folder))
    return parsed.groupBy("age", "age_band").agg(
        F.count("*").alias("n"), F.min("tenure_years").alias("min_tenure"),
        F.max("tenure_years").alias("max_tenure"))


@register
def latest_customers(spark, folder):
    raw = supplied.raw_customers(tune(spark), folder)
    latest = dedupe_latest(raw, ["customer_id"], "updated_at", ["customer_status"])
    return latest.select("customer_id", "updated_at", "customer_status")


@register
def first_transactions(spark, folder):
    raw = supplied.raw_card_transactions(tune(spark), folder)
    return dedupe_first(raw, ["txn_id"], "txn_ts", [
        "account_id", "card_type", "channel", "merchant_category", "amount"])


@register
def orphan_accounts(spark, folder):
    t = lake(spark, folder)
    return parents.orphans(t.bronze["accounts"], t.bronze["customers"], "customer_id").select(
        "account_id", "customer_id", "balance")


@register
def largest_accounts(spark, folder):
    accounts = lake(spark, folder).accounts
    return top_k(accounts.select("account_id", "customer_id", "balance"),
                 [F.col("balance").desc(), "account_id"], 25)


@register
def average_ranks(spark, folder):
    """Rank basis of the AUC on the customers' balances: one row per distinct balance."""
    return ranks.average_rank(lake(spark, folder).customer_360, "total_balance")


# Profiling.

@register
def profile_columns(spark, folder):
    """Exact profile of the raw customers and accounts."""
    raw = supplied.raw_sources(tune(spark), folder)
    parts = [profile.profile(raw[s], approx=False).withColumn("table_name", F.lit(s))
             for s in ("customers", "accounts")]
    return parts[0].unionByName(parts[1])


@register
def profile_sketched(spark, folder):
    """Profile of the accounts from sketches that were kept for each type of account and merged;
    are the estimates within four standard errors of the exact numbers?"""
    t = lake(spark, folder).bronze["accounts"]
    accounts = t.withColumn("balance", F.col("balance").cast("double"))
    kept = new_folder(spark, "sketches")
    for kind in ("checking", "savings"):
        sketches.store(accounts.where(F.col("account_type") == kind), kept, kind)
    sketches.store(accounts.where("account_type NOT IN ('checking', 'savings')"), kept, "others")
    told = sketches.estimates(sketches.stored(spark, kept), {"median": 0.5})
    exact = profile.profile(accounts, approx=False).select(
        "column_name", F.col("distinct_count").alias("exact"))
    median = told.where("column_name = 'balance'").first()["median"]
    rank = accounts.agg(F.avg((F.col("balance") <= median).cast("double")).alias("rank")).first()
    near = F.abs(F.col("distinct_count") - F.col("exact")) <= 0.0325 * F.col("exact")
    return told.join(exact, "column_name").select(
        "column_name", "row_count", "null_count", near.alias("distinct_near"),
        F.when(F.col("column_name") == "balance", F.lit(rank["rank"]).between(0.48, 0.52))
         .alias("median_near"))


@register
def sample_customers(spark, folder):
    """A few raw rows to look at."""
    raw = supplied.raw_customers(tune(spark), folder)
    return profile.sample_rows(raw.select(
        "customer_id", "date_of_birth", "home_state", "segment", "acquisition_channel",
        "source_bank", "customer_status", "updated_at"), 15)


@register
def duplicate_keys(spark, folder):
    raw = supplied.raw_card_transactions(tune(spark), folder)
    return profile.duplicate_keys(raw, ["txn_id"])


@register
def duplicate_summary(spark, folder):
    raw = supplied.raw_sources(tune(spark), folder)
    parts = [profile.duplicate_summary(raw[s], [k]).withColumn("table_name", F.lit(s))
             for s, k in (("customers", "customer_id"), ("card_transactions", "txn_id"),
                          ("branches", "branch_id"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register
def format_violations(spark, folder):
    raw = supplied.raw_customers(tune(spark), folder)
    return profile.count_where(raw, {
        "state_not_a_code": profile.nonmatching("home_state", "^[A-Z]{2}$"),
        "dob_not_iso": profile.not_iso_date("date_of_birth"),
        "dob_missing": profile.missing("date_of_birth"),
    })


@register
def missing_values(spark, folder):
    raw = supplied.raw_customers(tune(spark), folder)
    return profile.missing_count(raw, ["date_of_birth", "source_bank", "attrition_flag"])


@register
def range_violations(spark, folder):
    raw = supplied.raw_accounts(tune(spark), folder)
    return profile.range_violations(raw, "balance", 0, v.BALANCE_LIMIT)


@register
def distinct_counts(spark, folder):
    raw = supplied.raw_sources(tune(spark), folder)
    parts = [profile.distinct_count(raw[s], cols).withColumn("counted", F.lit(".".join(cols)))
             for s, cols in (("customers", ["customer_id"]), ("card_transactions", ["txn_id"]),
                             ("accounts", ["customer_id", "account_type"]))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def defects_of(raw) -> DataFrame:
    """The nine known defects, counted on landing data; one pass per source."""
    accounts = parents.tag_orphans(raw["accounts"], raw["customers"], "customer_id")
    parts = [
        profile.count_where(raw["customers"], {
            "long_form_state": profile.nonmatching("home_state", "^[A-Z]{2}$"),
            "alt_date_format_dob": profile.not_iso_date("date_of_birth"),
            "missing_dob": profile.missing("date_of_birth")}, "defect"),
        profile.count_where(accounts, {
            "negative_balance": profile.out_of_range("balance", low=0),
            "balance_outlier_100x": profile.out_of_range("balance", high=v.BALANCE_LIMIT),
            "orphan_account_customer": F.col("is_orphan")}, "defect"),
        profile.count_where(raw["card_transactions"], {
            "txn_amount_outlier_100x": profile.out_of_range("amount", high=v.AMOUNT_LIMIT),
        }, "defect"),
        profile.duplicate_summary(raw["customers"], ["customer_id"]).select(
            F.lit("duplicate_customer_rows").alias("defect"), F.col("excess_rows").alias("n")),
        profile.duplicate_summary(raw["card_transactions"], ["txn_id"]).select(
            F.lit("duplicate_txn_rows").alias("defect"), F.col("excess_rows").alias("n")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out


@register
def defect_report(spark, folder):
    return defects_of(supplied.raw_sources(tune(spark), folder))


@register
def expected_range_check(spark, folder):
    t = lake(spark, folder)
    judged = t.judged_customers
    share = lambda part, whole: c.ratio(part, whole, 6)
    # Seven bands at most, so counting them per customer table needs no exact distinct.
    clean = F.col(quality.REASON).isNull()
    moved = clean & F.col("moved_from_bank")
    wide = judged.agg(
        F.count("*").alias("all"), F.count_if(clean).alias("customers"),
        F.count_if(~clean).alias("bad"),
        F.count_if(moved).alias("moved"),
        F.count_if(moved & F.col("is_retained")).alias("stayed"),
        F.count_if(clean & F.col("attrition_flag").isNull()).alias("unlabelled"),
        F.count_if(clean & F.col("attrition_flag").isNotNull()).alias("labelled"),
        F.count_if(clean & (F.col("attrition_flag") == 1)).alias("left"),
        F.count_distinct(F.when(clean, F.col("age_band"))).alias("age_bands"))
    metrics_wide = wide.select(
        "customers", share("stayed", "moved").alias("retention_rate"),
        share("bad", "all").alias("quarantine_share"),
        share("unlabelled", "customers").alias("unlabelled_share"),
        share("left", "labelled").alias("base_rate"), "age_bands")
    long = profile.unpivot_metrics(metrics_wide, [], list(EXPECTED_RANGES))
    return profile.check_ranges(long, EXPECTED_RANGES)


@register
def metric_spread(spark, folder):
    """Smallest and greatest value of each headline metric over the regions' datasets."""
    c360 = lake(spark, folder).customer_360
    moved = F.coalesce(F.col("moved_from_bank"), F.lit(False))
    per_region = c360.groupBy("region").agg(
        F.count("*").alias("customers"),
        F.count_if(F.col("age").between(61, 65)).alias("n_61_65"),
        F.coalesce(F.sum(F.when(F.col("age").between(21, 25), F.col("debit_swipe_count"))),
                   F.lit(0)).alias("debit_swipes_21_25"),
        F.count_if(moved).alias("moved_in"),
        F.count_if(moved & F.col("is_retained")).alias("stayed"))
    long = profile.unpivot_metrics(
        per_region, ["region"],
        ["customers", "n_61_65", "debit_swipes_21_25", "moved_in", "stayed"])
    return profile.metric_spread(long)


# Data quality.

def table_metrics(raw) -> DataFrame:
    """Expectation metrics of the three checked tables: each on its deduplicated or
    parent-checked input, which is what the expectations see."""
    accounts = parents.with_parent(
        silver.parse_accounts(raw["accounts"]), raw["customers"], "customer_id")
    return (quality.expectation_metrics(
                silver.parse_customers(raw["customers"]), silver.CUSTOMER_RULES,
                "silver_customers")
            .unionAll(quality.expectation_metrics(
                accounts, silver.ACCOUNT_RULES, "silver_accounts"))
            .unionAll(quality.expectation_metrics(
                silver.parse_transactions(raw["card_transactions"]),
                silver.TRANSACTION_RULES, "silver_card_transactions")))


@register
def expectation_metrics(spark, folder):
    return table_metrics(supplied.raw_sources(tune(spark), folder))


@register
def expectation_drop(spark, folder):
    accounts = silver.parse_accounts(supplied.raw_accounts(tune(spark), folder))
    kept = quality.expect(accounts, {r.name: r.predicate for r in silver.ACCOUNT_RULES})
    return kept.select("account_id", "balance")


@register
def expectation_warn(spark, folder):
    events = lake(spark, folder).events
    flagged = quality.expect(events, {"known_bank": "source_bank IS NOT NULL"}, "warn")
    return flagged.groupBy("event_type", "known_bank_ok").agg(F.count("*").alias("n"))


@register
def expectation_fail(spark, folder):
    """Passes on clean accounts; on the raw ones the job would end with an error."""
    checked = quality.expect(lake(spark, folder).accounts,
                             {"non_negative_balance": "balance >= 0"}, "fail")
    return checked.groupBy("account_type").agg(F.count("*").alias("n"))


@register
def conservation_check(spark, folder):
    t = lake(spark, folder)
    first = dedupe_first(t.bronze["card_transactions"].select("txn_id", "txn_ts"),
                         ["txn_id"], "txn_ts")
    latest = dedupe_latest(t.bronze["customers"].select("customer_id", "updated_at"),
                           ["customer_id"], "updated_at")
    checks = {
        "customers": (latest, t.customers, t.customers_quarantine, "customer_id"),
        "accounts": (t.bronze["accounts"], t.accounts, t.accounts_quarantine, "account_id"),
        "card_transactions": (first, t.transactions, t.transactions_quarantine, "txn_id"),
    }
    parts = [quality.conservation(src, clean, bad, [key]).withColumn("source", F.lit(name))
             for name, (src, clean, bad, key) in checks.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def planted(raw, flagged: bool = False) -> dict[str, DataFrame]:
    customers = d.plant(raw["customers"], "customer_id", PLANTED_CUSTOMERS, SEED, flagged)
    transactions = d.plant(raw["card_transactions"], "txn_id", PLANTED_TRANSACTIONS, SEED,
                           flagged)
    return {
        "customers": d.plant_copies(customers, "customer_id", "duplicate_customer_rows",
                                    CUSTOMER_COPY_RATE, SEED, STALE, flagged),
        "accounts": d.plant(raw["accounts"], "account_id", PLANTED_ACCOUNTS, SEED, flagged),
        "card_transactions": d.plant_copies(transactions, "txn_id", "duplicate_txn_rows",
                                            TRANSACTION_COPY_RATE, SEED, flagged=flagged),
    }


def planting(raw, seed: int) -> DataFrame:
    """(defect, n): how many rows each of the nine planting rules hits under a seed."""
    return (d.planted_counts(raw["customers"], "customer_id", PLANTED_CUSTOMERS, seed,
                             {"duplicate_customer_rows": CUSTOMER_COPY_RATE})
            .unionAll(d.planted_counts(raw["accounts"], "account_id", PLANTED_ACCOUNTS, seed))
            .unionAll(d.planted_counts(raw["card_transactions"], "txn_id",
                                       PLANTED_TRANSACTIONS, seed,
                                       {"duplicate_txn_rows": TRANSACTION_COPY_RATE})))


@register
def planted_defects(spark, folder):
    """How many rows each of the nine planting rules hits."""
    return planting(supplied.raw_sources(tune(spark), folder), SEED)


@register
def metric_spread_runs(spark, folder):
    """Smallest and greatest number of rows that each planting rule hits over the runs of a ledger,
    one run per seed; a run that is entered twice counts once."""
    raw = supplied.raw_sources(tune(spark), folder)
    ledger = new_folder(spark, "ledger")
    for seed in (*SEEDS, SEEDS[0]):
        profile.record_run(planting(raw, seed).select(
            F.col("defect").alias("metric"), F.col("n").alias("value")), ledger, f"seed-{seed}")
    return profile.metric_spread(profile.recorded_runs(spark, ledger)).withColumnRenamed(
        "datasets", "runs")


def repeated(df: DataFrame, key: str) -> DataFrame:
    """``df`` with a flag on the rows whose key occurs more than once. The repeated keys are staged:
    a join with a written table is one that adaptive execution may broadcast, or split where a key
    is hot."""
    keys = stage(profile.duplicate_keys(df.select(key), [key]).select(
        F.col(key).alias("__key")), "repeated")
    return df.join(keys, F.col(key) == F.col("__key"), "left").withColumn(
        "is_repeated", F.col("__key").isNotNull()).drop("__key")


@register
def rule_coverage(spark, folder):
    """Of the rows that each planting rule hits, how many each of the nine checks fires on; what no
    check fires on, and what fires on untouched rows, included."""
    t = planted(supplied.raw_sources(tune(spark), folder), flagged=True)
    flags = lambda rules, *more: {
        n: F.col(d.planted_flag(n)) for n in (*[r.name for r in rules], *more)}
    accounts = parents.tag_orphans(t["accounts"], t["customers"], "customer_id")
    parts = {
        "customers": quality.coverage(
            repeated(t["customers"], "customer_id"),
            flags(PLANTED_CUSTOMERS, "duplicate_customer_rows"),
            {"long_form_state": profile.nonmatching("home_state", "^[A-Z]{2}$"),
             "alt_date_format_dob": profile.not_iso_date("date_of_birth"),
             "missing_dob": profile.missing("date_of_birth"),
             "duplicate_customer_rows": F.col("is_repeated")}),
        "accounts": quality.coverage(
            accounts, flags(PLANTED_ACCOUNTS),
            {"negative_balance": profile.out_of_range("balance", low=0),
             "balance_outlier_100x": profile.out_of_range("balance", high=v.BALANCE_LIMIT),
             "orphan_account_customer": F.col("is_orphan")}),
        "card_transactions": quality.coverage(
            repeated(t["card_transactions"], "txn_id"),
            flags(PLANTED_TRANSACTIONS, "duplicate_txn_rows"),
            {"txn_amount_outlier_100x": profile.out_of_range("amount", high=v.AMOUNT_LIMIT),
             "duplicate_txn_rows": F.col("is_repeated")}),
    }
    out = None
    for source, part in parts.items():
        part = part.select(F.lit(source).alias("source"), "planted", "fired", "n")
        out = part if out is None else out.unionAll(part)
    return out


@register
def dq_before_after(spark, folder):
    raw = supplied.raw_sources(tune(spark), folder)
    return quality.compare_metrics(table_metrics(raw), table_metrics(planted(raw)))


@register
def planted_caught(spark, folder):
    """Planted bad accounts by whether the quarantine of the damaged input holds them.

    A balance that stays below the limit after multiplication is the kind no expectation sees.
    """
    raw = supplied.raw_sources(tune(spark), folder)
    damaged = planted(raw)
    bad = silver.silver_accounts_quarantine(damaged["accounts"], damaged["customers"])
    return d.caught_counts(raw["accounts"], "account_id", PLANTED_ACCOUNTS, SEED, bad)


# Landing, bronze, tables.

def landed(spark, folder, sources) -> str:
    """Write the named sources as landing files below the shared work folder."""
    raw = supplied.raw_sources(tune(spark), folder)
    path = new_folder(spark, "landing")
    for source in sources:
        landing.export_source(raw[source], path, source)
    return path


def bronze_columns(df: DataFrame, source: str) -> DataFrame:
    """The declared columns, amounts as numbers, and whether the file's name is there."""
    return df.select(
        *[F.col(f).try_cast("double").alias(f) if f == "amount" else f
          for f in landing.source_fields(source)],
        F.col("_source_file").contains(f"/{source}/").alias("has_source"))


def _bronze_batch(source: str) -> Query:
    def query(spark, folder):
        df = landing.read_source(spark, landed(spark, folder, [source]), source, lineage=True)
        return bronze_columns(df, source)
    query.__name__ = f"bronze_{source}"
    return query


for _source in supplied.SOURCES:
    register(_bronze_batch(_source))


def _stream(source: str) -> Query:
    def query(spark, folder):
        path = landed(spark, folder, [source])
        bronze = ingest.source_to_bronze(
            spark, path, source, new_folder(spark, f"bronze-{source}"),
            new_folder(spark, f"progress-{source}"))
        return bronze_columns(bronze, source)
    query.__name__ = f"stream_bronze_{source}"
    return query


for _source in supplied.SOURCES:
    register(_stream(_source))


@register
def stream_dedupe(spark, folder):
    """Distinct keys that the streaming dedup lets through, each exactly once."""
    path = landed(spark, folder, ["card_transactions"])
    once = ingest.stream_dedupe(
        spark, f"{path}/card_transactions", landing.landing_schema("card_transactions"),
        "txn_id", new_folder(spark, "deduped"), new_folder(spark, "progress-deduped"))
    return once.select("txn_id")


@register
def landing_manifest(spark, folder):
    path = landed(spark, folder, list(supplied.SOURCES))
    return landing.landing_manifest(spark, path, list(supplied.SOURCES))


@register
def reordered_accounts(spark, folder):
    """Accounts that land in two files, the second with its columns in another order."""
    raw = supplied.raw_accounts(tune(spark), folder)
    path = new_folder(spark, "landing")
    half = F.pmod(F.xxhash64("account_id"), F.lit(2)) == 0
    for part, fields in ((half, v.ACCOUNT_FIELDS), (~half, v.ACCOUNT_FIELDS[::-1])):
        landing.export_landing(raw.where(part), f"{path}/accounts", fields)
    return landing.read_source(spark, path, "accounts").select(*v.ACCOUNT_FIELDS)


@register
def stream_reordered_accounts(spark, folder):
    """The same by the stream, in two deliveries; a file of other data is set aside meanwhile."""
    raw = supplied.raw_accounts(tune(spark), folder)
    path, out, progress = (new_folder(spark, n) for n in ("landing", "bronze", "progress"))
    half = F.pmod(F.xxhash64("account_id"), F.lit(2)) == 0
    for part, fields in ((half, v.ACCOUNT_FIELDS), (~half, v.ACCOUNT_FIELDS[::-1])):
        landing.export_landing(raw.where(part), f"{path}/accounts", fields)
        landing.export_landing(raw.select(F.col("balance").alias("x")).limit(3),
                               f"{path}/accounts", ["x"], shards=1)
        bronze = ingest.source_to_bronze(spark, path, "accounts", out, progress)
    return bronze.select(*v.ACCOUNT_FIELDS)


@register
def stream_first_transactions(spark, folder):
    """The first row per transaction, by its own time, though the rows of later days are delivered
    first; all columns."""
    raw = supplied.raw_card_transactions(tune(spark), folder)
    path, out, progress = (new_folder(spark, n) for n in ("landing", "firsts", "progress"))
    table = out.rsplit("/", 1)[1].replace("-", "_")
    schema = landing.landing_schema("card_transactions")
    early = F.pmod(F.xxhash64("txn_id", "txn_ts"), F.lit(2)) == 0
    for part in (~early, early):
        landing.export_source(raw.where(part), path, "card_transactions")
        firsts = ingest.stream_first(spark, f"{path}/card_transactions", schema, "txn_id",
                                     "txn_ts", table, out, progress)
    spark.sql(f"DROP TABLE {table}")  # the files stay, and the frame knows them
    return firsts.drop(landing.CORRUPT).withColumn("amount", F.col("amount").cast("double"))


def damaged_lines(raw: DataFrame) -> DataFrame:
    """Transactions as JSON lines, some of them cut short, without an id, or with a word as
    amount; which ones follows from the account's number."""
    n = F.regexp_extract("account_id", r"(\d+)", 1).cast("bigint")
    line = F.to_json(F.struct(
        F.when(n % 83 != 0, F.col("txn_id")).alias("txn_id"),
        *[c for c in v.TRANSACTION_FIELDS if c not in ("txn_id", "amount")],
        F.when(n % 89 == 0, "n/a").otherwise(F.col("amount").cast("string")).alias("amount")))
    return raw.select(F.when(n % 97 == 0, F.left(line, F.lit(25))).otherwise(line).alias("value"))


@register
def damaged_transactions(spark, folder):
    """Where the rows of a landing file with damaged lines end: silver or a reason."""
    raw = supplied.raw_card_transactions(tune(spark), folder)
    path = new_folder(spark, "landing")
    damaged_lines(raw).write.text(f"{path}/card_transactions")
    judged = silver.judge_transactions(landing.read_source(spark, path, "card_transactions"))
    return judged.groupBy(F.coalesce(quality.REASON, F.lit("clean")).alias("outcome"),
                          F.col("raw_text").isNotNull().alias("has_raw_text")).agg(
        F.count("*").alias("n"))


@register
def rebuild_counts(spark, folder):
    """Rows per table after the same database was built twice."""
    database, names = built(spark, folder, "assay_twice")
    build(spark, supplied.raw_sources(tune(spark), folder), database)
    return tables.table_counts({n: spark.table(f"{database}.{n}") for n in names})


@register
def landing_rows(spark, folder):
    """Rows per source as read back from the landing files."""
    manifest = landing_manifest(spark, folder)
    return manifest.select("source", "row_count", "landed")


def built(spark, folder, name) -> tuple[str, list[str]]:
    """A database of its own with all tables written."""
    database = new_folder(spark, name).rsplit("/", 1)[1].replace("-", "_")
    return database, build(spark, supplied.raw_sources(tune(spark), folder), database)


@register
def table_counts(spark, folder):
    database, names = built(spark, folder, "assay_build")
    return tables.table_counts({n: spark.table(f"{database}.{n}") for n in names})


@register
def observed_expectations(spark, folder):
    """The expectation metrics that a build counted while it wrote its tables."""
    database, _ = built(spark, folder, "assay_observed")
    return spark.table(f"{database}.expectation_metrics")


@register
def promote_tables(spark, folder):
    source, _ = built(spark, folder, "assay_source")
    target = source.replace("assay_source", "assay_target")
    tables.create_database(spark, target, new_folder(spark, target))
    return tables.promote(spark, source, target, tables.level_tables("medallion"))


@register
def promote_scored(spark, folder):
    """The seventeen tables of the second level, scores included."""
    source, _ = built(spark, folder, "assay_scored_source")
    build_scored(spark, source)
    target = source.replace("scored_source", "scored_target")
    tables.create_database(spark, target, new_folder(spark, target))
    return tables.promote(spark, source, target, tables.level_tables("scored"))


# Metric layer.

@register
def metric_by_region(spark, folder):
    """All ten measures by region."""
    return metrics.BANKING.query(
        lake(spark, folder).customer_360, list(metrics.BANKING.measures), by=["Region"])


@register
def metric_by_all_dimensions(spark, folder):
    """Counts and medians at the finest grain that the eleven dimensions give."""
    return metrics.BANKING.query(
        lake(spark, folder).customer_360, ["Customer Count", "Median Balance"],
        by=list(metrics.BANKING.dimensions))


@register
def metric_by_segment(spark, folder):
    return metrics.segment_comparison(lake(spark, folder).customer_360)


@register
def metric_filtered(spark, folder):
    """The three anchor questions through the metric layer."""
    c360 = lake(spark, folder).customer_360
    ask = metrics.BANKING.query
    first = ask(c360, ["Average Balance", "Customer Count"], where="`Age` BETWEEN 61 AND 65")
    second = ask(c360, ["Debit Card Swipes"], where="`Age` BETWEEN 21 AND 25")
    third = ask(c360, ["Customer Count", "Retention Rate"], where="`Moved From Bank` = true")
    rows = [
        first.select(F.lit("average_balance_61_65").alias("question"),
                     F.col("Average Balance").alias("answer"),
                     F.col("Customer Count").alias("n")),
        second.select(F.lit("debit_swipes_21_25"),
                      F.col("Debit Card Swipes").cast("double"), F.lit(None).cast("bigint")),
        third.select(F.lit("moved_and_retained"), F.col("Retention Rate"),
                     F.col("Customer Count")),
    ]
    return rows[0].unionAll(rows[1]).unionAll(rows[2])


@register
def metric_medians(spark, folder):
    return metrics.BANKING.query(
        lake(spark, folder).customer_360, ["Median Balance", "Customer Count"],
        by=["Age Band", "Segment"])


@register
def metric_catalogue(spark, folder):
    """Definitions with the number of distinct values each dimension has in the data."""
    c360 = lake(spark, folder).customer_360
    dims = metrics.BANKING.dimensions
    values = c360.select(*[F.expr(x.expr).cast("string").alias(n) for n, x in dims.items()])
    cardinality = profile.profile(values, approx=False).select(
        F.col("column_name").alias("name"), F.col("distinct_count").alias("distinct_values"))
    return metrics.BANKING.catalogue(spark).join(cardinality, "name", "left").select(
        "kind", "name", "expr", "distinct_values")


# Reports.

@register
def kpi_overview(spark, folder):
    return reports.kpi_overview(lake(spark, folder).customer_360)


@register
def kpi_overview_affluent(spark, folder):
    return reports.kpi_overview(lake(spark, folder).customer_360, segment="affluent")


@register
def average_balance_by_band(spark, folder):
    return reports.average_balance_by_band(lake(spark, folder).balance_by_age_band)


@register
def swipes_by_age_band(spark, folder):
    return reports.swipes_by_band(lake(spark, folder).facts)


@register
def retention_outcomes_long(spark, folder):
    return reports.retention_outcomes(lake(spark, folder).retention_summary)


@register
def customers_by_state(spark, folder):
    return reports.customers_by_state(lake(spark, folder).customer_360)


@register
def retention_table(spark, folder):
    return reports.retention_table(lake(spark, folder).retention_summary)


@register
def retention_rate_by_bank(spark, folder):
    return reports.retention_rate_by_bank(lake(spark, folder).retention_summary)


@register
def retention_by_segment(spark, folder):
    return reports.retention_by_segment(lake(spark, folder).customer_360)


@register
def retention_mass_market(spark, folder):
    return reports.retention_for_segment(lake(spark, folder).customer_360, "mass_market")


@register
def attrited_count(spark, folder):
    return reports.attrited_count(lake(spark, folder).customer_360)


@register
def anchor_balance_61_65(spark, folder):
    return reports.anchor_balance(lake(spark, folder).customer_360)


@register
def anchor_swipes_21_25(spark, folder):
    t = lake(spark, folder)
    return reports.swipes_two_paths(t.customer_360, t.facts)


@register
def anchor_moved_stayed(spark, folder):
    return reports.anchor_moved(lake(spark, folder).customer_360)


@register
def churn_reason_buckets(spark, folder):
    return reports.churn_reason_buckets(lake(spark, folder).events)


@register
def churn_reason_examples(spark, folder):
    return reports.churn_reason_examples(lake(spark, folder).events)


# Reports of one segment, whatever table they come from.

def affluent(spark, folder) -> SegmentView:
    return SegmentView(lake(spark, folder), "affluent")


@register
def average_balance_by_band_affluent(spark, folder):
    return reports.average_balance_by_band(affluent(spark, folder).balance_by_age_band)


@register
def retention_table_affluent(spark, folder):
    return reports.retention_table(affluent(spark, folder).retention_summary)


@register
def anchor_swipes_affluent(spark, folder):
    t = affluent(spark, folder)
    return reports.swipes_two_paths(t.customer_360, t.facts)


@register
def churn_reason_buckets_affluent(spark, folder):
    return reports.churn_reason_buckets(affluent(spark, folder).events)


# Churn.

def features(spark, folder) -> DataFrame:
    return m.feature_table(lake(spark, folder).customer_360)


def staged_features(spark, folder) -> DataFrame:
    """Features written once; a model fit reads them many times."""
    return stage(m.exact_split(features(spark, folder)), "features")


def fitted(spark, folder, algo="gbt"):
    """(model, all staged rows); trained on the labelled training rows."""
    rows = staged_features(spark, folder)
    train = m.split_labelled(rows)[0].filter("split = 'train'")
    model = m.fit_churn(train, algo) if algo == "gbt" else m.fit_baseline(train)
    return model, rows


@register
def churn_feature_table(spark, folder):
    return features(spark, folder)


@register
def churn_signal_features(spark, folder):
    out = churn_features(features(spark, folder))
    return out.select("customer_id", *[F.round(f, 6).alias(f) for f in v.SCORECARD])


@register
def churn_split(spark, folder):
    labelled, open_rows = m.split_labelled(features(spark, folder))
    train, test = m.stratified_split(labelled)
    parts = [df.groupBy("attrition_flag").agg(F.count("*").alias("n"))
               .withColumn("part", F.lit(name))
             for name, df in (("train", train), ("test", test), ("score", open_rows))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register
def churn_split_exact(spark, folder):
    """Part of each labelled customer; a quarter of each class is for the test, to the row."""
    rows = m.exact_split(features(spark, folder))
    return m.split_labelled(rows)[0].select("customer_id", "attrition_flag", "split")


def training_rows(spark, folder) -> DataFrame:
    return m.split_labelled(staged_features(spark, folder))[0].filter("split = 'train'")


@register
def imputed_features(spark, folder):
    """All customers' numbers, missing ones replaced by the exact medians of the training rows."""
    outs = [f"{n}_num" for n in v.CHURN_NUMERIC]
    imputer = MedianImputer(inputCols=list(v.CHURN_NUMERIC), outputCols=outs)
    filled = imputer.fit(training_rows(spark, folder)).transform(features(spark, folder))
    return filled.select("customer_id", *[F.round(o, 6).alias(o) for o in outs])


@register
def category_index(spark, folder):
    """Number and frequency of each category of the training rows."""
    columns = list(v.CHURN_CATEGORICAL)
    model = CategoryIndexer(inputCols=columns, outputCols=[f"{n}_idx" for n in columns]).fit(
        training_rows(spark, folder))
    name = F.element_at(F.array(*map(F.lit, columns)), F.col("column") + 1)
    return model.categories(spark).select(
        name.alias("column_name"), "category", "n", F.col("index").cast("bigint").alias("index"))


@register
def permutation_importance(spark, folder):
    """What the scorecard's AUC loses when one of its features is dealt out anew."""
    rows = stage(churn_features(m.split_labelled(features(spark, folder))[0]), "signals")
    out = m.permutation_importance(
        rows, list(v.SCORECARD),
        lambda df: scorecard(df, v.SCORECARD_INTERCEPT, v.SCORECARD), "z")
    return out.select("feature", *[F.round(x, 9).alias(x) for x in ("auc", "permuted_auc")],
                      F.round("drop", 6).alias("drop"))


@register
def label_summary(spark, folder):
    out = profile.label_summary(features(spark, folder), v.CHURN_LABEL)
    return out.withColumn("base_rate", F.round("base_rate", 6))


@register
def churn_scorecard(spark, folder):
    scored = scorecard(churn_features(features(spark, folder)), v.SCORECARD_INTERCEPT,
                       v.SCORECARD)
    return scored.select("customer_id", F.round("z", 6).alias("z"),
                         F.round("z_probability", 6).alias("z_probability"))


@register
def scorecard_bands(spark, folder):
    """Risk bands of the scorecard probability."""
    scored = scorecard(churn_features(features(spark, folder)), v.SCORECARD_INTERCEPT,
                       v.SCORECARD)
    return (m.risk_band(scored, "z_probability").groupBy("risk_band")
            .agg(F.count("*").alias("n")))


@register
def rank_auc(spark, folder):
    """AUC of the scorecard against the known outcomes."""
    scored = scorecard(churn_features(features(spark, folder)), v.SCORECARD_INTERCEPT,
                       v.SCORECARD)
    out = ranks.rank_auc(scored, "z", v.CHURN_LABEL)
    return out.withColumn("auc", F.round("auc", 9))


@register
def churn_gbt_eval(spark, folder):
    model, rows = fitted(spark, folder)
    return m.evaluate(model, m.split_labelled(rows)[0].filter("split = 'test'"))


@register
def customers_scored(spark, folder):
    model, rows = fitted(spark, folder)
    return m.score(model, m.split_labelled(rows)[1].drop("split"))


@register
def risk_band_summary(spark, folder):
    return reports.band_summary(customers_scored(spark, folder))


def all_scored(spark, folder) -> DataFrame:
    model, rows = fitted(spark, folder)
    return m.score(model, rows.drop("split"))


@register
def churn_watchlist(spark, folder):
    return reports.churn_watchlist(all_scored(spark, folder))


@register
def churn_watchlist_groups(spark, folder):
    return reports.watchlist_by_group(all_scored(spark, folder))


@register
def feature_importance(spark, folder):
    model, rows = fitted(spark, folder)
    return m.importances(model, rows)


@register
def logistic_baseline(spark, folder):
    """Standardised coefficients of the logistic baseline, greatest size first."""
    model, rows = fitted(spark, folder, "logistic")
    return m.coefficients(model, churn_features(rows)).withColumn(
        "coefficient", F.round("coefficient", 4))


@register
def logistic_eval(spark, folder):
    model, rows = fitted(spark, folder, "logistic")
    out = m.evaluate(model, churn_features(
        m.split_labelled(rows)[0].filter("split = 'test'")))
    return out.withColumn("auc", F.round("auc", 4))


@register
def scored_invariants(spark, folder):
    """Per scored customer: is the score a probability, and does the band follow from it?"""
    scored = customers_scored(spark, folder)
    expected = c.threshold_band("churn_score", v.RISK_BANDS)
    return scored.select("customer_id",
                         F.col("churn_score").between(0, 1).alias("is_probability"),
                         (F.col("risk_band") == expected).alias("band_follows"))


@register
def model_reload_scores(spark, folder):
    """Does the saved and reloaded model score every customer as the one in memory does?"""
    model, rows = fitted(spark, folder)
    path = new_folder(spark, "model")
    m.save_model(model, path)
    open_rows = m.split_labelled(rows)[1].drop("split")
    again = m.score(m.load_model(path), open_rows).select(
        "customer_id", F.col("churn_score").alias("reloaded"))
    return m.score(model, open_rows).join(again, "customer_id").select(
        "customer_id", (F.col("churn_score") == F.col("reloaded")).alias("same_score"))
