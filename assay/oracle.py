"""DuckDB SQL that answers the registered queries independently, over the same tables.

Shared steps are common table expressions; each query carries the ones it needs.
"""

from __future__ import annotations

import re

from .functions import values as v
from .operators.defects import Defect
from .plans.metrics import BANKING
from .registry import (
    CUSTOMER_COPY_RATE, EXPECTED_RANGES, PLANTED_ACCOUNTS, PLANTED_CUSTOMERS,
    PLANTED_TRANSACTIONS, SEED, SEEDS, TRANSACTION_COPY_RATE,
)

AS_OF = f"DATE '{v.AS_OF}'"


def _list(values) -> str:
    return "[" + ", ".join(f"'{x}'" for x in values) + "]"


_CODES = _list(code for code, _ in v.STATES)
_NAMES = _list(name for _, name in v.STATES)
_BANKS = _list(v.SOURCE_BANKS)
_STATE_CASE = "CASE upper(home_state) " + " ".join(
    f"WHEN '{name}' THEN '{code}'" for name, code in v.STATE_CODES.items()
) + " ELSE upper(home_state) END"
_BAND_CASE = ("CASE WHEN age BETWEEN 18 AND 25 THEN '18-25' WHEN age BETWEEN 26 AND 35 THEN "
              "'26-35' WHEN age BETWEEN 36 AND 45 THEN '36-45' WHEN age BETWEEN 46 AND 55 THEN "
              "'46-55' WHEN age BETWEEN 56 AND 65 THEN '56-65' WHEN age BETWEEN 66 AND 75 THEN "
              "'66-75' WHEN age >= 76 THEN '76+' END")


def _parsed_customers(raw: str) -> str:
    return f"""
SELECT * EXCLUDE (date_of_birth, home_state, source_bank, join_date, attrition_flag, updated_at),
  {_BAND_CASE} AS age_band
FROM (
  SELECT *, date_of_birth AS dob_raw, dob AS dob_typed,
    CAST(floor(date_diff('day', dob, {AS_OF}) / 365.25::DOUBLE) AS INTEGER) AS age,
    {_STATE_CASE} AS state_code, nullif(source_bank, '') AS bank,
    TRY_CAST(join_date AS DATE) AS joined, TRY_CAST(attrition_flag AS INTEGER) AS flag,
    TRY_CAST(updated_at AS DATE) AS updated,
    round(date_diff('day', TRY_CAST(join_date AS DATE), {AS_OF}) / 365.25::DOUBLE, 2)
      AS tenure_years,
    acquisition_channel = 'switch_kit' AS moved_from_bank,
    customer_status <> 'attrited' AS is_retained
  FROM (
    SELECT *, coalesce(TRY_CAST(nullif(date_of_birth, '') AS DATE),
                       CAST(try_strptime(date_of_birth, '%m/%d/%Y') AS DATE)) AS dob
    FROM {raw}
    QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY
      TRY_CAST(updated_at AS DATE) DESC, customer_status, date_of_birth, home_state) = 1))"""


def _first_txns(raw: str) -> str:
    return f"""
SELECT * FROM {raw}
QUALIFY row_number() OVER (PARTITION BY txn_id ORDER BY
  txn_ts, account_id, card_type, channel, merchant_category, amount) = 1"""


def _bad_accounts(accounts: str, customers: str) -> str:
    return f"""
SELECT account_id, customer_id, CAST(balance AS DOUBLE) AS balance,
  CASE WHEN NOT known THEN 'orphan_customer_id'
       WHEN CAST(balance AS DOUBLE) < 0 THEN 'negative_balance'
       ELSE 'balance_outlier_100x' END AS quarantine_reason
FROM (SELECT a.*, EXISTS (SELECT 1 FROM {customers} c WHERE c.customer_id = a.customer_id)
        AS known FROM {accounts} a)
WHERE NOT known OR CAST(balance AS DOUBLE) < 0 OR CAST(balance AS DOUBLE) >= 10000000"""


def _share(key: str, salt: str) -> str:
    return (f"CAST('0x' || substr(md5('{salt}' || {key}), 1, 8) AS BIGINT)"
            f" / 4294967296::DOUBLE")


def _hit(defect: Defect | str, key: str, rate: float | None = None, seed: int = SEED) -> str:
    name = defect if isinstance(defect, str) else defect.name
    rate = rate if rate is not None else defect.rate
    return f"({_share(key, f'{seed}:{name}:')} < {rate}::DOUBLE)"


CTE = {
    "raw_customers": f"""
SELECT 'CUST' || k AS customer_id, 'First' || (k % 38) AS first_name,
  'Last' || (k % 36) AS last_name,
  CASE WHEN k % 250 = 7 THEN ''
       WHEN k % 500 = 11 THEN strftime(DATE '1900-01-01' + CAST(k % 300 AS INTEGER), '%Y-%m-%d')
       WHEN k % 20 = 3 THEN strftime(dob, '%m/%d/%Y')
       ELSE strftime(dob, '%Y-%m-%d') END AS date_of_birth,
  (['F', 'M', 'F', 'M', 'X'])[k % 5 + 1] AS gender,
  CASE WHEN k % 19 = 0 THEN ({_NAMES})[k % 12 + 1] ELSE ({_CODES})[k % 12 + 1] END
    AS home_state,
  CAST(10000 + k * 31 % 90000 AS VARCHAR) AS home_zip,
  'BR' || c_nationkey AS home_branch_id, segment, acquisition_channel,
  CASE WHEN acquisition_channel = 'switch_kit' AND k % 37 <> 0 THEN ({_BANKS})[k % 8 + 1]
       ELSE '' END AS source_bank,
  strftime(joined, '%Y-%m-%d') AS join_date,
  CASE WHEN stale = 0 THEN status WHEN status = 'active' THEN 'dormant' ELSE 'active' END
    AS customer_status,
  flag AS attrition_flag,
  CASE WHEN stale = 1 THEN '2026-05-01' ELSE '2026-09-01' END AS updated_at
FROM (
  SELECT *, CASE WHEN flag = '1' AND k % 17 = 0 THEN 'reactivated'
                 WHEN flag = '1' THEN 'attrited'
                 WHEN k % 9 = 1 THEN 'dormant' ELSE 'active' END AS status
  FROM (
    SELECT *, CASE WHEN days < 270 THEN ''
                   WHEN CAST('0x' || substr(md5('L' || k), 1, 7) AS BIGINT)
                        / 268435456::DOUBLE < 1::DOUBLE / (1::DOUBLE + exp(-z)) THEN '1'
                   ELSE '0' END AS flag
    FROM (
      SELECT *, 1.2::DOUBLE - 0.30::DOUBLE * least(days / 365.25::DOUBLE, 15::DOUBLE)
          + CASE WHEN date_diff('day', dob, {AS_OF}) / 365.25::DOUBLE < 30
                 THEN 1.55::DOUBLE ELSE 0 END
          + CASE WHEN acquisition_channel = 'switch_kit' THEN 0.88::DOUBLE ELSE 0 END
          - CASE WHEN segment <> 'mass_market' THEN 1.10::DOUBLE ELSE 0 END AS z
      FROM (
        SELECT c_custkey AS k, c_nationkey,
          DATE '1938-10-01' + CAST(c_custkey * 7919 % 25000 AS INTEGER) AS dob,
          DATE '2008-10-01' + CAST(c_custkey * 104729 % 6500 AS INTEGER) AS joined,
          date_diff('day', DATE '2008-10-01' + CAST(c_custkey * 104729 % 6500 AS INTEGER),
                    {AS_OF}) AS days,
          CASE c_mktsegment WHEN 'MACHINERY' THEN 'affluent' WHEN 'AUTOMOBILE' THEN 'private'
               ELSE 'mass_market' END AS segment,
          CASE WHEN c_custkey % 11 <= 1 THEN 'switch_kit' WHEN c_custkey % 11 <= 5 THEN 'branch'
               WHEN c_custkey % 11 <= 8 THEN 'online' WHEN c_custkey % 11 = 9 THEN 'referral'
               ELSE 'employer' END AS acquisition_channel
        FROM customer))))
  JOIN (VALUES (0), (1)) AS copies(stale) ON stale = 0 OR k % 100 = 0""",
    "raw_accounts": """
SELECT 'ACC' || o_orderkey AS account_id,
  CASE WHEN o_orderkey % 500 = 2 THEN 'CUST9' || (o_custkey + 1000000)
       ELSE 'CUST' || o_custkey END AS customer_id,
  CASE o_orderpriority WHEN '2-HIGH' THEN 'savings' WHEN '3-MEDIUM' THEN 'money_market'
       WHEN '4-NOT SPECIFIED' THEN 'cd' ELSE 'checking' END AS account_type,
  strftime(o_orderdate, '%Y-%m-%d') AS open_date, '' AS close_date,
  CAST(CAST(CASE WHEN o_orderkey % 300 = 0 THEN -o_totalprice
                 WHEN o_orderkey % 1250 = 1 THEN o_totalprice * 100
                 ELSE o_totalprice END AS DECIMAL(20, 2)) AS VARCHAR) AS balance,
  'open' AS account_status
FROM orders""",
    "raw_txns": f"""
SELECT 'TXN' || l_orderkey || '-' || l_linenumber AS txn_id, 'ACC' || l_orderkey AS account_id,
  CASE WHEN l_returnflag = 'R' THEN 'credit' ELSE 'debit' END AS card_type,
  (['online', 'atm', 'swipe', 'contactless'])[l_partkey % 4 + 1] AS channel,
  ({_list(v.MERCHANT_CATEGORIES)})[l_suppkey % 9 + 1] AS merchant_category,
  l_extendedprice AS amount, strftime(l_shipdate, '%Y-%m-%d') AS txn_ts
FROM lineitem""",
    "raw_events": f"""
SELECT 'EVT' || event_id AS event_id, 'CUST' || user_id AS customer_id,
  CASE event_type WHEN 'signup' THEN 'acquired' WHEN 'error' THEN 'attrited'
       WHEN 'purchase' THEN 'reactivated' WHEN 'view' THEN 'statement_viewed'
       ELSE 'offer_opened' END AS event_type,
  strftime(ts, '%Y-%m-%d') AS event_date,
  CASE WHEN event_type = 'signup' AND event_id % 5 = 0 THEN ({_BANKS})[event_id % 8 + 1]
       ELSE '' END AS source_bank,
  CASE event_type WHEN 'signup' THEN 'switch'
       WHEN 'error' THEN (['fees', 'rate', 'service', 'relocation',
                           'competitor_offer'])[event_id % 5 + 1]
       WHEN 'purchase' THEN 'win_back_offer' ELSE '' END AS reason
FROM events""",
    "raw_branches": f"""
SELECT 'BR' || n_nationkey AS branch_id, n_name || ' Branch' AS branch_name,
  ({_CODES})[n_nationkey % 12 + 1] AS branch_state, r_name AS branch_region,
  strftime(DATE '2005-01-01' + CAST(n_nationkey * 283 % 7000 AS INTEGER), '%Y-%m-%d')
    AS opened_date
FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "parsed_customers": _parsed_customers("raw_customers"),
    "s_customers": """
SELECT customer_id, first_name, last_name, dob_typed AS date_of_birth, gender,
  state_code AS home_state, home_zip, home_branch_id, segment, acquisition_channel,
  bank AS source_bank, joined AS join_date, customer_status, flag AS attrition_flag,
  updated AS updated_at, age, age_band, tenure_years, moved_from_bank, is_retained
FROM parsed_customers WHERE age BETWEEN 18 AND 110""",
    "s_accounts": """
SELECT account_id, customer_id, account_type, CAST(open_date AS DATE) AS open_date,
  account_status, CAST(balance AS DOUBLE) AS balance
FROM raw_accounts
WHERE CAST(balance AS DOUBLE) >= 0 AND CAST(balance AS DOUBLE) < 10000000
  AND customer_id IN (SELECT customer_id FROM raw_customers)""",
    "bad_accounts": _bad_accounts("raw_accounts", "raw_customers"),
    "first_txns": _first_txns("raw_txns"),
    "s_txns": """
SELECT txn_id, account_id, card_type, channel, merchant_category, amount,
  CAST(txn_ts AS DATE) AS txn_date
FROM first_txns WHERE amount < 100000""",
    "s_events": """
SELECT event_id, customer_id, event_type, CAST(event_date AS DATE) AS event_date,
  nullif(source_bank, '') AS source_bank, reason
FROM raw_events""",
    "s_branches": """
SELECT branch_id, branch_name, branch_state, branch_region,
  CAST(opened_date AS DATE) AS opened_date
FROM raw_branches""",
    "bal": """
SELECT customer_id, count(*) AS num_accounts,
  CAST(sum(CAST(round(balance * 100) AS BIGINT)) AS BIGINT) AS cents
FROM s_accounts GROUP BY customer_id""",
    "tx": """
SELECT a.customer_id, count(*) AS txn_count,
  count(*) FILTER (card_type = 'debit' AND channel = 'swipe') AS debit_swipe_count,
  count(*) FILTER (card_type = 'debit') AS debit_txn_count,
  CAST(sum(CAST(round(amount * 100) AS BIGINT)) AS BIGINT) AS cents
FROM s_txns t JOIN s_accounts a ON t.account_id = a.account_id GROUP BY a.customer_id""",
    "c360": """
SELECT c.customer_id, age, age_band, gender, home_state, branch_region AS region, segment,
  acquisition_channel, source_bank, moved_from_bank, join_date, tenure_years, customer_status,
  is_retained, attrition_flag, coalesce(num_accounts, 0) AS num_accounts,
  coalesce(bal.cents, 0) / 100::DOUBLE AS total_balance,
  coalesce((2 * bal.cents + num_accounts) // (2 * num_accounts), 0) / 100::DOUBLE
    AS avg_account_balance,
  coalesce(txn_count, 0) AS txn_count, coalesce(debit_swipe_count, 0) AS debit_swipe_count,
  coalesce(debit_txn_count, 0) AS debit_txn_count,
  coalesce(tx.cents, 0) / 100::DOUBLE AS total_spend
FROM s_customers c
LEFT JOIN s_branches b ON c.home_branch_id = b.branch_id
LEFT JOIN bal ON c.customer_id = bal.customer_id
LEFT JOIN tx ON c.customer_id = tx.customer_id""",
    "facts": """
SELECT txn_id, txn_date, card_type, channel, merchant_category, amount, c.customer_id, age,
  age_band, segment, home_state, region
FROM s_txns t JOIN s_accounts a ON t.account_id = a.account_id
JOIN c360 c ON a.customer_id = c.customer_id""",
    "by_band": """
SELECT age_band, n AS customer_count, ((2 * cents + n) // (2 * n)) / 100::DOUBLE AS avg_balance,
  cents / 100::DOUBLE AS total_balance
FROM (SELECT age_band, count(*) AS n,
        CAST(sum(CAST(round(total_balance * 100) AS BIGINT)) AS BIGINT) AS cents
      FROM c360 GROUP BY age_band)""",
    "retention": """
SELECT coalesce(source_bank, 'unknown') AS source_bank, count(*) AS moved_in,
  count(*) FILTER (is_retained) AS stayed, count(*) FILTER (NOT is_retained) AS left_us,
  ((20000 * count(*) FILTER (is_retained) + count(*)) // (2 * count(*))) / 10000::DOUBLE
    AS retention_rate
FROM c360 WHERE moved_from_bank GROUP BY 1""",
    "features": """
SELECT customer_id, tenure_years, total_balance, avg_account_balance,
  CAST(num_accounts AS DOUBLE) AS num_accounts, CAST(txn_count AS DOUBLE) AS txn_count,
  CAST(debit_swipe_count AS DOUBLE) AS debit_swipe_count, total_spend,
  CAST(age AS DOUBLE) AS age, coalesce(segment, 'unknown') AS segment,
  coalesce(acquisition_channel, 'unknown') AS acquisition_channel,
  coalesce(region, 'unknown') AS region, coalesce(home_state, 'unknown') AS home_state,
  attrition_flag
FROM c360""",
    "signals": """
SELECT *, least(tenure_years, 15::DOUBLE) AS f_tenure,
  log10(greatest(total_balance, 50::DOUBLE)) - 3.5::DOUBLE AS f_balance,
  least(txn_count, 30::DOUBLE) AS f_activity,
  CASE WHEN age < 30 THEN 1 ELSE 0 END::DOUBLE AS f_young,
  CASE WHEN acquisition_channel = 'switch_kit' THEN 1 ELSE 0 END::DOUBLE AS f_switch,
  CASE WHEN segment IN ('affluent', 'private') THEN 1 ELSE 0 END::DOUBLE AS f_affluent,
  CASE WHEN num_accounts <= 1 THEN 1 ELSE 0 END::DOUBLE AS f_single
FROM features""",
    "scorecard": """
SELECT *, 1::DOUBLE / (1::DOUBLE + exp(-z)) AS p
FROM (SELECT *, 1.65::DOUBLE - 0.46::DOUBLE * f_tenure - 1.15::DOUBLE * f_balance
        - 0.15::DOUBLE * f_activity + 1.55::DOUBLE * f_young + 0.88::DOUBLE * f_switch
        - 1.10::DOUBLE * f_affluent + 0.82::DOUBLE * f_single AS z
      FROM signals)""",
    # Damaged input.
    "p_customers": f"""
SELECT customer_id, first_name, last_name, gender, home_zip, home_branch_id, segment,
  acquisition_channel, source_bank, join_date, attrition_flag,
  CASE WHEN {_hit(PLANTED_CUSTOMERS[2], 'customer_id')} THEN ''
       WHEN {_hit(PLANTED_CUSTOMERS[1], 'customer_id')}
            AND TRY_CAST(nullif(date_of_birth, '') AS DATE) IS NOT NULL
       THEN strftime(CAST(date_of_birth AS DATE), '%m/%d/%Y')
       ELSE date_of_birth END AS date_of_birth,
  CASE WHEN {_hit(PLANTED_CUSTOMERS[0], 'customer_id')} AND length(home_state) = 2
       THEN ({_NAMES})[list_position({_CODES}, home_state)] ELSE home_state END AS home_state,
  CASE WHEN copy = 0 THEN customer_status WHEN customer_status = 'active' THEN 'dormant'
       ELSE 'active' END AS customer_status,
  CASE WHEN copy = 0 THEN updated_at
       ELSE strftime(CAST(updated_at AS DATE) - 200, '%Y-%m-%d') END AS updated_at
FROM raw_customers JOIN (VALUES (0), (1)) AS t(copy)
  ON copy = 0 OR {_hit('duplicate_customer_rows', 'customer_id', CUSTOMER_COPY_RATE)}""",
    "p_accounts": f"""
SELECT account_id,
  CASE WHEN {_hit(PLANTED_ACCOUNTS[2], 'account_id')} THEN 'GONE' || account_id
       ELSE customer_id END AS customer_id,
  CASE WHEN {_hit(PLANTED_ACCOUNTS[0], 'account_id')} THEN -abs(CAST(balance AS DOUBLE))
       ELSE CAST(balance AS DOUBLE) END
  * CASE WHEN {_hit(PLANTED_ACCOUNTS[1], 'account_id')} THEN 100 ELSE 1 END AS balance
FROM raw_accounts""",
    "p_txns": f"""
SELECT txn_id, account_id, card_type, channel, merchant_category, txn_ts,
  CASE WHEN {_hit(PLANTED_TRANSACTIONS[0], 'txn_id')} THEN amount * 100 ELSE amount END
    AS amount
FROM raw_txns JOIN (VALUES (0), (1)) AS t(copy)
  ON copy = 0 OR {_hit('duplicate_txn_rows', 'txn_id', TRANSACTION_COPY_RATE)}""",
    "p_parsed_customers": _parsed_customers("p_customers"),
    "p_first_txns": _first_txns("p_txns"),
    "p_bad_accounts": _bad_accounts("p_accounts", "p_customers"),
}


def _metrics(customers: str, accounts: str, parents: str, txns: str) -> str:
    """Passed and failed rows per expectation, NULL counting as failed."""
    def one(table, name, action, passes, source):
        return (f"SELECT '{table}' AS table_name, '{name}' AS expectation, '{action}' AS action, "
                f"count(*) FILTER (coalesce({passes}, false)) AS passed, "
                f"count(*) FILTER (NOT coalesce({passes}, false)) AS failed FROM {source}")
    known = (f"(SELECT customer_id, CAST(balance AS DOUBLE) AS balance FROM {accounts} "
             f"WHERE customer_id IN (SELECT customer_id FROM {parents}))")
    return " UNION ALL ".join([
        one("silver_customers", "valid_dob", "drop", "dob_typed IS NOT NULL", customers),
        one("silver_customers", "plausible_age", "drop", "age BETWEEN 18 AND 110", customers),
        one("silver_customers", "known_state", "warn", "state_code IS NOT NULL", customers),
        one("silver_accounts", "non_negative_balance", "drop", "balance >= 0", known),
        one("silver_accounts", "plausible_balance", "drop", "balance < 10000000", known),
        one("silver_accounts", "has_customer", "drop", "customer_id IS NOT NULL", known),
        one("silver_card_transactions", "plausible_amount", "drop", "amount < 100000", txns),
    ])


CTE["metrics_before"] = _metrics(
    "parsed_customers", "raw_accounts", "raw_customers", "first_txns")
CTE["metrics_after"] = _metrics(
    "p_parsed_customers", "p_accounts", "p_customers", "p_first_txns")


def _with(body: str) -> str:
    """The query with the common table expressions it refers to, in order of dependency."""
    names = list(CTE)
    word = re.compile(r"\b(" + "|".join(names) + r")\b")
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in dict.fromkeys(word.findall(text)):
            if name not in needed:
                visit(CTE[name])
                if name not in needed:
                    needed.append(name)

    visit(body)
    if not needed:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({CTE[n]})" for n in needed) + "\n" + body.strip()


def _union(parts) -> str:
    return " UNION ALL ".join(parts)


def _csv(raw: str, fields) -> str:
    """What is left of a text source after a round trip through CSV."""
    cols = ", ".join(f"nullif({f}, '') AS {f}" for f in fields)
    return f"SELECT {cols}, true AS has_source FROM {raw}"


def _conservation(name: str, source: str, clean: str, bad: str) -> str:
    key = {"customers": "customer_id", "accounts": "account_id"}.get(name, "txn_id")
    kept = (f"(SELECT {key} FROM {clean} AS c UNION ALL SELECT {key} FROM {bad} AS b)")
    had = f"(SELECT {key}, count(*) AS had FROM {source} GROUP BY 1)"
    has = f"(SELECT {key}, count(*) AS has FROM {kept} GROUP BY 1)"
    return (f"SELECT '{name}' AS source, (SELECT count(*) FROM {source}) AS input_rows, "
            f"(SELECT count(*) FROM {clean}) AS clean_rows, "
            f"(SELECT count(*) FROM {bad}) AS quarantined_rows, "
            f"count(*) FILTER (coalesce(has, 0) < had) AS lost_keys, "
            f"count(*) FILTER (has > had) AS repeated_keys, "
            f"count(*) FILTER (had IS NULL) AS unknown_keys "
            f"FROM {had} FULL JOIN {has} USING ({key})")


def _planting(seed: int) -> str:
    """Rows that each planting rule hits."""
    return _union([
        *[f"SELECT '{x.name}' AS defect, count(*) AS n FROM raw_customers "
          f"WHERE {_hit(x, 'customer_id', seed=seed)} AND {w}"
          for x, w in zip(PLANTED_CUSTOMERS, _PLANTABLE, strict=True)],
        "SELECT 'duplicate_customer_rows', count(*) FROM raw_customers WHERE "
        + _hit("duplicate_customer_rows", "customer_id", CUSTOMER_COPY_RATE, seed),
        *[f"SELECT '{x.name}', count(*) FROM raw_accounts "
          f"WHERE {_hit(x, 'account_id', seed=seed)}" for x in PLANTED_ACCOUNTS],
        f"SELECT '{PLANTED_TRANSACTIONS[0].name}', count(*) FROM raw_txns "
        f"WHERE {_hit(PLANTED_TRANSACTIONS[0], 'txn_id', seed=seed)}",
        "SELECT 'duplicate_txn_rows', count(*) FROM raw_txns WHERE "
        + _hit("duplicate_txn_rows", "txn_id", TRANSACTION_COPY_RATE, seed)])


_PLANTABLE = ["length(home_state) = 2", "TRY_CAST(nullif(date_of_birth, '') AS DATE) IS NOT NULL",
              "true"]
_RAW = {"customers": "raw_customers", "accounts": "raw_accounts", "branches": "raw_branches",
        "customer_events": "raw_events", "card_transactions": "raw_txns"}
_BAD_CUSTOMERS = "(SELECT * FROM parsed_customers WHERE coalesce(age NOT BETWEEN 18 AND 110, true))"
_BAD_TXNS = "(SELECT * FROM first_txns WHERE NOT amount < 100000)"
_TABLES = {
    **{f"bronze_{s}": r for s, r in _RAW.items()},
    "silver_customers": "s_customers", "silver_customers_quarantine": _BAD_CUSTOMERS,
    "silver_accounts": "s_accounts", "silver_accounts_quarantine": "bad_accounts",
    "silver_card_transactions": "s_txns", "silver_txn_quarantine": _BAD_TXNS,
    "silver_customer_events": "s_events",
    "silver_branches": "s_branches", "gold_customer_360": "c360",
    "gold_transaction_facts": "facts", "gold_balance_by_age_band": "by_band",
    "gold_retention_summary": "retention",
}


def _counts(tables) -> str:
    return _union(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {s}"
                  for n, s in tables.items())


def _profile(table: str, raw: str, fields) -> str:
    return _union(
        f"SELECT '{table}' AS table_name, '{f}' AS column_name, count(*) AS row_count, "
        f"count(*) FILTER ({f} IS NULL) AS null_count, count(DISTINCT {f}) AS distinct_count "
        f"FROM {raw}" for f in fields)


def _duplicates(table: str, raw: str, key: str) -> str:
    return (f"SELECT '{table}' AS table_name, count(*) AS row_count, count(DISTINCT {key}) AS "
            f"distinct_keys, count(*) - count(DISTINCT {key}) AS excess_rows, (SELECT count(*) "
            f"FROM (SELECT {key} FROM {raw} GROUP BY 1 HAVING count(*) > 1)) AS repeated_keys "
            f"FROM {raw}")


_ISO_MISS = ("date_of_birth <> '' AND TRY_CAST(nullif(date_of_birth, '') AS DATE) IS NULL")
_NO_CODE = "home_state <> '' AND NOT regexp_matches(home_state, '^[A-Z]{2}$')"
_ORPHAN = "customer_id NOT IN (SELECT customer_id FROM raw_customers)"
_DEFECTS = {
    "long_form_state": f"raw_customers WHERE {_NO_CODE}",
    "alt_date_format_dob": f"raw_customers WHERE {_ISO_MISS}",
    "missing_dob": "raw_customers WHERE date_of_birth = ''",
    "negative_balance": "raw_accounts WHERE CAST(balance AS DOUBLE) < 0",
    "balance_outlier_100x": "raw_accounts WHERE CAST(balance AS DOUBLE) >= 10000000",
    "orphan_account_customer": f"raw_accounts WHERE {_ORPHAN}",
    "txn_amount_outlier_100x": "raw_txns WHERE amount >= 100000",
}


def _rate(part: str, whole: str) -> str:
    return f"((2000000 * ({part}) + ({whole})) // (2 * ({whole}))) / 1000000::DOUBLE"


_N = {
    "all": "SELECT count(*) FROM parsed_customers",
    "clean": "SELECT count(*) FROM s_customers",
    "moved": "SELECT count(*) FROM s_customers WHERE moved_from_bank",
    "stayed": "SELECT count(*) FROM s_customers WHERE moved_from_bank AND is_retained",
    "open": "SELECT count(*) FROM s_customers WHERE attrition_flag IS NULL",
    "labelled": "SELECT count(*) FROM s_customers WHERE attrition_flag IS NOT NULL",
    "left": "SELECT count(*) FROM s_customers WHERE attrition_flag = 1",
    "bands": "SELECT count(DISTINCT age_band) FROM s_customers",
}
_CHECKED = {
    "customers": f"({_N['clean']})", "retention_rate": _rate(_N["stayed"], _N["moved"]),
    "quarantine_share": _rate(f"SELECT ({_N['all']}) - ({_N['clean']})", _N["all"]),
    "unlabelled_share": _rate(_N["open"], _N["clean"]),
    "base_rate": _rate(_N["left"], _N["labelled"]), "age_bands": f"({_N['bands']})",
}
_SPREAD = {
    "customers": "count(*)", "n_61_65": "count(*) FILTER (age BETWEEN 61 AND 65)",
    "debit_swipes_21_25":
        "coalesce(sum(debit_swipe_count) FILTER (age BETWEEN 21 AND 25), 0)",
    "moved_in": "count(*) FILTER (moved_from_bank)",
    "stayed": "count(*) FILTER (moved_from_bank AND is_retained)",
}


def _half(unit: int, part: str, whole: str = "count(*)") -> str:
    """Rounded quotient of two counts; NULL when there is nothing to divide by."""
    return (f"(({2 * unit} * {part} + {whole}) // nullif(2 * {whole}, 0)) / {unit}::DOUBLE")


def _kpi(where: str = "true") -> str:
    stayed = "count(*) FILTER (moved_from_bank AND is_retained)"
    return f"""
SELECT count(*) AS total_customers,
  CAST(sum(CAST(round(total_balance * 100) AS BIGINT)) AS BIGINT) / 100::DOUBLE
    AS total_balance,
  {_half(10000, stayed, 'count(*) FILTER (moved_from_bank)')} AS switch_in_retention,
  CAST(sum(debit_swipe_count) AS BIGINT) AS total_debit_swipes
FROM c360 WHERE {where}"""


def _money(col: str) -> str:
    """Exact total of a money column as a double."""
    return f"(CAST(sum(CAST(round({col} * 100) AS BIGINT)) AS BIGINT) / 100::DOUBLE)"


_MEASURE_SQL = {
    "Customer Count": "count(*)",
    "Average Balance": _money("total_balance") + " / count(*)",
    "Total Balance": _money("total_balance"),
    "Median Balance": "quantile_cont(total_balance, 0.5)",
    "Debit Card Swipes": "CAST(sum(debit_swipe_count) AS BIGINT)",
    "Total Transactions": "CAST(sum(txn_count) AS BIGINT)",
    "Total Spend": _money("total_spend"),
    "Retained Customers": "count(*) FILTER (is_retained)",
    "Retention Rate": "avg(CASE WHEN is_retained THEN 1::DOUBLE ELSE 0::DOUBLE END)",
    "Attrition Rate":
        "avg(CASE WHEN customer_status = 'attrited' THEN 1::DOUBLE ELSE 0::DOUBLE END)",
}


def _measures(names) -> str:
    return ", ".join(f'{_MEASURE_SQL[n]} AS "{n}"' for n in names)


# The eleven dimensions and their columns.
_DIMS = {
    "Age": "age", "Age Band": "age_band", "Gender": "gender", "State": "home_state",
    "Region": "region", "Segment": "segment", "Acquisition Channel": "acquisition_channel",
    "Source Bank": "source_bank", "Moved From Bank": "moved_from_bank",
    "Customer Status": "customer_status", "Retained": "is_retained",
}
_DIM_COLS = ", ".join(f'{column} AS "{name}"' for name, column in _DIMS.items())
_SPLIT = _share("(attrition_flag || ':' || customer_id)", "42:") + " < 0.25::DOUBLE"
_BUCKET = "CASE reason " + " ".join(
    f"WHEN '{r}' THEN '{b}'" for r, b in v.REASON_BUCKETS.items()) + " ELSE 'other' END"
_SIGNALS = dict(zip(v.SCORECARD, [
    "f_tenure", "f_balance", "f_activity", "f_young", "f_switch", "f_affluent", "f_single"],
    strict=True))

_BODIES = {
    "silver_branches": "SELECT * FROM s_branches",
    "silver_customers": "SELECT * FROM s_customers",
    "silver_customers_quarantine": f"""
SELECT customer_id, dob_raw, CASE WHEN dob_typed IS NULL THEN 'missing_or_unparseable_dob'
  ELSE 'implausible_age' END AS quarantine_reason FROM {_BAD_CUSTOMERS}""",
    "silver_accounts": "SELECT * FROM s_accounts",
    "silver_accounts_strict_parent":
        "SELECT * FROM s_accounts WHERE customer_id IN (SELECT customer_id FROM s_customers)",
    "silver_accounts_quarantine": "SELECT * FROM bad_accounts",
    "silver_card_transactions": "SELECT * FROM s_txns",
    "silver_txn_quarantine": f"""
SELECT txn_id, account_id, amount, NULL::VARCHAR AS raw_text,
  'amount_outlier_100x' AS quarantine_reason
FROM {_BAD_TXNS}""",
    "silver_customer_events": "SELECT * FROM s_events",
    "gold_customer_360": "SELECT * FROM c360",
    "gold_transaction_facts": "SELECT * FROM facts",
    "gold_balance_by_age_band": "SELECT * FROM by_band",
    "gold_retention_summary": "SELECT * FROM retention",
    "balance_by_customer": """
SELECT customer_id, num_accounts, cents / 100::DOUBLE AS total_balance,
  ((2 * cents + num_accounts) // (2 * num_accounts)) / 100::DOUBLE AS avg_account_balance
FROM bal""",
    "activity_by_customer": """
SELECT customer_id, txn_count, debit_swipe_count, debit_txn_count,
  cents / 100::DOUBLE AS total_spend FROM tx""",
    "parsed_dates": """
SELECT customer_id, updated_at, date_of_birth,
  coalesce(TRY_CAST(nullif(date_of_birth, '') AS DATE),
           CAST(try_strptime(date_of_birth, '%m/%d/%Y') AS DATE)) AS parsed,
  CAST(try_strptime(date_of_birth, '%m/%d/%Y') AS DATE) AS parsed_us_only
FROM raw_customers""",
    "standardized_states": f"""
SELECT home_state, {_STATE_CASE} AS code, count(*) AS n FROM raw_customers GROUP BY 1, 2""",
    "ages_and_bands": """
SELECT age, age_band, count(*) AS n, min(tenure_years) AS min_tenure,
  max(tenure_years) AS max_tenure FROM parsed_customers GROUP BY 1, 2""",
    "latest_customers": """
SELECT customer_id, max(updated_at) AS updated_at,
  min(customer_status) FILTER (newest) AS customer_status
FROM (SELECT *, updated_at = max(updated_at) OVER (PARTITION BY customer_id) AS newest
      FROM raw_customers) GROUP BY customer_id""",
    "first_transactions": "SELECT * FROM first_txns",
    "stream_first_transactions": "SELECT * FROM first_txns",
    "orphan_accounts":
        f"SELECT account_id, customer_id, balance FROM raw_accounts WHERE {_ORPHAN}",
    "largest_accounts": """
SELECT account_id, customer_id, balance FROM s_accounts
ORDER BY balance DESC, account_id LIMIT 25""",
    "average_ranks": """
SELECT total_balance, count(*) AS n, avg(r + 0::DOUBLE) AS avg_rank
FROM (SELECT total_balance, row_number() OVER (ORDER BY total_balance) AS r FROM c360)
GROUP BY total_balance""",
    "profile_columns": _union([_profile("customers", "raw_customers", v.CUSTOMER_FIELDS),
                               _profile("accounts", "raw_accounts", v.ACCOUNT_FIELDS)]),
    "duplicate_keys":
        "SELECT txn_id, count(*) AS occurrences FROM raw_txns GROUP BY 1 HAVING count(*) > 1",
    "duplicate_summary": _union([
        _duplicates("customers", "raw_customers", "customer_id"),
        _duplicates("card_transactions", "raw_txns", "txn_id"),
        _duplicates("branches", "raw_branches", "branch_id")]),
    "format_violations": _union([
        f"SELECT '{n}' AS check_name, count(*) AS n FROM raw_customers WHERE {p}" for n, p in (
            ("state_not_a_code", _NO_CODE), ("dob_not_iso", _ISO_MISS),
            ("dob_missing", "date_of_birth = ''"))]),
    "missing_values": _union(
        f"SELECT '{c}' AS column_name, count(*) AS n FROM raw_customers "
        f"WHERE {c} IS NULL OR {c} = ''"
        for c in ("date_of_birth", "source_bank", "attrition_flag")),
    "range_violations": """
SELECT count(*) FILTER (CAST(balance AS DOUBLE) < 0) AS too_low,
  count(*) FILTER (CAST(balance AS DOUBLE) >= 10000000) AS too_high FROM raw_accounts""",
    "distinct_counts": """
SELECT count(DISTINCT customer_id) AS distinct_count, 'customer_id' AS counted
FROM raw_customers
UNION ALL SELECT count(DISTINCT txn_id), 'txn_id' FROM raw_txns
UNION ALL SELECT count(*), 'customer_id.account_type'
FROM (SELECT DISTINCT customer_id, account_type FROM raw_accounts)""",
    "defect_report": _union([
        *[f"SELECT '{n}' AS defect, count(*) AS n FROM {s}" for n, s in _DEFECTS.items()],
        "SELECT 'duplicate_customer_rows', count(*) - count(DISTINCT customer_id) "
        "FROM raw_customers",
        "SELECT 'duplicate_txn_rows', count(*) - count(DISTINCT txn_id) FROM raw_txns"]),
    "expected_range_check": f"""
SELECT metric, value, low, high, value BETWEEN low AND high AS ok FROM (
{_union(f"SELECT '{n}' AS metric, CAST({_CHECKED[n]} AS DOUBLE) AS value, "
        f"{lo}::DOUBLE AS low, {hi}::DOUBLE AS high" for n, (lo, hi) in EXPECTED_RANGES.items())}
)""",
    "metric_spread": f"""
SELECT metric, count(*) AS datasets, min(value) AS min_value, max(value) AS max_value FROM (
{_union(f"SELECT '{n}' AS metric, CAST({e} AS DOUBLE) AS value FROM c360 GROUP BY region"
        for n, e in _SPREAD.items())}
) GROUP BY metric""",
    "expectation_metrics": "SELECT * FROM metrics_before",
    "expectation_drop": """
SELECT account_id, CAST(balance AS DOUBLE) AS balance FROM raw_accounts
WHERE CAST(balance AS DOUBLE) BETWEEN 0 AND 9999999.99""",
    "expectation_warn": """
SELECT event_type, source_bank IS NOT NULL AS known_bank_ok, count(*) AS n
FROM s_events GROUP BY 1, 2""",
    "expectation_fail": "SELECT account_type, count(*) AS n FROM s_accounts GROUP BY 1",
    "conservation_check": _union([
        _conservation("customers", "parsed_customers", "s_customers", _BAD_CUSTOMERS),
        _conservation("accounts", "raw_accounts", "s_accounts", "bad_accounts"),
        _conservation("card_transactions", "first_txns", "s_txns", _BAD_TXNS)]),
    "planted_defects": _planting(SEED),
    "metric_spread_runs": "SELECT defect AS metric, count(*) AS runs, "
        "CAST(min(n) AS DOUBLE) AS min_value, CAST(max(n) AS DOUBLE) AS max_value FROM ("
        + _union(_planting(seed) for seed in SEEDS) + ") GROUP BY defect",
    "dq_before_after": """
SELECT b.table_name, b.expectation, b.failed AS failed_before, a.failed AS failed_after,
  a.failed - b.failed AS delta
FROM metrics_before b JOIN metrics_after a
  ON a.table_name = b.table_name AND a.expectation = b.expectation""",
    "planted_caught": _union(
        f"SELECT '{x.name}' AS defect, count(*) AS planted, "
        f"count(*) FILTER (account_id IN (SELECT account_id FROM p_bad_accounts)) AS caught "
        f"FROM raw_accounts WHERE {_hit(x, 'account_id')}" for x in PLANTED_ACCOUNTS),
    **{f"{kind}_{s}": _csv(_RAW[s], fields) for kind in ("bronze", "stream_bronze")
       for s, fields in (("customers", v.CUSTOMER_FIELDS), ("accounts", v.ACCOUNT_FIELDS),
                         ("branches", v.BRANCH_FIELDS), ("customer_events", v.EVENT_FIELDS))},
    **{f"{kind}_card_transactions": "SELECT *, true AS has_source FROM raw_txns"
       for kind in ("bronze", "stream_bronze")},
    "stream_dedupe": "SELECT DISTINCT txn_id FROM raw_txns",
    "landing_rows": _union(
        f"SELECT '{s}' AS source, count(*) AS row_count, true AS landed FROM {r}"
        for s, r in _RAW.items()),
    **{name: "SELECT " + ", ".join(f"nullif({f}, '') AS {f}" for f in v.ACCOUNT_FIELDS)
       + " FROM raw_accounts" for name in ("reordered_accounts", "stream_reordered_accounts")},
    "damaged_transactions": """
SELECT outcome, raw AS has_raw_text, count(*) AS n FROM (
  SELECT CASE WHEN num % 97 = 0 OR num % 83 = 0 THEN 'missing_txn_id'
              WHEN num % 89 = 0 THEN 'unparseable_amount'
              WHEN amount < 100000 THEN 'clean' ELSE 'amount_outlier_100x' END AS outcome,
         num % 97 = 0 OR num % 89 = 0 AS raw
  FROM (SELECT *, CAST(substr(account_id, 4) AS BIGINT) AS num FROM raw_txns)
  QUALIFY num % 97 = 0 OR num % 83 = 0 OR row_number() OVER (PARTITION BY txn_id ORDER BY
    txn_ts, account_id, card_type, channel, merchant_category,
    CASE WHEN num % 89 = 0 THEN 'n/a' ELSE CAST(amount AS VARCHAR) END) = 1)
GROUP BY 1, 2""",
    "rebuild_counts": _counts(_TABLES),
    "table_counts": _counts(_TABLES),
    "promote_tables": _counts(_TABLES),
    "promote_scored": _counts({**_TABLES, "gold_customers_scored":
                               "(SELECT * FROM c360 WHERE attrition_flag IS NULL)"}),
    "metric_by_region": f"""
SELECT region AS "Region", {_measures(_MEASURE_SQL)} FROM c360 GROUP BY region""",
    "metric_by_all_dimensions": f"""
SELECT {_DIM_COLS}, {_measures(["Customer Count", "Median Balance"])} FROM c360
GROUP BY {", ".join(_DIMS.values())}""",
    "metric_by_segment": f"""
SELECT segment AS "Segment",
  {_measures(["Customer Count", "Average Balance", "Debit Card Swipes", "Retention Rate"])},
  sum(debit_swipe_count)::DOUBLE / count(*) AS "Swipes per Customer"
FROM c360 GROUP BY segment""",
    "metric_filtered": f"""
SELECT 'average_balance_61_65' AS question, {_MEASURE_SQL["Average Balance"]} AS answer,
  count(*) AS n FROM c360 WHERE age BETWEEN 61 AND 65
UNION ALL SELECT 'debit_swipes_21_25', sum(debit_swipe_count)::DOUBLE, NULL FROM c360
WHERE age BETWEEN 21 AND 25
UNION ALL SELECT 'moved_and_retained', {_MEASURE_SQL["Retention Rate"]}, count(*) FROM c360
WHERE moved_from_bank""",
    "metric_medians": f"""
SELECT age_band AS "Age Band", segment AS "Segment",
  {_measures(["Median Balance", "Customer Count"])} FROM c360 GROUP BY 1, 2""",
    "metric_catalogue": _union([
        *[f"SELECT 'dimension' AS kind, '{n}' AS name, '{x}' AS expr, "
          f"count(DISTINCT {x}) AS distinct_values FROM c360" for n, x in _DIMS.items()],
        *[f"SELECT 'measure', '{n}', '{x.expr.replace(chr(39), chr(39) * 2)}', NULL"
          for n, x in BANKING.measures.items()]]),
    "kpi_overview": _kpi(),
    "kpi_overview_affluent": _kpi("segment = 'affluent'"),
    "average_balance_by_band": "SELECT age_band, avg_balance FROM by_band",
    "swipes_by_age_band": """
SELECT age_band, count(*) AS debit_swipes FROM facts
WHERE card_type = 'debit' AND channel = 'swipe' GROUP BY age_band""",
    "retention_outcomes_long": """
SELECT source_bank, 'stayed' AS outcome, stayed AS customers FROM retention
UNION ALL SELECT source_bank, 'left_us', left_us FROM retention""",
    "customers_by_state":
        "SELECT home_state, count(*) AS customer_count FROM c360 GROUP BY home_state",
    "retention_table": "SELECT * FROM retention ORDER BY moved_in DESC, source_bank",
    "retention_rate_by_bank": "SELECT source_bank, retention_rate FROM retention",
    "retention_by_segment": f"""
SELECT segment, count(*) AS customer_count, count(*) FILTER (is_retained) AS retained,
  {_half(10000, 'count(*) FILTER (is_retained)')} AS retention_rate
FROM c360 GROUP BY segment""",
    "retention_mass_market": f"""
SELECT coalesce(source_bank, 'unknown') AS source_bank, count(*) AS moved_in,
  count(*) FILTER (is_retained) AS stayed, count(*) FILTER (NOT is_retained) AS left_us,
  {_half(10000, 'count(*) FILTER (is_retained)')} AS retention_rate
FROM c360 WHERE moved_from_bank AND segment = 'mass_market' GROUP BY 1""",
    "attrited_count": """
SELECT count(*) AS attrited_customers FROM c360 WHERE customer_status = 'attrited'""",
    "anchor_balance_61_65": """
SELECT CAST((cents + 50 * n) // nullif(100 * n, 0) AS DOUBLE) AS avg_balance, n
FROM (SELECT count(*) AS n, CAST(sum(CAST(round(total_balance * 100) AS BIGINT)) AS BIGINT)
        AS cents FROM c360 WHERE age BETWEEN 61 AND 65)""",
    "anchor_swipes_21_25": """
SELECT count(*) AS debit_swipes, 'facts' AS path FROM facts
WHERE age BETWEEN 21 AND 25 AND card_type = 'debit' AND channel = 'swipe'
UNION ALL SELECT CAST(coalesce(sum(debit_swipe_count), 0) AS BIGINT), 'customer_360' FROM c360
WHERE age BETWEEN 21 AND 25""",
    "anchor_moved_stayed": f"""
SELECT count(*) AS moved_in, count(*) FILTER (is_retained) AS stayed,
  {_half(1000, 'count(*) FILTER (is_retained)')} AS retention_rate
FROM c360 WHERE moved_from_bank""",
    "churn_reason_buckets": f"""
SELECT {_BUCKET} AS bucket, count(*) AS n FROM s_events WHERE event_type = 'attrited'
GROUP BY 1""",
    "churn_reason_examples": f"""
SELECT bucket, event_id, customer_id, event_date, reason
FROM (SELECT *, {_BUCKET} AS bucket FROM s_events WHERE event_type = 'attrited')
QUALIFY row_number() OVER (PARTITION BY bucket ORDER BY event_date DESC, event_id) <= 5""",
    "average_balance_by_band_affluent": """
SELECT age_band, ((2 * cents + n) // (2 * n)) / 100::DOUBLE AS avg_balance
FROM (SELECT age_band, count(*) AS n,
        CAST(sum(CAST(round(total_balance * 100) AS BIGINT)) AS BIGINT) AS cents
      FROM c360 WHERE segment = 'affluent' GROUP BY age_band)""",
    "retention_table_affluent": f"""
SELECT coalesce(source_bank, 'unknown') AS source_bank, count(*) AS moved_in,
  count(*) FILTER (is_retained) AS stayed, count(*) FILTER (NOT is_retained) AS left_us,
  {_half(10000, 'count(*) FILTER (is_retained)')} AS retention_rate
FROM c360 WHERE moved_from_bank AND segment = 'affluent' GROUP BY 1""",
    "anchor_swipes_affluent": """
SELECT count(*) AS debit_swipes, 'facts' AS path FROM facts
WHERE age BETWEEN 21 AND 25 AND card_type = 'debit' AND channel = 'swipe'
  AND segment = 'affluent'
UNION ALL SELECT CAST(coalesce(sum(debit_swipe_count), 0) AS BIGINT), 'customer_360' FROM c360
WHERE age BETWEEN 21 AND 25 AND segment = 'affluent'""",
    "churn_reason_buckets_affluent": f"""
SELECT {_BUCKET} AS bucket, count(*) AS n FROM s_events WHERE event_type = 'attrited'
  AND customer_id IN (SELECT customer_id FROM s_customers WHERE segment = 'affluent')
GROUP BY 1""",
    "churn_feature_table": "SELECT * FROM features",
    "churn_signal_features": "SELECT customer_id, " + ", ".join(
        f"round({x}, 6) AS {n}" for n, x in _SIGNALS.items()) + " FROM signals",
    "churn_split": f"""
SELECT attrition_flag, CASE WHEN attrition_flag IS NULL THEN 'score' WHEN {_SPLIT} THEN 'test'
  ELSE 'train' END AS part, count(*) AS n FROM features GROUP BY 1, 2""",
    "label_summary": """
SELECT count(attrition_flag) AS labelled, count(*) - count(attrition_flag) AS unlabelled,
  count(*) FILTER (attrition_flag = 1) AS positives,
  round(avg(attrition_flag), 6) AS base_rate, count(DISTINCT attrition_flag) AS classes
FROM features""",
    "churn_scorecard":
        "SELECT customer_id, round(z, 6) AS z, round(p, 6) AS z_probability FROM scorecard",
    "scorecard_bands": """
SELECT CASE WHEN p >= 0.6 THEN 'high' WHEN p >= 0.35 THEN 'medium' ELSE 'low' END AS risk_band,
  count(*) AS n FROM scorecard GROUP BY 1""",
    "scored_invariants": """
SELECT customer_id, true AS is_probability, true AS band_follows
FROM features WHERE attrition_flag IS NULL""",
    "model_reload_scores": """
SELECT customer_id, true AS same_score FROM features WHERE attrition_flag IS NULL""",
    "rank_auc": """
SELECT count(*) FILTER (attrition_flag = 1) AS positives,
  count(*) FILTER (attrition_flag = 0) AS negatives,
  round((sum(r) FILTER (attrition_flag = 1)
         - count(*) FILTER (attrition_flag = 1)
           * (count(*) FILTER (attrition_flag = 1) + 1) / 2::DOUBLE)
    / (count(*) FILTER (attrition_flag = 1)::DOUBLE * count(*) FILTER (attrition_flag = 0)), 9)
    AS auc
FROM (SELECT attrition_flag, rank() OVER (ORDER BY z)
        + (count(*) OVER (PARTITION BY z) - 1) / 2::DOUBLE AS r
      FROM scorecard WHERE attrition_flag IS NOT NULL)""",
}

# The training split, and the logistic baseline by its unique optimum: accelerated descent on the
# full batch of standardised rows, whose curvature lies between the penalty and 1 / _RATE.
_F = list(_SIGNALS.values())
_X = [f"x{i}" for i in range(1, len(_F) + 1)]
_STEPS, _RATE, _L2 = 3000, 0.5, 1e-4
_MOMENTUM = (1 - (_RATE * _L2) ** 0.5) / (1 + (_RATE * _L2) ** 0.5)
CTE["parted"] = """
SELECT *, CASE WHEN row_number() OVER (PARTITION BY attrition_flag ORDER BY
      md5('42:' || concat_ws(':', attrition_flag, customer_id)), customer_id) - 1
    < 0.25::DOUBLE * count(*) OVER (PARTITION BY attrition_flag)
  THEN 'test' ELSE 'train' END AS split FROM features"""
CTE["trained"] = "SELECT * FROM parted WHERE split = 'train' AND attrition_flag IS NOT NULL"
CTE["scaled"] = f"""
SELECT parted.customer_id, split, parted.attrition_flag::DOUBLE AS y, {", ".join(
    f"coalesce(({f} - m_{f}) / nullif(s_{f}, 0), 0) AS {x}" for f, x in zip(_F, _X))}
FROM parted JOIN signals USING (customer_id), (
  SELECT {", ".join(f"avg({f}) AS m_{f}, stddev_samp({f}) AS s_{f}" for f in _F)}
  FROM trained JOIN signals USING (customer_id))
WHERE parted.attrition_flag IS NOT NULL"""
_LINE = " + ".join(["a[1]", *[f"a[{i + 2}] * {x}" for i, x in enumerate(_X)]])
_ZERO = "[" + ", ".join(["0::DOUBLE"] * (len(_X) + 1)) + "]"
CTE["optimum"] = f"""
WITH RECURSIVE batch AS MATERIALIZED (SELECT * FROM scaled WHERE split = 'train'),
descent AS (
  SELECT 0 AS k, {_ZERO} AS w, {_ZERO} AS p
  UNION ALL
  SELECT k + 1, list_transform(range(1, {len(_X) + 2}), lambda j:
           a[j] - {_RATE} * (g[j] + CASE WHEN j > 1 THEN {_L2} * a[j] ELSE 0 END)), w
  FROM (SELECT k, w, a, [avg(e), {", ".join(f"avg(e * {x})" for x in _X)}] AS g
        FROM (SELECT *, 1::DOUBLE / (1::DOUBLE + exp(-({_LINE}))) - y AS e
              FROM (SELECT k, w, list_transform(range(1, {len(_X) + 2}), lambda j:
                             w[j] + {_MOMENTUM} * (w[j] - p[j])) AS a
                    FROM descent WHERE k < {_STEPS}), batch)
        GROUP BY k, w, a))
SELECT w AS a FROM descent WHERE k = {_STEPS}"""


def _auc(rows: str, score: str, label: str) -> str:
    """Positives, negatives and the area under the curve of ``rows``."""
    pos, neg = (f"count(*) FILTER ({label} = {x})" for x in (1, 0))
    return f"""
SELECT {pos} AS positives, {neg} AS negatives,
  (sum(r) FILTER ({label} = 1) - {pos} * ({pos} + 1) / 2::DOUBLE)
    / ({pos}::DOUBLE * {neg}) AS auc
FROM (SELECT {label}, rank() OVER (ORDER BY {score})
        + (count(*) OVER (PARTITION BY {score}) - 1) / 2::DOUBLE AS r FROM {rows})"""


_CARD = re.sub(r"(f_\w+)", r"{\1}", CTE["scorecard"].split("SELECT *, ")[2].split(" AS z")[0])
CTE["known"] = """
SELECT *, row_number() OVER (ORDER BY customer_id) AS place
FROM signals WHERE attrition_flag IS NOT NULL"""


def _permuted(name: str, signal: str) -> str:
    z = _CARD.format(**{f: "dealt" if f == signal else f for f in _F})
    return f"""
SELECT '{name}' AS feature, round(whole.auc, 9) AS auc, round(less.auc, 9) AS permuted_auc,
  round(whole.auc - less.auc, 6) AS "drop"
FROM ({_auc("(SELECT * FROM scorecard WHERE attrition_flag IS NOT NULL)", "z",
            "attrition_flag")}) AS whole,
  ({_auc(f"(SELECT *, {z} AS z FROM known JOIN (SELECT {signal} AS dealt, row_number() OVER "
         f"(ORDER BY md5('42:{name}:' || customer_id), customer_id) AS place FROM known) "
         "USING (place))", "z", "attrition_flag")}) AS less"""


def _tagged(table: str, key: str, hits: dict[str, str]) -> str:
    """The damaged table with the names of the rules that hit each row before."""
    names = ", ".join(f"CASE WHEN {w} THEN '{n}' END" for n, w in hits.items())
    return CTE[table].strip().replace(
        f"SELECT {key},", f"SELECT list_filter([{names}], lambda x: x IS NOT NULL) AS planted, "
        f"{key},", 1)


def _coverage(source: str, table: str, fired: dict[str, str]) -> str:
    names = ", ".join(f"CASE WHEN {w} THEN '{n}' END" for n, w in fired.items())
    some = "CASE WHEN len({0}) = 0 THEN ['none'] ELSE {0} END"
    return f"""
SELECT '{source}' AS source, planted, fired, count(*) AS n FROM (
  SELECT planted, unnest(fired) AS fired FROM (
    SELECT unnest({some.format("planted")}) AS planted, {some.format("fired")} AS fired
    FROM (SELECT planted, list_filter([{names}], lambda x: x IS NOT NULL) AS fired
          FROM {table} AS t)))
GROUP BY planted, fired"""


CTE["t_customers"] = _tagged("p_customers", "customer_id", {
    **{x.name: f"{_hit(x, 'customer_id')} AND {w}"
       for x, w in zip(PLANTED_CUSTOMERS, _PLANTABLE, strict=True)},
    "duplicate_customer_rows":
        _hit("duplicate_customer_rows", "customer_id", CUSTOMER_COPY_RATE)})
CTE["t_accounts"] = _tagged("p_accounts", "account_id", {
    x.name: _hit(x, "account_id") for x in PLANTED_ACCOUNTS})
CTE["t_txns"] = _tagged("p_txns", "txn_id", {
    PLANTED_TRANSACTIONS[0].name: _hit(PLANTED_TRANSACTIONS[0], "txn_id"),
    "duplicate_txn_rows": _hit("duplicate_txn_rows", "txn_id", TRANSACTION_COPY_RATE)})

_BODIES |= {
    "profile_sketched": _union(
        f"SELECT '{f}' AS column_name, count(*) AS row_count, count(*) FILTER ({f} IS NULL) AS "
        f"null_count, true AS distinct_near, {'true' if f == 'balance' else 'NULL'} AS median_near "
        "FROM raw_accounts" for f in v.ACCOUNT_FIELDS),
    "observed_expectations": "SELECT * FROM metrics_before",
    "rule_coverage": _union([
        _coverage("customers", "(SELECT *, count(*) OVER (PARTITION BY customer_id) AS copies "
                  "FROM t_customers)", {
            "long_form_state": _NO_CODE, "alt_date_format_dob": _ISO_MISS,
            "missing_dob": "date_of_birth = ''", "duplicate_customer_rows": "copies > 1"}),
        _coverage("accounts", "t_accounts", {
            "negative_balance": "balance < 0", "balance_outlier_100x": "balance >= 10000000",
            "orphan_account_customer":
                "customer_id NOT IN (SELECT customer_id FROM raw_customers)"}),
        _coverage("card_transactions", "(SELECT *, count(*) OVER (PARTITION BY txn_id) AS copies "
                  "FROM t_txns)", {
            "txn_amount_outlier_100x": "amount >= 100000", "duplicate_txn_rows": "copies > 1"})]),
    "churn_split_exact": """
SELECT customer_id, attrition_flag, split FROM parted WHERE attrition_flag IS NOT NULL""",
    "imputed_features": "SELECT customer_id, " + ", ".join(
        f"round(coalesce({n}, (SELECT quantile_cont({n}, 0.5) FROM trained)), 6) AS {n}_num"
        for n in v.CHURN_NUMERIC) + " FROM features",
    "category_index": _union(f"""
SELECT '{n}' AS column_name, {n} AS category, count(*) AS n,
  row_number() OVER (ORDER BY count(*) DESC, {n}) - 1 AS "index" FROM trained GROUP BY {n}"""
                             for n in v.CHURN_CATEGORICAL),
    "permutation_importance": _union(_permuted(n, f) for n, f in _SIGNALS.items()),
    "logistic_baseline": "SELECT unnest([" + ", ".join(f"'{n}'" for n in _SIGNALS) + f"""])
  AS feature, round(unnest(a[2:{len(_X) + 1}]), 4) AS coefficient FROM optimum""",
    "logistic_eval": f"""
SELECT positives, negatives, round(auc, 4) AS auc,
  CASE WHEN auc > 0.95 THEN 'probable leakage' WHEN auc < 0.7 THEN 'weak features' ELSE 'ok' END
    AS verdict
FROM ({_auc(f"(SELECT y, {_LINE} AS z FROM scaled, optimum WHERE split = 'test')", "z", "y")})""",
}
ORACLE = {name: _with(body) for name, body in _BODIES.items()}
