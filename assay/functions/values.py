"""Domains, limits, labels and weights that results depend on."""

# Reporting date used when the caller gives none.
AS_OF = "2026-09-01"

# Home states, code and long name.
STATES = [
    ("TN", "Tennessee"), ("TX", "Texas"), ("GA", "Georgia"), ("FL", "Florida"),
    ("NC", "North Carolina"), ("OH", "Ohio"), ("IL", "Illinois"), ("MI", "Michigan"),
    ("CA", "California"), ("AZ", "Arizona"), ("NY", "New York"), ("PA", "Pennsylvania"),
]
STATE_CODES = {name.upper(): code for code, name in STATES}

# Banks that switch-in customers come from.
SOURCE_BANKS = [
    "First National", "Metro Savings", "Union Trust", "Pinnacle Federal",
    "Harbor Community Bank", "Summit Credit Union", "Cornerstone Bank",
    "Riverside Financial",
]

# Merchant categories.
MERCHANT_CATEGORIES = [
    "grocery", "restaurant", "gas", "retail", "travel", "utilities", "healthcare",
    "entertainment", "atm_cash",
]

# Accepted layouts of a date of birth, in the order they are tried.
DATE_FORMATS = ["yyyy-MM-dd", "MM/dd/yyyy"]

# Age bands, both ends included; the last one is open.
AGE_BANDS = [
    (18, 25, "18-25"), (26, 35, "26-35"), (36, 45, "36-45"), (46, 55, "46-55"),
    (56, 65, "56-65"), (66, 75, "66-75"), (76, None, "76+"),
]

# Limits of the expectations.
MIN_AGE, MAX_AGE = 18, 110
BALANCE_LIMIT = 10_000_000
AMOUNT_LIMIT = 100_000

# Churn model columns; the label's near-copies may never be features.
CHURN_NUMERIC = [
    "tenure_years", "total_balance", "avg_account_balance", "num_accounts", "txn_count",
    "debit_swipe_count", "total_spend", "age",
]
CHURN_CATEGORICAL = ["segment", "acquisition_channel", "region", "home_state"]
CHURN_LABEL = "attrition_flag"
CHURN_LEAKS = {"customer_status", "is_retained", "attrition_flag"}

# Risk bands, lowest score of each.
RISK_BANDS = [(0.6, "high"), (0.35, "medium"), (None, "low")]

# Test AUC above the first hints at leakage, below the second at weak features.
AUC_LEAK, AUC_WEAK = 0.95, 0.70

# Reason of leaving -> bucket.
REASON_BUCKETS = {
    "fees": "pricing", "rate": "pricing", "service": "service",
    "relocation": "life_event", "competitor_offer": "competitor",
}

# Weights of the attrition scorecard, per clipped feature.
SCORECARD_INTERCEPT = 1.65
SCORECARD = {
    "tenure_clipped": -0.46, "log_balance": -1.15, "activity": -0.15, "is_young": 1.55,
    "is_switch_in": 0.88, "is_affluent": -1.10, "single_account": 0.82,
}

# Landing sources and their columns.
CUSTOMER_FIELDS = [
    "customer_id", "first_name", "last_name", "date_of_birth", "gender", "home_state",
    "home_zip", "home_branch_id", "segment", "acquisition_channel", "source_bank",
    "join_date", "customer_status", "attrition_flag", "updated_at",
]
ACCOUNT_FIELDS = [
    "account_id", "customer_id", "account_type", "open_date", "close_date", "balance",
    "account_status",
]
BRANCH_FIELDS = ["branch_id", "branch_name", "branch_state", "branch_region", "opened_date"]
EVENT_FIELDS = [
    "event_id", "customer_id", "event_type", "event_date", "source_bank", "reason",
]
TRANSACTION_FIELDS = [
    "txn_id", "account_id", "card_type", "channel", "merchant_category", "amount", "txn_ts",
]
