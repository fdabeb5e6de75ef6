"""Small literal frames for unit tests."""

from assay.functions import values as v
from assay.sources.landing import landing_schema

CUSTOMER = dict(
    customer_id="C1", first_name="Ann", last_name="Lee", date_of_birth="1980-05-05", gender="F",
    home_state="TN", home_zip="10000", home_branch_id="B1", segment="affluent",
    acquisition_channel="branch", source_bank="", join_date="2016-09-01",
    customer_status="active", attrition_flag="0", updated_at="2026-09-01")
ACCOUNT = dict(
    account_id="A1", customer_id="C1", account_type="checking", open_date="2020-01-01",
    close_date="", balance="100.00", account_status="open")
TRANSACTION = dict(
    txn_id="T1", account_id="A1", card_type="debit", channel="swipe",
    merchant_category="gas", amount=10.0, txn_ts="2026-01-01")
BRANCH = dict(branch_id="B1", branch_name="Main", branch_state="TN", branch_region="South",
              opened_date="2001-02-03")
EVENT = dict(event_id="E1", customer_id="C1", event_type="attrited", event_date="2026-02-02",
             source_bank="", reason="fees")

_BASE = {"customers": CUSTOMER, "accounts": ACCOUNT, "card_transactions": TRANSACTION,
         "branches": BRANCH, "customer_events": EVENT}


def bronze(spark, source, *rows):
    """A bronze frame, all text; every row gives only what differs from the default row."""
    schema = landing_schema(source)
    text = lambda x: x if x is None else str(x)
    full = [{**_BASE[source], **row} for row in rows]
    return spark.createDataFrame(
        [tuple(text(r.get(f)) for f in schema.fieldNames()) for r in full], schema)


def rows(df, *cols):
    picked = df.select(*cols) if cols else df
    return sorted([tuple(r) for r in picked.collect()], key=repr)


AS_OF = v.AS_OF
