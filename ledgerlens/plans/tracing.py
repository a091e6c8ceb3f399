"""Tracing and list reports: R17 account-debit payments to unlinked refunds,
R18 card behind unlinked refunds, R19 Interac refunds whose transfer was
never reversed, R22 sales matched to financing paydowns, R23 dispute
dashboard, R24 dispute detail sheet.

The hand-edited literals of the source sheets (one payout, one dispute, one
merchant, a list of payment ids) are parameters; None reports all of them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import local_ts, ts_lit
from ..operators.links import contains_join, lookup, metadata_value
from ..operators.reduction import reduced

NEW_YORK = "America/New_York"


# --------------------------------------------------------------------------- R17
def account_debit_unlinked(t, platform_account: str, payment_ids=None) -> DataFrame:
    """Platform book transfers tagged unreferenced-refund and the refund behind each.

    `payment_ids` (S4) restricts to listed account-debit payments via a semi
    join against an inline relation; None keeps all.
    """
    spark = t.spark
    cat = t.connected_account_transfers.where(
        (F.col("destination_id") == platform_account) & ~F.col("automatic") & ~F.col("reversed"))
    tagged = t.connected_account_transfers_metadata.where(
        (F.col("key") == "transaction_type") & (F.col("value") == "unreferenced-refund")) \
        .select(F.col("transfer_id").alias("id"))
    cat = cat.join(tagged, "id", "inner")
    if payment_ids is not None:
        wanted = spark.createDataFrame([(p,) for p in payment_ids], "payment_id string")
        cat = cat.join(wanted, cat.destination_payment_id == wanted.payment_id, "left_semi")
    parent = metadata_value(t.refunds_metadata, "parent_transfer", "refund_id", "_tid") \
        .withColumnRenamed("_parent", "_rid")
    refunds = t.refunds.where(F.col("charge_id").isNull()).select(
        F.col("id").alias("_rid"), F.col("id").alias("refund_id"),
        F.col("created").alias("refund_created"),
        (F.col("amount").cast("double") / F.lit(100.0)).alias("refund_amount"),
        F.col("balance_transaction_id").alias("refund_bt_id"), F.col("status").alias("_rstatus"))
    j = (cat.join(parent, cat.id == parent._tid, "left")
         .join(refunds, "_rid", "left"))
    return j.select("refund_id", "refund_created", "refund_amount", "refund_bt_id",
                    F.col("_rstatus").alias("status"),
                    F.col("id").alias("merchant_account_debit_transfer_id"),
                    F.col("destination_payment_id").alias("account_debit_payment_id"),
                    F.col("account").alias("merchant_account_id"))


# --------------------------------------------------------------------------- R18
def unlinked_refund_cards(t, since, platform_account: str) -> DataFrame:
    """Unlinked refund -> parent book transfer -> card it went back to."""
    r = t.refunds.where(F.col("charge_id").isNull() & (F.col("status") == "succeeded")
                        & (F.col("created") > ts_lit(since)))
    parent = metadata_value(t.refunds_metadata, "parent_transfer", "refund_id", "_tid")
    cat = t.connected_account_transfers.where(
        (F.col("destination_id") == platform_account) & ~F.col("automatic") & ~F.col("reversed")) \
        .select(F.col("id").alias("_tid"), F.col("id").alias("transfer_id"),
                F.col("destination_payment_id").alias("payment_id"),
                F.col("account").alias("merchant_account"))
    dest = metadata_value(t.connected_account_transfers_metadata, "final_destination",
                          "transfer_id", "_pmid").withColumnRenamed("_parent", "transfer_id")
    pm = t.payment_methods.withColumnRenamed("id", "_pmid")
    j = (r.join(parent, r.id == parent._parent, "left").join(cat, "_tid", "inner")
         .join(dest, "transfer_id", "left").join(pm, "_pmid", "left"))
    return j.select(F.col("id").alias("refund_id"), "created",
                    F.col("amount").alias("refund_amount"),
                    F.col("balance_transaction_id").alias("refund_bt"), "transfer_id",
                    "payment_id", "merchant_account", F.col("_pmid").alias("payment_method_id"),
                    "card_brand", "card_country", "card_exp_month", "card_exp_year",
                    "card_fingerprint", "card_funding", F.col("card_iin").alias("card_bin_number"),
                    "card_last4", "card_three_d_secure_supported")


# --------------------------------------------------------------------------- R19
def interac_not_reversed(t, since) -> DataFrame:
    """Refunded Interac charges whose transfer has no reversal (anti join)."""
    r = t.refunds.where((F.col("status") == "succeeded") & (F.col("created") > ts_lit(since)))
    ch = t.charges.where((F.col("payment_method_type") == "interac_present") & F.col("captured")) \
        .select(F.col("id").alias("charge_id"), F.col("transfer_id").alias("_ctid"),
                F.col("destination_id").alias("merchant_account"))
    tr = t.transfers.select(F.col("id").alias("_ctid"), F.col("id").alias("transfer_id"))
    rev = t.transfer_reversals.select("transfer_id")
    names = t.connected_accounts.select(F.col("id").alias("merchant_account"),
                                        "business_name", "business_url")
    j = (r.join(ch, "charge_id", "inner").join(tr, "_ctid", "left")
         .join(rev, "transfer_id", "left_anti")
         .join(names, "merchant_account", "left"))
    return j.select(F.col("id").alias("refunds_id"), F.col("amount").alias("refunds_amount"),
                    F.col("created").alias("refund_created"), F.col("status").alias("refund_status"),
                    "merchant_account", "business_name", "business_url", "transfer_id") \
        .orderBy(F.col("merchant_account").asc_nulls_last(), F.col("business_name").asc_nulls_last(),
                 F.col("refund_created").desc_nulls_last())


# --------------------------------------------------------------------------- R22
def sales_with_paydowns(t, since, account: str | None = None) -> DataFrame:
    """Payments matched to financing paydowns whose text names the payment."""
    cabt = t.connected_account_balance_transactions.where(F.col("created") > ts_lit(since))
    if account is not None:
        cabt = cabt.where(F.col("account") == account)
    paydowns = cabt.where(F.col("type").isin("financing_paydown")).select(
        F.col("id").alias("_pid"), F.col("account").alias("merchant"),
        F.round(F.col("amount") / F.lit(100), 2).cast("double").alias("paydown_amount"),
        F.col("description").alias("paydown_description"))
    cac = t.connected_account_charges.select(F.col("balance_transaction_id").alias("id"),
                                             F.col("id").alias("payment_id"),
                                             F.col("application_fee_id").alias("_afid"))
    af = t.application_fees.select(F.col("id").alias("_afid"), F.col("amount").alias("_afamt"))
    paid = cabt.where(F.col("type").isin("payment") & (F.col("reporting_category") == "charge"))
    sales = (paid.join(cac, "id", "left").join(af, "_afid", "left")
             .select(F.col("id").alias("_sid"), F.col("account").alias("merchant"), "payment_id",
                     "created", "source_id",
                     F.round(F.col("_afamt") / F.lit(-100), 2).cast("double")
                     .alias("application_fee_amount"),
                     F.round(F.col("amount") / F.lit(100), 2).cast("double").alias("sales_amount")))
    j = contains_join(sales, paydowns, "_sid", "source_id", "_pid", "paydown_description",
                      partition_cols=["merchant"], keys=paid.select(F.col("account").alias("merchant"), "source_id"))
    return j.select("merchant", "payment_id", "created", "sales_amount", "application_fee_amount",
                    "paydown_amount", "paydown_description").orderBy(F.col("created").desc())


# --------------------------------------------------------------------------- R23
def _months_before(ts: dt.datetime, months: int) -> dt.datetime:
    y, m = divmod(ts.year * 12 + ts.month - 1 - months, 12)
    m += 1
    last = [31, 29 if y % 4 == 0 and (y % 100 != 0 or y % 400 == 0) else 28, 31, 30, 31, 30,
            31, 31, 30, 31, 30, 31][m - 1]
    return ts.replace(year=y, month=m, day=min(ts.day, last))


def dispute_dashboard(t, as_of, months: int = 6) -> DataFrame:
    """Disputes, evidence submitted and wins by reason over the last `months`."""
    as_of = as_of if isinstance(as_of, dt.datetime) else dt.datetime.fromisoformat(str(as_of))
    d = t.disputes.where(F.col("created") > ts_lit(_months_before(as_of, months)))
    won = d.where(F.col("status") == "won").groupBy("reason") \
        .agg(F.count("id").alias("disputes_won"))
    data = d.groupBy("reason").agg(
        F.count("id").alias("disputes"),
        F.count_if(F.col("evidence_details_submission_count") > 0)
        .alias("disputes_with_evidence_submitted"))
    return data.join(won, "reason", "left").orderBy(F.col("disputes").desc())


# --------------------------------------------------------------------------- R24
# Dispute reason codes and their sheet labels.
REASON_LABELS = {
    "fraudulent": "Fraud",
    "duplicate": "Duplicate processing",
    "credit_not_processed": "Credit not processed",
    "product_not_received": "Merchandise/Services not Received",
    "product_unacceptable": "Not As Described/Defective",
    "subscription_canceled": "Cancelled Merchandise/Services",
}


def dispute_sheet(t, dispute_id: str | None = None, tz: str = NEW_YORK) -> DataFrame:
    """Dispute detail sheet with labels, local dates, CP / CNP and order id."""
    d = t.disputes.where(F.col("status").isin("warning_needs_response", "needs_response"))
    if dispute_id is not None:
        d = d.where(F.col("id") == dispute_id)
    # every table is cut down to the open disputes, or to their charges, before it is shuffled
    bt = reduced(t.balance_transactions, "source_id", d, "id").select(F.col("source_id").alias("id"), F.col("created").alias("_btc"))
    ch = reduced(t.charges, "dispute_id", d, "id").select(
        F.col("dispute_id").alias("id"), F.col("id").alias("_cid"), F.col("destination_id").alias("account_id"),
        F.col("created").alias("_chc"), "payment_method_type")
    names = t.connected_accounts.select(F.col("id").alias("account_id"),
                                        F.col("business_name").alias("merchant_name"))
    pmd = reduced(t.payment_method_details, "charge_id", ch, "_cid").select(
        F.col("charge_id").alias("_cid"), F.col("card_last4").alias("last_4digits_card"))
    oid = reduced(metadata_value(t.charges_metadata, "order_id", "charge_id", "order_id"), "_parent", ch, "_cid") \
        .withColumnRenamed("_parent", "_cid")
    j = d.join(bt, "id", "left").join(ch, "id", "left")
    for dim, key in ((names, "account_id"), (pmd, "_cid"), (oid, "_cid")):
        j = lookup(j, dim, key, ["id"])
    label = F.col("reason")
    for code, text in reversed(list(REASON_LABELS.items())):
        label = F.when(F.col("reason") == code, F.lit(text)).otherwise(label)
    day = lambda c: F.date_format(local_ts(c, tz), "yyyy-MM-dd")
    return j.select(
        "merchant_name", "account_id", F.col("id").alias("case_id"),
        day("_chc").alias("trx_date"), day("created").alias("report_date"),
        day("_btc").alias("funds_withdrawn_date"),
        F.col("evidence_details_due_by").alias("respond_by"), "is_charge_refundable",
        (F.col("amount").cast("decimal(18,2)") / F.lit(100)).cast("double").alias("amount"),
        F.when(F.col("payment_method_type") == "card", F.lit("CNP")).otherwise(F.lit("CP"))
        .alias("cp_or_cnp"),
        F.when(F.col("status") == "warning_needs_response", F.lit("inquiry"))
        .when(F.col("status") == "needs_response", F.lit("chargeback")).alias("type"),
        label.alias("reason_code"), "last_4digits_card", "order_id",
        F.col("created").alias("_dcreated")).orderBy(F.col("_dcreated").desc()).drop("_dcreated")
