"""Fee and payout reports: R12 fee report, R13 balance report, R14/R15 payout
breakdowns, R16 payout activity timing, R20 itemised fees with tags, R21
invoice fee reconciliation.

Payout breakdowns reduce the ledger to (payout, currency, type[, period
start]) with a partial aggregate before meeting the payout rows, so one
payout with millions of ledger rows is summed map-side and never becomes a
single hot join key. The source's left joins of the ledger to charges,
disputes and refunds select nothing and hit unique ids, so they cannot
change the result and are not planned (J9).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import in_days, local_day, local_ts, ts_lit
from ..operators.links import lookup
from ..functions.descriptions import (date_after_open_paren, date_before_close_paren,
                                      has_period, period_start)

NEW_YORK = "America/New_York"


def _cents(c) -> F.Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("double") / F.lit(100.0)


# --------------------------------------------------------------------------- R12
def fee_report(t, d0, d1) -> DataFrame:
    """Itemised interchange-plus fees plus daily and monthly fee rows by period."""
    ic = t.icplus_fees.where(in_days("incurred_at", d0, d1))
    icplus = ic.groupBy(
        local_day("incurred_at").alias("activity_at"),
        F.to_date("attribution_start_time").alias("attribution_start_time"),
        F.date_sub(F.to_date("attribution_end_time"), 1).alias("attribution_end_time"),
        "fee_category", "card_brand", "card_funding",
        F.when(F.col("card_present"), F.lit("Card Present")).otherwise(F.lit("CNP")).alias("type"),
    ).agg(_cents(F.sum("billing_amount")).alias("amount"))

    bt = t.balance_transactions.where(F.col("type") == "stripe_fee")
    desc = F.lower("description")
    start = date_after_open_paren("description")
    end = date_before_close_paren("description")
    none_s = F.lit(None).cast("string")
    daily = bt.where((desc.like("%radar%") | desc.like("%services fee%"))
                     & (start >= F.lit(d0).cast("date")) & (start <= F.lit(d1).cast("date"))) \
        .select(start.alias("activity_at"), F.lit(None).cast("date").alias("attribution_start_time"),
                F.lit(None).cast("date").alias("attribution_end_time"),
                # positional union: the description lands in fee_category
                F.col("description").alias("fee_category"), none_s.alias("card_brand"),
                none_s.alias("card_funding"), none_s.alias("type"),
                _cents(-F.col("amount")).alias("amount"))
    monthly = bt.where((desc.like("%sigma%") | desc.like("%active reader fee%")
                        | desc.like("%connect%"))
                       & (start >= F.lit(d0).cast("date")) & (end <= F.lit(d1).cast("date"))) \
        .select(start.alias("activity_at"), start.alias("attribution_start_time"),
                end.alias("attribution_end_time"), F.col("description").alias("fee_category"),
                none_s.alias("card_brand"), none_s.alias("card_funding"), none_s.alias("type"),
                _cents(-F.col("amount")).alias("amount"))
    out = icplus.unionByName(daily).unionByName(monthly).distinct()
    return out.orderBy(F.col("activity_at").asc_nulls_last(), F.col("type").asc_nulls_last(),
                       F.col("fee_category").asc_nulls_last(),
                       F.col("card_funding").asc_nulls_last(), F.col("card_brand").asc_nulls_last())


# --------------------------------------------------------------------------- R13
def balance_report(t, d0, d1) -> DataFrame:
    """Ledger sums by day, category and card type; refunds re-summed per refund first."""
    bt = t.balance_transactions
    pmd = t.payment_method_details.select(
        "charge_id", "card_brand", "card_funding",
        F.when(F.col("type") == "card", F.lit("cnp")).otherwise(F.col("type")).alias("type"))
    keys = ["activity_at", "reporting_category", "card_brand", "card_funding", "type"]
    charges = (bt.where(F.col("type").isin("charge", "application_fee") & in_days("created", d0, d1))
               .select(local_day("created").alias("activity_at"), "reporting_category",
                       F.col("source_id").alias("charge_id"), "amount")
               .join(pmd, "charge_id", "left")
               .groupBy(*keys).agg(F.sum("amount").alias("_cents")))
    re = t.refunds.where(in_days("created", d0, d1)) \
        .select(F.col("id").alias("refund_id"), "charge_id")
    per_refund = (bt.where((F.col("type") == "refund") & in_days("created", d0, d1))
                  .select(local_day("created").alias("activity_at"), "reporting_category",
                          F.col("source_id").alias("refund_id"), "amount")
                  .join(re, "refund_id", "inner")
                  .join(pmd, "charge_id", "left")
                  .groupBy(*keys, "charge_id", "refund_id").agg(F.sum("amount").alias("_cents")))
    refunds = per_refund.groupBy(*keys).agg(F.sum("_cents").alias("_cents"))
    out = charges.unionByName(refunds).distinct()
    return out.select(*keys, _cents("_cents").alias("amount")).orderBy(
        "activity_at", "reporting_category", F.col("type").asc_nulls_last(),
        F.col("card_funding").asc_nulls_last(), F.col("card_brand").asc_nulls_last())


# --------------------------------------------------------------------------- R14 / R15
def payout_breakdown(t, payout_id: str | None = None, with_accrual: bool = False) -> DataFrame:
    """R14 (and R15 with the accrual start parsed from the fee text).

    payout_id=None reports every bank payout; a single id reproduces the
    one-payout sheet.
    """
    po = t.transfers.where(F.col("type") == "bank_account")
    if payout_id is not None:
        po = po.where(F.col("id") == payout_id)
    bt = t.balance_transactions.where(~F.col("type").isin("payout")
                                      & F.col("automatic_transfer_id").isNotNull())
    keys = [F.col("automatic_transfer_id").alias("payout_id"), "currency",
            F.col("type").alias("balance_transaction_type")]
    if with_accrual:
        keys.append(F.when((F.col("reporting_category") == "fee") & has_period("description"),
                           period_start("description")).alias("fee_activity_start_time"))
    agg = bt.groupBy(*keys).agg(F.sum("amount").alias("_amount"), F.sum("net").alias("_net"))
    out = po.select(F.to_date("date").alias("payout_date"), F.col("id").alias("payout_id"),
                    _cents("amount").alias("payout_amount"), F.col("status").alias("payout_status")) \
        .join(agg, "payout_id", "left")
    cols = ["payout_date", "payout_id", "payout_amount", "payout_status", "currency",
            "balance_transaction_type"]
    if with_accrual:
        cols.append("fee_activity_start_time")
    return out.select(*cols, _cents("_amount").alias("balance_transaction_amount"),
                      _cents("_net").alias("balance_transaction_net"))


# --------------------------------------------------------------------------- R16
def payout_activity_timing(t, since, tz: str = NEW_YORK) -> DataFrame:
    """Latest ledger time per payout and type, with a local 12-hour clock."""
    bt = t.balance_transactions.where((F.col("created") > ts_lit(since))
                                      & F.col("automatic_transfer_id").isNotNull())
    m = bt.groupBy("type", F.col("automatic_transfer_id").alias("payout_id")) \
          .agg(F.max("created").alias("raw_date"))
    return m.select("type", "raw_date",
                    F.date_format(local_ts("raw_date", tz), "hh:mm:ss a").alias("trx_date"),
                    "payout_id").orderBy("payout_id", "raw_date", "type")


# --------------------------------------------------------------------------- R20
def icplus_tagged(t, since) -> DataFrame:
    """Itemised fees tagged subscription / product, with the billed amount."""
    ic = t.icplus_fees.where(F.col("incurred_at") > ts_lit(since))
    ch = t.charges.select(F.col("id").alias("charge_id"),
                          F.col("description").alias("charge_description"))
    tags = t.charges_metadata.where((F.col("key") == "product_id")
                                    & F.col("value").isin("resto", "retail")) \
        .select("charge_id", F.col("value").alias("_product"))
    inv = t.invoices.select(F.col("subscription_id"), F.col("charge_id"))
    subs = t.subscriptions.select(F.col("id").alias("subscription_id"))
    sub_charges = subs.join(inv, "subscription_id", "inner")
    # a subscription counts for charges that exist, so it is joined to them first;
    # tags count without a charge; both lookups have one key, so that the fees move once
    known = ch.join(sub_charges, "charge_id", "left").withColumn("_mid", F.col("charge_id"))
    j = lookup(ic, known, "charge_id", ["id"])
    j = lookup(j, tags, "charge_id", ["id"])
    return j.select(
        F.date_format(F.date_trunc("day", "incurred_at"), "yyyy-MM-dd").alias("date"),
        F.round(F.col("billing_amount") / F.lit(-100), 10).cast("double").alias("billed"),
        "subscription_id",
        F.coalesce(F.when(F.col("subscription_id").isNotNull(), F.lit("subscription")),
                   F.col("_product")).alias("business_type"),
        "charge_description",
        F.coalesce("charge_id", "_mid", "refund_id", "dispute_id", "request_id")
        .alias("activity_id"),
        "fee_name", "fee_category")


# --------------------------------------------------------------------------- R21
def invoice_fee_daily(t) -> DataFrame:
    """Invoiced charges per day and the 0.5 % billing fee."""
    ch = t.charges.where(F.col("invoice_id").isNotNull())
    return ch.groupBy(F.date_trunc("day", "created").cast("timestamp_ntz").alias("day")).agg(
        F.round(F.sum("amount")).cast("bigint").alias("charge_total"),
        F.round(F.sum(F.col("amount") * F.lit(0.5).cast("decimal(2,1)")
                      * F.lit(0.01).cast("decimal(3,2)"))).cast("bigint").alias("fee_total"))
