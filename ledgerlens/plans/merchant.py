"""Merchant x day volume (R2 New York days, R3 UTC days) and merchant x month.

Every measure is first reduced to (day, account[, currency]) by a partial +
final aggregate; only those reduced relations meet in the spine joins.
Payout batches are made distinct on (day, account, payout) BEFORE the
lookup of the payout row, so the big ledger never joins the payout table
row by row (the payout id is unique, so the result is the same).
Local-day filters are converted to UTC instant bounds (DST-aware) and
applied to the raw columns; only the bucketing shifts the zone.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import in_days, local_day, sum_if
from ..operators.calendars import month_bounds, month_range
from ..operators.links import lookup
from ..operators.presence import days_seen, days_unseen
from ..operators.reduction import reduced

NEW_YORK = "America/New_York"


def _major(c) -> F.Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.cast("double") / F.lit(100.0), F.lit(0.0))


def merchant_transfers_daily(t, d0, d1, tz) -> DataFrame:
    """Paid card transfers to merchants per local day."""
    tr = t.transfers.where((F.col("status") == "paid") & (F.col("source_type") == "card")
                           & (F.col("type") == "stripe_account")
                           & in_days("created", d0, d1, tz))
    return tr.groupBy(local_day("created", tz).alias("day"),
                      F.col("destination_id").alias("account")) \
             .agg(F.sum("amount").alias("transfers"))


def merchant_ledger_daily(t, d0, d1, tz) -> DataFrame:
    """Merchant ledger pivot; payout rows bucket on available_on."""
    bt = t.connected_account_balance_transactions
    typ, amt = F.col("type"), F.col("amount")
    not_payout = typ != "payout"
    # each kind's lower bound on its own column: a disjunction that reaches the scan
    lower_ok = ((not_payout & in_days("created", d0, None, tz))
                | (~not_payout & in_days("available_on", d0, None, tz)))
    bt = bt.where(~typ.like("%transfer%") & lower_ok & in_days("created", None, d1, tz))
    activity = F.when(not_payout, local_day("created", tz)).otherwise(local_day("available_on", tz))
    refund = typ.isin("payment_refund", "refund")
    lag = F.datediff(F.to_date("available_on"), F.to_date("created"))
    aggs = [sum_if(typ.isin("payment", "charge"), amt).alias("total_charges"),
            sum_if(refund, amt).alias("refunds")]
    aggs += [sum_if(refund & (lag == i), amt).alias(f"refunds_t{i}") for i in range(6)]
    aggs += [sum_if(typ.isin("payment", "charge"), -F.col("fee")).alias("application_fees"),
             sum_if(typ == "adjustment", amt).alias("adjustments"),
             sum_if(typ == "payout", amt).alias("connect_payouts")]
    return bt.withColumn("day", activity).where(F.col("day").between(F.lit(str(d0)).cast("date"), F.lit(str(d1)).cast("date"))) \
        .groupBy("day", "currency", "account").agg(*aggs)


def merchant_icplus_daily(t, d0, d1, tz) -> DataFrame:
    """Network and processor fees; distinct card-present / not-present charges.

    Fees are first summed per charge, so both distinct counts are plain sums.
    """
    ic = t.icplus_fees.where(in_days("incurred_at", d0, d1, tz))
    cat, cp = F.col("fee_category"), F.col("card_present")
    per_charge = ic.groupBy(local_day("incurred_at", tz).alias("day"), F.col("destination_id").alias("account"), "charge_id").agg(
        sum_if(cat == "network_cost", F.col("billing_amount")).alias("network_costs"),
        sum_if(cat == "stripe_fee", F.col("billing_amount")).alias("stripe_fees"),
        F.max(F.when(cp, 1).otherwise(0)).alias("_present"), F.max(F.when(~cp, 1).otherwise(0)).alias("_absent"))
    a_charge = F.col("charge_id").isNotNull()
    return per_charge.groupBy("day", "account").agg(
        F.sum("network_costs").alias("network_costs"), F.sum("stripe_fees").alias("stripe_fees"),
        F.sum(F.when(a_charge, F.col("_present"))).alias("present_charges"),
        F.sum(F.when(a_charge, F.col("_absent"))).alias("absent_charges"))


def merchant_payout_batches(t, d0, d1, tz) -> DataFrame:
    """R2d: distinct payout batch of each merchant-day's payments."""
    bt = t.connected_account_balance_transactions.where(
        F.col("type").isin("payment", "charge") & in_days("created", d0, d1, tz))
    keys = bt.select(local_day("created", tz).alias("day"), "account",
                     F.col("automatic_transfer_id").alias("payout_id")).distinct()
    po = t.connected_account_transfers.select(
        F.col("id").alias("payout_id"), F.to_date("date").alias("batch_paid_date"),
        F.col("amount").alias("batched_connect_payout"), F.col("status").alias("batch_status"))
    return lookup(keys, po, "payout_id", ["day", "account"])


def merchant_names(t) -> DataFrame:
    """R2e: business name, else url."""
    return t.connected_accounts.select(
        F.col("id").alias("account"),
        F.coalesce("business_name", "business_url").alias("business_name"))


def unlinked_refunds_daily(t, d0, d1, tz) -> DataFrame:
    """R2f: succeeded refunds without a charge, merchant found via the parent transfer."""
    r = t.refunds.where(F.col("charge_id").isNull() & (F.col("status") == "succeeded")
                        & in_days("created", d0, d1, tz))
    md = t.refunds_metadata.where(F.col("key") == "parent_transfer") \
          .select(F.col("refund_id").alias("id"), F.col("value").alias("_tid"))
    cat = t.connected_account_transfers.select(F.col("id").alias("_tid"), "account")
    j = r.join(md, "id", "inner").join(cat, "_tid", "left")
    return j.groupBy(local_day("created", tz).alias("day"), "account") \
            .agg(F.sum("amount").alias("total_unlinked_refunds"))


def account_debits_daily(t, d0, d1, tz, platform_account: str) -> DataFrame:
    """R2g: book transfers that debit merchants for unreferenced refunds."""
    tr = t.connected_account_transfers.where(
        in_days("created", d0, d1, tz) & ~F.col("automatic")
        & (F.col("destination_id") == platform_account) & (F.col("kind") == "book")
        & ~F.col("reversed") & (F.col("source_type") == "card") & (F.col("status") == "paid")
        & (F.col("type") == "stripe_account"))
    md = t.connected_account_transfers_metadata.where(
        (F.col("key") == "transaction_type") & (F.col("value") == "unreferenced-refund")) \
        .select(F.col("transfer_id").alias("id"))
    return tr.join(md, "id", "inner") \
             .groupBy(local_day("created", tz).alias("day"), "account") \
             .agg(F.sum("amount").alias("unlinked_refund_account_debits"))


def merchant_volume_daily(t, d0, d1, platform_account: str | None = None, tz=NEW_YORK, with_unlinked=True,
                          terminal_rate: float = 2.0, radar_rate: float = 1.5) -> DataFrame:
    """R2 (tz=New York, with unlinked refunds) / R3 (tz=None, without).

    Measures of a merchant-day are gathered in one union and aggregation and
    joined to the ledger rows once. Days without a ledger row appear once with
    nulls; they are read off the ledger's aggregation inside the plan, so
    nothing is joined on the day alone. The rates are minor units per card-present and per other
    charge.
    """
    ledger = merchant_ledger_daily(t, d0, d1, tz)
    parts = [merchant_transfers_daily(t, d0, d1, tz), merchant_icplus_daily(t, d0, d1, tz)]
    if with_unlinked:
        parts += [unlinked_refunds_daily(t, d0, d1, tz), account_debits_daily(t, d0, d1, tz, platform_account)]
    names = [c for p in parts for c in p.columns if c not in ("day", "account")]
    rows = functools.reduce(DataFrame.unionByName, [
        p.select("day", "account", *[(F.col(c) if c in p.columns else F.lit(None)).cast("decimal(38,8)").alias(c) for c in names])
        for p in parts])
    extra = rows.groupBy("day", "account").agg(*[F.sum(c).alias(c) for c in names])
    bare = days_unseen(t.spark, days_seen(ledger, d0, d1), d0, d1)
    spine = ledger.unionByName(bare, allowMissingColumns=True)
    out = (spine.join(extra, ["day", "account"], "left")
           .join(merchant_payout_batches(t, d0, d1, tz), ["day", "account"], "left")
           .join(merchant_names(t), "account", "left"))
    out = out.withColumn("stripe_terminal_fees", F.col("present_charges").cast("double") * F.lit(terminal_rate)) \
             .withColumn("stripe_radar_fees", F.col("absent_charges").cast("double") * F.lit(radar_rate))
    cols = [F.col("day").alias("activity_date"), F.col("account").alias("destination_id"),
            "business_name", "currency"]
    cols += [_major(c).alias(c) for c in
             ("transfers", "total_charges", "refunds", "application_fees", "network_costs",
              "stripe_fees", "stripe_terminal_fees", "stripe_radar_fees", "adjustments")]
    cols += [_major("connect_payouts").alias("connect_payouts_paid"),
             _major("batched_connect_payout").alias("batched_connect_payout"),
             "batch_paid_date", "batch_status"]
    cols += [_major(f"refunds_t{i}").alias(f"refunds_t{i}") for i in range(6)]
    if with_unlinked:
        cols += [_major("total_unlinked_refunds").alias("platform_unlinked_refunds"),
                 _major("unlinked_refund_account_debits").alias("unlinked_refund_account_debits")]
    return out.select(*cols).orderBy(F.col("destination_id").asc_nulls_last(), "activity_date")


# --------------------------------------------------------------------------- R4
def merchant_monthly(t, m0: str, m1: str, radar_rate: float = 1.5, lpm_since=None) -> DataFrame:
    """Merchant x month volume by payment method, fees and platform earnings.

    Month membership (a semi join against the month list in the source) is
    applied as a literal half-open instant range, which reaches the scan.
    """
    lo, hi = month_bounds(m0, m1)
    months = month_range(t.spark, m0, m1).select(F.date_format("month", "yyyy-MM").alias("month"))
    in_months = lambda c: (F.col(c) >= F.lit(lo).cast("timestamp_ntz")) & \
        (F.col(c) < F.lit(hi).cast("timestamp_ntz"))
    ym = lambda c: F.date_format(c, "yyyy-MM")

    ic = t.icplus_fees.where(in_months("incurred_at"))
    cat = F.col("fee_category")
    # fees are summed per charge first, so the distinct count is a sum
    per_charge = ic.groupBy(F.col("destination_id").alias("account"), ym("incurred_at").alias("month"), "charge_id").agg(
        sum_if(cat == "network_cost", F.col("billing_amount")).alias("network_costs"),
        sum_if(cat == "stripe_fee", F.col("billing_amount")).alias("stripe_fees"),
        F.max(F.when(~F.col("card_present"), 1).otherwise(0)).alias("_absent"))
    card = per_charge.groupBy("account", "month").agg(
        F.sum("network_costs").alias("network_costs"), F.sum("stripe_fees").alias("stripe_fees"),
        (F.sum(F.when(F.col("charge_id").isNotNull(), F.col("_absent")).otherwise(0)) * F.lit(radar_rate)).alias("stripe_radar_fees"))
    since = lpm_since or lo
    ch = t.charges.where(~F.col("payment_method_type").isin("card")
                         & (F.col("created") > F.lit(since).cast("timestamp_ntz"))
                         & in_months("created"))
    # ledger and fee details are cut down to the charges of the months before they are shuffled
    bt = reduced(t.balance_transactions, "id", ch, "balance_transaction_id").select(F.col("id").alias("balance_transaction_id"), "fee")
    lpm = lookup(ch, bt, "balance_transaction_id", ["id"]) \
        .groupBy(F.col("destination_id").alias("account"), ym("created").alias("month")) \
        .agg(F.lit(0).alias("network_costs"), F.sum("fee").alias("stripe_fees"),
             F.lit(0).alias("stripe_radar_fees"))
    fees = card.unionByName(lpm).groupBy("account", "month").agg(
        F.sum("network_costs").alias("network_costs"), F.sum("stripe_fees").alias("stripe_fees"),
        F.sum("stripe_radar_fees").alias("stripe_radar_fees"))

    cac = t.connected_account_charges.where(in_months("created") & F.col("captured"))
    det = reduced(t.connected_account_balance_transaction_fee_details, "balance_transaction_id", cac, "balance_transaction_id").select(
        "balance_transaction_id", F.col("amount").alias("_fee"))
    earned = lookup(cac, det, "balance_transaction_id", ["id"]) \
        .groupBy("account", ym("created").alias("month"), "currency") \
        .agg(F.sum(F.coalesce("_fee", F.lit(0))).alias("application_fees"))

    gch = t.charges.where(in_months("created") & F.col("captured"))
    pm, amt = F.col("payment_method_type"), F.col("amount")
    methods = ("card", "bancontact", "ideal")
    gmv = gch.groupBy(F.col("destination_id").alias("account"), ym("created").alias("month"), "currency").agg(
        F.sum(amt).alias("volume"), F.count("id").alias("txns"),
        *[sum_if(pm == m, amt).alias(f"{m}_volume") for m in methods], *[sum_if(pm == m, 1).alias(f"{m}_txns") for m in methods])

    names = t.connected_accounts.select(F.col("id").alias("account"), "business_name")
    out = (gmv.join(F.broadcast(months), "month", "inner")
           .join(fees, ["account", "month"], "inner")
           .join(names, "account", "left")
           .join(earned, ["account", "month", "currency"], "left"))

    def maj(c):
        return F.col(c).cast("double") / F.lit(100.0)

    def cents3(c):
        return F.round(F.coalesce(F.col(c), F.lit(0)).cast("decimal(38,4)") / F.lit(100), 3) \
            .cast("decimal(38,3)").cast("double")
    return out.select(
        "account", "month", "currency", "business_name",
        maj("volume").alias("total_volume"), *[maj(f"{m}_volume").alias(f"{m}_volume") for m in methods],
        F.col("txns").alias("total_num_txns"), *[F.col(f"{m}_txns").cast("bigint").alias(f"{m}_num_txns") for m in methods],
        maj("application_fees").alias("platform_application_fees"),
        cents3("network_costs").alias("icplus_fees"), cents3("stripe_fees").alias("stripe_fees"),
        (F.coalesce(F.col("stripe_radar_fees"), F.lit(0)).cast("double") / F.lit(100.0))
        .alias("radar_fees")).orderBy("account", "month")
