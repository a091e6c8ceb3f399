"""Daily platform and per-merchant reports.

Shape of every report here: each measure is reduced to the report grain
(day, or day x account) by a partial+final hash aggregate, so the later
joins see at most days x accounts rows; the calendar spine is generated
from literals and the joins against it are broadcast-sized on both sides.
Date filters are literal half-open ranges on the raw instant column.

Per-merchant chains join every measure on (day, account). The source
reports join some merchant measures on the day alone, which repeats each
merchant's row once per other merchant active that day (all pairs within
a day); that fan-out is not reproduced (see README, D4).
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import count_if, distinct_counts, in_days, local_day, sum_if, zero_major
from ..operators.calendars import calendar_days, gate_joined
from ..operators.attribution import attributed_daily
from ..operators.links import lookup
from ..operators.presence import days_seen, days_unseen
from ..operators.reduction import reduced

CHARGE_TYPES = ("payment", "charge")
REFUND_TYPES = ("payment_refund", "refund")


def _not_transfer_or_payout(bt: DataFrame) -> DataFrame:
    return bt.where(~F.col("type").like("%transfer%") & (F.col("type") != "payout"))


def _zero_fill(cols, counts=()):
    out = [zero_major(c).alias(c) for c in cols]
    out += [F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in counts]
    return out


# --------------------------------------------------------------------------- R10 / R11
def _failure_aggs():
    typ, amt = F.col("type"), F.col("amount")
    tf, pf = typ == "transfer_failure", typ == "payout_failure"
    return [
        sum_if(tf & (amt > 0), amt).alias("transfer_credit_failures"),
        sum_if(tf & (amt < 0), amt).alias("transfer_debit_failures"),
        sum_if(pf & (amt > 0), amt).alias("payout_credit_failures"),
        sum_if(pf & (amt < 0), amt).alias("payout_debit_failures"),
        sum_if(tf & (amt > 0), 1).alias("transfer_credit_failure_count"),
        sum_if(tf & (amt < 0), 1).alias("transfer_debit_failure_count"),
        sum_if(pf & (amt > 0), 1).alias("payout_credit_failure_count"),
        sum_if(pf & (amt < 0), 1).alias("payout_debit_failure_count"),
    ]


_FAIL_AMT = ["transfer_credit_failures", "transfer_debit_failures", "payout_credit_failures",
             "payout_debit_failures"]
_FAIL_CNT = ["transfer_credit_failure_count", "transfer_debit_failure_count",
             "payout_credit_failure_count", "payout_debit_failure_count"]


def failed_transfers_daily(t, d0, d1) -> DataFrame:
    """Platform-wide transfer and payout failures per day, zero-filled.

    The measure groups every ledger row of the range by day (zero sums on
    days without failures), so its first day is the first-activity gate.
    """
    bt = t.connected_account_balance_transactions.where(in_days("created", d0, d1))
    m = bt.groupBy(local_day("created").alias("day")).agg(
        *_failure_aggs(), F.lit(1).alias("_hit"))
    out = gate_joined(calendar_days(t.spark, d0, d1).join(m, "day", "left"), "_hit")
    return (out.select("day", *_zero_fill(_FAIL_AMT, _FAIL_CNT))
            .orderBy(F.col("day").desc()))


def merchant_days(t, d0, d1, sources, measures, gate) -> DataFrame:
    """Per-merchant report rows: day, account and the sums of `measures`.

    `sources` is a list of (rows, keyed): rows with day, account and some of
    the measures; keyed rows make their (day, account) a report row. All
    sources go through one union and one aggregation, so no measure is joined
    to another and none to the calendar. Days without a row appear once with a
    null account. The days that have rows, and the first day of `gate` (P18,
    one of the keyed sources), are read off that aggregation inside the plan. A
    null account has no measures, as it equals no other.
    """
    value = lambda rows, m: F.when(F.col("account").isNotNull(), F.col(m)) if m in rows.columns else F.lit(None)
    # 2 for a row of the gate, 1 for another that makes a report row, 0 for others
    rel = functools.reduce(DataFrame.unionByName, [
        rows.select("day", "account", *[value(rows, m).cast("bigint").alias(m) for m in measures], F.lit(2 if rows is gate else int(keyed)).alias("_mark"))
        for rows, keyed in sources])
    # `_day` is an aggregate, so a bound on it stays above the shuffle that the subquery shares
    grouped = rel.groupBy("day", "account").agg(*[F.sum(m).alias(m) for m in measures], F.max("_mark").alias("_mark"), F.max("day").alias("_day"))
    seen = days_seen(grouped, d0, d1, F.col("_mark") > 0, F.col("_mark") == 2)
    first = seen.getField("first")
    out = grouped.where((F.col("_mark") > 0) & (F.col("_day") >= first)).drop("_mark", "_day")
    bare = days_unseen(t.spark, seen, d0, d1).where(F.col("day") >= first)
    return out.unionByName(bare.select("day", F.lit(None).cast("string").alias("account"),
                                       *[F.lit(None).cast("bigint").alias(m) for m in measures]))


def failed_transfers_merchant_daily(t, d0, d1) -> DataFrame:
    """The same per merchant, only merchant-days that had a failure."""
    typ, amt = F.col("type"), F.col("amount")
    rows = t.connected_account_balance_transactions.where(
        in_days("created", d0, d1) & typ.isin("transfer_failure", "payout_failure"))
    picks = []
    for kind in ("transfer", "payout"):
        for sign, cond in (("credit", amt > 0), ("debit", amt < 0)):
            hit = (typ == f"{kind}_failure") & cond
            picks += [F.when(hit, amt).alias(f"{kind}_{sign}_failures"),
                      F.when(hit, 1).alias(f"{kind}_{sign}_failure_count")]
    rows = rows.select(local_day("created").alias("day"), "account", *picks)
    out = merchant_days(t, d0, d1, [(rows, True)], _FAIL_AMT + _FAIL_CNT, rows)
    return (out.select("day", "account", *_zero_fill(_FAIL_AMT, _FAIL_CNT))
            .orderBy(F.col("day").desc(), F.col("account").asc_nulls_last()))


# --------------------------------------------------------------------------- R8 / R9
def fee_daily(t, d0, d1) -> DataFrame:
    """Platform daily volume, refunds, application fees and their refunds."""
    bt = _not_transfer_or_payout(t.balance_transactions.where(in_days("created", d0, d1)))
    typ, amt = F.col("type"), F.col("amount")
    m = bt.groupBy(local_day("created").alias("day")).agg(
        sum_if(typ.isin(*CHARGE_TYPES), amt).alias("captured_authorizations"),
        sum_if(typ.isin(*REFUND_TYPES), amt).alias("refunds"),
        sum_if(typ == "application_fee", amt).alias("application_fees"),
        sum_if(typ == "application_fee_refund", amt).alias("application_fee_refunds"),
        count_if(typ.isin(*CHARGE_TYPES)).alias("captured_authorizations_count"),
        count_if(typ.isin(*REFUND_TYPES)).alias("refund_count"),
        count_if(typ == "application_fee").alias("application_fee_count"),
        count_if(typ == "application_fee_refund").alias("application_fee_refund_count"),
        F.lit(1).alias("_hit"))
    out = gate_joined(calendar_days(t.spark, d0, d1).join(m, "day", "left"), "_hit")
    return (out
            .select("day", *_zero_fill(
                ["captured_authorizations", "refunds", "application_fees",
                 "application_fee_refunds"],
                ["captured_authorizations_count", "refund_count", "application_fee_count",
                 "application_fee_refund_count"]))
            .orderBy(F.col("day").desc()))


def _merchant_ledger_rows(t, d0, d1) -> DataFrame:
    """Merchant ledger rows with their volume and refund measures."""
    typ, amt = F.col("type"), F.col("amount")
    charge, refund = typ.isin(*CHARGE_TYPES), typ.isin(*REFUND_TYPES)
    return _not_transfer_or_payout(
        t.connected_account_balance_transactions.where(in_days("created", d0, d1))).select(
        local_day("created").alias("day"), "account",
        F.when(charge, amt).alias("captured_authorizations"), F.when(refund, amt).alias("refunds"),
        F.when(charge, 1).alias("captured_authorizations_count"), F.when(refund, 1).alias("refund_count"))


def fee_merchant_daily(t, d0, d1) -> DataFrame:
    """Per merchant-day volume, refunds, application fees and fee refunds."""
    ledger = _merchant_ledger_rows(t, d0, d1)
    af = t.application_fees
    fees = af.where(in_days("created", d0, d1)).select(
        local_day("created").alias("day"), F.col("account_id").alias("account"),
        F.col("amount").alias("application_fees"), F.lit(1).alias("application_fee_count"))
    refunds = (t.application_fee_refunds.where(in_days("created", d0, d1))
               .join(af.select(F.col("id").alias("fee_id"), "account_id"), "fee_id", "inner")
               .select(local_day("created").alias("day"), F.col("account_id").alias("account"),
                       F.col("amount").alias("application_fee_refunds"), F.lit(1).alias("application_fee_refund_count")))
    amounts = ["captured_authorizations", "refunds", "application_fees", "application_fee_refunds"]
    counts = ["captured_authorizations_count", "refund_count", "application_fee_count",
              "application_fee_refund_count"]
    out = merchant_days(t, d0, d1, [(ledger, True), (fees, True), (refunds, True)], amounts + counts, ledger)
    return (out.select("day", "account", *_zero_fill(amounts, counts))
            .orderBy(F.col("day").desc(), F.col("account").asc_nulls_last()))


# --------------------------------------------------------------------------- R6 / R7
def _withdrawal():
    return (F.col("type") == "adjustment") & F.lower("description").like("chargeback withdrawal%")


def _reversal():
    return (F.col("type") == "adjustment") & F.lower("description").like("chargeback reversal%")


def declines_daily(t, d0, d1, by_account: bool = False) -> DataFrame:
    """Issuer-declined charges per day (and merchant)."""
    ch = t.charges.where((F.col("outcome_type") == "issuer_declined") & in_days("created", d0, d1))
    keys = [local_day("created").alias("day")]
    if by_account:
        keys.append(F.col("destination_id").alias("account"))
    return ch.groupBy(*keys).agg(F.sum("amount").alias("declines"),
                                 F.count("id").alias("decline_count"))


def connect_payouts_daily(t, d0, d1, by_account=False, end_inclusive=False,
                          types=("bank_account", "card")) -> DataFrame:
    """R5g / R6 / R7d: paid merchant payouts per arrival day."""
    tr = t.connected_account_transfers
    cond = (F.col("status") == "paid") & in_days("date", d0, d1, end_inclusive=end_inclusive)
    if types:
        cond = cond & F.col("type").isin(*types)
    keys = [local_day("date").alias("day")] + (["account"] if by_account else [])
    return tr.where(cond).groupBy(*keys).agg(F.sum("amount").alias("connect_payouts"),
                                             F.count("id").alias("connect_payout_count"))


def _dispute_counts(t, d0, d1) -> DataFrame:
    """Distinct disputes per day, from the adjustment rows alone."""
    bt = t.balance_transactions.where(in_days("created", d0, d1) & (_withdrawal() | _reversal()))
    return distinct_counts(bt, [local_day("created").alias("day")], "source_id", dispute_count=_withdrawal(), disputes_won_count=_reversal())


def volume_daily(t, d0, d1) -> DataFrame:
    """Platform volume, declines, disputes and payouts per day."""
    bt = _not_transfer_or_payout(t.balance_transactions.where(in_days("created", d0, d1)))
    typ, amt = F.col("type"), F.col("amount")
    dbt = bt.groupBy(local_day("created").alias("day")).agg(
        sum_if(typ.isin(*CHARGE_TYPES), amt).alias("captured_authorizations"),
        sum_if(typ.isin(*REFUND_TYPES), amt).alias("refunds"),
        sum_if(_withdrawal(), amt).alias("disputes"),
        sum_if(_reversal(), amt).alias("disputes_won"),
        count_if(typ.isin(*CHARGE_TYPES)).alias("captured_authorizations_count"),
        count_if(typ.isin(*REFUND_TYPES)).alias("refund_count"),
        F.lit(1).alias("_hit"))
    tr = t.transfers
    platform = (tr.where((F.col("status") == "paid") & (F.col("type") == "bank_account")
                         & in_days("created", d0, d1))
                .groupBy(local_day("date").alias("day"))
                .agg(F.sum("amount").alias("platform_payouts"),
                     F.count("id").alias("platform_payout_count")))
    cal = calendar_days(t.spark, d0, d1)
    out = gate_joined(cal.join(dbt, "day", "left"), "_hit")
    out = (out.join(_dispute_counts(t, d0, d1), "day", "left").join(declines_daily(t, d0, d1), "day", "left")
           .join(platform, "day", "left")
           .join(connect_payouts_daily(t, d0, d1, end_inclusive=False), "day", "left"))
    return (out.select("day", *_zero_fill(
        ["captured_authorizations", "refunds", "declines", "disputes", "disputes_won",
         "platform_payouts", "connect_payouts"],
        ["captured_authorizations_count", "refund_count", "decline_count", "dispute_count",
         "disputes_won_count", "platform_payout_count", "connect_payout_count"]))
        .orderBy(F.col("day").desc()))


def disputes_merchant_daily(t, d0, d1) -> DataFrame:
    """Platform dispute adjustments resolved to the merchant of the charge.

    Grain is day x source x charge x merchant, as in the source report.
    """
    bt = t.balance_transactions.where((F.col("type") == "adjustment") & in_days("created", d0, d1))
    # adjustments are few: disputes and charges are cut down to theirs before they are shuffled
    d = reduced(t.disputes, "id", bt, "source_id").select(F.col("id").alias("source_id"), "charge_id")
    ch = reduced(t.charges, "id", d, "charge_id").select(F.col("id").alias("charge_id"), F.col("destination_id").alias("account"))
    j = lookup(lookup(bt, d, "source_id", ["id"]), ch, "charge_id", ["id"])
    amt = F.col("amount")
    return j.groupBy(local_day("created").alias("day"), "source_id", "charge_id", "account").agg(
        sum_if(_withdrawal(), amt).alias("disputes"),
        sum_if(_reversal(), amt).alias("disputes_won"),
        # one dispute per group, so its distinct count is 1 or 0
        F.max(F.when(_withdrawal() & F.col("source_id").isNotNull(), 1).otherwise(0)).alias("dispute_count"),
        F.max(F.when(_reversal() & F.col("source_id").isNotNull(), 1).otherwise(0)).alias("disputes_won_count"))


def volume_merchant_daily(t, d0, d1) -> DataFrame:
    """Per merchant-day volume, declines, disputes and paid payouts."""
    ledger = _merchant_ledger_rows(t, d0, d1)
    payouts = t.connected_account_transfers.where((F.col("status") == "paid") & in_days("date", d0, d1)).select(
        local_day("date").alias("day"), "account", F.col("amount").alias("connect_payouts"),
        F.lit(1).alias("connect_payout_count"))
    declines = t.charges.where((F.col("outcome_type") == "issuer_declined") & in_days("created", d0, d1)).select(
        local_day("created").alias("day"), F.col("destination_id").alias("account"),
        F.col("amount").alias("declines"), F.lit(1).alias("decline_count"))
    measures = ["captured_authorizations", "refunds", "declines", "connect_payouts",
                "captured_authorizations_count", "refund_count", "decline_count", "connect_payout_count"]
    out = merchant_days(t, d0, d1, [(ledger, True), (payouts, True), (declines, False)], measures, ledger)
    # disputes have a finer grain and repeat the row
    out = out.join(disputes_merchant_daily(t, d0, d1).drop("source_id", "charge_id"), ["day", "account"], "left")
    return (out.select("day", "account", *_zero_fill(
        ["captured_authorizations", "refunds", "declines", "disputes", "disputes_won",
         "connect_payouts"],
        ["captured_authorizations_count", "refund_count", "decline_count", "dispute_count",
         "disputes_won_count", "connect_payout_count"]))
        .orderBy(F.col("day").desc()))


# --------------------------------------------------------------------------- R5
def platform_daily(t, d0, d1) -> DataFrame:
    """Platform day: accounts, volume, cash and accrued fees, payouts."""
    spark = t.spark
    ch = t.charges.where(in_days("created", d0, d1))
    accounts = ch.groupBy(local_day("created").alias("day")).agg(
        F.count_distinct("destination_id").alias("count_accounts"))
    bt = _not_transfer_or_payout(t.balance_transactions.where(in_days("created", d0, d1)))
    typ, amt, fee = F.col("type"), F.col("amount"), F.col("fee")
    desc = F.lower("description")
    monthly = desc.like("sigma%") | desc.like("%active reader fee") | desc.like("connect%")
    dbt = bt.groupBy(local_day("created").alias("day")).agg(
        sum_if(typ.isin(*CHARGE_TYPES), amt).alias("captured_authorizations"),
        sum_if(typ.isin(*REFUND_TYPES), amt).alias("refunds"),
        sum_if(_withdrawal(), amt).alias("disputes"),
        sum_if(_reversal(), amt).alias("disputes_won"),
        sum_if((typ == "adjustment") & desc.like("chargeback%"), fee).alias("stripe_dispute_fees"),
        sum_if(typ.isin("application_fee", "application_fee_refund"), amt).alias("platform_fees"),
        sum_if(typ == "network_cost", -amt).alias("interchange_cash"),
        sum_if((typ == "stripe_fee") & desc.like("card payments%"), -amt)
        .alias("stripe_icplus_fees_cash"),
        sum_if((typ == "stripe_fee") & ~desc.like("card payments%") & ~desc.like("sigma%")
               & ~desc.like("%active reader fee") & ~desc.like("connect%"), -amt)
        .alias("stripe_other_fees_daily_cash"),
        sum_if((typ == "stripe_fee") & monthly, -amt).alias("stripe_other_fees_monthly_cash"),
        count_if(typ.isin(*CHARGE_TYPES)).alias("captured_authorizations_count"),
        count_if(typ.isin(*REFUND_TYPES)).alias("refund_count"),
        F.lit(1).alias("_hit"))
    platform = (t.transfers.where(F.col("status").isin("paid", "in_transit", "pending")
                                  & (F.col("type") == "bank_account")
                                  & in_days("created", d0, d1))
                .groupBy(local_day("date").alias("day"), "status")
                .agg(F.sum("amount").alias("platform_payouts"),
                     F.count("id").alias("platform_payout_count")))
    ic = t.icplus_fees
    cat = F.col("fee_category")
    incurred = (ic.where(in_days("incurred_at", d0, d1) & F.col("attribution_start_time").isNull()
                         & F.col("attribution_end_time").isNull())
                .groupBy(local_day("incurred_at").alias("day"))
                .agg(sum_if(cat == "network_cost", F.col("billing_amount"))
                     .alias("daily_interchange"),
                     sum_if(cat == "stripe_fee", F.col("billing_amount"))
                     .alias("daily_stripe_icplus_fees")))
    attributed = attributed_daily(ic, d0, d1)
    cal = gate_joined(calendar_days(spark, d0, d1).join(dbt, "day", "left"), "_hit")
    out = (cal.join(accounts, "day", "left").join(_dispute_counts(t, d0, d1), "day", "left")
           .join(declines_daily(t, d0, d1), "day", "left").join(platform, "day", "left")
           .join(incurred, "day", "left").join(attributed, "day", "left")
           .join(connect_payouts_daily(t, d0, d1, end_inclusive=False), "day", "left"))

    def dec(c):
        return F.coalesce(F.col(c).cast("double") / F.lit(100.0), F.lit(0.0)).alias
    return (out.select(
        "day", F.coalesce("count_accounts", F.lit(0)).alias("connect_accounts"),
        *_zero_fill(["captured_authorizations", "refunds", "declines", "disputes", "disputes_won",
                     "stripe_dispute_fees", "platform_fees", "platform_payouts"]),
        F.col("status").alias("platform_payout_status"),
        dec("daily_interchange")("interchange_rec"),
        # shares are non-terminating divisions: stated output precision 1e-6
        F.coalesce(F.round(F.col("attr_interchange") / F.lit(100), 6).cast("double"),
                   F.lit(0.0)).alias("attr_interchange_rec"),
        dec("daily_stripe_icplus_fees")("stripe_icplus_fees_rec"),
        *_zero_fill(["interchange_cash", "stripe_icplus_fees_cash", "stripe_other_fees_daily_cash",
                     "stripe_other_fees_monthly_cash", "connect_payouts"],
                    ["captured_authorizations_count", "refund_count", "decline_count",
                     "dispute_count", "disputes_won_count", "platform_payout_count",
                     "connect_payout_count"]))
        .orderBy(F.col("day").desc()))
