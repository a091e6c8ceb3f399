"""Accrual line items - one row per gross, fee or tax component of every
ledger activity in a window.

Plan shape
----------
* Charges that the window's activity names are given their customer and invoice
  first, never all charges: those are narrow rows, the activity is not.
* Non-fee ledger rows (prefiltered on `created`) resolve their polymorphic
  `source_id` against charges, refunds, disputes and platform transfers with
  left joins on the same key, so the ledger is shuffled once for all four;
  refunds and disputes bring their charge along.
* Fee rows parse their service period from the description text.
* Rows without a charge id or source join on a key of their own instead of
  null, so they spread over all reducers. Ledger and payout rows that many
  lines point to are repeated and the lines dealt over the copies.
* Each activity row has its gross and fee lines (likewise the fee and tax lines
  of each itemised fee) side by side in one row, with the payout's dates, and
  moves once more: by ranges of the report's order. Equal lines meet there, so
  the lines are split, made distinct and sorted in place. Lines of a ledger row
  that very many itemised fees belong to are split before and dealt by component.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import decimalize, ts_lit
from ..functions.descriptions import has_period, is_icplus, period_end, period_start
from ..operators.links import heavy_keys, lookup
from ..operators.reduction import reduced

# Fixed value: fee rows before this instant carry no parseable period.
PERIOD_TEXT_SINCE = "2018-04-01"

LINE_COLS = [
    "balance_transaction_id", "balance_transaction_created_at",
    "balance_transaction_reporting_category", "balance_transaction_component", "activity_at",
    "currency", "amount", "charge_id", "refund_id", "dispute_id", "invoice_id", "subscription_id",
    "fee_id", "destination_id", "customer_id", "customer_email", "customer_description",
    "automatic_payout_id", "customer_facing_currency", "customer_facing_amount", "event_type",
    "card_brand", "card_funding", "card_country", "activity_interval_type",
    "activity_start_time", "activity_end_time", "balance_transaction_description",
]


def month_window(load_time) -> tuple[dt.datetime, dt.datetime]:
    """The calendar month before `load_time`, half-open."""
    lt = load_time if isinstance(load_time, dt.datetime) else dt.datetime.fromisoformat(str(load_time))
    hi = dt.datetime(lt.year, lt.month, 1)
    lo = dt.datetime(hi.year - (hi.month == 1), (hi.month - 2) % 12 + 1, 1)
    return lo, hi


#: What a charge adds to its lines.
CONTEXT = ["_ch_dest", "_ch_customer", "_ch_currency", "_ch_amount", "invoice_id", "card_brand", "card_funding", "card_country",
           "customer_email", "customer_description", "subscription_id"]


def _charge_context(t, ids: DataFrame) -> DataFrame:
    """(charge_id, _context): charge, customer and invoice of the charges in `ids`."""
    ch = t.charges.select(F.col("id").alias("charge_id"), F.col("destination_id").alias("_ch_dest"),
                          F.col("customer_id").alias("_ch_customer"),
                          F.col("currency").alias("_ch_currency"),
                          F.col("amount").alias("_ch_amount"), "invoice_id", "card_brand",
                          "card_funding", "card_country")
    cu = t.customers.select(F.col("id").alias("_ch_customer"),
                            F.col("email").alias("customer_email"),
                            F.col("description").alias("customer_description"))
    inv = t.invoices.select(F.col("id").alias("invoice_id"), "subscription_id")
    ch = ch.join(ids.where(F.col("charge_id").isNotNull()).distinct(), "charge_id", "left_semi")
    ch = lookup(lookup(ch, cu, "_ch_customer", ["charge_id"]), inv, "invoice_id", ["charge_id"])
    return ch.select("charge_id", F.struct(*CONTEXT).alias("_context"))


def _window_ledger(t, lo, hi, currency) -> DataFrame:
    """Non-fee ledger rows of the window."""
    cur = (F.col("currency") == currency) if currency is not None else F.lit(True)
    return t.balance_transactions.where(
        ~F.col("reporting_category").isin("payout", "connect_reserved_funds", "fee", "network_cost")
        & (F.col("created") >= ts_lit(lo)) & (F.col("created") < ts_lit(hi)) & cur)


def _activity(t, lo, hi, currency, period_since, fee_charges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Activity rows of the window, and the context of their charges and of `fee_charges`."""
    bts = t.balance_transactions
    rc = F.col("reporting_category")
    cur = (F.col("currency") == currency) if currency is not None else F.lit(True)
    base = _window_ledger(t, lo, hi, currency)
    re = reduced(t.refunds, "id", base, "source_id").select(
        F.col("id").alias("_src"), F.col("id").alias("refund_id"), "charge_id",
        F.col("currency").alias("_re_currency"), (-F.col("amount")).alias("_re_amount"))
    dp = reduced(t.disputes, "id", base, "source_id").select(
        F.col("id").alias("_src"), F.col("id").alias("dispute_id"), "charge_id")
    tr = t.transfers.where(F.col("type") == "stripe_account") \
        .select(F.col("id").alias("_src"), F.col("destination_id").alias("_tr_dest"))
    ids = base.where(rc == "charge").select(F.col("source_id").alias("charge_id"))
    context = _charge_context(t, fee_charges.unionByName(ids).unionByName(re.select("charge_id")).unionByName(dp.select("charge_id")))
    re = lookup(re, context, "charge_id", ["refund_id"]).withColumnsRenamed({"charge_id": "_re_charge", "_context": "_re_context"})
    dp = lookup(dp, context, "charge_id", ["dispute_id"]).withColumnsRenamed({"charge_id": "_dp_charge", "_context": "_dp_context"})
    own = context.select(F.col("charge_id").alias("_src"), F.col("_context").alias("_own_context"))
    nf = base.withColumn("_src", F.coalesce("source_id", F.concat(F.lit("\u0001"), F.xxhash64("id").cast("string"))))
    for dim in (re, dp, tr, own):
        nf = nf.join(dim, "_src", "left")
    nf = nf.withColumn("_context", F.when(rc == "charge", F.col("_own_context")).when(F.col("_re_charge").isNotNull(), F.col("_re_context"))
                       .otherwise(F.col("_dp_context")))
    none_ts = F.lit(None).cast("timestamp_ntz")
    non_fee = nf.select(
        F.col("id").alias("balance_transaction_id"), F.col("created").alias("bt_created"),
        rc.alias("rc"), "currency", F.col("amount").alias("gross"), "fee",
        F.col("_re_currency").alias("cf_currency"), F.col("_re_amount").alias("cf_amount"),
        "refund_id", "dispute_id", F.lit(None).cast("string").alias("fee_id"),
        F.col("_tr_dest").alias("dest_from_transfer"),
        F.col("automatic_transfer_id").alias("automatic_payout_id"),
        F.when(rc == "charge", F.col("source_id"))
        .otherwise(F.coalesce("_re_charge", "_dp_charge")).alias("charge_id"),
        F.when(rc.isin("charge", "partial_capture_reversal"), F.lit("charge_captured"))
        .otherwise(rc).alias("event_type"),
        none_ts.alias("start_time"), none_ts.alias("end_time"),
        F.col("description").alias("bt_description"), "_context.*")

    fees = bts.where((rc == "fee") & cur & ~is_icplus("description"))
    parsed = (rc == "fee") & (F.col("created") >= ts_lit(period_since)) & has_period("description")
    none_s = F.lit(None).cast("string")
    fee = fees.select(
        F.col("id").alias("balance_transaction_id"), F.col("created").alias("bt_created"),
        rc.alias("rc"), "currency", F.col("amount").alias("gross"), "fee",
        none_s.alias("cf_currency"), F.lit(None).cast("bigint").alias("cf_amount"),
        none_s.alias("refund_id"), none_s.alias("dispute_id"), none_s.alias("fee_id"),
        none_s.alias("dest_from_transfer"),
        F.col("automatic_transfer_id").alias("automatic_payout_id"), none_s.alias("charge_id"),
        rc.alias("event_type"),
        F.when(parsed, period_start("description")).alias("start_time"),
        F.when(parsed, period_end("description") + F.expr("interval 1 day")).alias("end_time"),
        F.col("description").alias("bt_description"))

    act = non_fee.unionByName(fee, allowMissingColumns=True)
    activity_at = F.coalesce(F.col("end_time") - F.expr("interval 1 second"), F.col("bt_created"))
    act = act.withColumn("activity_at", activity_at) \
             .where((F.col("activity_at") >= ts_lit(lo)) & (F.col("activity_at") < ts_lit(hi)))
    rcc = F.col("rc")
    act = act.select(
        "*",
        F.coalesce("_ch_dest", "dest_from_transfer").alias("destination_id"),
        F.col("_ch_customer").alias("customer_id"),
        F.when(rcc.isin("refund", "charge_failure"), F.col("cf_currency"))
        .when(rcc == "charge", F.col("_ch_currency")).alias("customer_facing_currency"),
        F.when(rcc.isin("refund", "charge_failure"), F.col("cf_amount"))
        .when(rcc == "charge", F.col("_ch_amount")).alias("customer_facing_amount"),
        F.when(F.col("end_time").isNotNull(), F.lit("range")).otherwise(F.lit("instant"))
        .alias("activity_interval_type"))
    return act, context


#: Both lines of a row side by side: which it has (1, 2 or 3 for both), what they share, what each has.
PAIR_COLS = ["_has", *[c for c in LINE_COLS if c not in ("balance_transaction_component", "amount")],
             "_component_1", "_component_2", "_amount_1", "_amount_2", "_effective"]


def _pairs(rows: DataFrame, fields: dict, components, amounts, exists) -> DataFrame:
    """PAIR_COLS of the rows that have a line."""
    has = sum((F.when(on, F.lit(k)).otherwise(F.lit(0)) for k, on in enumerate(exists, 1)), F.lit(0))
    fields = fields | {"_has": has, "_effective": F.col("_effective")} \
        | {f"_component_{k}": c for k, c in enumerate(components, 1)} \
        | {f"_amount_{k}": a.cast("decimal(38,12)") for k, a in enumerate(amounts, 1)}
    return rows.select(*[fields[c].alias(c) for c in PAIR_COLS]).where(F.col("_has") != 0)


def _ledger_lines(act: DataFrame) -> DataFrame:
    rc = F.col("rc")
    common = {
        "balance_transaction_id": F.col("balance_transaction_id"),
        "balance_transaction_created_at": F.col("bt_created"),
        "balance_transaction_reporting_category": rc, "activity_at": F.col("activity_at"),
        "currency": F.col("currency"), "charge_id": F.col("charge_id"),
        "refund_id": F.col("refund_id"), "dispute_id": F.col("dispute_id"),
        "invoice_id": F.col("invoice_id"), "subscription_id": F.col("subscription_id"),
        "fee_id": F.col("fee_id"), "destination_id": F.col("destination_id"),
        "customer_id": F.col("customer_id"), "customer_email": F.col("customer_email"),
        "customer_description": F.col("customer_description"),
        "automatic_payout_id": F.col("automatic_payout_id"), "event_type": F.col("event_type"),
        "card_brand": F.col("card_brand"), "card_funding": F.col("card_funding"),
        "card_country": F.col("card_country"),
        "activity_interval_type": F.col("activity_interval_type"),
        "activity_start_time": F.col("start_time"), "activity_end_time": F.col("end_time"),
        "balance_transaction_description": F.col("bt_description"),
    }

    gross_component = F.when(rc.isin("fee", "network_cost"), F.lit("other_fee")) \
                       .otherwise(F.lit("gross"))
    fee_component = (F.when(rc.isin("fee", "network_cost"), F.lit("tax"))
                     .when(rc.isin("dispute", "dispute_reversal"), F.lit("dispute_fee"))
                     .when(rc.isin("transfer", "transfer_reversal"), F.concat(rc, F.lit("_fee")))
                     .when(rc == "other_adjustment", F.lit("other_fee"))
                     .otherwise(F.lit("payments_fee")))
    # only the gross line has a customer-facing amount
    common.update(customer_facing_currency=F.col("customer_facing_currency"),
                  customer_facing_amount=F.col("customer_facing_amount").cast("bigint"))
    return _pairs(act, common, (gross_component, fee_component), (F.col("gross"), -F.col("fee")),
                  (F.col("gross") != 0, F.col("fee") != 0))


def _window_fees(t, lo, hi, currency) -> DataFrame:
    """Itemised fees of the window that make a line."""
    activity_at = F.coalesce("incurred_at",
                             F.col("attribution_end_time") - F.expr("interval 1 second"))
    cur = (F.col("billing_currency") == currency) if currency is not None else F.lit(True)
    return t.icplus_fees.withColumn("activity_at", activity_at).where(
        (F.col("activity_at") >= ts_lit(lo)) & (F.col("activity_at") < ts_lit(hi)) & cur
        & ((F.col("subtotal_amount") != 0) | (F.col("tax_amount") != 0)))


def _fee_ledger(t) -> DataFrame:
    """Ledger rows that itemised fees belong to."""
    return t.balance_transactions.where(
        F.col("reporting_category").isin("fee", "network_cost") & is_icplus("description")) \
        .select(F.col("id").alias("balance_transaction_id"), F.col("created").alias("_bt_created"),
                F.col("reporting_category").alias("_bt_rc"),
                F.col("automatic_transfer_id").alias("_bt_payout"),
                F.col("description").alias("_bt_desc"))


def _effective(t) -> DataFrame:
    """(automatic_payout_id, _effective): when each payout takes effect, one array a payout, null rows included."""
    payouts = t.transfers.where(F.col("automatic")).select(F.col("id").alias("automatic_payout_id"))
    return t.balance_transactions.where(F.col("reporting_category") == "payout") \
        .select(F.col("source_id").alias("automatic_payout_id"), F.struct(F.col("available_on").alias("at")).alias("_at")) \
        .join(payouts, "automatic_payout_id", "inner") \
        .groupBy("automatic_payout_id").agg(F.sort_array(F.collect_list("_at")).alias("_effective"))


def _icplus_lines(t, ic: DataFrame, context: DataFrame, effective: DataFrame, heavy_ledger: DataFrame) -> DataFrame:
    ic = ic.drop("card_brand", "card_funding")
    ledger = _fee_ledger(t)
    ledger = lookup(ledger, effective.withColumnRenamed("automatic_payout_id", "_bt_payout"), "_bt_payout", ["balance_transaction_id"],
                    heavy_keys(ledger, "_bt_payout"))
    # one monthly ledger row can stand for millions of itemised fees
    j = lookup(lookup(ic, ledger, "balance_transaction_id", ["id"], heavy_ledger), context, "charge_id", ["id"]).select("*", "_context.*")
    fx = F.coalesce(F.col("fx_rate"), F.lit(1).cast("decimal(18,8)"))
    none_s = F.lit(None).cast("string")
    common = {
        "balance_transaction_id": F.col("balance_transaction_id"),
        "balance_transaction_created_at": F.col("_bt_created"),
        "balance_transaction_reporting_category": F.col("_bt_rc"),
        "activity_at": F.col("activity_at"), "currency": F.col("billing_currency"),
        "charge_id": F.col("charge_id"), "refund_id": F.col("refund_id"),
        "dispute_id": F.col("dispute_id"), "invoice_id": F.col("invoice_id"),
        "subscription_id": F.col("subscription_id"), "fee_id": F.col("id"),
        "destination_id": F.col("destination_id"), "customer_id": F.col("customer_id"),
        "customer_email": F.col("customer_email"),
        "customer_description": F.col("customer_description"),
        "automatic_payout_id": F.col("_bt_payout"),
        "customer_facing_currency": none_s,
        "customer_facing_amount": F.lit(None).cast("bigint"),
        "event_type": F.coalesce(F.col("event_type"), F.lit("aggregate card scheme")),
        "card_brand": F.col("card_brand"), "card_funding": F.col("card_funding"),
        "card_country": F.col("card_country"),
        "activity_interval_type": F.when(F.col("attribution_end_time").isNotNull(),
                                         F.lit("range")).otherwise(F.lit("instant")),
        "activity_start_time": F.col("attribution_start_time"),
        "activity_end_time": F.col("attribution_end_time"),
        "balance_transaction_description": F.col("_bt_desc"),
    }

    return _pairs(j, common, (F.col("fee_name"), F.lit("tax")), (-F.col("subtotal_amount") * fx, -F.col("tax_amount") * fx),
                  (F.col("subtotal_amount") != 0, F.col("tax_amount") != 0))


def _ordered_lines(pairs: DataFrame, heavy_ledger: DataFrame) -> DataFrame:
    """Distinct LINE_COLS of `pairs` with the payout's dates, in the report's order.

    Identical lines share ledger id and creation, and the order begins with them: ranges of the two hold all equal lines
    and all lines of a ledger row, so one shuffle serves the distinct and the order. A row with more than its part of all
    itemised fees is cut by the rest of the order as well.
    """
    hot = F.col("_hot").isNotNull()
    rank = lambda component: F.when(component == "gross", 1).otherwise(2)
    component = F.when(F.col("_has") == 2, F.col("_component_2")).otherwise(F.col("_component_1"))
    pairs = (pairs.where(F.col("balance_transaction_id").isNotNull())
             .join(F.broadcast(heavy_ledger.select("_hot")), F.col("balance_transaction_id") == F.col("_hot"), "left")
             .withColumn("_of", F.explode(F.when(hot, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(3)))))
             .withColumn("_has", F.col("_has").bitwiseAND(F.col("_of"))).where(F.col("_has") != 0)
             .withColumn("_at", F.date_trunc("second", "balance_transaction_created_at"))
             .withColumn("_rank", F.when(hot, rank(component))).withColumn("_component", F.when(hot, component)).drop("_hot", "_of")
             .repartitionByRange(F.col("_at").asc_nulls_last(), F.col("balance_transaction_id").asc(), F.col("_rank").asc(),
                                 F.col("_component").asc_nulls_last()))
    first = F.col("_line") == 1
    own = {"balance_transaction_component": F.when(first, F.col("_component_1")).otherwise(F.col("_component_2")),
           "amount": F.when(first, F.col("_amount_1")).otherwise(F.col("_amount_2"))} \
        | {c: F.when(first, F.col(c)) for c in ("customer_facing_currency", "customer_facing_amount")}
    lines = (pairs.select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("_line"))
             .where(F.col("_has").bitwiseAND(F.col("_line")) != 0)
             .select(*[own.get(c, F.col(c)).alias(c) for c in LINE_COLS], "_effective", "_at", "_rank", "_component").distinct())
    component = F.col("balance_transaction_component")
    return (lines.select("*", F.explode_outer("_effective").alias("_paid")).withColumn("automatic_payout_effective_at", F.col("_paid.at"))
            .sortWithinPartitions(F.col("_at").asc_nulls_last(), "balance_transaction_id", rank(component), component.asc_nulls_last()))


def line_items(t, lo, hi, currency: str | None = None,
               period_since=PERIOD_TEXT_SINCE) -> DataFrame:
    """R1 over the half-open window [lo, hi); currency=None means every currency."""
    fees = _window_fees(t, lo, hi, currency)
    heavy_ledger = heavy_keys(fees, "balance_transaction_id")
    act, context = _activity(t, lo, hi, currency, period_since, fees.select("charge_id"))
    effective = _effective(t)
    # one payout has many lines, and unsettled lines have none
    bts = t.balance_transactions
    act = lookup(act, effective, "automatic_payout_id", ["balance_transaction_id"],
                 heavy_keys(bts.where((F.col("created") >= ts_lit(lo)) & (F.col("created") < ts_lit(hi))), "automatic_transfer_id"))
    li = _ordered_lines(_ledger_lines(act).unionByName(_icplus_lines(t, fees, context, effective, heavy_ledger)), heavy_ledger)
    ts_fmt = "yyyy-MM-dd HH:mm:ss"
    end_or_at = F.coalesce(F.col("activity_end_time") - F.expr("interval 1 second"),
                           F.col("activity_at"))
    return li.select(
        "balance_transaction_id",
        F.date_format("balance_transaction_created_at", ts_fmt).alias("balance_transaction_created_at"),
        "balance_transaction_reporting_category", "balance_transaction_component",
        F.date_format("activity_at", ts_fmt).alias("activity_at"), "currency",
        decimalize(F.col("currency"), F.col("amount"), 6).alias("amount"),
        "charge_id", "refund_id", "dispute_id", "invoice_id", "subscription_id", "fee_id",
        "destination_id", "customer_id", "customer_email", "customer_description",
        "automatic_payout_id",
        F.date_format("automatic_payout_effective_at", ts_fmt).alias("automatic_payout_effective_at"),
        "event_type", "card_brand", "card_funding", "card_country", "customer_facing_currency",
        decimalize(F.col("customer_facing_currency"), F.col("customer_facing_amount"))
        .alias("customer_facing_amount"),
        "activity_interval_type",
        F.date_format(F.coalesce("activity_start_time", "activity_at"), "yyyy-MM-dd")
        .alias("activity_start_date"),
        F.date_format(end_or_at, "yyyy-MM-dd").alias("activity_end_date"),
        "balance_transaction_description")


def activity_report(t, load_time, currency: str | None = None, period_since=PERIOD_TEXT_SINCE) -> DataFrame:
    """R1 as it is run every month: the month before `load_time`, one currency or all."""
    return line_items(t, *month_window(load_time), currency, period_since)
