"""Registry of report queries and their DuckDB oracle texts.

Registered queries run each report over the whole derived tables: the
report range covers every day of the driver data.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .plans import daily, fees, line_items, merchant, primitives as pr, tracing
from .plans import oracle_primitives as op
from .plans import oracle_daily as od, oracle_merchant as om, oracle_reports as orr
from .sources.fixtures import PLATFORM_ACCOUNT, oracle_ctes
from .sources.report_csv import OPTIONS, csv_lines, plain_numbers
from .sources.tables import load_tables

# Whole-data report window: the driver's orders run 1995-01-01 .. 2001-08-01
# and derived activity trails them by at most ~45 days.
D0, D1 = "1995-01-01", "2001-12-31"
M0, M1 = "1995-01", "2001-12"
# Lower bound for the `created > since` sheets: before the first driver day.
SINCE = "1994-12-31"
# `now()` of the six-month dispute dashboard.
AS_OF, MONTHS = "2001-09-01", 6
# Line-item window (half-open) and the first instant whose fee text is parsed.
LO, HI, PERIOD_SINCE = "1995-01-01 00:00:00", "2002-01-01 00:00:00", "1995-01-01"

_REGISTRY: dict[str, tuple[Callable, str | None]] = {}


def register(name: str, fn: Callable, oracle: str | None):
    _REGISTRY[name] = (fn, oracle)


def _ranged(plan):
    return lambda t: plan(t, D0, D1)


register("failed_transfers_daily", _ranged(daily.failed_transfers_daily), od.FAILED_TRANSFERS_DAILY)
register("failed_transfers_merchant_daily", _ranged(daily.failed_transfers_merchant_daily),
         od.FAILED_TRANSFERS_MERCHANT_DAILY)
register("fee_daily", _ranged(daily.fee_daily), od.FEE_DAILY)
register("fee_merchant_daily", _ranged(daily.fee_merchant_daily), od.FEE_MERCHANT_DAILY)
register("volume_daily", _ranged(daily.volume_daily), od.VOLUME_DAILY)
register("volume_merchant_daily", _ranged(daily.volume_merchant_daily), od.VOLUME_MERCHANT_DAILY)
register("platform_daily", _ranged(daily.platform_daily), od.PLATFORM_DAILY)
register("merchant_volume_daily", lambda t: merchant.merchant_volume_daily(t, D0, D1, PLATFORM_ACCOUNT),
         om.MERCHANT_VOLUME_DAILY)
register("merchant_volume_daily_utc",
         lambda t: merchant.merchant_volume_daily(t, D0, D1, tz=None, with_unlinked=False),
         om.MERCHANT_VOLUME_DAILY_UTC)
register("merchant_monthly", lambda t: merchant.merchant_monthly(t, M0, M1), om.MERCHANT_MONTHLY)
register("fee_report", _ranged(fees.fee_report), orr.FEE_REPORT)
register("balance_report", _ranged(fees.balance_report), orr.BALANCE_REPORT)
register("payout_breakdown", lambda t: fees.payout_breakdown(t), orr.PAYOUT_BREAKDOWN)
register("payout_breakdown_accrual", lambda t: fees.payout_breakdown(t, with_accrual=True),
         orr.PAYOUT_BREAKDOWN_ACCRUAL)
register("payout_activity_timing", lambda t: fees.payout_activity_timing(t, SINCE),
         orr.PAYOUT_ACTIVITY_TIMING)
register("icplus_tagged", lambda t: fees.icplus_tagged(t, SINCE), orr.ICPLUS_TAGGED)
register("invoice_fee_daily", fees.invoice_fee_daily, orr.INVOICE_FEE_DAILY)
register("account_debit_unlinked", lambda t: tracing.account_debit_unlinked(t, PLATFORM_ACCOUNT),
         orr.ACCOUNT_DEBIT_UNLINKED)
register("unlinked_refund_cards", lambda t: tracing.unlinked_refund_cards(t, SINCE, PLATFORM_ACCOUNT),
         orr.UNLINKED_REFUND_CARDS)
register("interac_not_reversed", lambda t: tracing.interac_not_reversed(t, SINCE),
         orr.INTERAC_NOT_REVERSED)
register("sales_with_paydowns", lambda t: tracing.sales_with_paydowns(t, SINCE),
         orr.SALES_WITH_PAYDOWNS)
register("dispute_dashboard", lambda t: tracing.dispute_dashboard(t, AS_OF, MONTHS),
         orr.DISPUTE_DASHBOARD)
register("dispute_sheet", tracing.dispute_sheet, orr.DISPUTE_SHEET)
register("line_items",
         lambda t: line_items.line_items(t, dt.datetime.fromisoformat(LO),
                                         dt.datetime.fromisoformat(HI),
                                         period_since=PERIOD_SINCE),
         orr.LINE_ITEMS)

# The forms that users run by hand: one month and currency, a list of payments, a
# single payout, dispute or merchant (the first one), and rows for a CSV file.
LOAD_TIME, CURRENCY = "2000-08-15", "usd"
PAYMENT_IDS = [f"py_book_{k}" for k in range(15, 3000, 15)]


def _first(df, col):
    return df.agg({col: "min"}).first()[0]


register("activity_report", lambda t: line_items.activity_report(t, LOAD_TIME, CURRENCY, PERIOD_SINCE),
         orr.line_items_sql("2000-07-01", "2000-08-01", CURRENCY))
register("account_debit_listed", lambda t: tracing.account_debit_unlinked(t, PLATFORM_ACCOUNT, PAYMENT_IDS),
         orr.account_debit_sql(f"destination_payment_id in ({', '.join(map(repr, PAYMENT_IDS))})"))
register("payout_breakdown_single",
         lambda t: fees.payout_breakdown(t, _first(t.transfers.where("type = 'bank_account'"), "id")),
         orr.PAYOUT_BREAKDOWN_SINGLE)
register("dispute_sheet_single",
         lambda t: tracing.dispute_sheet(t, _first(t.disputes.where("status in ('needs_response', 'warning_needs_response')"), "id")),
         orr.DISPUTE_SHEET_SINGLE)
register("sales_one_merchant",
         lambda t: tracing.sales_with_paydowns(t, SINCE, _first(t.connected_account_balance_transactions, "account")),
         orr.SALES_ONE_MERCHANT)
register("dispute_dashboard_csv", lambda t: csv_lines(tracing.dispute_dashboard(t, AS_OF, MONTHS)),
         orr.DISPUTE_DASHBOARD_CSV)
register("activity_report_csv",
         lambda t: csv_lines(plain_numbers(line_items.activity_report(t, LOAD_TIME, CURRENCY, PERIOD_SINCE)), **OPTIONS),
         orr.activity_report_csv_sql("2000-07-01", "2000-08-01", CURRENCY))

# Operator-level queries on the driver tables.
# Months for the semi-join check: one per year of the data.
SEMI_MONTHS = ["1995-03", "1996-07", "1997-11", "1998-02", "1999-06", "2000-10", "2001-04"]
register("prim_day_spine", _ranged(pr.day_spine_orders), op.DAY_SPINE_ORDERS)
register("prim_month_spine", lambda t: pr.month_spine_orders(t, M0, M1), op.MONTH_SPINE_ORDERS)
register("prim_local_day", pr.events_new_york_daily, op.EVENTS_NEW_YORK_DAILY)
register("prim_attribution", _ranged(pr.attributed_order_value), op.ATTRIBUTED_ORDER_VALUE)
register("prim_contains", pr.nation_key_mentions, op.NATION_KEY_MENTIONS)
register("prim_text_parse", pr.page_url_parts, op.PAGE_URL_PARTS)
register("prim_sum_pivot", pr.lineitem_pivot, op.LINEITEM_PIVOT)
register("prim_distinct", pr.supplier_distinct_orders, op.SUPPLIER_DISTINCT_ORDERS)
register("prim_two_level", pr.customer_two_level, op.CUSTOMER_TWO_LEVEL)
register("prim_union_all", pr.order_ship_union, op.ORDER_SHIP_UNION)
register("prim_union_distinct", pr.order_ship_labels, op.ORDER_SHIP_LABELS)
register("prim_anti", lambda t: pr.customers_without_orders(t, "2000-01-01", "2000-12-31"),
         op.CUSTOMERS_WITHOUT_ORDERS.replace("{d0}", "2000-01-01").replace("{d1}", "2000-12-31"))
register("prim_semi_months", lambda t: pr.customers_in_months(t, SEMI_MONTHS),
         op.CUSTOMERS_IN_MONTHS.replace("{months}", ", ".join(f"'{m}'" for m in SEMI_MONTHS)))
register("prim_having", pr.mixed_status_customers, op.MIXED_STATUS_CUSTOMERS)
register("prim_decimalize", pr.nation_order_value, op.NATION_ORDER_VALUE)
register("prim_dates", pr.ship_lag_buckets, op.SHIP_LAG_BUCKETS)
register("prim_full_chain", _ranged(pr.daily_chain), op.DAILY_CHAIN)
register("prim_polymorphic", pr.polymorphic_refs, op.POLYMORPHIC_REFS)
register("prim_metadata", pr.event_metadata, op.EVENT_METADATA)


def plans() -> dict[str, Callable]:
    """name -> plan(tables): the report over an already bound `Tables`."""
    return {name: fn for name, (fn, _) in _REGISTRY.items()}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn):
        return lambda spark, sf_dir: fn(load_tables(spark, sf_dir))
    return {name: bind(fn) for name, (fn, _) in _REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    out = {}
    for name, (_, sql) in _REGISTRY.items():
        if sql is None:
            continue
        for k, v in (("{d0}", D0), ("{d1}", D1), ("{m0}", M0), ("{m1}", M1), ("{since}", SINCE),
                     ("{as_of}", AS_OF), ("{months}", str(MONTHS)), ("{lo}", LO),
                     ("{hi}", HI), ("{period_since}", PERIOD_SINCE)):
            sql = sql.replace(k, v)
        out[name] = oracle_ctes(sql)
    return out
