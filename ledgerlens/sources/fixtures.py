"""Payments tables derived from the driver's TPC-H-style tables.

The reports read 22 payments tables (charges, refunds, ledgers, payouts, ...)
that the driver data does not have. Each one is defined here as ONE SQL text
that both Spark SQL and DuckDB accept, so the Spark reports and the DuckDB
oracle start from identical inputs. Every table is a projection, union or
group-by over whole driver tables (every order becomes a charge, every
line item an itemised fee), so the work grows with the scale factor.
Attribute assignment uses key arithmetic only to spread ids over the value
domains the reports test (statuses, categories, currencies); it never drops
rows to make a check cheaper.

Table references are written ``{name}``; Spark binds them to DataFrames via
``spark.sql(text, name=df)``, the oracle replaces them with view names.
"""

from __future__ import annotations

import re

# Fixed values (account of the platform itself, used by the book transfers
# that debit merchants for unlinked refunds).
PLATFORM_ACCOUNT = "acct_platform"

_DAY = "cast(cast({e} as date) as varchar(10))"


def _d(expr: str) -> str:
    return _DAY.format(e=expr)


FIXTURES: dict[str, str] = {}

# Shared per-order facts: one row per order, every column the derived
# tables reuse. `odate` is the order's midnight, `created` adds a spread
# of seconds inside the day.
FIXTURES["order_facts"] = """
select
  o_orderkey as k,
  o_custkey as c,
  o_orderpriority as priority,
  o_orderdate as odate,
  o_orderdate + (o_orderkey * 7919 % 86400) * interval '1' second as created,
  cast(round(o_totalprice * 100) as bigint) as amount,
  cast(floor(cast(round(o_totalprice * 100) as bigint) * 0.03) as bigint) as app_fee,
  cast(floor(cast(round(o_totalprice * 100) as bigint) * 0.029) as bigint) + 30 as processing_fee,
  case o_custkey % 5 when 0 then 'usd' when 1 then 'eur' when 2 then 'cad'
       when 3 then 'gbp' else 'jpy' end as currency,
  -- five customers share a merchant; one merchant has a third of all orders
  case when o_orderkey * 31 % 97 < 32 then 'acct_0'
       else 'acct_' || cast(floor(o_custkey / 5) as bigint) end as merchant,
  o_orderstatus <> 'P' as captured,
  case o_orderpriority when '3-MEDIUM' then 'bancontact' when '4-NOT SPECIFIED' then 'ideal'
       when '5-LOW' then 'interac_present' else 'card' end as method,
  case o_orderkey % 3 when 0 then 'visa' when 1 then 'mastercard' else 'amex' end as card_brand,
  case when o_orderkey % 2 = 0 then 'credit' else 'debit' end as card_funding
from {orders}
"""

FIXTURES["charges"] = """
select
  'ch_' || k as id,
  created,
  amount,
  currency,
  merchant as destination_id,
  'cus_' || c as customer_id,
  case when k % 4 = 0 then 'in_' || k end as invoice_id,
  card_brand,
  card_funding,
  case c % 3 when 0 then 'US' when 1 then 'CA' else 'DE' end as card_country,
  captured,
  case when not captured and k % 2 = 0 then 'issuer_declined'
       when not captured then 'blocked' else 'authorized' end as outcome_type,
  method as payment_method_type,
  'tr_' || k as transfer_id,
  'txn_ch_' || k as balance_transaction_id,
  case when captured and k % 13 = 0 then 'dp_' || k end as dispute_id,
  'Order ' || k || ' ' || priority as description
from {order_facts}
"""

FIXTURES["refunds"] = """
select
  're_' || k as id,
  case when k % 15 = 0 then null else 'ch_' || k end as charge_id,
  created + (k % 6) * interval '1' day + interval '1' hour as created,
  cast(floor(amount * 0.5) as bigint) as amount,
  currency,
  case when k % 35 = 0 then 'failed' else 'succeeded' end as status,
  'txn_re_' || k as balance_transaction_id
from {order_facts}
where captured and k % 5 = 0
"""

FIXTURES["disputes"] = """
select
  'dp_' || k as id,
  'ch_' || k as charge_id,
  created + interval '10' day as created,
  amount,
  case k % 8 when 0 then 'fraudulent' when 1 then 'duplicate' when 2 then 'credit_not_processed'
       when 3 then 'product_not_received' when 4 then 'product_unacceptable'
       when 5 then 'subscription_canceled' when 6 then 'general' end as reason,
  case k % 5 when 0 then 'won' when 1 then 'lost' when 2 then 'needs_response'
       when 3 then 'warning_needs_response' else 'under_review' end as status,
  cast(k % 3 as integer) as evidence_details_submission_count,
  created + interval '17' day as evidence_details_due_by,
  k % 2 = 0 as is_charge_refundable
from {order_facts}
where captured and k % 13 = 0
"""

FIXTURES["application_fees"] = """
select 'fee_' || k as id, merchant as account_id, created, app_fee as amount, 'ch_' || k as charge_id
from {order_facts}
where captured
"""

FIXTURES["application_fee_refunds"] = """
select 'fr_' || k as id, 'fee_' || k as fee_id, created + interval '3' day as created,
  cast(floor(app_fee * 0.5) as bigint) as amount
from {order_facts}
where captured and k % 25 = 0
"""

# Platform payouts: one per currency and settlement day.
FIXTURES["platform_payouts"] = f"""
select
  'po_' || currency || '_' || {_d("odate + interval '2' day")} as id,
  currency,
  odate + interval '2' day as created,
  odate + interval '3' day as arrival,
  cast(sum(amount - processing_fee) as bigint) as amount,
  case when day(odate) % 7 = 0 then 'in_transit' when day(odate) % 11 = 0 then 'pending'
       else 'paid' end as status
from {{order_facts}}
where captured
group by currency, odate
"""

FIXTURES["transfers"] = """
select 'tr_' || k as id, 'stripe_account' as type, merchant as destination_id, false as automatic,
  created, created as date, amount - app_fee as amount, 'paid' as status,
  case when method in ('card', 'interac_present') then 'card' else 'bank_account' end as source_type
from {order_facts}
where captured
union all
select id, 'bank_account' as type, cast(null as varchar(32)) as destination_id, true as automatic,
  created, arrival as date, amount, status, cast(null as varchar(32)) as source_type
from {platform_payouts}
"""

_FEE_DESC = (
    "case k % 8"
    " when 0 then 'Card payments (' || {d0} || ' - ' || {d1} || '): Interchange plus processing'"
    " when 1 then 'IC+ fees (' || {d0} || ' - ' || {d1} || '): Network costs'"
    " when 2 then 'Radar (' || {d0} || '): Radar screening'"
    " when 3 then 'Sigma (' || {d0} || ' - ' || {d1} || '): Sigma queries'"
    " when 4 then 'Terminal (' || {d0} || ' - ' || {d1} || '): Active reader fee'"
    " when 5 then 'Connect (' || {d0} || ' - ' || {d1} || '): Connect account fees'"
    " when 6 then 'Services fee (' || {d0} || '): Premium support'"
    " else 'Radar credit: manual adjustment' end"
).format(d0=_d("odate"), d1=_d("odate + interval '29' day"))

FIXTURES["balance_transactions"] = f"""
select 'txn_ch_' || k as id, created, created + interval '2' day as available_on,
  'charge' as type, 'charge' as reporting_category, currency, amount,
  processing_fee as fee, amount - processing_fee as net,
  'Charge for order ' || k as description, 'ch_' || k as source_id,
  'po_' || currency || '_' || {_d("odate + interval '2' day")} as automatic_transfer_id
from {{order_facts}} where captured
union all
select 'txn_re_' || k, created + (k % 6) * interval '1' day + interval '1' hour,
  created + (k % 6) * interval '1' day + interval '1' hour + interval '2' day,
  'refund', 'refund', currency, -cast(floor(amount * 0.5) as bigint), 0,
  -cast(floor(amount * 0.5) as bigint), 'REFUND FOR CHARGE (Order ' || k || ')', 're_' || k,
  'po_' || currency || '_' || {_d("odate + (k % 6) * interval '1' day + interval '2' day")}
from {{order_facts}} where captured and k % 5 = 0 and k % 35 <> 0
union all
select 'txn_dp_' || k, created + interval '10' day, created + interval '12' day,
  'adjustment', 'dispute', currency, -amount, 1500, -amount - 1500,
  'Chargeback withdrawal for ch_' || k, 'dp_' || k, cast(null as varchar(64))
from {{order_facts}} where captured and k % 13 = 0
union all
select 'txn_dr_' || k, created + interval '40' day, created + interval '42' day,
  'adjustment', 'dispute_reversal', currency, amount, -1500, amount + 1500,
  'Chargeback reversal for ch_' || k, 'dp_' || k, cast(null as varchar(64))
from {{order_facts}} where captured and k % 13 = 0 and k % 5 = 0
union all
select 'txn_af_' || k, created, created + interval '2' day,
  'application_fee', 'platform_earning', currency, app_fee, 0, app_fee,
  'Application fee from ' || merchant, 'fee_' || k,
  'po_' || currency || '_' || {_d("odate + interval '2' day")}
from {{order_facts}} where captured
union all
select 'txn_fr_' || k, created + interval '3' day, created + interval '5' day,
  'application_fee_refund', 'platform_earning_refund', currency,
  -cast(floor(app_fee * 0.5) as bigint), 0, -cast(floor(app_fee * 0.5) as bigint),
  'Application fee refund', 'fr_' || k, cast(null as varchar(64))
from {{order_facts}} where captured and k % 25 = 0
union all
select 'txn_tr_' || k, created, created, 'transfer', 'transfer', currency,
  -(amount - app_fee), 0, -(amount - app_fee), 'Transfer to ' || merchant, 'tr_' || k,
  cast(null as varchar(64))
from {{order_facts}} where captured
union all
select 'txn_sf_' || k, odate + interval '30' day + interval '1' hour,
  odate + interval '32' day + interval '1' hour,
  case when k % 8 = 1 then 'network_cost' else 'stripe_fee' end,
  case when k % 8 = 1 then 'network_cost' else 'fee' end,
  currency, -(amount % 5000 + 100), 0, -(amount % 5000 + 100),
  {_FEE_DESC}, cast(null as varchar(64)),
  'po_' || currency || '_' || {_d("odate + interval '32' day")}
from {{order_facts}} where k % 3 = 2
union all
select 'txn_po_' || id, created, arrival, 'payout', 'payout', currency, -amount, 0, -amount,
  'PAYOUT', id, cast(null as varchar(64))
from {{platform_payouts}}
"""

# Merchant payouts: one per merchant, currency and settlement day.
FIXTURES["merchant_payouts"] = f"""
select
  'po_' || merchant || '_' || currency || '_' || {_d("odate + interval '2' day")} as id,
  merchant as account,
  currency,
  odate + interval '2' day as created,
  odate + interval '3' day as arrival,
  cast(sum(amount - app_fee) as bigint) as amount,
  case when day(odate) % 9 = 0 then 'in_transit' when day(odate) % 13 = 0 then 'pending'
       else 'paid' end as status,
  case when length(merchant) % 3 = 0 then 'card' else 'bank_account' end as type
from {{order_facts}}
where captured
group by merchant, currency, odate
"""

FIXTURES["connected_account_balance_transactions"] = f"""
select 'txn_py_' || k as id, merchant as account, created, created + interval '2' day as available_on,
  currency, 'payment' as type, 'charge' as reporting_category, amount, app_fee as fee,
  amount - app_fee as net,
  'po_' || merchant || '_' || currency || '_' || {_d("odate + interval '2' day")} as automatic_transfer_id,
  'py_' || k as source_id, 'Payment py_' || k as description
from {{order_facts}} where captured
union all
select 'txn_pr_' || k, merchant, created + (k % 6) * interval '1' day + interval '1' hour,
  created + (k % 6) * interval '1' day + interval '1' hour + (k % 7) * interval '1' day,
  currency, 'payment_refund', 'refund', -cast(floor(amount * 0.5) as bigint), 0,
  -cast(floor(amount * 0.5) as bigint), cast(null as varchar(64)), 'pyr_' || k,
  'Refund for py_' || k
from {{order_facts}} where captured and k % 5 = 0 and k % 15 <> 0
union all
select 'txn_ad_' || k, merchant, created + interval '10' day, created + interval '12' day,
  currency, 'adjustment', 'dispute', -amount, 0, -amount, cast(null as varchar(64)), 'dp_' || k,
  'Chargeback withdrawal'
from {{order_facts}} where captured and k % 13 = 0
union all
select 'txn_' || id, account, created, arrival, currency, 'payout', 'payout', -amount, 0, -amount,
  cast(null as varchar(64)), id, 'PAYOUT'
from {{merchant_payouts}}
union all
select 'txn_tf_' || k, merchant, created + interval '1' hour, created + interval '1' hour,
  currency, 'transfer_failure', 'transfer_reversal',
  case when k % 2 = 0 then amount % 10000 else -(amount % 10000) end, 0,
  case when k % 2 = 0 then amount % 10000 else -(amount % 10000) end,
  cast(null as varchar(64)), 'trf_' || k, 'Transfer failure'
from {{order_facts}} where k % 17 = 0
union all
select 'txn_pf_' || k, merchant, created + interval '2' hour, created + interval '2' hour,
  currency, 'payout_failure', 'payout_reversal',
  case when k % 2 = 1 then amount % 7000 else -(amount % 7000) end, 0,
  case when k % 2 = 1 then amount % 7000 else -(amount % 7000) end,
  cast(null as varchar(64)), 'pof_' || k, 'Payout failure'
from {{order_facts}} where k % 19 = 0
union all
select 'txn_fp_' || k, merchant, created + interval '1' day, created + interval '3' day,
  currency, 'financing_paydown', 'financing', -cast(floor(amount * 0.1) as bigint), 0,
  -cast(floor(amount * 0.1) as bigint), cast(null as varchar(64)), 'fp_' || k,
  'Financing paydown withheld from py_' || k
from {{order_facts}} where captured and k % 23 = 0
"""

FIXTURES["connected_account_transfers"] = f"""
select id, account, created, arrival as date, amount, status, type, 'payout' as kind,
  'card' as source_type, cast(null as varchar(64)) as destination_id,
  cast(null as varchar(64)) as destination_payment_id, true as automatic, false as reversed
from {{merchant_payouts}}
union all
select 'trb_' || k, merchant, created + (k % 6) * interval '1' day,
  created + (k % 6) * interval '1' day, cast(floor(amount * 0.5) as bigint), 'paid',
  'stripe_account', 'book', 'card', '{PLATFORM_ACCOUNT}', 'py_book_' || k, false, k % 60 = 0
from {{order_facts}} where captured and k % 15 = 0
"""

FIXTURES["connected_account_transfers_metadata"] = """
select 'trb_' || k as transfer_id, 'transaction_type' as key,
  case when k % 45 = 0 then 'manual' else 'unreferenced-refund' end as value
from {order_facts} where captured and k % 15 = 0
union all
select 'trb_' || k, 'final_destination', 'pm_' || c
from {order_facts} where captured and k % 15 = 0
union all
select 'trb_' || k, 'note', 'auto-generated'
from {order_facts} where captured and k % 15 = 0
"""

FIXTURES["refunds_metadata"] = """
select 're_' || k as refund_id, 'parent_transfer' as key, 'trb_' || k as value
from {order_facts} where captured and k % 15 = 0
union all
select 're_' || k, 'note', 'support ticket ' || k
from {order_facts} where captured and k % 5 = 0
"""

FIXTURES["charges_metadata"] = """
select 'ch_' || k as charge_id, 'product_id' as key,
  case k % 3 when 0 then 'resto' when 1 then 'retail' else 'online' end as value
from {order_facts}
union all
select 'ch_' || k, 'order_id', 'ord_' || k
from {order_facts} where k % 2 = 0
"""

FIXTURES["transfer_reversals"] = """
select 'trr_' || k as id, 'tr_' || k as transfer_id
from {order_facts} where captured and k % 10 = 0 and k % 15 <> 0
"""

FIXTURES["icplus_fees"] = """
select
  'icf_' || l_orderkey || '_' || l_linenumber || '_' || l_partkey || '_' || l_suppkey as id,
  'txn_sf_' || l_orderkey as balance_transaction_id,
  case l_linenumber % 3 when 0 then 'interchange' when 1 then 'scheme_fees' else 'processing' end
    as fee_name,
  case when l_linestatus = 'O' then 'network_cost' else 'stripe_fee' end as fee_category,
  case l_returnflag when 'A' then 'charge' when 'R' then 'refund' end as event_type,
  case when l_linenumber = 7 then null
       else l_shipdate + (l_partkey * 131 % 86400) * interval '1' second end as incurred_at,
  case when l_linenumber = 7 then l_shipdate - (day(l_shipdate) - 1) * interval '1' day end
    as attribution_start_time,
  case when l_linenumber = 7
       then l_shipdate - (day(l_shipdate) - 1) * interval '1' day + interval '1' month end
    as attribution_end_time,
  f.currency as billing_currency,
  cast(l_extendedprice * l_discount as decimal(18,4)) as billing_amount,
  cast(l_extendedprice * l_discount as decimal(18,4)) as subtotal_amount,
  cast(case f.currency when 'usd' then null when 'eur' then 1.1 when 'cad' then 0.75
       when 'gbp' then 1.25 else 0.0068 end as decimal(18,8)) as fx_rate,
  cast(l_extendedprice * l_tax as decimal(18,4)) as tax_amount,
  case when l_returnflag <> 'R' then 'ch_' || l_orderkey end as charge_id,
  case when l_returnflag = 'R' and l_linestatus = 'F' then 're_' || l_orderkey end as refund_id,
  case when l_returnflag = 'R' and l_linestatus = 'O' and l_orderkey % 13 = 0
       then 'dp_' || l_orderkey end as dispute_id,
  'req_' || l_orderkey || '_' || l_linenumber as request_id,
  f.merchant as destination_id,
  'cus_' || f.c as customer_id,
  f.card_brand,
  f.card_funding,
  case l_returnflag when 'A' then true when 'N' then false end as card_present
from {lineitem} l join {order_facts} f on l.l_orderkey = f.k
"""

FIXTURES["customers"] = """
select 'cus_' || c_custkey as id, lower(replace(c_name, '#', '_')) || '@example.com' as email,
  c_mktsegment as description
from {customer}
"""

FIXTURES["connected_accounts"] = """
select 'acct_' || m as id, case when m % 4 = 0 then null else 'Merchant ' || m end as business_name,
  'https://merchant' || m || '.example.com' as business_url
from (select distinct cast(floor(c_custkey / 5) as bigint) as m from {customer} union select 0) accounts
"""

FIXTURES["invoices"] = """
select 'in_' || k as id, case when k % 8 = 0 then 'sub_' || c end as subscription_id,
  'ch_' || k as charge_id
from {order_facts} where k % 4 = 0
"""

FIXTURES["subscriptions"] = """
select distinct 'sub_' || c as id from {order_facts} where k % 8 = 0
"""

FIXTURES["payment_method_details"] = """
select 'ch_' || k as charge_id,
  case method when 'interac_present' then 'card_present' else method end as type,
  card_brand, card_funding, lpad(cast(k % 10000 as varchar(10)), 4, '0') as card_last4
from {order_facts}
"""

FIXTURES["payment_methods"] = """
select 'pm_' || c_custkey as id,
  case c_custkey % 3 when 0 then 'visa' when 1 then 'mastercard' else 'amex' end as card_brand,
  case c_nationkey % 3 when 0 then 'US' when 1 then 'CA' else 'DE' end as card_country,
  cast(c_custkey % 12 + 1 as integer) as card_exp_month,
  cast(2025 + c_custkey % 5 as integer) as card_exp_year,
  'fp_' || (c_custkey % 97) as card_fingerprint,
  case when c_custkey % 2 = 0 then 'credit' else 'debit' end as card_funding,
  cast(400000 + c_custkey % 1000 as varchar(10)) as card_iin,
  lpad(cast(c_custkey % 10000 as varchar(10)), 4, '0') as card_last4,
  c_custkey % 2 = 0 as card_three_d_secure_supported
from {customer}
"""

FIXTURES["connected_account_charges"] = """
select 'py_' || k as id, merchant as account, created, currency, captured,
  'txn_py_' || k as balance_transaction_id,
  case when captured then 'fee_' || k end as application_fee_id
from {order_facts}
"""

FIXTURES["connected_account_balance_transaction_fee_details"] = """
select 'txn_py_' || k as balance_transaction_id, app_fee as amount, 'application_fee' as type
from {order_facts} where captured
union all
select 'txn_py_' || k, 25, 'application_fee'
from {order_facts} where captured and k % 4 = 0
"""

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations")

_REF = re.compile(r"\{(\w+)\}")


def deps(name: str) -> list[str]:
    return sorted(set(_REF.findall(FIXTURES[name])))


def closure(names) -> list[str]:
    """Fixture names needed by `names`, dependencies first."""
    out: list[str] = []

    def visit(n):
        if n in out or n not in FIXTURES:
            return
        for d in deps(n):
            visit(d)
        out.append(n)

    for n in names:
        visit(n)
    return out


def oracle_ctes(sql: str) -> str:
    """Prefix a DuckDB query with the fixture CTEs it references."""
    used = [n for n in FIXTURES if re.search(rf"\b{n}\b", sql)]
    order = closure(used)
    ctes = ",\n".join(f"{n} as ({_REF.sub(lambda m: m.group(1), FIXTURES[n])})" for n in order)
    if not ctes:
        return sql
    body = sql.lstrip()
    if body[:4].lower() == "with":
        return "with " + ctes + ",\n" + body[4:]
    return "with " + ctes + "\n" + body
