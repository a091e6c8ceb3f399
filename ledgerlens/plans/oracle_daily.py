"""DuckDB oracle texts for the daily family (R5-R11), built from measures.

A report is stated as measures: where a value comes from, on which clock it
counts, which rows count, and what is added up. `long_rows` turns the
statement into one relation (day, account, measure, v, k) with a row for every
ledger entry that a measure counts, and a report is a single aggregation of it
over the days of the range. The Spark plans work on wide rows instead, so the
two share neither steps nor structure. `{d0}` / `{d1}` are ISO dates.
"""

from __future__ import annotations

from dataclasses import dataclass

SPINE = ("spine as (select unnest(generate_series(timestamp '{d0}', timestamp '{d1}', interval 1 day))::date as day)")


@dataclass(frozen=True)
class Measure:
    """Rows of `source` with `when`, counted on the day of `clock` if that lies in the range."""
    name: str
    source: str
    clock: str
    when: str = "true"
    add: str = "null"  # what is summed
    key: str = "null"  # what is counted once
    account: str = "null"
    open_end: bool = False  # the last day does not count
    bucket: str | None = None  # day it is shown on, if not that of `clock`


def in_range(c: str, open_end: bool = False) -> str:
    return f"{c} >= date '{{d0}}' and {c} {'<' if open_end else '<='} date '{{d1}}'"


def long_rows(measures) -> str:
    one = [f"select cast({m.bucket or m.clock} as date) as day, {m.account} as account, '{m.name}' as measure, "
           f"cast({m.add} as decimal(38, 4)) as v, cast({m.key} as varchar) as k from {m.source} "
           f"where ({m.when}) and {in_range(f'cast({m.clock} as date)', m.open_end)}" for m in measures]
    return "long as (" + "\nunion all ".join(one) + ")"


def money(name: str) -> str:
    return f"coalesce(cast(sum(v) filter (measure = '{name}') as double) / 100.0, 0) as {name}"


def number(name: str, measure: str) -> str:
    return f"count(*) filter (measure = '{measure}') as {name}"


def distinct(name: str, measure: str) -> str:
    return f"count(distinct k) filter (measure = '{measure}') as {name}"


def daily(measures, columns, gate: str) -> str:
    """A row per day from the first day of `gate` on."""
    return (f"with {SPINE},\n{long_rows(measures)}\nselect day, {', '.join(columns)}\n"
            f"from spine left join long using (day)\nwhere day >= (select min(day) from long where measure = '{gate}')\ngroup by day")


def per_merchant(measures, columns, gate: str, keyed, extra: str = "", extra_columns=()) -> str:
    """A row per merchant-day that has a `keyed` measure, and one for each day without any."""
    keys = ", ".join(f"'{k}'" for k in keyed)
    names = [c.rpartition(" as ")[2] for c in columns]
    nothing = ", ".join(f"0 as {n}" for n in names)
    shown = ", ".join([*names, *(f"coalesce({c}, 0) as {c}" for c in extra_columns)])
    return (f"with {SPINE},\n{long_rows(measures)},\n"
            f"cells as (select day, account, {', '.join(columns)} from long group by all having bool_or(measure in ({keys}))),\n"
            f"filled as (select * from cells union all by name select day, null as account, {nothing} from spine where day not in (select day from cells))\n"
            f"select day, account, {shown} from filled {extra}\nwhere day >= (select min(day) from long where measure = '{gate}')")


LEDGER, MERCHANT_LEDGER = "balance_transactions", "connected_account_balance_transactions"
_VOLUME_KINDS = {"captured_authorizations": "type in ('charge', 'payment')", "refunds": "type in ('refund', 'payment_refund')"}
_COUNT_OF = {"captured_authorizations": "captured_authorizations_count", "refunds": "refund_count",
             "application_fees": "application_fee_count", "application_fee_refunds": "application_fee_refund_count"}
#: Ledger rows that are neither transfers nor payouts.
_BUSINESS = "not contains(type, 'transfer') and type != 'payout'"


def _failures(account: str):
    out = [Measure("ledger", MERCHANT_LEDGER, "created", account=account)]
    for kind in ("transfer", "payout"):
        out.append(Measure(f"{kind}_failure", MERCHANT_LEDGER, "created", f"type = '{kind}_failure'", account=account))
        for sign, test in (("credit", "amount > 0"), ("debit", "amount < 0")):
            out.append(Measure(f"{kind}_{sign}_failures", MERCHANT_LEDGER, "created", f"type = '{kind}_failure' and {test}", "amount", account=account))
    return out


_FAILURE_NAMES = [f"{kind}_{sign}_failure" for kind in ("transfer", "payout") for sign in ("credit", "debit")]
_FAILURE_COLUMNS = [money(f"{n}s") for n in _FAILURE_NAMES] + [number(f"{n}_count", f"{n}s") for n in _FAILURE_NAMES]
FAILED_TRANSFERS_DAILY = daily(_failures("null"), _FAILURE_COLUMNS, "ledger")
_MERCHANT_FAILURES = _failures("account")[1:]
# the report's first day is that of the first failure of either kind
FAILED_TRANSFERS_MERCHANT_DAILY = per_merchant(
    [*_MERCHANT_FAILURES, *(Measure("any", m.source, m.clock, m.when, account="account") for m in _MERCHANT_FAILURES if m.add == "null")],
    _FAILURE_COLUMNS, "any", ["any"])


def _volume(source: str, account: str = "null"):
    return [Measure("ledger", source, "created", _BUSINESS, account=account),
            *(Measure(n, source, "created", w, "amount", account=account) for n, w in _VOLUME_KINDS.items())]


def _volume_columns(*more: str):
    names = [*_VOLUME_KINDS, *more]
    return [money(n) for n in names] + [number(_COUNT_OF[n], n) for n in names]


FEE_DAILY = daily(
    [*_volume(LEDGER), Measure("application_fees", LEDGER, "created", "type = 'application_fee'", "amount"),
     Measure("application_fee_refunds", LEDGER, "created", "type = 'application_fee_refund'", "amount")],
    _volume_columns("application_fees", "application_fee_refunds"), "ledger")

FEE_MERCHANT_DAILY = per_merchant(
    [*_volume(MERCHANT_LEDGER, "account"),
     Measure("application_fees", "application_fees", "created", add="amount", account="account_id"),
     Measure("application_fee_refunds", "(select r.*, f.account_id from application_fee_refunds r, application_fees f where r.fee_id = f.id)",
             "created", add="amount", account="account_id")],
    _volume_columns("application_fees", "application_fee_refunds"), "ledger",
    ["ledger", "application_fees", "application_fee_refunds"])

# the two chargeback movements of an adjustment, told by how its text begins
_MOVED = {"disputes": "type = 'adjustment' and starts_with(lower(description), 'chargeback withdrawal')",
          "disputes_won": "type = 'adjustment' and starts_with(lower(description), 'chargeback reversal')"}
_DISPUTES = [Measure(n, LEDGER, "created", w, "amount", "source_id") for n, w in _MOVED.items()]
_DISPUTE_NUMBERS = [distinct("dispute_count", "disputes"), distinct("disputes_won_count", "disputes_won")]


def _declines(account: str = "null"):
    return Measure("declines", "charges", "created", "outcome_type = 'issuer_declined'", "amount", account=account)


_CONNECT_PAYOUTS = Measure("connect_payouts", "connected_account_transfers", "date", "status = 'paid' and type in ('card', 'bank_account')", "amount", open_end=True)
# selected by the day a payout was made, shown on the day it arrives
_PLATFORM_PAYOUTS = Measure("platform_payouts", "transfers", "created", "status = 'paid' and type = 'bank_account'", "amount", bucket="date")

VOLUME_DAILY = daily(
    [*_volume(LEDGER), *_DISPUTES, _declines(), _PLATFORM_PAYOUTS, _CONNECT_PAYOUTS],
    [*_volume_columns(), *map(money, ("declines", "disputes", "disputes_won", "platform_payouts", "connect_payouts")),
     *_DISPUTE_NUMBERS, number("decline_count", "declines"), number("platform_payout_count", "platform_payouts"), number("connect_payout_count", "connect_payouts")],
    "ledger")

VOLUME_MERCHANT_DAILY = per_merchant(
    [*_volume(MERCHANT_LEDGER, "account"), _declines("destination_id"),
     Measure("connect_payouts", "connected_account_transfers", "date", "status = 'paid'", "amount", account="account")],
    [*_volume_columns(), money("declines"), money("connect_payouts"), number("decline_count", "declines"), number("connect_payout_count", "connect_payouts")],
    "ledger", ["ledger", "connect_payouts"],
    # a row repeats for every dispute moved on its day
    f"""left join (
  select cast(a.created as date) as day, c.destination_id as account,
    sum(if({_MOVED['disputes']}, a.amount, 0)) / 100.0 as disputes, sum(if({_MOVED['disputes_won']}, a.amount, 0)) / 100.0 as disputes_won,
    cast(bool_or({_MOVED['disputes']}) and a.source_id is not null as bigint) as dispute_count,
    cast(bool_or({_MOVED['disputes_won']}) and a.source_id is not null as bigint) as disputes_won_count
  from (select *, source_id as dispute from {LEDGER} where type = 'adjustment' and {in_range('cast(created as date)')}) a
  left join (select id as dispute, charge_id from disputes) d using (dispute)
  left join (select id as charge_id, destination_id from charges) c using (charge_id)
  group by cast(a.created as date), c.destination_id, a.source_id, charge_id) using (day, account)""",
    ("disputes", "disputes_won", "dispute_count", "disputes_won_count"))

# fee texts by how they begin or end
_SAYS = {"card": "starts_with(text, 'card payments')", "monthly": "starts_with(text, 'sigma') or ends_with(text, 'active reader fee') or starts_with(text, 'connect')"}
_TEXTED = f"(select *, lower(description) as text from {LEDGER} where type = 'stripe_fee')"
_FEES = [
    Measure("stripe_dispute_fees", LEDGER, "created", "type = 'adjustment' and starts_with(lower(description), 'chargeback')", "fee"),
    Measure("platform_fees", LEDGER, "created", "starts_with(type, 'application_fee')", "amount"),
    Measure("interchange_cash", LEDGER, "created", "type = 'network_cost'", "-amount"),
    Measure("stripe_icplus_fees_cash", _TEXTED, "created", _SAYS["card"], "-amount"),
    Measure("stripe_other_fees_monthly_cash", _TEXTED, "created", _SAYS["monthly"], "-amount"),
    Measure("stripe_other_fees_daily_cash", _TEXTED, "created", f"not ({_SAYS['card']} or {_SAYS['monthly']})", "-amount"),
    *(Measure(n, "icplus_fees", "incurred_at", f"fee_category = '{c}' and attribution_start_time is null and attribution_end_time is null", "billing_amount")
      for n, c in (("interchange_rec", "network_cost"), ("stripe_icplus_fees_rec", "stripe_fee"))),
]

# Each period fee is laid out over the midnights it spans; amounts are added up
# exactly per day and period length before the one division.
_SPREAD = """spread as (
  select day, sum(total / nullif(days, 0)) as share
  from (
    select day, days, sum(billing_amount) as total
    from (
      select days, billing_amount,
        unnest(generate_series(greatest(if(a = date_trunc('day', a), a, date_trunc('day', a) + interval 1 day), timestamp '{d0}'),
                               least(date_trunc('day', b), timestamp '{d1}'), interval 1 day))::date as day
      from (select attribution_start_time as a, attribution_end_time as b, billing_amount,
              cast(floor(date_diff('second', attribution_start_time, attribution_end_time) / 86400) as bigint) as days
            from icplus_fees where attribution_start_time is not null and attribution_end_time is not null))
    group by day, days)
  group by day)"""

_PLATFORM_COLUMNS = [
    distinct("connect_accounts", "accounts"), *_volume_columns(),
    *map(money, ("declines", "disputes", "disputes_won", "stripe_dispute_fees", "platform_fees", "interchange_rec", "stripe_icplus_fees_rec", "interchange_cash",
                 "stripe_icplus_fees_cash", "stripe_other_fees_daily_cash", "stripe_other_fees_monthly_cash", "connect_payouts")),
    *_DISPUTE_NUMBERS, number("decline_count", "declines"), number("connect_payout_count", "connect_payouts")]
_PLATFORM = daily([*_volume(LEDGER), *_DISPUTES, _declines(), _CONNECT_PAYOUTS, *_FEES, Measure("accounts", "charges", "created", key="destination_id")], _PLATFORM_COLUMNS, "ledger")
PLATFORM_DAILY = f"""with {_SPREAD},
report as ({_PLATFORM}),
settled as (
  select cast(date as date) as day, status as platform_payout_status, sum(amount) / 100.0 as platform_payouts, count(*) as platform_payout_count
  from transfers where type = 'bank_account' and status in ('pending', 'in_transit', 'paid') and {in_range('cast(created as date)')}
  group by all)
select report.*, platform_payout_status, coalesce(platform_payouts, 0) as platform_payouts, coalesce(platform_payout_count, 0) as platform_payout_count,
  coalesce(round(cast(share as double) / 100.0, 6), 0) as attr_interchange_rec
from report left join settled using (day) left join spread using (day)
"""
