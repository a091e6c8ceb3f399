"""DuckDB oracle texts for R2 / R3 (merchant x day) and R4 (merchant x month).

R2 / R3: a merchant's ledger per day and currency, with what else happened to
the merchant that day (one row per measure in a long relation, see
oracle_daily) and the payout batches its payments went into. R4: volume per
merchant, month and currency, with the month's fees of the merchant.
"""

from __future__ import annotations

from .oracle_daily import MERCHANT_LEDGER, SPINE, in_range


def merchant_volume_sql(tz: str | None, with_unlinked: bool) -> str:
    def day(c: str) -> str:
        return f"cast({c} as date)" if tz is None else f"cast(timezone('{tz}', timezone('UTC', {c})) as date)"

    def happened(name, source, clock, account, value, when="true"):
        return f"select {day(clock)} as day, {account} as account, '{name}' as measure, cast({value} as decimal(38, 8)) as v from {source} where ({when}) and {in_range(day(clock))}"

    # priced once per charge and day: a charge counts however many fees it has
    priced = lambda flag: f"(select distinct {day('incurred_at')} as day, destination_id, charge_id, min(incurred_at) over (partition by {day('incurred_at')}, destination_id, charge_id) as incurred_at from icplus_fees where card_present = {flag} and charge_id is not null)"
    extra = [
        happened("transfers", "transfers", "created", "destination_id", "amount", "type = 'stripe_account' and source_type = 'card' and status = 'paid'"),
        happened("network_costs", "icplus_fees", "incurred_at", "destination_id", "billing_amount", "fee_category = 'network_cost'"),
        happened("stripe_fees", "icplus_fees", "incurred_at", "destination_id", "billing_amount", "fee_category = 'stripe_fee'"),
        happened("stripe_terminal_fees", priced("true"), "incurred_at", "destination_id", "2.0"),
        happened("stripe_radar_fees", priced("false"), "incurred_at", "destination_id", "1.5"),
    ]
    names = ["transfers", "network_costs", "stripe_fees", "stripe_terminal_fees", "stripe_radar_fees"]
    if with_unlinked:
        extra += [
            happened("platform_unlinked_refunds", "(select r.created, r.amount, (select any_value(account) from connected_account_transfers where id = m.value) as account "
                     "from refunds r, refunds_metadata m where m.refund_id = r.id and m.key = 'parent_transfer' and r.charge_id is null and r.status = 'succeeded')",
                     "created", "account", "amount"),
            happened("unlinked_refund_account_debits", "connected_account_transfers", "created", "account", "amount",
                     "destination_id = 'acct_platform' and kind = 'book' and source_type = 'card' and type = 'stripe_account' and status = 'paid' and not (automatic or reversed) "
                     "and id in (select transfer_id from connected_account_transfers_metadata where key = 'transaction_type' and value = 'unreferenced-refund')"),
        ]
        names += ["platform_unlinked_refunds", "unlinked_refund_account_debits"]
    cents = lambda test, value="amount": f"coalesce(sum({value}) filter ({test}), 0) / 100.0"
    payment, refund = "type in ('payment', 'charge')", "type in ('payment_refund', 'refund')"
    lag = "cast(available_on as date) - cast(created as date)"
    ledger = {"total_charges": cents(payment), "refunds": cents(refund), "application_fees": cents(payment, "-fee"),
              "adjustments": cents("type = 'adjustment'"), "connect_payouts_paid": cents("type = 'payout'"),
              **{f"refunds_t{i}": cents(f"{refund} and {lag} = {i}") for i in range(6)}}
    zero = lambda n: f"coalesce({n}, 0) as {n}"
    return f"""
with {SPINE},
entries as (
  -- a payout counts on the day it becomes available, all else on the day it was made
  select *, if(type = 'payout', {day('available_on')}, {day('created')}) as day
  from {MERCHANT_LEDGER} where not contains(type, 'transfer') and {day('created')} <= date '{{d1}}'),
ledger as (
  select day, account, currency, {', '.join(f'{v} as {k}' for k, v in ledger.items())}
  from entries where {in_range('day')} group by day, account, currency),
happened as ({' union all '.join(extra)}),
beside as (select day, account, {', '.join(f"cast(sum(v) filter (measure = '{n}') as double) / 100.0 as {n}" for n in names)} from happened where account is not null group by day, account),
batches as (
  select distinct day, account, automatic_transfer_id as batch from (select *, {day('created')} as day from {MERCHANT_LEDGER} where {payment}) where {in_range('day')}),
paid as (select id as batch, cast(date as date) as batch_paid_date, amount / 100.0 as batched_connect_payout, status as batch_status from connected_account_transfers),
called as (select id as account, ifnull(business_name, business_url) as business_name from connected_accounts)
select day as activity_date, account as destination_id, business_name, currency, {', '.join(map(zero, [*ledger, *names, 'batched_connect_payout']))}, batch_paid_date, batch_status
from spine left join ledger using (day) left join beside using (day, account) left join (batches left join paid using (batch)) using (day, account) left join called using (account)
"""


MERCHANT_VOLUME_DAILY = merchant_volume_sql("America/New_York", True)
MERCHANT_VOLUME_DAILY_UTC = merchant_volume_sql(None, False)

_METHODS = ("card", "bancontact", "ideal")
MERCHANT_MONTHLY = f"""
with months as (select strftime(unnest(generate_series(timestamp '{{m0}}-01', timestamp '{{m1}}-01', interval 1 month)), '%Y-%m') as month),
sold as (
  select destination_id as account, strftime(created, '%Y-%m') as month, currency, sum(amount) / 100.0 as total_volume, count(*) as total_num_txns,
    {', '.join(f"coalesce(sum(amount) filter (payment_method_type = '{m}'), 0) / 100.0 as {m}_volume, count(*) filter (payment_method_type = '{m}') as {m}_num_txns" for m in _METHODS)}
  from charges where captured group by all),
-- what the month cost the merchant: itemised card fees, ledger fees of other methods
costs as (
  select destination_id as account, strftime(incurred_at, '%Y-%m') as month, fee_category as what, billing_amount as cents, null as screened from icplus_fees
  union all
  select destination_id, strftime(incurred_at, '%Y-%m'), 'screening', null, charge_id from icplus_fees where not card_present
  union all
  select c.destination_id, strftime(c.created, '%Y-%m'), 'stripe_fee', (select any_value(b.fee) from balance_transactions b where b.id = c.balance_transaction_id), null
  from charges c where c.payment_method_type != 'card' and c.created > timestamp '{{m0}}-01'),
cost as (
  select account, month, coalesce(sum(cents) filter (what = 'network_cost'), 0) as network, coalesce(sum(cents) filter (what = 'stripe_fee'), 0) as processing,
    count(distinct screened) * 1.5 as screening
  from costs where month is not null group by account, month),
earned as (
  select account, strftime(created, '%Y-%m') as month, currency, sum(ifnull(detail, 0)) / 100.0 as platform_application_fees
  from (select c.*, d.amount as detail from connected_account_charges c
        left join connected_account_balance_transaction_fee_details d using (balance_transaction_id)) where captured group by all),
called as (select id as account, business_name from connected_accounts)
select account, month, currency, business_name, total_volume, {', '.join(f'{m}_volume' for m in _METHODS)}, total_num_txns, {', '.join(f'{m}_num_txns' for m in _METHODS)},
  platform_application_fees, cast(round(network * 0.01, 3) as double) as icplus_fees, cast(round(processing * 0.01, 3) as double) as stripe_fees,
  cast(screening as double) / 100.0 as radar_fees
from sold semi join months using (month) join cost using (account, month) left join called using (account) left join earned using (account, month, currency)
"""
