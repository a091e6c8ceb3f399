"""DuckDB oracle texts for the operator-level queries on the driver tables."""

from .oracle_daily import SPINE, in_range
from .oracle_reports import _dec

CAL = SPINE.replace("spine as", "cal as")


def rng(c: str) -> str:
    return in_range(f"cast({c} as date)")


_C = "cast(round({x} * 100) as bigint)"


def c(x: str) -> str:
    return _C.format(x=x)


DAY_SPINE_ORDERS = f"""
with {CAL},
m as (select cast(o_orderdate as date) as day, sum({c('o_totalprice')}) as cents,
    count(o_orderkey) as n
  from orders where {rng('o_orderdate')} group by 1)
select cal.day, coalesce(cents / 100.0, 0) as order_total, cast(coalesce(n, 0) as bigint) as order_count
from m right join cal on cal.day = m.day
where cal.day >= (select min(day) from m)
"""

MONTH_SPINE_ORDERS = f"""
with months as (select strftime(generate_series, '%Y-%m') as month
  from generate_series(timestamp '{{m0}}-01', timestamp '{{m1}}-01', interval 1 month)),
m as (select strftime(o_orderdate, '%Y-%m') as month, count(o_orderkey) as n,
    sum({c('o_totalprice')}) as cents from orders group by 1)
select months.month, cast(strptime(months.month, '%Y-%m') as date) as month_start,
  cast(coalesce(n, 0) as bigint) as order_count, coalesce(cents / 100.0, 0) as order_total
from months left join m on months.month = m.month
"""

EVENTS_NEW_YORK_DAILY = f"""
select cast((ts at time zone 'UTC') at time zone 'America/New_York' as date) as day, event_type,
  count(event_id) as events, sum({c('value')}) / 100.0 as value
from events group by 1, 2
"""

ATTRIBUTED_ORDER_VALUE = f"""
with {CAL},
o as (select date_trunc('month', o_orderdate) as s, date_trunc('month', o_orderdate) + interval 1 month as e,
    cast({c('o_totalprice')} as decimal(18,4)) as amount from orders),
a as (select day, sum(total / n) as attr
  from (select cal.day, date_sub('day', s, e) as n, sum(amount) as total
        from cal cross join o
        where cast(e as date) >= date '{{d0}}' and cast(s as date) <= date '{{d1}}'
          and cast(cal.day as timestamp) between s and e
        group by 1, 2) per_length
  group by 1)
select cal.day, coalesce(round(cast(attr as double) / 100.0, 6), 0) as attributed
from cal left join a on cal.day = a.day
"""

NATION_KEY_MENTIONS = """
select n.n_nationkey, n.n_name, count(e.event_id) as matching_events
from nation n left join events e on e.props like concat('%', cast(n.n_nationkey as varchar), '%')
group by 1, 2
"""

PAGE_URL_PARTS = r"""
select page_id,
  nullif(regexp_extract(url, '^https?://[^/]+/([a-z]{2})/', 1), '') as lang,
  regexp_matches(url, '^https://') as secure,
  try_cast(nullif(regexp_extract(url, '/([0-9]+)', 1), '') as bigint) as page_no,
  substr(url, position('//' in url) + 2, 10) as host_prefix
from pages
"""

LINEITEM_PIVOT = f"""
select l_returnflag, l_linestatus,
  sum({c('l_extendedprice')}) / 100.0 as gross,
  sum(case when l_discount >= 0.05 then {c('l_extendedprice')} else 0 end) / 100.0 as discounted_gross,
  cast(sum(case when year(l_shipdate) >= 2000 then 1 else 0 end) as bigint) as recent_lines,
  count(l_orderkey) as lines, cast(count_if(l_tax = 0.0) as bigint) as zero_tax_lines
from lineitem group by 1, 2
"""

SUPPLIER_DISTINCT_ORDERS = """
select l_suppkey, count(distinct l_orderkey) as orders,
  count(distinct case when l_returnflag = 'R' then l_orderkey end) as returned_orders,
  cast(count(distinct case when l_returnflag = 'R' then l_orderkey end) * 1.5 as double)
    as returned_priced,
  count(distinct l_partkey) as parts
from lineitem group by 1
"""

CUSTOMER_TWO_LEVEL = f"""
with per_order as (select l_orderkey, sum({c('l_extendedprice')}) as order_cents
  from lineitem group by 1)
select o.o_custkey, count(o.o_orderkey) as orders,
  sum(coalesce(p.order_cents, 0)) / 100.0 as total,
  cast(round(sum(p.order_cents * 0.5 * 0.01)) as bigint) as fee_cents
from orders o left join per_order p on p.l_orderkey = o.o_orderkey
group by 1
"""

ORDER_SHIP_UNION = f"""
select day, kind, count(*) as rows, sum(cents) / 100.0 as amount
from (select cast(o_orderdate as date) as day, 'order' as kind, {c('o_totalprice')} as cents
      from orders
      union all
      select cast(l_shipdate as date), 'ship', {c('l_extendedprice')} from lineitem) u
group by 1, 2
"""

ORDER_SHIP_LABELS = """
select cast(o_orderdate as date) as day, o_orderpriority as label, cast(null as varchar) as flag
from orders
union
select cast(l_shipdate as date), null, l_returnflag from lineitem
"""

CUSTOMERS_WITHOUT_ORDERS = f"""
select c.c_custkey, c.c_name from customer c
left join (select * from orders where {rng('o_orderdate')}) o on o.o_custkey = c.c_custkey
where o.o_orderkey is null
"""

CUSTOMERS_IN_MONTHS = """
select c_custkey, c_name from customer
where c_custkey in (select o_custkey from orders
                    where strftime(date_trunc('month', o_orderdate), '%Y-%m') in ({months}))
"""

MIXED_STATUS_CUSTOMERS = """
select o_custkey, count_if(o_orderstatus = 'F') as fulfilled, count_if(o_orderstatus = 'O') as open
from orders group by 1
having count_if(o_orderstatus = 'F') > 0 and count_if(o_orderstatus = 'O') > 0
"""

NATION_ORDER_VALUE = f"""
with per_nation as (
  select c.c_nationkey as n_nationkey, sum({c('o.o_totalprice')}) as cents
  from orders o join customer c on c.c_custkey = o.o_custkey group by 1),
n as (select n_nationkey, case when n_regionkey = 2 then 'jpy' when n_regionkey = 3 then 'eur'
    else 'usd' end as currency from nation)
select n.n_nationkey, n.currency, {_dec('n.currency', 'p.cents', 2)} as amount
from n left join per_nation p on p.n_nationkey = n.n_nationkey
"""

SHIP_LAG_BUCKETS = """
select case when date_diff('day', cast(o.o_orderdate as date), cast(l.l_shipdate as date)) < 0
         then 'before'
       when date_diff('day', cast(o.o_orderdate as date), cast(l.l_shipdate as date)) <= 30
         then 'within_30d'
       else 'later' end as bucket,
  strftime(cast(o.o_orderdate as date) - interval 1 month, '%Y-%m') as month_before,
  count(*) as lines
from lineitem l join orders o on l.l_orderkey = o.o_orderkey
where o.o_orderdate >= timestamp '1995-01-01'
group by 1, 2
"""

DAILY_CHAIN = f"""
with {CAL},
o as (select cast(o_orderdate as date) as day, count(*) as orders from orders
      where {rng('o_orderdate')} group by 1),
s as (select cast(l_shipdate as date) as day, count(*) as shipped from lineitem
      where {rng('l_shipdate')} group by 1),
r as (select cast(l_shipdate as date) as day, count(*) as returned from lineitem
      where {rng('l_shipdate')} and l_returnflag = 'R' group by 1)
select cal.day, cast(coalesce(orders, 0) as bigint) as orders,
  cast(coalesce(shipped, 0) as bigint) as shipped, cast(coalesce(returned, 0) as bigint) as returned
from cal
full outer join o on cal.day = o.day
full outer join s on cal.day = s.day
full outer join r on cal.day = r.day
where cal.day >= (select min(day) from o)
"""

POLYMORPHIC_REFS = """
with refs as (select ref, count(*) as uses from (
    select 'supp_' || l_suppkey as ref from lineitem
    union all select 'part_' || l_partkey from lineitem
    union all select 'cust_' || o_custkey from orders) u group by 1)
select refs.ref, coalesce(s.s_name, c.c_name, p.p_name) as name, refs.uses
from refs
left join supplier s on refs.ref = 'supp_' || s.s_suppkey
left join customer c on refs.ref = 'cust_' || c.c_custkey
left join part p on refs.ref = 'part_' || p.p_partkey
"""

EVENT_METADATA = """
with kv as (select event_id, 'type' as key, event_type as value from events
            union all select event_id, 'user', cast(user_id as varchar) from events)
select t.value as event_type, c.c_nationkey, count(t.event_id) as events
from (select * from kv where key = 'type') t
left join (select * from kv where key = 'user') u on u.event_id = t.event_id
left join customer c on cast(c.c_custkey as varchar) = u.value
group by 1, 2
"""
