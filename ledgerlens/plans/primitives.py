"""Operator-level queries on the driver's own tables.

Each exercises one group of inventory ids on its own, with the same library
operators the reports use, over whole driver tables (orders, lineitem,
customer, nation, part, supplier, events, pages). The D4 day-only fan-out
has no query here (it forms all pairs within a day; see README).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import (count_if, decimalize, distinct_counts, in_days, local_day, sum_if,
                         zero_major)
from ..operators.attribution import attributed_daily
from ..operators.calendars import calendar_days, gate_joined, month_bounds, month_range
from ..operators.links import contains_join

NEW_YORK = "America/New_York"


def _cents(c: str) -> F.Column:
    return F.round(F.col(c) * F.lit(100)).cast("bigint")


def _major(c) -> F.Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("double") / F.lit(100.0)


def day_spine_orders(t, d0, d1) -> DataFrame:
    """Calendar left join daily order totals, zero-filled, gated."""
    o = t.orders.where(in_days("o_orderdate", d0, d1))
    m = o.groupBy(local_day("o_orderdate").alias("day")).agg(
        F.sum(_cents("o_totalprice")).alias("cents"), F.count("o_orderkey").alias("n"))
    joined = gate_joined(calendar_days(t.spark, d0, d1).join(m, "day", "left"), "n")
    return joined.select(
        "day", zero_major("cents").alias("order_total"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("order_count"))


def month_spine_orders(t, m0, m1) -> DataFrame:
    """Month list joined to monthly orders on a formatted key."""
    lo, hi = month_bounds(m0, m1)
    months = month_range(t.spark, m0, m1).select(F.date_format("month", "yyyy-MM").alias("month"))
    o = t.orders.where((F.col("o_orderdate") >= F.lit(lo).cast("timestamp_ntz"))
                       & (F.col("o_orderdate") < F.lit(hi).cast("timestamp_ntz")))
    m = o.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(
        F.count("o_orderkey").alias("n"), F.sum(_cents("o_totalprice")).alias("cents"))
    return months.join(m, "month", "left").select(
        "month", F.to_date(F.col("month"), "yyyy-MM").alias("month_start"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("order_count"),
        zero_major("cents").alias("order_total"))


def events_new_york_daily(t) -> DataFrame:
    """events bucketed on New York days."""
    e = t.events
    return e.groupBy(local_day("ts", NEW_YORK).alias("day"), "event_type").agg(
        F.count("event_id").alias("events"), _major(F.sum(_cents("value"))).alias("value"))


def attributed_order_value(t, d0, d1) -> DataFrame:
    """Each order's value spread over the days of its order month."""
    start = F.date_trunc("month", "o_orderdate").cast("timestamp_ntz")
    o = t.orders.select(start.alias("attribution_start_time"),
                        (start + F.expr("interval 1 month")).alias("attribution_end_time"),
                        _cents("o_totalprice").cast("decimal(18,4)").alias("billing_amount"))
    a = attributed_daily(o, d0, d1)
    # shares are non-terminating divisions: stated output precision 1e-6
    return a.select("day", F.coalesce(F.round(F.col("attr_interchange") / F.lit(100), 6)
                                      .cast("double"), F.lit(0.0)).alias("attributed"))


def nation_key_mentions(t) -> DataFrame:
    """Events whose props text contains a nation's key (LIKE containment)."""
    n = t.nation.select(F.col("n_nationkey"), "n_name",
                        F.col("n_nationkey").cast("string").alias("_key"))
    e = t.events.select("event_id", "props")
    j = contains_join(n, e, "n_nationkey", "_key", "event_id", "props")
    return j.groupBy("n_nationkey", "n_name").agg(F.count("event_id").alias("matching_events"))


def page_url_parts(t) -> DataFrame:
    """Regex and position parsing of page URLs."""
    url = F.col("url")
    return t.pages.select(
        "page_id",
        F.nullif(F.regexp_extract(url, r"^https?://[^/]+/([a-z]{2})/", 1), F.lit("")).alias("lang"),
        url.rlike(r"^https://").alias("secure"),
        F.nullif(F.regexp_extract(url, r"/([0-9]+)", 1), F.lit("")).try_cast("bigint")
        .alias("page_no"),
        url.substr(F.locate("//", url) + F.lit(2), F.lit(10)).alias("host_prefix"))


def lineitem_pivot(t) -> DataFrame:
    """Group by flag and status with conditional sums and counts, in cents."""
    li = t.lineitem
    cents = _cents("l_extendedprice")
    return li.groupBy("l_returnflag", "l_linestatus").agg(
        _major(F.sum(cents)).alias("gross"),
        _major(sum_if(F.col("l_discount") >= F.lit(0.05), cents)).alias("discounted_gross"),
        sum_if(F.year("l_shipdate") >= 2000, 1).cast("bigint").alias("recent_lines"),
        F.count("l_orderkey").alias("lines"),
        count_if(F.col("l_tax") == F.lit(0.0)).alias("zero_tax_lines"))


def supplier_distinct_orders(t, rate: float = 1.5) -> DataFrame:
    """Exact distinct and conditional distinct counts, priced."""
    li = t.lineitem
    orders = distinct_counts(li, ["l_suppkey"], "l_orderkey", orders=F.lit(True), returned_orders=F.col("l_returnflag") == "R")
    parts = distinct_counts(li, ["l_suppkey"], "l_partkey", parts=F.lit(True))
    every = orders.unionByName(parts, allowMissingColumns=True).unionByName(li.select("l_suppkey").distinct(), allowMissingColumns=True)
    return (every.groupBy("l_suppkey").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("orders", "returned_orders", "parts")])
            .withColumn("returned_priced", F.col("returned_orders") * F.lit(rate)))


def customer_two_level(t) -> DataFrame:
    """Per order, then per customer; rescale and round."""
    per_order = t.lineitem.groupBy("l_orderkey").agg(
        F.sum(_cents("l_extendedprice")).alias("order_cents"))
    o = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    j = o.join(per_order, "l_orderkey", "left")
    return j.groupBy("o_custkey").agg(
        F.count("l_orderkey").alias("orders"),
        _major(F.sum(F.coalesce("order_cents", F.lit(0)))).alias("total"),
        F.round(F.sum(F.col("order_cents") * F.lit(0.5).cast("decimal(2,1)")
                      * F.lit(0.01).cast("decimal(3,2)"))).cast("bigint").alias("fee_cents"))


def order_ship_union(t) -> DataFrame:
    """Union all of order days and ship days, re-aggregated."""
    o = t.orders.select(local_day("o_orderdate").alias("day"), F.lit("order").alias("kind"),
                        _cents("o_totalprice").alias("cents"))
    s = t.lineitem.select(local_day("l_shipdate").alias("day"), F.lit("ship").alias("kind"),
                          _cents("l_extendedprice").alias("cents"))
    return o.unionByName(s).groupBy("day", "kind").agg(
        F.count("*").alias("rows"), _major(F.sum("cents")).alias("amount"))


def order_ship_labels(t) -> DataFrame:
    """Distinct union of unlike branches, typed nulls filling the gaps."""
    o = t.orders.select(local_day("o_orderdate").alias("day"),
                        F.col("o_orderpriority").alias("label"),
                        F.lit(None).cast("string").alias("flag"))
    s = t.lineitem.select(local_day("l_shipdate").alias("day"),
                          F.lit(None).cast("string").alias("label"),
                          F.col("l_returnflag").alias("flag"))
    return o.unionByName(s).distinct()


def customers_without_orders(t, d0, d1) -> DataFrame:
    """Customers with no order in a date range (anti join)."""
    o = t.orders.where(in_days("o_orderdate", d0, d1)).select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.join(o, "c_custkey", "left_anti").select("c_custkey", "c_name")


def customers_in_months(t, months) -> DataFrame:
    """Customers with an order in listed months (semi join on a month list)."""
    wanted = t.spark.createDataFrame([(m,) for m in months], "month string")
    o = t.orders.select(F.col("o_custkey").alias("c_custkey"),
                        F.date_format(F.date_trunc("month", "o_orderdate"), "yyyy-MM")
                        .alias("month"))
    hit = o.join(F.broadcast(wanted), "month", "left_semi").select("c_custkey")
    return t.customer.join(hit, "c_custkey", "left_semi").select("c_custkey", "c_name")


def mixed_status_customers(t) -> DataFrame:
    """P20, A5: customers with at least one fulfilled and one open order (having)."""
    st = F.col("o_orderstatus")
    return t.orders.groupBy("o_custkey").agg(
        count_if(st == "F").alias("fulfilled"), count_if(st == "O").alias("open")) \
        .where((F.col("fulfilled") > 0) & (F.col("open") > 0))


def nation_order_value(t) -> DataFrame:
    """Order value per nation in a pretend currency, decimalised by exponent."""
    n = t.nation.select("n_nationkey", F.when(F.col("n_regionkey") == 2, F.lit("jpy"))
                        .when(F.col("n_regionkey") == 3, F.lit("eur")).otherwise(F.lit("usd"))
                        .alias("currency"))
    c = t.customer.select(F.col("c_custkey").alias("o_custkey"),
                          F.col("c_nationkey").alias("n_nationkey"))
    per_cust = t.orders.groupBy("o_custkey").agg(F.sum(_cents("o_totalprice")).alias("cents"))
    per_nation = per_cust.join(c, "o_custkey", "inner").groupBy("n_nationkey") \
        .agg(F.sum("cents").alias("cents"))
    return n.join(per_nation, "n_nationkey", "left").select(
        "n_nationkey", "currency", decimalize(F.col("currency"), F.col("cents"), 2).alias("amount"))


def ship_lag_buckets(t) -> DataFrame:
    """order-to-ship lag buckets by the month before the order."""
    o = t.orders.where(F.col("o_orderdate") >= F.lit("1995-01-01").cast("timestamp_ntz")) \
        .select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    j = t.lineitem.select("l_orderkey", "l_shipdate").join(o, "l_orderkey", "inner")
    lag = F.datediff(F.to_date("l_shipdate"), F.to_date("o_orderdate"))
    bucket = F.when(lag < 0, F.lit("before")).when(lag <= 30, F.lit("within_30d")) \
        .otherwise(F.lit("later"))
    return j.groupBy(bucket.alias("bucket"),
                     F.date_format(F.add_months(F.to_date("o_orderdate"), -1), "yyyy-MM")
                     .alias("month_before")).agg(F.count("*").alias("lines"))


def daily_chain(t, d0, d1) -> DataFrame:
    """Spine full outer joined to three daily measures, gated at the first order."""
    orders = t.orders.where(in_days("o_orderdate", d0, d1)) \
        .groupBy(local_day("o_orderdate").alias("day")).agg(F.count("*").alias("orders"))
    li = t.lineitem.where(in_days("l_shipdate", d0, d1))
    shipped = li.groupBy(local_day("l_shipdate").alias("day")).agg(F.count("*").alias("shipped"))
    returned = li.where(F.col("l_returnflag") == "R") \
        .groupBy(local_day("l_shipdate").alias("day")).agg(F.count("*").alias("returned"))
    cal = gate_joined(calendar_days(t.spark, d0, d1).join(orders, "day", "left"), "orders")
    out = cal.join(shipped, "day", "left").join(returned, "day", "left")
    return out.select("day", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
                               for c in ("orders", "shipped", "returned")])


def polymorphic_refs(t) -> DataFrame:
    """One reference column resolved against supplier, customer and part."""
    refs = (t.lineitem.select(F.concat(F.lit("supp_"), F.col("l_suppkey")).alias("ref"))
            .unionByName(t.lineitem.select(F.concat(F.lit("part_"), F.col("l_partkey")).alias("ref")))
            .unionByName(t.orders.select(F.concat(F.lit("cust_"), F.col("o_custkey")).alias("ref"))))
    counted = refs.groupBy("ref").agg(F.count("*").alias("uses"))
    s = t.supplier.select(F.concat(F.lit("supp_"), F.col("s_suppkey")).alias("ref"), "s_name")
    c = t.customer.select(F.concat(F.lit("cust_"), F.col("c_custkey")).alias("ref"), "c_name")
    p = t.part.select(F.concat(F.lit("part_"), F.col("p_partkey")).alias("ref"), "p_name")
    j = counted.join(s, "ref", "left").join(c, "ref", "left").join(p, "ref", "left")
    return j.select("ref", F.coalesce("s_name", "c_name", "p_name").alias("name"), "uses")


def event_metadata(t) -> DataFrame:
    """Events as key/value rows; filter on a key, join on a value used as a key."""
    e = t.events
    kv = (e.select("event_id", F.lit("type").alias("key"), F.col("event_type").alias("value"))
          .unionByName(e.select("event_id", F.lit("user").alias("key"),
                                F.col("user_id").cast("string").alias("value"))))
    typ = kv.where(F.col("key") == "type").select("event_id", F.col("value").alias("event_type"))
    usr = kv.where(F.col("key") == "user").select("event_id", F.col("value").alias("_user"))
    cust = t.customer.select(F.col("c_custkey").cast("string").alias("_user"), "c_nationkey")
    j = typ.join(usr, "event_id", "left").join(cust, "_user", "left")
    return j.groupBy("event_type", "c_nationkey").agg(F.count("event_id").alias("events"))
