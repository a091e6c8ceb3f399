"""Row-level cases the oracle cannot settle."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions import decimalize, in_days, local_day
from ledgerlens.functions.descriptions import (date_after_open_paren, date_before_close_paren,
                                               has_period, is_icplus, period_end, period_start)
from ledgerlens.operators.attribution import attributed_daily
from ledgerlens.operators.calendars import calendar_days, gate, month_range
from ledgerlens.operators.links import contains_join, heavy_keys, lookup
from ledgerlens.operators.presence import days_seen, days_unseen
from ledgerlens.operators.reduction import reduced
from ledgerlens.sources.report_csv import csv_lines, OPTIONS, read_report_csv, write_report_csv


def test_period_text_parsing(spark):
    rows = [("Sigma (2020-01-01 - 2020-01-31): queries",),
            ("Radar (2020-02-05): screening",),
            ("Radar credit: manual adjustment",),
            ("IC+ fees (2020-01-01 - 2020-01-31): network",),
            ("ICC (2020-01-01): not interchange plus",)]
    df = spark.createDataFrame(rows, "d string").select(
        has_period("d").alias("ok"), period_start("d").alias("s"), period_end("d").alias("e"),
        is_icplus("d").alias("icp"), date_after_open_paren("d").alias("o"),
        date_before_close_paren("d").alias("c"))
    r = df.collect()
    assert r[0].ok and r[0].s == dt.datetime(2020, 1, 1) and r[0].e == dt.datetime(2020, 1, 31)
    assert r[1].ok and r[1].e == dt.datetime(2020, 2, 5)
    assert not r[2].ok and r[2].s is None and r[2].o is None  # no parenthesis: null, no error
    assert r[3].icp and not r[4].icp  # `\+` is a literal plus, not "one or more C"
    assert r[0].o == dt.date(2020, 1, 1) and r[0].c == dt.date(2020, 1, 31)


def test_new_york_day_bounds_match_bucketing_across_dst(spark):
    # 2020-03-08 and 2020-11-01 are the New York DST switch days.
    instants = [dt.datetime(2020, 3, 8, 4, 59, 59), dt.datetime(2020, 3, 8, 5, 0, 0),
                dt.datetime(2020, 3, 9, 3, 59, 59), dt.datetime(2020, 3, 9, 4, 0, 0),
                dt.datetime(2020, 11, 1, 3, 59, 59), dt.datetime(2020, 11, 2, 4, 59, 59),
                dt.datetime(2020, 11, 2, 5, 0, 0)]
    df = spark.createDataFrame([(str(i),) for i in instants], "s string") \
        .select(F.col("s").cast("timestamp_ntz").alias("t"))
    tz = "America/New_York"
    for d0, d1 in [("2020-03-08", "2020-03-08"), ("2020-11-01", "2020-11-01")]:
        by_bounds = df.where(in_days("t", d0, d1, tz)).collect()
        by_bucket = df.where(local_day("t", tz).between(F.lit(d0).cast("date"),
                                                        F.lit(d1).cast("date"))).collect()
        assert sorted(by_bounds) == sorted(by_bucket)
    assert [r.d for r in df.select(local_day("t", tz).alias("d")).collect()][:2] == \
        [dt.date(2020, 3, 7), dt.date(2020, 3, 8)]


def test_attribution_spreads_over_own_days_and_zero_day_is_null(spark):
    rows = [("a", "2020-01-01 00:00:00", "2020-01-03 00:00:00", Decimal("10.0000")),
            ("b", "2020-01-02 10:00:00", "2020-01-02 20:00:00", Decimal("5.0000")),
            ("c", "2020-01-01 23:00:00", "2020-01-02 01:00:00", Decimal("7.0000"))]
    fees = spark.createDataFrame(rows, "id string, s string, e string, billing_amount decimal(18,4)") \
        .select("id", F.col("s").cast("timestamp_ntz").alias("attribution_start_time"),
                F.col("e").cast("timestamp_ntz").alias("attribution_end_time"), "billing_amount")
    got = {r.day: r.attr_interchange for r in attributed_daily(fees, "2020-01-01", "2020-01-05").collect()}
    # a: midnight to midnight covers 3 days, each gets 10 / 2 (n + 1 days share n parts)
    assert got[dt.date(2020, 1, 1)] == Decimal(5)
    assert got[dt.date(2020, 1, 3)] == Decimal(5)
    # c: 2020-01-02 00:00 lies inside a zero-whole-day period -> null share, no failure
    assert got[dt.date(2020, 1, 2)] == Decimal(5)
    # b covers no midnight -> contributes nothing; days after every period are 0
    assert got[dt.date(2020, 1, 4)] == 0


def _brute_contains(sales, paydowns):
    out = set()
    for sid, key, m in sales:
        for pid, text, m2 in paydowns:
            if m != m2:
                continue
            import re
            pat = "^.*" + "".join("." if ch == "_" else re.escape(ch) for ch in key) + ".*$"
            if re.match(pat, text, re.S):
                out.add((sid, pid))
    return out


def test_containment_join_matches_brute_force_like(spark):
    sales = [("s1", "py_1", "m"), ("s2", "py_12", "m"), ("s3", "py_123", "m"), ("s4", "zz_9", "m"),
             ("s5", "py_1", "other"), ("s6", "a_b_c", "m"), ("s7", "__", "m"), ("s8", None, "m"),
             ("s9", "x-1_2", "m")]
    pays = [("p1", "withheld from py_123", "m"), ("p2", "withheld from pyX1 and more", "m"),
            ("p3", "nothing here", "m"), ("p4", "withheld from py_1", "other"),
            ("p5", "aXbYc", "m"), ("p6", "ref x-1_2!", "m")]
    sdf = spark.createDataFrame(sales, "sid string, source_id string, merchant string")
    pdf = spark.createDataFrame(pays, "pid string, text string, merchant string")
    j = contains_join(sdf, pdf, "sid", "source_id", "pid", "text", partition_cols=["merchant"])
    got = {(r.sid, r.pid) for r in j.collect() if r.pid is not None}
    want = _brute_contains([s for s in sales if s[1] is not None], pays)
    assert got == want
    assert ("s1", "p2") in got  # `_` in the id is a one-character wildcard (D16)
    assert j.count() == len(want) + len({s[0] for s in sales} - {g[0] for g in got})


def test_containment_join_with_odd_keys_and_long_texts(spark):
    long = "".join(chr(97 + i % 26) for i in range(10_000))
    sales = [("s1", "--", "m"), ("s2", "%", "m"), ("s3", "", "m"), ("s4", "a%c", "m"), ("s5", long[5000:5030], "m"), ("s6", "zzz", "m")]
    pays = [("p1", "x -- y", "m"), ("p2", "abc", "m"), ("p3", long, "m"), ("p4", None, "m"), ("p5", "", "m")]
    sdf = spark.createDataFrame(sales, "sid string, source_id string, merchant string")
    pdf = spark.createDataFrame(pays, "pid string, text string, merchant string")
    for parts in (["merchant"], []):
        right = pdf if parts else pdf.drop("merchant")
        j = contains_join(sdf, right, "sid", "source_id", "pid", "text", partition_cols=parts)
        got = {(r.sid, r.pid) for r in j.collect()}
        assert got == {("s1", "p1"), *(("s2", p) for p in ("p1", "p2", "p3", "p5")), *(("s3", p) for p in ("p1", "p2", "p3", "p5")),
                       ("s4", "p2"), ("s4", "p3"), ("s5", "p3"), ("s6", None)}


@pytest.mark.parametrize("n", [2_000, 20_000])
def test_candidates_grow_with_the_texts(spark, n):
    """Keys of seven digits, one text in ten keys: few texts are compared with a key that they do not name."""
    from ledgerlens.operators.links import _candidates
    sales = spark.range(n).selectExpr("concat('s', id) sid", "concat('py_', 1000000 + id * 397) key", "'m' merchant")
    pays = spark.range(0, n, 10).selectExpr("concat('p', id) pid", "concat('withheld from py_', 1000000 + id * 397) text", "'m' merchant")
    pairs = _candidates(sales, pays, "key", "pid", "text", ["merchant"])
    found = contains_join(sales, pays, "sid", "key", "pid", "text", partition_cols=["merchant"]).where("pid is not null")
    assert found.count() == n // 10 and pairs.count() <= n


def test_lookup_spreads_null_and_hot_keys(spark):
    left = spark.createDataFrame([(i, "hot" if i % 2 else None if i % 4 else f"k{i}") for i in range(200)], "id int, key string")
    dim = spark.createDataFrame([("hot", 1), ("hot", 2), ("k4", 3), (None, 9)], "key string, v int")
    rows = lambda df: sorted((r.id, r.key or "", r.v or 0) for r in df.select("id", "key", "v").collect())
    want = rows(left.join(dim, "key", "left"))
    for parts in (None, 2, 7, 4096):
        assert rows(lookup(left, dim, "key", ["id"], parts and heavy_keys(left, "key", parts))) == want


def test_heavy_keys_are_measured(spark):
    """A key with a third of all rows: no reducer has more than twice the median; without skew nothing is repeated."""
    skewed = spark.range(120_000).select("id", F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("key"))
    heavy = heavy_keys(skewed, "key")
    assert [(r._hot, r._copies) for r in heavy.collect()] == [("hot", 1366)]
    even = skewed.where("id % 3 != 0")
    assert heavy_keys(even, "key").count() == 0
    dim = skewed.select("key").distinct().withColumn("v", F.lit(1))
    confs = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "32"}
    before = {k: spark.conf.get(k) for k in confs}
    try:
        for k, v in confs.items():
            spark.conf.set(k, v)
        placed = lookup(skewed, dim, "key", ["id"], heavy).select("id", "v", F.spark_partition_id().alias("p"))
        assert placed.where("v is null").count() == 0
        sizes = sorted(r["count"] for r in placed.groupBy("p").count().collect())
        plain = lookup(skewed, dim, "key", ["id"]).groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(sizes) == 32 and sum(sizes) == 120_000 and sizes[-1] <= 2 * sizes[16] < plain


def test_presence_bitmap(spark):
    rows = spark.createDataFrame([("1995-01-01", 1, True), ("1995-01-03", 2, False), ("1999-12-31", 3, True), ("1990-01-01", 4, True), (None, 5, True), ("2095-06-01", 6, True)], "d string, v int, g boolean") \
        .select(F.col("d").cast("date").alias("day"), "v", "g").groupBy("day").agg(F.max("v").alias("v"), F.max("g").alias("g"))
    for d0, d1 in (("1995-01-01", "1995-01-05"), ("1990-01-01", "2095-12-31"), ("1999-12-31", "1999-12-31"), ("2000-01-02", "2000-01-01")):
        seen = days_seen(rows, d0, d1, F.col("v") != 2, F.col("g") & (F.col("v") > 1))
        missing = {r.day for r in days_unseen(spark, seen, d0, d1).collect()}
        span = [dt.date.fromisoformat(d0) + dt.timedelta(i) for i in range((dt.date.fromisoformat(d1) - dt.date.fromisoformat(d0)).days + 1)]
        assert missing == set(span) - {dt.date(1995, 1, 1), dt.date(1999, 12, 31), dt.date(1990, 1, 1), dt.date(2095, 6, 1)}
        assert spark.range(1).select(seen.getField("first")).first()[0] == dt.date(1990, 1, 1)


def test_reduction_never_drops_a_match(spark):
    keys = spark.range(0, 3000, 3).select(F.concat(F.lit("k"), "id").alias("key")).unionByName(spark.createDataFrame([(None,)], "key string"))
    large = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("k"), "id").unionByName(spark.createDataFrame([(None, -1)], "k string, id bigint"))
    for bits in (64, 1 << 12, 1 << 24):
        kept = {r.id for r in reduced(large, "k", keys, "key", bits).collect()}
        assert kept >= set(range(0, 3000, 3)) and -1 not in kept
        assert len(kept) <= {64: 3000, 1 << 12: 1700, 1 << 24: 1002}[bits]
    assert reduced(large, "k", keys.where("false"), "key").count() == 0


def test_anti_join_keeps_null_keys(spark):
    left = spark.createDataFrame([("r1", "t1"), ("r2", None), ("r3", "t3")], "id string, tid string")
    rev = spark.createDataFrame([("x", "t1"), ("y", None)], "rid string, tid string")
    kept = {r.id for r in left.join(rev, "tid", "left_anti").collect()}
    assert kept == {"r2", "r3"}


def test_decimalize_zero_decimal_currency_and_half_up(spark):
    df = spark.createDataFrame([("jpy", 1234), ("usd", 1234), ("usd", None), ("eur", -5)],
                               "c string, a bigint")
    r = df.select(decimalize(F.col("c"), F.col("a"), 1).alias("v")).collect()
    assert [x.v for x in r] == [1234.0, 12.3, None, -0.1]


def test_decimalize_holds_every_bigint(spark):
    amounts = [10**12, 10**15, 2**63 - 1, -2**63]
    df = spark.createDataFrame([(c, a) for a in amounts for c in ("usd", "jpy")], "c string, a bigint")
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            got = [r.v for r in df.select(decimalize(F.col("c"), F.col("a"), 2).alias("v")).collect()]
        finally:
            spark.conf.unset("spark.sql.ansi.enabled")
        assert got == [float(Decimal(a) * (Decimal("0.01") if c == "usd" else 1)) for a in amounts for c in ("usd", "jpy")]


def test_gate_with_empty_measure_gives_no_rows(spark):
    cal = calendar_days(spark, "2020-01-01", "2020-01-10")
    empty = spark.createDataFrame([], "day date")
    assert gate(cal, empty).count() == 0
    assert calendar_days(spark, "2020-01-30", "2020-02-02").count() == 4
    assert [r.month for r in month_range(spark, "2020-11", "2021-02").collect()][-1] == \
        dt.date(2021, 2, 1)


def test_csv_sink_rejects_duplicate_names(spark, tmp_path):
    df = spark.createDataFrame([(1, 2)], "a int, b int").select("a", F.col("b").alias("a"))
    with pytest.raises(ValueError):
        write_report_csv(df, str(tmp_path / "out"))


def test_report_csv_keeps_rows_and_order(spark, tmp_path):
    """R1 in bounded files: read back in order, quoted fields and blanks unchanged."""
    odd = ['a "quoted" word', "commas, and, more", "line\nbreak", " spaces ", "", None, "#1", '"', "plain"]
    df = spark.range(2000).select((F.lit(5000) - F.col("id")).alias("n"), F.element_at(F.array(*[F.lit(x) for x in odd]), (F.col("id") % len(odd) + 1).cast("int")).alias("text")).orderBy("n")
    path = str(tmp_path / "report")
    write_report_csv(df.repartitionByRange(4, "n").sortWithinPartitions("n"), path, max_records=150)
    back = read_report_csv(spark, path, df.schema).collect()
    assert [(r.n, r.text or "") for r in back] == [(r.n, r.text or "") for r in df.collect()]
    manifest = spark.read.option("header", True).csv(f"{path}/_manifest").collect()
    assert len(manifest) >= 16 and all(int(r.n_rows) <= 150 for r in manifest) and sum(int(r.n_rows) for r in manifest) == 2000
    assert csv_lines(df.limit(0), **OPTIONS).columns == ["line"]


def test_spines_are_partitioned_and_reversed_ranges_are_empty(spark):
    cal = calendar_days(spark, "2020-02-27", "2020-03-02")
    assert [r.day for r in cal.orderBy("day").collect()] == \
        [dt.date(2020, 2, 27), dt.date(2020, 2, 28), dt.date(2020, 2, 29), dt.date(2020, 3, 1),
         dt.date(2020, 3, 2)]
    assert cal.rdd.getNumPartitions() > 1
    assert calendar_days(spark, "2020-03-02", "2020-03-01").count() == 0
    assert month_range(spark, "2021-02", "2021-01").count() == 0
