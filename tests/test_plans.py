"""Plan checks: no pair-forming joins, date bounds reach the scan."""

import datetime as dt
import re

import pytest

from ledgerlens import catalog
from ledgerlens.sources.tables import load_tables

PLANS = catalog.plans()


@pytest.mark.parametrize("name", sorted(PLANS))
def test_no_nested_loop_or_cartesian_join(spark, sf_dir, name):
    plan = PLANS[name](load_tables(spark, sf_dir))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan
    assert "CartesianProduct" not in plan


def test_day_range_reaches_parquet_scan(spark, sf_dir, tmp_path):
    from ledgerlens.plans import daily
    from ledgerlens.sources.tables import materialize
    t = materialize(spark, sf_dir, str(tmp_path / "derived"),
                    names=["connected_account_balance_transactions"])
    plan = daily.failed_transfers_daily(t, "1996-01-01", "1996-12-31") \
        ._jdf.queryExecution().executedPlan().toString()
    pushed = " ".join(re.findall(r"PushedFilters: \[([^\]]*)", plan))  # text may be truncated
    assert "GreaterThanOrEqual(created,1996-01-01T00:00)" in pushed
    assert "LessThan(created,1997-01-01" in pushed  # plan text truncates the rest


def _nodes(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(autouse=True)
def whole_plan_texts(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


@pytest.fixture(scope="module")
def derived(spark, sf_dir, tmp_path_factory):
    from ledgerlens.sources.tables import materialize
    return materialize(spark, sf_dir, str(tmp_path_factory.mktemp("derived")))


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


MERCHANT_REPORTS = ["fee_merchant_daily", "volume_merchant_daily", "failed_transfers_merchant_daily",
                    "merchant_volume_daily", "merchant_volume_daily_utc"]


def _seq(jvm_seq):
    return [jvm_seq.apply(i) for i in range(jvm_seq.size())]


def _scans(node, above=()):
    """(path, nodes above it, nearest first) of every file scan that runs: reused shuffles and subqueries are not run again."""
    kind = node.getClass().getSimpleName()
    if kind in ("ReusedExchangeExec", "ReusedSubqueryExec"):
        return
    if kind == "FileSourceScanExec":
        yield node.relation().location().rootPaths().mkString(","), above
    inner = [node.executedPlan()] if kind == "AdaptiveSparkPlanExec" else [node.plan()] if kind.endswith("QueryStageExec") else _seq(node.children())
    for child in inner:
        yield from _scans(child, (node, *above))
    for subquery in _seq(node.subqueries()):
        yield from _scans(subquery)


def _run_scans(df):
    """Number of scans of each table in the plan as it was run."""
    df.collect()
    found = {}
    for path, _ in _scans(df._jdf.queryExecution().executedPlan()):
        name = path.rstrip("/").rsplit("/", 1)[-1]
        found[name] = found.get(name, 0) + 1
    return found


@pytest.mark.parametrize("name", MERCHANT_REPORTS)
def test_merchant_reports_read_each_ledger_once_per_measure(derived, no_broadcast, name):
    df = PLANS[name](derived)
    joins = re.findall(r"(?:SortMergeJoin|ShuffledHashJoin|BroadcastHashJoin) \[([^\]]*)\]", _nodes(df))
    assert not [k for k in joins if re.fullmatch(r"(activity_)?day#\d+", k)], joins
    # the ledger: once for the measures and the days; R2 and R3 look its payout batches up as well
    assert _run_scans(df)["connected_account_balance_transactions"] == (2 if name.startswith("merchant_volume") else 1)


@pytest.mark.parametrize("name", [*MERCHANT_REPORTS, "sales_with_paydowns", "merchant_monthly", "dispute_sheet", "line_items"])
def test_building_a_plan_starts_no_job(spark, derived, name):
    PLANS[name](derived)  # the first look at a table's schema may be a job
    sc = spark.sparkContext
    sc.setJobGroup(f"building-{name}", "")
    try:
        PLANS[name](derived)
        assert list(sc.statusTracker().getJobIdsForGroup(f"building-{name}")) == []
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("name, tables", [
    ("merchant_monthly", {"balance_transactions", "connected_account_balance_transaction_fee_details"}),
    ("dispute_sheet", {"balance_transactions", "charges", "payment_method_details", "charges_metadata"}),
    ("volume_merchant_daily", {"disputes"})])
def test_large_tables_are_reduced_before_their_shuffle(derived, no_broadcast, name, tables):
    seen = set()
    for path, above in _scans(PLANS[name](derived)._jdf.queryExecution().executedPlan()):
        table = path.rstrip("/").rsplit("/", 1)[-1]
        kinds = [n.getClass().getSimpleName() for n in above]
        below = above[:kinds.index("ShuffleExchangeExec")] if "ShuffleExchangeExec" in kinds else ()
        filtered = any(n.getClass().getSimpleName() == "FilterExec" and "subquery" in n.condition().toString() for n in below)
        if table in tables and filtered:
            seen.add(table)
    assert seen == tables


def test_payout_lower_bound_reaches_the_scan(spark, derived):
    from ledgerlens.plans import merchant
    plan = _nodes(merchant.merchant_ledger_daily(derived, "2001-07-01", "2001-07-10", "America/New_York"))
    pushed = " ".join(re.findall(r"PushedFilters: \[(.*)", plan))
    assert "GreaterThanOrEqual(created,2001-07-01T04:00)" in pushed and "GreaterThanOrEqual(available_on,2001-07-01T04:00)" in pushed


def test_attribution_overlap_reaches_the_scan(spark, derived, sf_dir):
    from ledgerlens.operators.attribution import attributed_daily
    plan = _nodes(attributed_daily(derived.icplus_fees, "2001-07-01", "2001-07-10"))
    platform = _nodes(PLANS["platform_daily"](derived))
    spread = _nodes(PLANS["prim_attribution"](load_tables(spark, sf_dir)))
    pushed = " ".join(re.findall(r"PushedFilters: \[(.*)", plan))
    assert "GreaterThanOrEqual(attribution_end_time,2001-07-01T00:00)" in pushed
    assert "LessThan(attribution_start_time,2001-07-11T00:00)" in pushed
    assert platform.count("/icplus_fees]") <= 2
    assert spread.count("/orders.parquet]") == 1


def test_line_items_look_customers_up_for_the_window_only(derived):
    """No join of customers or invoices has a charge scan without the window's activity below it."""
    from ledgerlens.plans import line_items
    plan = line_items.line_items(derived, dt.datetime(1998, 7, 1), dt.datetime(1998, 8, 1))._jdf.queryExecution().optimizedPlan()

    def tables(node):
        text = node.toString()
        return {t for t in ("customers", "invoices", "charges", "balance_transactions", "icplus_fees") if f"{t}/" in text or f"{COLUMN[t]}#" in text}

    def walk(node):
        if node.nodeName() == "Join":
            left, right = tables(node.children().apply(0)), tables(node.children().apply(1))
            if right & {"customers", "invoices"}:
                assert left & {"balance_transactions", "icplus_fees"}, (left, right)
                seen.append(right)
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    seen = []
    walk(plan)
    assert len(seen) >= 4


# a column that only this table has
COLUMN = {"customers": "email", "invoices": "subscription_id", "charges": "outcome_type", "balance_transactions": "reporting_category",
          "icplus_fees": "subtotal_amount"}


def test_sales_are_made_once(derived, no_broadcast):
    """The joins of a sale run once; its keys and the paydowns come from the ledger alone."""
    runs = _run_scans(PLANS["sales_with_paydowns"](derived))
    assert runs["connected_account_charges"] == 1 and runs["application_fees"] == 1
    # sales, their keys, the grams of paydowns (to count and to match), and their columns
    assert runs["connected_account_balance_transactions"] == 5


@pytest.mark.parametrize("name", ["platform_daily", "volume_daily", "volume_merchant_daily", "merchant_monthly", "merchant_volume_daily", "prim_distinct"])
def test_distinct_counts_need_no_expand(spark, sf_dir, derived, name):
    plan = _nodes(PLANS[name](load_tables(spark, sf_dir) if name.startswith("prim") else derived))
    assert "Expand" not in plan


def test_bucketed_tables_are_not_shuffled(spark, derived, no_broadcast):
    """R1 on charges and ledger kept in buckets of their join key: the charge lookup moves the activity only."""
    from ledgerlens.plans import line_items
    from ledgerlens.sources.tables import Tables, bucketed
    spark.sql("create database if not exists bucketed_test")
    try:
        bound = bucketed(derived, "bucketed_test", {"charges": "id", "customers": "id"}, 16)
        t = Tables(spark, derived.sf_dir, derived.derived_dir, bind=bound)
        plan = line_items.line_items(t, dt.datetime(1995, 1, 1), dt.datetime(2002, 1, 1), period_since=catalog.PERIOD_SINCE)
        above = {}
        for path, nodes in _scans(plan._jdf.queryExecution().executedPlan()):
            kinds = [n.getClass().getSimpleName() for n in nodes]
            if "SortMergeJoinExec" in kinds:
                above.setdefault(path.rsplit("/", 1)[-1], []).append(kinds[:kinds.index("SortMergeJoinExec")])
        for table in ("charges", "customers"):
            assert above[table] and all("ShuffleExchangeExec" not in kinds for kinds in above[table]), above[table]
        assert sorted(map(tuple, plan.select("balance_transaction_id", "amount").collect()), key=str) == \
            sorted(map(tuple, PLANS["line_items"](derived).select("balance_transaction_id", "amount").collect()), key=str)
    finally:
        spark.sql("drop database bucketed_test cascade")


def test_broadcasts_follow_the_rows_not_the_file(spark, tmp_path):
    """Half a million customers in a file of a few MB are no broadcast side of R1."""
    from ledgerlens.session import SCALE_CONFS
    from ledgerlens.sources.tables import Tables
    spark.range(500_000).selectExpr("concat('cus_', id) id", "concat('customer_', id, '@example.com') email", "'BUILDING' description") \
        .write.parquet(str(tmp_path / "customers"))
    customers = spark.read.parquet(str(tmp_path / "customers"))
    keys = spark.range(10**9).selectExpr("concat('cus_', id) id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", SCALE_CONFS["spark.sql.autoBroadcastJoinThreshold"])
    assert "BroadcastHashJoin" not in _nodes(keys.join(Tables(spark, bind={"customers": customers}).customers, "id"))
    # a split of this size and its aggregate fit a task many times
    assert int(SCALE_CONFS["spark.sql.files.maxPartitionBytes"]) <= 16 << 20


def test_itemised_fees_move_once(derived, no_broadcast):
    """Between the scan of the fees and the result there is one shuffle of them."""
    above = [n for path, n in _scans(PLANS["icplus_tagged"](derived)._jdf.queryExecution().executedPlan()) if path.rstrip("/").endswith("/icplus_fees")]
    kinds = [n.getClass().getSimpleName() for n in above[0]]
    assert len(above) == 1 and kinds.count("ShuffleExchangeExec") == 1 and kinds.count("SortMergeJoinExec") == 2


def test_line_items_are_shuffled_for_three_keys(derived, no_broadcast):
    """Itemised fees move for their ledger row, their charge and the order, ledger rows for their source, their payout and the order."""
    moves = {"icplus_fees": [], "balance_transactions": []}
    for path, above in _scans(PLANS["line_items"](derived)._jdf.queryExecution().executedPlan()):
        table, output = path.rstrip("/").rsplit("/", 1)[-1], above[0].output().toString()
        if "fee_name#" in output or "fee#" in output and "source_id#" in output:
            moves[table].append([n.getClass().getSimpleName() for n in above].count("ShuffleExchangeExec"))
    assert moves == {"icplus_fees": [3], "balance_transactions": [3]}


def test_line_items_of_repeated_null_and_hot_keys(spark, derived, duck, tmp_path):
    """R1 by its SQL: one ledger row has most itemised fees, rows and payouts come twice, ids and dates are null."""
    from ledgerlens.plans import line_items, oracle_reports
    from ledgerlens.sources.fixtures import FIXTURES
    from ledgerlens.sources.tables import Tables
    from pyspark.sql import functions as F
    fees, bts = derived.icplus_fees, derived.balance_transactions
    one = bts.where("reporting_category = 'network_cost' and description like 'IC+%'").agg(F.min("id")).first()[0]
    fees = fees.withColumn("balance_transaction_id", F.when(F.crc32("request_id") % 10 < 7, one).when(F.crc32("request_id") % 10 < 9, F.col("balance_transaction_id")))
    fees = fees.withColumn("charge_id", F.when(F.crc32("id") % 7 > 0, F.col("charge_id"))).withColumn("id", F.when(F.crc32("id") % 5 > 0, F.col("id")))
    payout = F.col("reporting_category") == "payout"
    late = bts.where(payout & (F.crc32("id") % 3 == 0)).withColumn("available_on", F.when(F.crc32("id") % 2 == 0, F.col("available_on")))
    bts = bts.withColumn("source_id", F.when(payout | (F.crc32("id") % 11 > 0), F.col("source_id")))
    bound = {"icplus_fees": fees.unionAll(fees.where(F.crc32("request_id") % 4 == 0)),
             "balance_transactions": bts.unionAll(bts.where((F.crc32("id") % 6 == 0) & ~payout)).unionAll(late)}
    for name, df in bound.items():
        df.write.parquet(str(tmp_path / name))
        bound[name] = spark.read.parquet(str(tmp_path / name))
    rows = line_items.line_items(Tables(spark, derived.sf_dir, derived.derived_dir, bind=bound), dt.datetime(1995, 1, 1), dt.datetime(2002, 1, 1),
                                 period_since="1995-01-01").collect()
    con = duck.cursor()
    con.execute("create schema odd")
    con.execute("use odd")
    for name in FIXTURES:
        if name != "order_facts":
            folder = tmp_path / name if name in bound else f"{derived.derived_dir}/{name}"
            con.execute(f"create view {name} as select * from read_parquet('{folder}/*.parquet')")
    res = con.execute(oracle_reports.LINE_ITEMS.replace("{lo}", "1995-01-01").replace("{hi}", "2002-01-01").replace("{period_since}", "1995-01-01"))
    names = [d[0] for d in res.description]
    plain = lambda r: tuple(f"{r[c]:.6f}" if isinstance(r[c], float) else str(r[c]) for c in sorted(names))
    want = sorted(plain(dict(zip(names, r, strict=True))) for r in res.fetchall())
    assert sorted(plain(r.asDict()) for r in rows) == want
    assert sum(r.balance_transaction_id == one for r in rows) > len(rows) / 4
    order = [(r.balance_transaction_created_at or "9", r.balance_transaction_id, r.balance_transaction_component != "gross", r.balance_transaction_component) for r in rows]
    assert order == sorted(order)


def test_tags_and_subscriptions_of_itemised_fees(spark):
    """Tags count without a charge, a subscription only with one; repeated keys repeat rows."""
    from ledgerlens.plans import fees
    from ledgerlens.sources.tables import Tables
    make = spark.createDataFrame
    ids = ["a", "a", "b", "c", "d", None]
    tables = {
        "icplus_fees": make([(f"f{i}", c, dt.datetime(2000, 1, 2), 100, "n", "k", "r", "d", "q") for i, c in enumerate(ids)],
                            "id string, charge_id string, incurred_at timestamp_ntz, billing_amount int, fee_name string, fee_category string, refund_id string, dispute_id string, request_id string"),
        "charges": make([("a", "A"), ("b", "B1"), ("b", "B2"), (None, "N")], "id string, description string"),
        "charges_metadata": make([("a", "product_id", "resto"), ("c", "product_id", "retail"), ("c", "product_id", "resto"), (None, "product_id", "resto"), ("d", "note", "x")],
                                 "charge_id string, key string, value string"),
        "invoices": make([("s1", "b"), ("s2", "b"), ("s1", "d"), ("s1", None)], "subscription_id string, charge_id string"),
        "subscriptions": make([("s1",), ("s2",)], "id string")}
    got = sorted(tuple(r) for r in fees.icplus_tagged(Tables(spark, bind=tables), "1999-01-01")
                 .selectExpr("activity_id", "coalesce(charge_description, '')", "coalesce(subscription_id, '')", "coalesce(business_type, '')").collect())
    assert got == [("a", "A", "", "resto")] * 2 + [("b", x, s, "subscription") for x in ("B1", "B2") for s in ("s1", "s2")] \
        + [("c", "", "", "resto"), ("c", "", "", "retail"), ("d", "", "", ""), ("r", "", "", "")]
