"""Grain and conservation checks and parameter forms."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlens import catalog
from ledgerlens.plans import daily, line_items, merchant, tracing
from ledgerlens.sources.fixtures import PLATFORM_ACCOUNT
from ledgerlens.sources.report_csv import write_report_csv
from ledgerlens.sources.tables import Tables, load_tables

D0, D1 = "1995-01-01", "2001-12-31"


def test_strict_grain_merchant_rows_add_up_to_the_ledger(spark, sf_dir):
    t = load_tables(spark, sf_dir)
    per_merchant = daily.fee_merchant_daily(t, D0, D1)
    # one row per (day, account): no fan-out
    assert per_merchant.count() == per_merchant.select("day", "account").distinct().count()
    got = per_merchant.groupBy("day").agg(F.sum("refund_count").alias("got_n"))
    bt = t.connected_account_balance_transactions
    want = bt.where(F.col("type").isin("payment_refund", "refund")) \
        .groupBy(F.to_date("created").alias("day")).agg(F.count("*").alias("want_n"))
    diff = want.join(got, "day", "left") \
        .where(F.col("got_n").isNull() | (F.col("want_n") != F.col("got_n")))
    assert diff.count() == 0


def test_line_items_conserve_gross_minus_fee(spark, sf_dir):
    t = load_tables(spark, sf_dir)
    lo, hi = dt.datetime(1995, 1, 1), dt.datetime(2002, 1, 1)
    li = line_items.line_items(t, lo, hi, period_since="1995-01-01").where(F.col("fee_id").isNull())
    sums = li.groupBy("balance_transaction_id").agg(F.sum("amount").alias("s"))
    bt = t.balance_transactions.where(
        ~F.col("reporting_category").isin("payout", "connect_reserved_funds", "fee", "network_cost")
        & (F.col("amount") - F.col("fee") != 0)) \
        .select(F.col("id").alias("balance_transaction_id"),
                ((F.col("amount") - F.col("fee")).cast("double") / 100).alias("expect"),
                "currency")
    j = bt.where(F.col("currency") != "jpy").join(sums, "balance_transaction_id", "inner")
    assert j.count() > 0
    assert j.where(F.abs(F.col("s") - F.col("expect")) > 1e-6).count() == 0


def test_account_debit_inline_payment_list(spark, sf_dir):
    t = load_tables(spark, sf_dir)
    full = tracing.account_debit_unlinked(t, PLATFORM_ACCOUNT)
    ids = [r.account_debit_payment_id for r in full.limit(2).collect()]
    some = tracing.account_debit_unlinked(t, PLATFORM_ACCOUNT, payment_ids=ids)
    assert {r.account_debit_payment_id for r in some.collect()} == set(ids)


def test_single_dispute_sheet_is_a_subset(spark, sf_dir):
    t = load_tables(spark, sf_dir)
    full = tracing.dispute_sheet(t)
    one = full.first().case_id
    assert tracing.dispute_sheet(t, dispute_id=one).count() == \
        full.where(F.col("case_id") == one).count()


def test_keys_the_plans_rely_on_are_unique(spark, sf_dir):
    from ledgerlens.sources.tables import duplicate_keys
    t = load_tables(spark, sf_dir)
    # icplus_fees ids are not unique in the driver data (line-item keys repeat) and no plan
    # relies on them: R1 merges identical lines with its distinct, as the source does.
    for table, key in [("charges", "id"), ("disputes", "id"), ("refunds", "id"),
                       ("transfers", "id"), ("connected_account_transfers", "id"),
                       ("balance_transactions", "id"),
                       ("customers", "id"), ("invoices", "id"), ("connected_accounts", "id"),
                       ("payment_method_details", "charge_id")]:
        assert duplicate_keys(t[table], key).count() == 0, table


def test_line_items_month_window_and_currency_choice(spark, sf_dir):
    assert line_items.month_window("2020-01-15 08:00:00") == \
        (dt.datetime(2019, 12, 1), dt.datetime(2020, 1, 1))
    assert line_items.month_window(dt.datetime(2020, 3, 1)) == \
        (dt.datetime(2020, 2, 1), dt.datetime(2020, 3, 1))
    t = load_tables(spark, sf_dir)
    lo, hi = line_items.month_window("1998-07-03")
    eur = line_items.line_items(t, lo, hi, currency="eur")
    cur = {r.currency for r in eur.select("currency").distinct().collect()}
    assert cur == {"eur"}
    acts = eur.select(F.to_timestamp("activity_at").alias("a")).agg(F.min("a"), F.max("a")).first()
    assert acts[0] >= lo and acts[1] < hi


def test_payout_on_the_range_edge(spark, sf_dir):
    # Platform reports stop the day before d1 (`<`), the per-merchant one includes d1 (`<=`)
    t = load_tables(spark, sf_dir)
    tr = t.connected_account_transfers.where(
        (F.col("status") == "paid") & F.col("type").isin("bank_account", "card"))
    d1 = tr.select(F.max(F.to_date("date")).alias("d")).first().d
    d0 = d1 - dt.timedelta(days=30)
    excl = daily.connect_payouts_daily(t, d0, d1, end_inclusive=False)
    incl = daily.connect_payouts_daily(t, d0, d1, by_account=True, end_inclusive=True, types=None)
    assert excl.where(F.col("day") == F.lit(d1)).count() == 0
    assert incl.where(F.col("day") == F.lit(d1)).count() > 0
    assert excl.where(F.col("day") == F.lit(d0)).count() == \
        (1 if tr.where(F.to_date("date") == F.lit(d0)).count() else 0)


# report: sort keys, "-" for falling ones
ORDERS = {
    "failed_transfers_daily": ["-day"], "failed_transfers_merchant_daily": ["-day", "account"], "fee_daily": ["-day"],
    "fee_merchant_daily": ["-day", "account"], "volume_daily": ["-day"], "volume_merchant_daily": ["-day"], "platform_daily": ["-day"],
    "merchant_volume_daily": ["destination_id", "activity_date"], "merchant_volume_daily_utc": ["destination_id", "activity_date"],
    "merchant_monthly": ["account", "month"], "fee_report": ["activity_at", "type", "fee_category", "card_funding", "card_brand"],
    "balance_report": ["activity_at", "reporting_category", "type", "card_funding", "card_brand"],
    "payout_activity_timing": ["payout_id", "raw_date", "type"],
    "interac_not_reversed": ["merchant_account", "business_name", "-refund_created"], "sales_with_paydowns": ["-created"],
    "dispute_dashboard": ["-disputes"],
}


def _before(a, b, keys):
    """Whether row a may come before row b."""
    for k in keys:
        x, y = a[k.lstrip("-")], b[k.lstrip("-")]
        if x == y:
            continue
        if x is None or y is None:
            return y is None
        return x > y if k[0] == "-" else x < y
    return True


@pytest.mark.parametrize("name", sorted(ORDERS))
def test_rows_come_in_the_reports_order(spark, sf_dir, name):
    rows = catalog.queries()[name](spark, sf_dir).collect()
    assert len(rows) > 1
    assert all(_before(a, b, ORDERS[name]) for a, b in zip(rows, rows[1:]))


def test_line_items_order_by_expression(spark, sf_dir):
    rows = [r.asDict() for r in catalog.queries()["line_items"](spark, sf_dir).collect()]
    for r in rows:
        r["rank"] = 1 if r["balance_transaction_component"] == "gross" else 2
    keys = ["balance_transaction_created_at", "balance_transaction_id", "rank", "balance_transaction_component"]
    assert all(_before(a, b, keys) for a, b in zip(rows, rows[1:]))


def test_dispute_sheet_order_by_a_hidden_column(spark, sf_dir):
    t = load_tables(spark, sf_dir)
    opened = {r.id: r.created for r in t.disputes.collect()}
    at = [opened[r.case_id] for r in tracing.dispute_sheet(t).collect()]
    assert at == sorted(at, reverse=True) and len(set(at)) > 1


def test_merchants_with_several_currencies(spark, sf_dir):
    t = load_tables(spark, sf_dir)
    daily_ = merchant.merchant_volume_daily(t, D0, D1, PLATFORM_ACCOUNT)
    twice = daily_.groupBy("destination_id", "activity_date").agg(F.count_distinct("currency").alias("n"))
    assert twice.where("n > 1").count() > 0
    month = merchant.merchant_monthly(t, "1995-01", "2001-12").groupBy("account", "month").agg(F.count_distinct("currency").alias("n"))
    assert month.where("n > 1").count() > 0
    shares = t.charges.groupBy("destination_id").count().orderBy(F.desc("count")).limit(2).collect()
    assert shares[0]["count"] > 0.25 * t.charges.count() and shares[1]["count"] < 0.1 * t.charges.count()


def test_report_range_covers_the_data(spark, sf_dir):
    t = load_tables(spark, sf_dir)
    lo, hi = dt.datetime.fromisoformat(catalog.D0), dt.datetime.fromisoformat(catalog.D1) + dt.timedelta(days=1)
    for table, clock in (("balance_transactions", "created"), ("connected_account_balance_transactions", "available_on"), ("charges", "created"),
                         ("icplus_fees", "incurred_at"), ("icplus_fees", "attribution_end_time"), ("connected_account_transfers", "date"), ("transfers", "date")):
        first, last = t[table].agg(F.min(clock), F.max(clock)).first()
        assert lo <= first and last < hi, (table, clock)


def test_rates_are_arguments(spark, sf_dir):
    t = load_tables(spark, sf_dir)
    total = lambda df, c: df.agg(F.sum(c)).first()[0]
    one = merchant.merchant_volume_daily(t, D0, D1, tz=None, with_unlinked=False)
    two = merchant.merchant_volume_daily(t, D0, D1, tz=None, with_unlinked=False, terminal_rate=4.0, radar_rate=0.0)
    assert total(one, "stripe_terminal_fees") > 0
    assert abs(total(two, "stripe_terminal_fees") - 2 * total(one, "stripe_terminal_fees")) < 1e-6
    assert total(two, "stripe_radar_fees") == 0


def test_reports_run_on_the_users_own_tables(spark, tmp_path):
    """A catalog view, Parquet with a given schema, and a DataFrame; no fixture table."""
    rows = [("m1", "payment", dt.datetime(2020, 1, 2, 3), 1000), ("m1", "transfer_failure", dt.datetime(2020, 1, 2, 4), -50), ("m2", "payout_failure", dt.datetime(2020, 1, 4), 70)]
    ledger = spark.createDataFrame(rows, "account string, type string, created timestamp_ntz, amount bigint")
    ledger.createOrReplaceTempView("my_ledger")
    path = str(tmp_path / "ledger")
    ledger.write.parquet(path)
    schema = "account string, type string, created timestamp_ntz, amount bigint"
    for source in ("my_ledger", (path, schema), ledger):
        t = Tables(spark, bind={"connected_account_balance_transactions": source})
        got = daily.failed_transfers_merchant_daily(t, "2020-01-01", "2020-01-05").collect()
        assert [(r.day.day, r.account, r.transfer_debit_failures, r.payout_credit_failures) for r in got] == \
            [(5, None, 0.0, 0.0), (4, "m2", 0.0, 0.7), (3, None, 0.0, 0.0), (2, "m1", -0.5, 0.0)]
    with pytest.raises(KeyError):
        Tables(spark)["no_such_table"]


def test_csv_sink_writes_the_rows(spark, sf_dir, tmp_path):
    df = tracing.dispute_dashboard(load_tables(spark, sf_dir), catalog.AS_OF, catalog.MONTHS)
    write_report_csv(df, str(tmp_path / "out"))
    back = spark.read.option("header", True).csv(str(tmp_path / "out"))
    assert back.columns == df.columns and back.count() == df.count() > 0
