from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from millrace.contracts import RAW
from millrace.operators import checks
from millrace.sources.landing import land_frame


def test_bad_values_become_null_and_are_listed(spark):
    feed = spark.createDataFrame(
        [
            ("1", "12.50", "2024-01-30 05:06:07", "true", "2024013005"),
            (" 2 ", "12,50", "2024-01-30 05:06:07", "true", "2024013005"),
            ("3.7", "1e3", "soon", "maybe", "2024013025"),
            (None, None, None, None, "20240130"),
        ],
        "txn_id string, gross_amount string, txn_ts string, void_flag string, date_ts string",
    )
    landing = land_frame("pos_transactions", feed)
    rows = landing.rows.orderBy("txn_id", "gross_amount").collect()
    assert landing.rows.columns == RAW["pos_transactions"].names
    by_id = {r.txn_id: r for r in rows if r.txn_id is not None}
    assert by_id[1].gross_amount == Decimal("12.5") and by_id[1].void_flag is True
    assert by_id[1].partition_ts == datetime(2024, 1, 30, 5)
    assert by_id[2].gross_amount is None and by_id[2].txn_ts == datetime(2024, 1, 30, 5, 6, 7)
    assert len(rows) == 4

    bad = {tuple(r.failed_columns): r.original for r in landing.quarantine.collect()}
    assert set(bad) == {("gross_amount",), ("txn_id", "txn_ts", "void_flag", "partition_ts")}
    assert '"gross_amount":"12,50"' in bad[("gross_amount",)]

    report = {r.column_name: (r.rows, r.failed) for r in checks.cast_report(landing).collect()}
    assert report["gross_amount"] == (4, 1)
    assert report["partition_ts"] == (4, 1)
    assert report["store_id"] == (4, 0)


def test_nested_values_keep_their_good_parts(spark):
    feed = spark.sql(
        """
        SELECT 'a' event_id, array(named_struct('sku', 's', 'qty', '2', 'price', '2.505'),
                                   named_struct('sku', 't', 'qty', 'two', 'price', '1')) items,
               map('k', 'v') properties, '20240130' event_date, '3' hour_bucket
        UNION ALL SELECT 'b', array(), map(), '20240130', '3'
        UNION ALL SELECT 'c', NULL, NULL, '20240130', '3'
        UNION ALL SELECT 'd', array(named_struct('sku', NULL, 'qty', NULL, 'price', NULL), NULL), NULL, '20240130', '3'
        """
    )
    landing = land_frame("mobile_events", feed)
    rows = {r.event_id: r for r in landing.rows.collect()}
    first, second = rows["a"]["items"]
    assert (first.sku, first.qty, first.price) == ("s", 2, Decimal("2.505"))
    assert (second.sku, second.qty, second.price) == ("t", None, Decimal("1"))
    assert rows["b"]["items"] == [] and rows["c"]["items"] is None
    assert rows["d"]["items"][1] is None
    assert rows["a"].properties.toPython() == {"k": "v"} and rows["b"].properties.toPython() == {}
    assert [r.failed_columns for r in landing.quarantine.collect()] == [["items"]]


def test_integer_and_decimal_feeds_are_widened(spark):
    feed = spark.sql(
        "SELECT array(named_struct('sku', 's', 'qty', 2, 'unit_price', cast(2.5 AS decimal(10,2)))) line_items, "
        "cast(7.25 AS decimal(14,2)) total_amount, 2024 feed_year, 12 feed_month"
    )
    landing = land_frame("supplier_invoices", feed)
    row = landing.rows.first()
    assert row.line_items[0].qty == 2 and row.line_items[0].unit_price == Decimal("2.5")
    assert landing.rows.schema.simpleString() == RAW["supplier_invoices"].schema.simpleString()
    assert landing.quarantine.count() == 0


def test_text_as_semi_structured_value(spark):
    feed = spark.createDataFrame(
        [("1", '{"a": {"b": 2}}'), ("2", '{"a": 1'), ("3", '{"a": 1, "a": 2}'), ("4", None)],
        "driver_id string, extras string",
    ).withColumn("date_ts", F.lit("20240130"))
    landing = land_frame("driver_logs", feed)
    rows = {r.driver_id: r.extras for r in landing.rows.collect()}
    assert rows["1"].toPython() == {"a": {"b": 2}}
    assert rows["2"] is None and rows["3"] is None and rows["4"] is None
    failed = {r.original[14:15] for r in landing.quarantine.collect()}
    assert failed == {"2", "3"}


def test_signal_key_stays_a_data_column(spark):
    feed = spark.createDataFrame(
        [("c", 1706572800123, ["x"], "20240130"), ("d", None, None, None)],
        "customer_id string, signal_ts bigint, reason_codes array<string>, signal_date string",
    )
    landing = land_frame("fraud_signals", feed)
    rows = {r.customer_id: r for r in landing.rows.collect()}
    assert rows["c"].signal_ts == datetime(2024, 1, 30, 0, 0, 0, 123000) and rows["c"].signal_date == "20240130"
    assert rows["d"].signal_ts is None and landing.quarantine.count() == 0


def test_drift(spark):
    feed = spark.createDataFrame([("1", "x", "20240130")], "campaign_id string, surprise string, date_ts string")
    drift = {r.column_name: (r.finding, r.filled) for r in
             checks.column_drift(feed, RAW["email_campaign_clicks"]).collect()}
    assert drift["campaign_id"] == ("declared", 1)
    assert drift["surprise"] == ("unexpected", 1)
    assert drift["utm"] == ("missing", 0)
    assert len(drift) == 11


def test_struct_fields_are_matched_by_name(spark):
    feed = spark.sql(
        "SELECT 'e' event_id, array(named_struct('price', 1.5D, 'note', 'x', 'sku', 's')) items, "
        "named_struct('country', 'fr', 'ip', '1.1.1.1') context, '20240130' event_date, 5 hour_bucket "
        "UNION ALL SELECT 'n', array(NULL), NULL, '20240130', 5"
    )
    landing = land_frame("mobile_events", feed)
    rows = {r.event_id: r for r in landing.rows.collect()}
    item = rows["e"]["items"][0]
    assert (item.sku, item.qty, item.price) == ("s", None, Decimal("1.5"))
    assert rows["e"].context.ip == "1.1.1.1" and rows["e"].context.referrer is None
    assert rows["n"].context is None and rows["n"]["items"] == [None]
    assert landing.rows.schema.simpleString() == RAW["mobile_events"].schema.simpleString()
    assert landing.quarantine.count() == 0
