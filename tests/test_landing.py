"""Feeds read from files of each format, with defects."""

from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from millrace.contracts import RAW
from millrace.operators import checks
from millrace.sources import landing
from millrace.sources.readers import read_feed

DROP = {"date_ts": "2024013005"}


def write(path, text):
    Path(path).write_text(text, encoding="utf-8")
    return str(path)


def test_csv(spark, tmp_path):
    path = write(
        tmp_path / "sales.csv",
        'A1,S1,"red, large",2,2024-01-30 05:00:00,2.50,C1,FR\n'
        "A2,S2,\\N,x,2024-01-30 05:00:00,,C2,FR\n"
        "A3,S3,short\n",
    )
    landed = landing.land_sales_retail(spark, path, DROP)
    rows = {r.invoice_no: r for r in landed.rows.collect()}
    assert rows["A1"].description == "red, large" and rows["A1"].unit_price == Decimal("2.5")
    assert rows["A1"].partition_ts == datetime(2024, 1, 30, 5)
    assert rows["A2"].description is None and rows["A2"].quantity is None and rows["A2"].customer_id == "C2"
    assert rows["A3"].description == "short" and rows["A3"].country is None
    bad = {r.original[:2]: r.failed_columns for r in landed.quarantine.collect()}
    assert bad == {'{"': ["quantity"], "A3": []}


def test_csv_folders_are_read_as_text(spark, tmp_path):
    folder = tmp_path / "date_ts=2024013005" / "carrier_partition=007"
    folder.mkdir(parents=True)
    write(folder / "a.csv", "T1,ups,I1,C1,2024-01-29 10:00:00,,shipped,Rome,\n")
    row = landing.land_shipment_tracking(spark, str(tmp_path)).rows.first()
    assert row.carrier_partition == "007" and row.partition_ts == datetime(2024, 1, 30, 5)
    assert row.shipped_at == datetime(2024, 1, 29, 10) and row.delivered_at is None


def test_tsv_with_too_few_and_too_many_fields(spark, tmp_path):
    lines = ["\t".join(f"v{i}" for i in range(1, n + 1)) for n in (59, 60, 61)]
    path = write(tmp_path / "log.tsv", "\n".join(lines) + "\n")
    landed = landing.land_omniture_logs(spark, path, DROP)
    rows = landed.rows.collect()
    assert len(rows) == 3 and sorted(r.col_60 or "" for r in rows) == ["", "v60", "v60"]
    assert landed.quarantine.count() == 2
    contract = RAW["omniture_logs"]
    drift = checks.record_drift(read_feed(spark, contract, path, DROP), contract, ["date_ts"]).first()
    assert (drift.records, drift.malformed, drift.short) == (3, 2, 1)


def test_tsv_keeps_quotes(spark, tmp_path):
    path = write(tmp_path / "chat.tsv", 'c1\tu1\ta1\t2024-01-30 05:00:00\t\t60\t2\tsaid "no"\t0.5\n')
    row = landing.land_chat_transcripts(spark, path, DROP).rows.first()
    assert row.transcript == 'said "no"' and row.sentiment == Decimal("0.5") and row.ended_at is None


def test_json(spark, tmp_path):
    path = write(
        tmp_path / "events.json",
        '{"event_id":"e1","event_ts":"2024-01-30 05:06:07","properties":{"a":1,"b":"x"},'
        '"context":{"ip":"1.2.3.4","country":"fr"},"items":[{"sku":"s","qty":2,"price":2.50}]}\n'
        '{"event_id":"e2","items":[],"platform":"ios"}\n'
        '{"event_id":"e3","items":[{"sku":"s","qty":"many"}]}\n'
        "{broken\n",
    )
    landed = landing.land_mobile_events(spark, path, {"event_date": "20240130", "hour_bucket": "5"})
    rows = {r.event_id: r for r in landed.rows.collect()}
    assert rows["e1"].properties.toPython() == {"a": "1", "b": "x"}
    assert rows["e1"]["items"][0].price == Decimal("2.5") and rows["e1"].context.session_id is None
    assert rows["e2"]["items"] == [] and rows["e2"].context is None
    assert rows["e3"]["items"][0].qty is None
    assert rows[None].event_timestamp == datetime(2024, 1, 30, 5)
    bad = sorted((tuple(r.failed_columns), r.original[:7]) for r in landed.quarantine.collect())
    assert bad == [((), "{broken"), (("items",), '{"event')]


def test_json_keys_outside_the_contract(spark, tmp_path):
    path = write(tmp_path / "a.json", '{"campaign_id":"1","new":1}\n{"new":2,"newer":{"geo":1}}\n{broken\n')
    drift = checks.json_key_drift(spark.read.text(path), RAW["email_campaign_clicks"])
    assert {r.key_name: r.lines for r in drift.collect()} == {"new": 2, "newer": 1}


def test_pattern_lines(spark, tmp_path):
    path = write(
        tmp_path / "loyalty.log",
        '2024-01-30 05:00:00|m1|earn| 12 |s1|t1|{"a":"x|y"}\nnot a record\n2024-01-30 05:00:00||earn||||\n',
    )
    landed = landing.land_loyalty_events(spark, path, DROP)
    rows = landed.rows.collect()
    assert len(rows) == 3
    assert {r.meta_raw for r in rows} == {'{"a":"x|y"}', "", None}
    assert [r.original for r in landed.quarantine.collect()] == ["not a record"]


def test_pattern_is_a_parameter(spark, tmp_path):
    path = write(tmp_path / "loyalty.log", "a b c d e f g\n")
    row = landing.land_loyalty_events(spark, path, DROP, pattern="^" + " ".join([r"(\S+)"] * 7) + "$").rows.first()
    assert (row.event_ts_str, row.meta_raw) == ("a", "g")


def test_parquet_with_narrow_types(spark, tmp_path):
    path = str(tmp_path / "moves")
    frame = spark.sql(
        "SELECT 1 movement_id, 'w' warehouse_id, cast(3 AS tinyint) quantity, "
        "timestamp_ntz'2024-01-30 05:00:00' movement_ts, '2024' year, '01' month, '30' day"
    )
    frame.write.partitionBy("year", "month", "day").parquet(path)
    row = landing.land_inventory_movements(spark, path).rows.first()
    assert (row.movement_id, row.quantity, row.movement_date) == (1, 3, date(2024, 1, 30))
    assert row.movement_ts == datetime(2024, 1, 30, 5) and row.sku is None


def test_sequence_file_with_nested_lines(spark, tmp_path):
    path = str(tmp_path / "invoices.seq")
    fields = ["i1", "s1", "2024-01-02", "2024-02-02", "10.50", "EUR", "a\x032\x031.25\x02b\x03\\N\x032", "<x/>"]
    records = ["\x01".join(fields), "\x01".join(["i2"] + ["\\N"] * 7), "i3\x01s3"]
    spark.sparkContext.parallelize([(None, r) for r in records]).saveAsSequenceFile(path)
    landed = landing.land_supplier_invoices(spark, path, {"feed_year": "2024", "feed_month": "1"})
    rows = {r.invoice_no: r for r in landed.rows.collect()}
    assert [tuple(x) for x in rows["i1"].line_items] == [("a", 2, Decimal("1.25")), ("b", None, Decimal("2"))]
    assert rows["i1"].feed_date == date(2024, 1, 1) and rows["i1"].total_amount == Decimal("10.5")
    assert rows["i2"].line_items is None and rows["i2"].raw_xml is None
    assert rows["i3"].supplier_id == "s3"
    assert [r.original for r in landed.quarantine.collect()] == ["i3\x01s3"]


def test_drop_values_are_needed_where_folders_cannot_be_read(spark, tmp_path):
    with pytest.raises(ValueError, match="feed_month"):
        landing.land_supplier_invoices(spark, str(tmp_path), {"feed_year": "2024"})


SIGNALS = """
{"type": "record", "name": "signal", "fields": [
  {"name": "customer_id", "type": ["null", "string"]},
  {"name": "score", "type": ["null", "double"]},
  {"name": "reason_codes", "type": ["null", {"type": "array", "items": "string"}]},
  {"name": "signal_ts", "type": ["null", {"type": "long", "logicalType": "timestamp-millis"}]}]}
"""
SIGNUPS = """
{"type": "record", "name": "signup", "fields": [
  {"name": "customer_id", "type": ["null", "string"]},
  {"name": "first_name", "type": ["null", "string"]},
  {"name": "marketing_opt_in", "type": ["null", "boolean"]}]}
"""


def write_avro(spark, path, schema_text, rows):
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    avro = jvm.org.apache.avro
    schema = avro.Schema.Parser().parse(schema_text, gateway.new_array(jvm.String, 0))
    writer = avro.file.DataFileWriter(avro.generic.GenericDatumWriter(schema))
    writer = writer.create(schema, jvm.java.io.File(path))
    for row in rows:
        record = avro.generic.GenericData.Record(schema)
        for name, value in row.items():
            if isinstance(value, list):
                items = jvm.java.util.ArrayList()
                for item in value:
                    items.add(item)
                value = items
            elif isinstance(value, int) and not isinstance(value, bool):
                value = jvm.java.lang.Long.valueOf(value)
            record.put(name, value)
        writer.append(record)
    writer.close()


def test_avro_signals(spark, tmp_path):
    path = str(tmp_path / "signals.avro")
    write_avro(
        spark,
        path,
        SIGNALS,
        [
            {"customer_id": "c1", "score": 0.5, "reason_codes": ["a", 'b"c'], "signal_ts": 1706572800123},
            {"customer_id": "c2", "score": float("nan"), "reason_codes": [], "signal_ts": None},
            {"customer_id": "c3", "score": float("-inf"), "reason_codes": None, "signal_ts": 1706572800124},
        ],
    )
    landed = landing.land_fraud_signals(spark, path, {"signal_date": "20240130"})
    rows = {r.customer_id: r for r in landed.rows.collect()}
    assert rows["c1"].reason_codes == ["a", 'b"c'] and rows["c1"].score == 0.5
    assert rows["c1"].signal_ts == datetime(2024, 1, 30, 0, 0, 0, 123000)
    assert rows["c2"].score != rows["c2"].score and rows["c2"].reason_codes == [] and rows["c2"].signal_ts is None
    assert rows["c3"].score == float("-inf") and rows["c3"].reason_codes is None
    assert {r.signal_date for r in rows.values()} == {"20240130"} and landed.quarantine.count() == 0


def test_avro_signups(spark, tmp_path):
    path = str(tmp_path / "signups.avro")
    rows = [
        {"customer_id": "c1", "first_name": "Zoë\n", "marketing_opt_in": True},
        {"customer_id": "c2", "first_name": None, "marketing_opt_in": None},
    ]
    write_avro(spark, path, SIGNUPS, rows)
    landed = landing.land_customer_signups(spark, path, {"signup_date": "2024-01-30"})
    got = {r.customer_id: r for r in landed.rows.collect()}
    assert got["c1"].first_name == "Zoë\n" and got["c1"].marketing_opt_in is True
    assert got["c2"].first_name is None and got["c2"].marketing_opt_in is None
    assert got["c1"].signup_date == date(2024, 1, 30) and got["c1"].email is None


def test_catalog_table_feed(spark):
    """RCFile itself needs a catalog with Hive support; a view stands in for such a table."""
    spark.sql(
        "SELECT 's1' sku, 'p' supplier_id, cast(2.5 AS decimal(10,2)) msrp, map('a', '1') metadata, "
        "date'2024-01-01' available_from, '20240130' feed_date, 'x' other"
    ).createOrReplaceTempView("catalog_feed")
    landed = landing.land_product_catalog_feed(spark, "catalog_feed")
    row = landed.rows.first()
    assert row.msrp == Decimal("2.5") and row.metadata.toPython() == {"a": "1"}
    assert row.feed_date == date(2024, 1, 30) and row.available_from == date(2024, 1, 1)
    assert landed.rows.columns == RAW["product_catalog_feed"].names


def test_landing_does_not_depend_on_session_zone(spark, tmp_path):
    path = write(tmp_path / "log.csv", "A1,S1,d,2,2024-01-30 05:00:00,2.50,C1,FR\n")
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        rows = landing.land_sales_retail(spark, path, DROP).rows
        assert rows.select(F.col("partition_ts").cast("string")).first()[0] == "2024-01-30 05:00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_footers_are_read_by_tasks_and_grouped_by_schema(spark, tmp_path):
    """Forty files of three schemas: one group each, whatever the order of the files."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    from millrace.sources import readers

    path = f"{tmp_path}/drop with space"
    Path(path).mkdir()
    for n in range(40):
        columns = [{"sku": ["a"], "quantity": pa.array([n], pa.int64())}, {"sku": ["a"], "quantity": [str(n)]}, {"sku": ["a"], "quantity": [n / 2], "new": [1]}][n % 3]
        pq.write_table(pa.table(columns), f"{path}/f{n:02}.parquet")
    groups = readers.file_groups(spark, path).collect()
    assert sorted(len(g["paths"]) for g in groups) == [13, 13, 14]
    values = {"year": "2024", "month": "1", "day": "30"}
    parts = readers.parquet_parts(spark, RAW["inventory_movements"], path, values, every=True)
    assert sorted((dict(p.dtypes)["quantity"], p.count()) for p in parts) == [("bigint", 14), ("double", 13), ("string", 13)]
