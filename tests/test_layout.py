import os
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import functions as F

from harness.tables import raw_shaped
from millrace.contracts import RAW, STAGING
from millrace.operators import checks
from millrace.operators.layout import place, read_table, stored_table, write_table
from millrace.plans.views import omniture


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def app_events(spark, rows=2000, hours=6):
    ids = spark.range(rows)
    return raw_shaped(
        ids,
        "mobile_events",
        event_id=F.col("id").cast("string"),
        platform=F.concat(F.lit("p"), (F.col("id") * 7 % 5).cast("string")),
        event_timestamp=F.timestamp_seconds(F.lit(1704067200) + F.col("id") % hours * 3600),
    )


def folders(path):
    return sorted(d for d in os.listdir(path) if "=" in d)


def test_hours_become_folders_and_are_pruned(spark, table_path):
    contract = RAW["mobile_events"]
    write_table(app_events(spark), table_path, contract)
    assert folders(table_path) == [f"_p=20240101{h:02d}" for h in range(6)]
    read = read_table(spark, table_path, contract, datetime(2024, 1, 1, 2), datetime(2024, 1, 1, 4))
    assert read.columns == contract.names
    assert read.count() == 2000 // 6 * 2 + sum(1 for i in range(1998, 2000) if i % 6 in (2, 3))
    plan = plan_of(read)
    assert "PartitionFilters: [isnotnull(_p" in plan and "2024010102" in plan
    assert read_table(spark, table_path, contract).count() == 2000


def test_dates_and_months(spark, table_path):
    contract = RAW["supplier_invoices"]
    frame = raw_shaped(
        spark.range(60), "supplier_invoices", feed_date=F.date_add(F.lit("2024-01-15").cast("date"), F.col("id").cast("int"))
    )
    write_table(frame, table_path, contract)
    assert folders(table_path) == ["_p=202401", "_p=202402", "_p=202403"]
    read = read_table(spark, table_path, contract, date(2024, 2, 10), date(2024, 2, 20))
    assert read.count() == 10
    assert "202402" in plan_of(read)

    orders = STAGING["cleansed_orders"]
    path = table_path + "_orders"
    dated = spark.range(10).select(
        F.col("id").cast("string").alias("order_id"),
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in orders.schema.fields[1:-1]],
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int") % 3).alias("order_date"),
    )
    write_table(dated, path, orders)
    read = read_table(spark, path, orders, since=date(2024, 1, 3))
    assert read.count() == 3
    assert "PartitionFilters: [isnotnull(order_date" in plan_of(read)


def test_rows_without_a_key_are_kept(spark, table_path):
    contract = RAW["mobile_events"]
    keyless = app_events(spark, 10).withColumn("event_timestamp", F.lit(None).cast("timestamp"))
    write_table(app_events(spark, 10).union(keyless), table_path, contract)
    read = read_table(spark, table_path, contract)
    assert read.count() == 20 and read.where("event_timestamp IS NULL").count() == 10
    report = checks.key_report(stored_table(spark, table_path, contract), contract)
    got = {r.partition_value: (r.rows, r.misplaced, r.null_keys) for r in report.collect()}
    assert got[None] == (10, 0, 10)


def test_reload_replaces_only_its_partitions(spark, table_path):
    contract = RAW["mobile_events"]
    write_table(app_events(spark, 60), table_path, contract)
    again = app_events(spark, 6).where(F.hour("event_timestamp") == 3)
    write_table(again, table_path, contract, mode="partitions")
    counts = stored_table(spark, table_path, contract).groupBy("_p").count().collect()
    assert {r["_p"]: r["count"] for r in counts} == {f"20240101{h:02d}": 1 if h == 3 else 10 for h in range(6)}
    write_table(again, table_path, contract)
    assert folders(table_path) == ["_p=2024010103"]


def hot_sizes(spark, frame):
    """Rows per task after placing, largest first."""
    sizes = frame.groupBy(F.spark_partition_id()).count().collect()
    return sorted((r["count"] for r in sizes), reverse=True)


def test_a_hot_hour_is_cut_into_several_files(spark, table_path):
    """One hour and one platform hold nearly all rows; clustering still cuts them by row hash."""
    contract = RAW["mobile_events"]
    hot = app_events(spark, 40_000, hours=1).withColumn("platform", F.lit("p0"))
    frame = hot.union(app_events(spark, 400))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert hot_sizes(spark, place(frame, contract))[0] < 20_000
        write_table(frame, table_path, contract)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    report = {r.partition_value: r for r in checks.cluster_report(spark, table_path, contract).collect()}
    assert report["2024010100"].files > 1
    assert all(r.overlapping == 0 for r in report.values())


def test_a_hot_partition_is_rebalanced_without_cluster_columns(spark, table_path):
    contract = RAW["pos_transactions"]
    frame = raw_shaped(
        spark.range(100_000).repartition(8),
        "pos_transactions",
        txn_id=F.col("id"),
        store_id=F.sha2(F.col("id").cast("string"), 256),
        partition_ts=F.lit("2024-01-01 00:00:00"),
    )
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        write_table(frame, table_path, contract)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    assert folders(table_path) == ["_p=2024010100"]
    files = stored_table(spark, table_path, contract).groupBy("_metadata.file_path").count().collect()
    assert len(files) > 2 and max(r["count"] for r in files) < 50_000


def test_overlapping_files_are_found(spark, table_path):
    contract = RAW["mobile_events"]
    stored = app_events(spark, 1000).withColumn("_p", F.lit("2024010100"))
    stored.repartition(3).write.partitionBy("_p").parquet(table_path)
    row = checks.cluster_report(spark, table_path, contract).first()
    assert row.files == 3 and row.overlapping == 2


def test_misplaced_rows_are_found(spark, table_path):
    contract = RAW["mobile_events"]
    stored = app_events(spark, 100).withColumn("_p", F.lit("2024010100"))
    stored.write.partitionBy("_p").parquet(table_path)
    row = checks.key_report(stored_table(spark, table_path, contract), contract).first()
    assert row.rows == 100 and row.misplaced == 100 - 17


def test_view_reads_eight_columns(spark, table_path):
    contract = RAW["omniture_logs"]
    logs = raw_shaped(spark.range(10), "omniture_logs", col_2=F.lit("x"), partition_ts=F.lit("2024-01-01 00:00:00"))
    write_table(logs, table_path, contract)
    plan = plan_of(omniture(read_table(spark, table_path, contract)))
    scanned = plan[plan.index("FileScan parquet [") :].split("]")[0]
    assert scanned.count("col_") == 7 and "partition_ts" in scanned


def test_folders_and_bounds_are_in_utc_whatever_the_zone(spark, table_path):
    contract = RAW["mobile_events"]
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
        write_table(app_events(spark, 24, 24), table_path, contract)
        assert folders(table_path) == [f"_p=20240101{h:02d}" for h in range(24)]
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        read = read_table(spark, table_path, contract, datetime(2024, 1, 1, 2), datetime(2024, 1, 1, 8))
        assert sorted(int(r.event_id) for r in read.collect()) == [2, 3, 4, 5, 6, 7]
        aware = datetime(2024, 1, 1, 4, tzinfo=timezone(timedelta(hours=2)))
        assert read_table(spark, table_path, contract, since=aware).count() == 22
        signals = raw_shaped(spark.range(3), "fraud_signals", signal_ts=F.timestamp_seconds(1704067200 - 1 + F.col("id")))
        write_table(signals, table_path + "2", RAW["fraud_signals"])
        assert folders(table_path + "2") == ["_p=20231231", "_p=20240101"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
