"""Faults that only larger or odd tables showed."""

from datetime import datetime

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from harness import checking
from harness.registry import ORACLES, QUERIES
from harness.tables import raw_shaped
from millrace.contracts import RAW
from millrace.operators.conform import DROP
from millrace.operators.layout import OPEN_FILES, files_kept_open, read_table, write_drops, write_table
from tests.oracle import compare, connection

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def zero_events(spark, tmp_path):
    """Events of each kind with and without the value zero."""
    kinds = ("view", "click", "signup", "purchase", "error")
    rows = [
        (10 * i + n, datetime(2024, 1, 1 + n, 5), i, kind, value, '{"k": 1}')
        for i, kind in enumerate(kinds)
        for n, value in enumerate((0.0, 12.5))
    ]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    con = connection(SF_DIR)
    con.execute(f"CREATE OR REPLACE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    return str(tmp_path), con


@pytest.mark.parametrize("name", ["float_tests", "write_day"])
def test_events_of_value_zero(spark, zero_events, name):
    sf_dir, con = zero_events
    assert compare(QUERIES[name](spark, sf_dir), con, ORACLES[name]) is None


OPEN = "spark.sql.maxConcurrentOutputFileWriters"


def test_loads_write_rows_without_sorting_them_by_folder(spark, tmp_path, monkeypatch):
    seen = []
    write = DataFrameWriter.parquet

    def watched(writer, *args, **kwargs):
        seen.append(spark.conf.get(OPEN, None))
        return write(writer, *args, **kwargs)

    before = spark.conf.get(OPEN, None)
    monkeypatch.setattr(DataFrameWriter, "parquet", watched)
    ids = spark.range(50)
    signals = raw_shaped(ids, "fraud_signals", customer_id=F.col("id").cast("string"), signal_ts=F.timestamp_seconds("id"))
    write_drops(signals.withColumn(DROP, F.lit("signal_date=a")), str(tmp_path / "drops"), RAW["fraud_signals"])
    app = raw_shaped(ids, "mobile_events", event_id=F.col("id").cast("string"), event_timestamp=F.timestamp_seconds("id"))
    write_table(app, str(tmp_path / "app"), RAW["mobile_events"])
    assert seen == ["100", "0"]  # the clustered table keeps its order
    assert spark.conf.get(OPEN, None) == before
    assert read_table(spark, str(tmp_path / "drops"), RAW["fraud_signals"]).count() == 50


def test_more_folders_than_files_kept_open(spark, tmp_path):
    """Rows of all folders are stored, those of the last ones by way of the sort."""
    hours = 3 * OPEN_FILES
    sales = raw_shaped(
        spark.range(0, 5 * hours, 1, 1), "pos_transactions", txn_id=F.col("id"), partition_ts=F.timestamp_seconds(F.col("id") % hours * 3600)
    )
    path = str(tmp_path / "sales")
    with files_kept_open(spark):
        sales.withColumn("_p", F.col("partition_ts").cast("string")).write.partitionBy("_p").parquet(path)
    counts = spark.read.parquet(path).groupBy("_p").count().collect()
    assert [r["count"] for r in counts] == [5] * hours


def test_days_of_the_cluster_check_are_written_by_several_tasks(spark, tmp_path, monkeypatch):
    path, merge = str(tmp_path / "clusters"), "spark.sql.adaptive.coalescePartitions.enabled"
    monkeypatch.setattr(checking, "scratch_path", lambda *_: path)
    before = spark.conf.get(merge)
    spark.conf.set(merge, "false")
    try:
        checking.check_clusters_two(spark, SF_DIR).collect()
    finally:
        spark.conf.set(merge, before)
    files = spark.read.parquet(path).select("_metadata.file_name").distinct().collect()
    assert len({f.file_name.split("-")[1] for f in files}) > 1


@pytest.mark.parametrize(("name", "amounts"), [("orders_in_steps", 2), ("clicks_in_steps", 1), ("orders_wide_amounts", 4)])
def test_amounts_are_computed_once_a_row(spark, name, amounts):
    """The text of an amount is padded once for each column it gives, not wherever a later step uses it."""
    frame = QUERIES[name](spark, SF_DIR)
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lpad(") <= amounts
