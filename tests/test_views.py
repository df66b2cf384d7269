from datetime import date, datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from harness.tables import raw_shaped
from millrace.contracts import RAW
from millrace.plans import views


def empty(spark, feed):
    return spark.createDataFrame([], RAW[feed].schema)


def test_views_resolve_on_empty_bases(spark):
    assert views.omniture(empty(spark, "omniture_logs")).columns == [
        "event_ts", "ip", "url", "user_id", "city", "country", "state", "partition_ts",
    ]
    recent = views.fraud_signals_recent(empty(spark, "fraud_signals"), date(2024, 1, 30))
    assert recent.columns == RAW["fraud_signals"].names
    pending = views.returns_pending(empty(spark, "return_authorizations"), date(2024, 1, 30))
    assert pending.columns == [
        "rma_id", "customer_id", "invoice_no", "stock_code", "quantity", "requested_at", "days_pending",
    ]
    assert dict(pending.dtypes)["days_pending"] == "bigint"


def test_missing_column_is_refused_without_reading(spark):
    with pytest.raises(AnalysisException):
        views.omniture(empty(spark, "omniture_logs").drop("col_53"))


def test_pending_returns(spark):
    rows = [
        ("yes", True, "2024-01-01 10:00:00"),
        ("no", False, "2024-01-29 23:59:59"),
        ("open", None, "2024-01-30 00:00:00"),
        ("undated", None, None),
        ("future", False, "2024-02-02 01:00:00"),
    ]
    frame = spark.createDataFrame(rows, "rma string, ok boolean, at string")
    base = raw_shaped(
        frame, "return_authorizations", rma_id=F.col("rma"), approved=F.col("ok"), requested_at=F.col("at")
    )
    got = {r.rma_id: r.days_pending for r in views.returns_pending(base, date(2024, 1, 30)).collect()}
    assert got == {"no": 1, "open": 0, "undated": None, "future": -3}


@pytest.mark.parametrize("prune_key", [False, True])
def test_recent_signals(spark, prune_key):
    days = ["20240130", "20240129", "20240128", None, "20240131"]
    frame = spark.createDataFrame([(d,) for d in days], "day string")
    at = F.to_timestamp(F.coalesce("day", F.lit("20240130")), "yyyyMMdd")
    base = raw_shaped(frame, "fraud_signals", signal_date=F.col("day"), signal_ts=at)
    recent = views.fraud_signals_recent(base, date(2024, 1, 30), prune_key)
    assert sorted(r.signal_date for r in recent.collect()) == ["20240129", "20240130", "20240131"]


def test_projection(spark):
    base = raw_shaped(
        spark.range(1),
        "omniture_logs",
        **{f"col_{i}": F.lit(f"v{i}") for i in range(1, 61)},
        partition_ts=F.lit("2024-01-30 05:00:00"),
    )
    row = views.omniture(base).first()
    assert tuple(row) == ("v2", "v8", "v13", "v14", "v50", "v51", "v53", datetime(2024, 1, 30, 5))
