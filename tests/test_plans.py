"""Plans of the jobs: what is reduced before a shuffle, what is read, and what must not appear."""

import pytest
from pyspark.sql import functions as F

from harness.registry import QUERIES
from harness.tables import raw_shaped
from millrace.operators.latest import latest_per_key
from millrace.operators.trailing import trailing_summary
from millrace.plans.clickstream import dedup_clickstream

SF_DIR = "/root/testdata/sf0.001"


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def before_shuffle(plan, operator):
    """True when some shuffle in the plan is fed directly by the operator."""
    lines = plan.split("\n")
    return any("Exchange hashpartitioning" in a and operator in b for a, b in zip(lines, lines[1:]))


@pytest.mark.parametrize("name", ["merged_cdc", "cleansed_products", "cleansed_orders", "dedup_clickstream"])
def test_latest_rows_are_picked_before_the_shuffle(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert any("WindowGroupLimit" in line and "Partial" in line for line in plan.split("\n"))


@pytest.mark.parametrize("name", ["kpi_snapshot", "check_parity", "check_differences", "dedup_clickstream"])
def test_sums_are_taken_before_the_shuffle(spark, name):
    assert "partial_" in plan_of(QUERIES[name](spark, SF_DIR))


@pytest.mark.parametrize("name", ["parsed_events", "view_projection", "view_recent", "view_returns_pending",
                                  "conform_scalar", "conform_nested", "map_to_variant"])
def test_projections_do_not_shuffle(spark, name):
    assert "Exchange" not in plan_of(QUERIES[name](spark, SF_DIR))


def test_views_read_only_their_columns_and_push_filters(spark):
    plan = plan_of(QUERIES["view_returns_pending"](spark, SF_DIR))
    scanned = plan[plan.index("FileScan parquet [") :].split("]")[0]
    assert "l_tax" not in scanned and "l_extendedprice" not in scanned
    recent = plan_of(QUERIES["kpi_snapshot"](spark, SF_DIR))
    assert "EqualTo(l_returnflag,A)" in recent


def test_a_hot_key_leaves_one_row_per_task_to_be_shuffled(spark):
    rows = spark.range(200_000).repartition(8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id"
    )
    latest = latest_per_key(rows, ["k"], ["id"])
    assert latest.where("k = 0").first().id == 199_998
    assert latest.count() == 1 + 200_000 - 66_667


def test_a_hot_customer_does_not_multiply(spark):
    """40,000 sales and 40,000 signals of one customer in one day: joined they would be 800 million
    pairs. All scores are checked against a running maximum."""
    n = 40_000
    at = F.timestamp_millis(F.lit(1706572800000) + F.col("id") * 2000)
    moments = spark.range(n).select(F.lit("hot").alias("key"), at.alias("moment"))
    score = (F.col("id") / n).alias("score")
    events = spark.range(n).select(
        F.lit("hot").alias("key"), at.alias("ts"), score, F.array(F.concat(F.lit("c"), (F.col("id") % 5).cast("string"))).alias("codes")
    )
    got = trailing_summary(moments, events)
    wrong = got.where(
        (F.abs(F.col("score") - (F.unix_millis("moment") - 1706572800000) / 2000 / n) > 1e-12)
        | (F.size("codes") != F.least(F.lit(5), (F.unix_millis("moment") - 1706572800000) / 2000 + 1))
    )
    assert got.count() == n and wrong.count() == 0


def test_a_hot_visitor_is_walked_by_slices(spark):
    """All events belong to one visitor: one every 20 seconds for four days, with one long pause."""
    n = 17_280
    late = F.when(F.col("id") >= n // 2, 7200).otherwise(0)
    at = F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 20 + late)
    app = raw_shaped(
        spark.range(n), "mobile_events", event_id=F.col("id").cast("string"), event_ts=at, user_id=F.lit("hot")
    )
    web = spark.createDataFrame([], "event_ts string, ip string, url string, user_id string, country string, "
                                    "partition_ts timestamp")  # fmt: skip
    sessions = dedup_clickstream(web, app).groupBy("session_id").count().collect()
    assert sorted(r["count"] for r in sessions) == [n // 2, n // 2]


@pytest.mark.parametrize("name,scans", [("cleansed_orders", 2), ("dedup_clickstream", 4)])
def test_feeds_are_scanned_no_more_than_needed(spark, name, scans):
    """Rows with and without a key come from one scan; sessions need a second, narrow one."""
    assert plan_of(QUERIES[name](spark, SF_DIR)).count("FileScan parquet") == scans


def test_fraud_scoring_reads_each_feed_twice(spark):
    """Sales for the moments asked and for the result, signals for scores and for codes; the plan that is
    left reads the sales once and otherwise the reduced tables."""
    plan = plan_of(QUERIES["fraud_scored"](spark, SF_DIR))
    assert plan.count("events.parquet") == 1 and "trailing-scores" in plan
