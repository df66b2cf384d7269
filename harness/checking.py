"""The data checks, over loads with defects put in by rules that the oracles repeat."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harness.conforming import special_double
from harness.storing import events_as_app
from harness.tables import raw_shaped, second_text, shaped, table, text
from millrace.contracts import RAW, STAGING
from millrace.operators import checks
from millrace.operators.layout import files_kept_open, stored_table, write_table
from millrace.session import scratch_path
from millrace.sources.landing import land_frame
from millrace.sources.readers import read_feed

QUERIES = {}
ORACLES = {}


def query(oracle: str):
    def register(function):
        QUERIES[function.__name__] = function
        ORACLES[function.__name__] = oracle
        return function

    return register


def _bad_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors carry an unreadable amount, signups an unreadable time, views an unreadable hour."""
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        text("event_id").alias("txn_id"),
        F.when(kind == "error", F.lit("12,50")).otherwise(text("value")).alias("gross_amount"),
        F.when(kind == "signup", F.lit("yesterday")).otherwise(second_text("ts")).alias("txn_ts"),
        F.when(kind == "view", F.date_format("ts", "yyyyMMdd'25'"))
        .otherwise(F.date_format("ts", "yyyyMMddHH"))
        .alias("date_ts"),
        kind.alias("tender_type"),
    )


# Declared columns of pos_transactions, in order, that the bad sales do not fill.
OTHER_COLUMNS = [
    "txn_id", "store_id", "register_id", "cashier_id", "customer_id", "invoice_no", "line_count",
    "discount_amount", "tax_amount", "tender_type", "void_flag",
]


@query(
    """
    SELECT column_name, (SELECT count(*) FROM events) AS rows, failed FROM (
      SELECT 'gross_amount' AS column_name, count(*) FILTER (WHERE event_type = 'error') AS failed FROM events
      UNION ALL SELECT 'txn_ts', count(*) FILTER (WHERE event_type = 'signup') FROM events
      UNION ALL SELECT 'partition_ts', count(*) FILTER (WHERE event_type = 'view') FROM events
      UNION ALL SELECT unnest([{others}]), 0)
    """.format(others=", ".join(f"'{c}'" for c in OTHER_COLUMNS))
)
def check_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.cast_report(land_frame("pos_transactions", _bad_sales(spark, sf_dir)))


@query(
    """
    SELECT 'raw.pos_transactions' AS table_name,
           CASE event_type WHEN 'error' THEN 'gross_amount' WHEN 'signup' THEN 'txn_ts'
                ELSE 'partition_ts' END AS failed_columns,
           CAST(event_id AS VARCHAR) AS txn_id, event_type AS tender_type
    FROM events WHERE event_type IN ('error', 'signup', 'view')
    """
)
def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that did not fit, with their original text."""
    rows = land_frame("pos_transactions", _bad_sales(spark, sf_dir)).quarantine
    return rows.select(
        "table_name",
        F.array_join("failed_columns", ",").alias("failed_columns"),
        F.get_json_object("original", "$.txn_id").alias("txn_id"),
        F.get_json_object("original", "$.tender_type").alias("tender_type"),
    )


@query(
    """
    SELECT column_name, finding, CAST(filled AS BIGINT) AS filled FROM (
      SELECT unnest(['rma_id', 'customer_id', 'requested_at', 'date_ts']) AS column_name,
             'declared' AS finding, (SELECT count(*) FROM events) AS filled
      UNION ALL
      SELECT unnest(['invoice_no', 'stock_code', 'quantity', 'reason_code', 'reason_text', 'approved',
                     'refund_amount']), 'missing', 0
      UNION ALL
      SELECT 'note', 'unexpected', count(*) FILTER (WHERE event_type = 'error') FROM events)
    """
)
def check_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = table(spark, sf_dir, "events").select(
        text("event_id").alias("rma_id"),
        text("user_id").alias("customer_id"),
        second_text("ts").alias("requested_at"),
        F.date_format("ts", "yyyyMMdd").alias("date_ts"),
        F.when(F.col("event_type") == "error", F.col("props")).alias("note"),
    )
    return checks.column_drift(feed, RAW["return_authorizations"])


@query(
    """
    SELECT strftime(ts, '%Y%m%d') AS date_ts, count(*) AS records,
           count(*) FILTER (WHERE event_type IN ('view', 'click')) AS malformed,
           count(*) FILTER (WHERE event_type = 'view') AS short
    FROM events GROUP BY ALL
    """
)
def check_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web log lines of 59, 60 and 61 fields."""
    contract, path = RAW["omniture_logs"], scratch_path(spark, "check_records")
    kind = F.col("event_type")
    fields = F.when(kind == "view", 59).when(kind == "click", 61).otherwise(60)
    line = F.array_join(F.array_repeat(text("event_id"), fields), "\t").alias("value")
    lines = table(spark, sf_dir, "events").select(line, F.date_format("ts", "yyyyMMdd").alias("date_ts"))
    lines.write.partitionBy("date_ts").text(path)
    return checks.record_drift(read_feed(spark, contract, path), contract, ["date_ts"])


@query(
    """
    SELECT key_name, count(*) AS lines FROM (
      SELECT 'kind_' || event_type AS key_name FROM events
      UNION ALL SELECT 'session' FROM events WHERE event_type = 'error')
    GROUP BY ALL
    """
)
def check_json_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks with keys that the feed does not declare."""
    kind = F.col("event_type")
    known = F.concat(F.lit('{"campaign_id":"'), text("event_id"), F.lit('","utm":'), F.col("props"))
    extra = F.concat(F.lit(',"kind_'), kind, F.lit('":1'))
    session = F.when(kind == "error", F.lit(',"session":"x"')).otherwise("")
    lines = table(spark, sf_dir, "events").select(F.concat(known, extra, session, F.lit("}")).alias("value"))
    return checks.json_key_drift(lines, RAW["email_campaign_clicks"])


@query(
    """
    SELECT strftime(ts, '%Y-%m-%d') AS partition_value, count(*) AS rows,
           count(*) FILTER (WHERE event_type = 'error') AS misplaced, 0 AS null_keys
    FROM events GROUP BY ALL
    """
)
def check_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors were stored under the day before their movement."""
    contract, path = RAW["inventory_movements"], scratch_path(spark, "check_keys")
    moved = F.when(F.col("event_type") == "error", F.col("ts") + F.expr("INTERVAL 1 DAY")).otherwise(F.col("ts"))
    moves = raw_shaped(
        table(spark, sf_dir, "events"),
        "inventory_movements",
        movement_id=F.col("event_id"),
        movement_ts=moved,
        movement_date=F.to_date("ts"),
    )
    write_table(moves, path, contract)
    return checks.key_report(stored_table(spark, path, contract), contract, F.to_date("movement_ts"))


@query(
    "SELECT strftime(ts, '%Y%m%d%H') AS partition_value, 0 AS overlapping, true AS has_files FROM events GROUP BY ALL"
)
def check_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    contract, path = RAW["mobile_events"], scratch_path(spark, "check_clusters")
    write_table(events_as_app(spark, sf_dir), path, contract)
    report = checks.cluster_report(spark, path, contract)
    return report.select("partition_value", "overlapping", (F.col("files") > 0).alias("has_files"))


@query(
    """
    WITH files AS (
      SELECT ts::DATE AS d, min(user_id % 10) FILTER (user_id % 10 <= 4) AS l1, max(user_id % 10) FILTER (user_id % 10 <= 4) AS h1,
             min(user_id % 10) FILTER (user_id % 10 >= CASE WHEN day(ts) % 2 = 0 THEN 3 ELSE 5 END) AS l2,
             max(user_id % 10) FILTER (user_id % 10 >= CASE WHEN day(ts) % 2 = 0 THEN 3 ELSE 5 END) AS h2
      FROM events GROUP BY 1)
    SELECT strftime(d, '%Y-%m-%d') AS partition_value, (l1 IS NOT NULL)::BIGINT + (l2 IS NOT NULL)::BIGINT AS files,
           coalesce(CASE WHEN l1 < l2 OR (l1 = l2 AND h1 <= h2) THEN l2 < h1 ELSE l1 < h2 END, false)::BIGINT AS overlapping
    FROM files
    """
)
def check_clusters_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows are of one country, so only the second cluster column can overlap: on even days the users
    of a second file begin below the last ones of the first."""
    contract, path = STAGING["dedup_clickstream"], scratch_path(spark, "check_clusters_two")
    user = F.col("user_id") % 10
    rows = table(spark, sf_dir, "events").select("ts", user.alias("u"), F.to_date("ts").alias("event_date"))
    begin = F.when(F.dayofmonth("ts") % 2 == 0, 3).otherwise(5)
    for part in (F.col("u") <= 4, F.col("u") >= begin):
        clicks = shaped(rows.where(part), contract, user_id=text("u"), country_partition=F.lit("DE"), event_date=F.col("event_date"))
        # One task holds a day, so that the day gets one file; days are dealt to different tasks.
        with files_kept_open(spark):
            clicks.repartition("event_date").write.mode("append").partitionBy("event_date").parquet(path)
    return checks.cluster_report(spark, path, contract)


def _copies(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A source, and a target that lost the errors of small value and holds the views of great value twice."""
    source = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", "value", F.try_parse_json("props").alias("doc")
    )
    lost = (F.col("event_type") == "error") & (F.col("value") < 10)
    twice = (F.col("event_type") == "view") & (F.col("value") > 300)
    copies = F.when(lost, 0).when(twice, 2).otherwise(1)
    target = source.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), copies))).drop("_copy")
    return source, target


@query(
    """
    SELECT CAST(user_id AS VARCHAR) AS key_value, count(*) AS source_rows,
           CAST(count(*) - sum(CASE WHEN event_type = 'error' AND value < 10 THEN 1 ELSE 0 END)
                + sum(CASE WHEN event_type = 'view' AND value > 300 THEN 1 ELSE 0 END) AS BIGINT) AS target_rows,
           sum(CASE WHEN (event_type = 'error' AND value < 10) OR (event_type = 'view' AND value > 300)
                    THEN 1 ELSE 0 END) = 0 AS passed
    FROM events GROUP BY user_id
    """
)
def check_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = _copies(spark, sf_dir)
    return checks.parity_report(source, target, "user_id")


@query(
    """
    SELECT event_id, event_type, 1 AS source_rows, CASE WHEN event_type = 'view' THEN 2 ELSE 0 END AS target_rows
    FROM events
    WHERE (event_type = 'error' AND value < 10) OR (event_type = 'view' AND value > 300)
    """
)
def check_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = _copies(spark, sf_dir)
    return checks.row_differences(source, target).select("event_id", "event_type", "source_rows", "target_rows")


@query(ORACLES["check_differences"])
def check_differences_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same differences, found by comparing the rows of differing buckets only."""
    source, target = _copies(spark, sf_dir)
    found = checks.row_differences_pruned(source, target, "event_type", 256)
    return found.select("event_id", "event_type", "source_rows", "target_rows")


@query(
    """
    SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS key_value, count(*) AS source_rows,
           count(*) AS target_rows, true AS passed
    FROM orders GROUP BY ALL
    """
)
def check_numeric_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts of up to 16 digits, of both signs, and nested ones with nine decimals."""
    contract = RAW["supplier_invoices"]
    price = F.col("o_totalprice").cast("decimal(15,2)")
    signed = F.when(F.col("o_orderstatus") == "F", -price).otherwise(price)
    line = F.struct(
        text("o_custkey").alias("sku"),
        F.lit(1).cast("bigint").alias("qty"),
        (signed * F.lit("0.0000001").cast("decimal(8,7)")).cast("decimal(38,9)").alias("unit_price"),
    )
    invoices = raw_shaped(
        table(spark, sf_dir, "orders"),
        "supplier_invoices",
        invoice_no=text("o_orderkey"),
        total_amount=signed * F.lit(10**8).cast("decimal(9,0)") + F.lit("0.01").cast("decimal(3,2)"),
        line_items=F.array(line),
        feed_date=F.trunc("o_orderdate", "MONTH"),
    )
    return checks.round_trip_report(spark, invoices, scratch_path(spark, "numeric_round_trip"), contract)


@query(
    """
    SELECT strftime(ts, '%Y-%m-%d') AS key_value, count(*) AS source_rows, count(*) AS target_rows, true AS passed
    FROM events GROUP BY ALL
    """
)
def check_double_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NaN, infinities, zeros of both signs, and numbers with all their digits."""
    contract = STAGING["cleansed_customers"]
    customers = shaped(
        table(spark, sf_dir, "events"),
        contract,
        customer_id=text("event_id"),
        geocoded_lat=special_double(),
        geocoded_lon=F.col("value") / 3,
        load_date=F.to_date("ts"),
    )
    return checks.round_trip_report(spark, customers, scratch_path(spark, "double_round_trip"), contract)


@query(
    """
    SELECT 'casts' AS check_name, 11 AS passed, 3 AS failed
    UNION ALL
    SELECT 'parity', count(*) FILTER (WHERE bad = 0), count(*) FILTER (WHERE bad > 0)
    FROM (SELECT sum(CASE WHEN (event_type = 'error' AND value < 10) OR (event_type = 'view' AND value > 300)
                          THEN 1 ELSE 0 END) AS bad FROM events GROUP BY user_id)
    """
)
def check_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    casts = checks.verdicts(check_casts(spark, sf_dir), "casts", F.col("failed") == 0)
    parity = checks.verdicts(check_parity(spark, sf_dir), "parity", F.col("passed"))
    return checks.totals([casts, parity])
