"""Values at and beyond the limits of the declared types, rows without keys, and drops that come again."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harness.staging import MERGED, _changes, _merged
from harness.storing import events_as_app
from harness.tables import MICRO, SECOND, money, raw_shaped, second_text, table, text
from millrace.contracts import RAW
from millrace.functions.text import address_hash
from millrace.functions.types import NUMERIC
from millrace.operators import checks
from millrace.operators.conform import DROP
from millrace.operators.layout import read_table, write_drops, write_table
from millrace.plans.addresses import ADDRESS, geocoded_addresses, unplaced_addresses
from millrace.plans.carriers import normalized_carrier_events, untimed_shipments
from millrace.plans.clickstream import dedup_clickstream
from millrace.plans.fraud import fraud_scored, unfit_scores
from millrace.plans.load import load_feed, table_path
from millrace.plans.orders import cleansed_orders, orders_of, orders_state, unfit_orders_of
from millrace.plans.returns import returns_snapshot, returns_state, unkeyed_returns
from millrace.plans.warehouse import closing_backlog, warehouse_kpi_snapshot
from millrace.session import scratch_path, written
from millrace.sources.landing import land
from millrace.sources.readers import parquet_parts

QUERIES = {}
ORACLES = {}


def query(oracle: str):
    def register(function):
        QUERIES[function.__name__] = function
        ORACLES[function.__name__] = oracle
        return function

    return register


BILLIONTHS = "(n // 1000000000) || '.' || lpad(CAST(n % 1000000000 AS VARCHAR), 9, '0')"


@query(
    f"""
    WITH lines AS (SELECT l_orderkey, (CAST(10000000001 AS HUGEINT) + CAST(l_quantity AS HUGEINT)) * 123456789 AS n FROM lineitem),
    sums AS (SELECT l_orderkey AS k, CAST(sum(n) AS HUGEINT) AS n FROM lines GROUP BY 1)
    SELECT CAST(k AS VARCHAR) AS order_id, {BILLIONTHS} AS net_amount, false AS unfit FROM sums
    UNION ALL
    SELECT 'wide ' || o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE repeat('9', 29) || '.000000000' END,
           o_orderstatus = 'P'
    FROM orders
    """
)
def orders_wide_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantities beyond ten digits with nine decimals, and amounts of 29 digits; with a tax, the
    latter do not fit and are listed."""
    lines = raw_shaped(
        table(spark, sf_dir, "lineitem"),
        "sales_retail",
        invoice_no=text("l_orderkey"),
        quantity=F.col("l_quantity").cast("bigint") + F.lit(10_000_000_001),
        unit_price=F.lit("0.123456789").cast(NUMERIC),
    )
    tills = raw_shaped(
        table(spark, sf_dir, "orders"),
        "pos_transactions",
        txn_id=F.col("o_orderkey"),
        gross_amount=F.lit("9" * 29).cast(NUMERIC),
        tax_amount=F.when(F.col("o_orderstatus") == "P", F.lit(1).cast(NUMERIC)),
    )
    said = [F.get_json_object("original", f"$.{c}").alias(f"_{c}") for c in ("order_id", "source_feed")]
    state = written(orders_state(tills, lines), "orders-wide")
    unfit = unfit_orders_of(state).select(*said)
    same = (F.col("order_id") == F.col("_order_id")) & (F.col("source_feed") == F.col("_source_feed"))
    orders = orders_of(state).join(unfit, same, "left")
    name = F.when(F.col("source_feed") == "pos", F.concat(F.lit("wide "), "order_id")).otherwise(F.col("order_id"))
    return orders.select(name.alias("order_id"), text("net_amount").alias("net_amount"), F.col("_order_id").isNotNull().alias("unfit"))


@query(
    """
    WITH tills AS (SELECT o_orderkey % 5 = 0 AS keyless, * FROM orders)
    SELECT 'pos' AS source_feed, NULL AS order_id, CAST(o_totalprice AS DECIMAL(18,2))::DOUBLE AS gross_amount, NULL AS line_count
    FROM tills WHERE keyless
    UNION ALL
    SELECT 'pos', CAST(o_orderkey AS VARCHAR), CAST(o_totalprice AS DECIMAL(18,2))::DOUBLE, NULL FROM tills WHERE NOT keyless
    UNION ALL
    SELECT 'retail', NULL, CAST(l_extendedprice AS DECIMAL(18,2))::DOUBLE, 1 FROM lineitem WHERE l_returnflag = 'A'
    UNION ALL
    SELECT 'retail', CAST(l_orderkey AS VARCHAR), CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE), count(*)
    FROM lineitem WHERE l_returnflag <> 'A' GROUP BY l_orderkey
    """
)
def orders_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fifth of the till records and all lines flagged A have no key."""
    tills = raw_shaped(
        table(spark, sf_dir, "orders"),
        "pos_transactions",
        txn_id=F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderkey")),
        gross_amount=F.col("o_totalprice").cast("decimal(18,2)"),
    )
    lines = raw_shaped(
        table(spark, sf_dir, "lineitem"),
        "sales_retail",
        invoice_no=F.when(F.col("l_returnflag") != "A", text("l_orderkey")),
        quantity=F.lit(1),
        unit_price=F.col("l_extendedprice").cast("decimal(18,2)"),
    )
    orders = cleansed_orders(tills, lines)
    return orders.select("source_feed", "order_id", money("gross_amount").alias("gross_amount"), "line_count")


@query(
    """
    WITH best AS (SELECT s_nationkey, max(CAST(s_acctbal * 100 AS BIGINT)) AS hundredths FROM supplier GROUP BY 1)
    SELECT DISTINCT lower(n_name) AS addr_city, hundredths / 10.0 AS confidence
    FROM best JOIN nation ON s_nationkey = n_nationkey JOIN customer ON c_nationkey = n_nationkey
    """
)
def addresses_any_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Confidences of any size and sign; the greatest wins."""
    nation = table(spark, sf_dir, "nation")
    customers = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    signups = raw_shaped(customers, "customer_signups", customer_id=text("c_custkey"), addr_city=F.col("n_name"))
    suppliers = table(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    address = {c: F.lit(None).cast("string") for c in ADDRESS} | {"addr_city": F.col("n_name")}
    candidates = suppliers.select(
        address_hash([address[c] for c in ADDRESS]).alias("raw_addr_hash"),
        F.lit(1.0).alias("lat"),
        F.lit(2.0).alias("lon"),
        (F.round(F.col("s_acctbal") * 100).cast("decimal(18,0)") / 10).cast(NUMERIC).alias("confidence"),
        F.col("s_name").alias("provider"),
    )
    placed = geocoded_addresses(signups, candidates, date(2024, 2, 1))
    return placed.select("addr_city", F.col("confidence").cast("double").alias("confidence"))


@query(
    """
    WITH address AS (
      SELECT DISTINCT lower(n_name) AS city, lower(c_mktsegment) AS segment
      FROM customer JOIN nation ON c_nationkey = n_nationkey),
    answer AS (
      SELECT DISTINCT lower(n_name) AS city, CASE WHEN s_acctbal >= 5000 THEN 'building' ELSE 'machinery' END AS segment
      FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_acctbal >= 0)
    SELECT city, segment, NULL AS provider,
           CASE WHEN EXISTS (SELECT 1 FROM answer WHERE answer.city = address.city AND answer.segment = address.segment)
                THEN 'placed' ELSE 'lat,lon' END AS place
    FROM address
    UNION ALL
    SELECT NULL, NULL, s_name, 'raw_addr_hash' FROM supplier WHERE s_acctbal < 0
    """
)
def addresses_unplaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each address is placed or listed, and so are results of suppliers in debt, which name none."""
    nation = table(spark, sf_dir, "nation")
    customers = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    suppliers = table(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    signups = raw_shaped(
        customers, "customer_signups", customer_id=text("c_custkey"), addr_city=F.col("n_name"), addr_region=F.col("c_mktsegment")
    )
    segment = F.when(F.col("s_acctbal") >= 5000, "BUILDING").when(F.col("s_acctbal") >= 0, "MACHINERY")
    address = {c: F.lit(None).cast("string") for c in ADDRESS} | {"addr_city": F.col("n_name"), "addr_region": segment}
    candidates = suppliers.select(
        F.when(segment.isNotNull(), address_hash([address[c] for c in ADDRESS])).alias("raw_addr_hash"),
        F.lit(1.0).alias("lat"),
        F.lit(2.0).alias("lon"),
        F.lit(1).cast(NUMERIC).alias("confidence"),
        F.col("s_name").alias("provider"),
    )
    placed = geocoded_addresses(signups, candidates, date(2024, 2, 1)).select(
        F.col("addr_city").alias("city"), F.col("addr_region").alias("segment"), F.lit(None).cast("string").alias("provider"), F.lit("placed").alias("place")
    )
    listed = unplaced_addresses(signups, candidates).select(
        F.get_json_object("original", "$.addr_city").alias("city"),
        F.get_json_object("original", "$.addr_region").alias("segment"),
        F.get_json_object("original", "$.provider").alias("provider"),
        F.concat_ws(",", "failed_columns").alias("place"),
    )
    return placed.unionByName(listed)


@query(
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS tracking_no,
           CASE WHEN o_orderstatus = 'F' THEN 'delivered_at'
                WHEN o_orderpriority LIKE '1%' THEN 'shipped_at,delivered_at,estimated_eta'
                ELSE 'shipped_at,delivered_at,estimated_eta,partition_ts' END AS missing,
           CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS events
    FROM orders WHERE o_orderstatus <> 'P'
    UNION ALL
    SELECT CAST(o_orderkey AS VARCHAR), NULL, 1 FROM orders WHERE o_orderstatus = 'P'
    """
)
def carrier_untimed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivered without its time; without any time, and lost or with no status; shipped and complete."""
    status, urgent = F.col("o_orderstatus"), F.col("o_orderpriority").startswith("1")
    shipments = raw_shaped(
        table(spark, sf_dir, "orders"),
        "shipment_tracking",
        tracking_no=text("o_orderkey"),
        status=F.when(status == "F", "Complete").when(status == "P", " SHIPPED").when(~urgent, "Lost"),
        shipped_at=F.when(status != "O", F.col("o_orderdate")),
        partition_ts=F.when((status != "O") | urgent, F.col("o_orderdate")),
    )
    events = normalized_carrier_events(shipments).select("tracking_no", F.lit(None).cast("string").alias("missing"), F.lit(1).alias("events"))
    listed = untimed_shipments(shipments).select(
        F.get_json_object("original", "$.tracking_no").alias("tracking_no"),
        F.concat_ws(",", "failed_columns").alias("missing"),
        F.lit(0).alias("events"),
    )
    both = events.unionByName(listed)
    return both.groupBy("tracking_no").agg(F.max("missing").alias("missing"), F.sum("events").cast("int").alias("events"))


@query(
    """
    SELECT event_id AS txn_id, CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN CAST(CAST(value * 1000 AS DECIMAL(38,9)) AS DOUBLE) ELSE 0.25 END AS fraud_score,
           CASE WHEN event_type = 'error' OR (event_type = 'view' AND value * 1000 >= 0.7) THEN 'high'
                WHEN event_type = 'view' AND value * 1000 >= 0.3 THEN 'medium' ELSE 'low' END AS risk_band,
           event_type = 'error' AS unfit
    FROM events
    """
)
def fraud_out_of_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event is a sale with a signal of its own: errors score without end, views beyond one."""
    events = table(spark, sf_dir, "events")
    kind = F.col("event_type")
    sales = raw_shaped(events, "pos_transactions", txn_id=F.col("event_id"), customer_id=text("event_id"), txn_ts=F.col("ts"))
    signals = raw_shaped(
        events,
        "fraud_signals",
        customer_id=text("event_id"),
        score=F.when(kind == "error", float("inf")).when(kind == "view", F.col("value") * 1000).otherwise(0.25),
        signal_ts=F.col("ts"),
    )
    scored = fraud_scored(sales, signals)
    listed = unfit_scores(scored).select(F.get_json_object("original", "$.txn_id").cast("bigint").alias("_id"))
    both = scored.join(listed, F.col("txn_id") == F.col("_id"), "left")
    return both.select("txn_id", F.col("fraud_score").cast("double").alias("fraud_score"), "risk_band", F.col("_id").isNotNull().alias("unfit"))


@query(
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS tracking_no,
           CASE o_orderstatus WHEN 'F' THEN '1 Main St, Rome' ELSE 'Rome' END AS location_city,
           CASE o_orderstatus WHEN 'F' THEN 'RM' END AS location_region,
           CASE WHEN o_orderstatus IN ('F', 'O') THEN 'IT' END AS location_country
    FROM orders
    """
)
def carrier_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Street, city, region and country; city and country; city alone."""
    status = F.col("o_orderstatus")
    place = F.when(status == "F", "1 Main St, Rome , RM, IT").when(status == "O", "Rome, IT").otherwise("Rome")
    shipments = raw_shaped(
        table(spark, sf_dir, "orders"),
        "shipment_tracking",
        tracking_no=text("o_orderkey"),
        shipped_at=F.col("o_orderdate"),
        last_location=place,
    )
    return normalized_carrier_events(shipments).select("tracking_no", "location_city", "location_region", "location_country")


def _clicks(spark: SparkSession, sf_dir: str, moment) -> DataFrame:
    events = table(spark, sf_dir, "events")
    web = events.select(
        moment.alias("event_ts"),
        F.lit(None).cast("string").alias("ip"),
        text("event_id").alias("url"),
        text("user_id").alias("user_id"),
        F.lit(None).cast("string").alias("country"),
        F.date_trunc("HOUR", "ts").alias("partition_ts"),
    )
    return dedup_clickstream(web, spark.createDataFrame([], RAW["mobile_events"].schema))


@query(
    f"""
    SELECT CAST(event_id AS VARCHAR) AS page_url,
           strftime(CASE event_type WHEN 'view' THEN date_trunc('second', ts) ELSE
             date_trunc('second', ts) + to_microseconds(microsecond(ts) % 1000000 // pow(10, 6 - d)::BIGINT * pow(10, 6 - d)::BIGINT) END, {MICRO}) AS event_ts
    FROM (SELECT *, 1 + event_id % 6 AS d FROM events)
    """
)
def clicks_any_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times with none to nine digits of a second."""
    digits = F.concat(F.date_format("ts", "SSSSSS"), F.lit("000"))
    cut = F.substring(digits, F.lit(1), (1 + F.col("event_id") % 6).cast("int"))
    longer = F.when(F.col("event_id") % 6 == 5, F.concat(cut, F.lit("000"))).otherwise(cut)
    whole = second_text("ts")
    moment = F.when(F.col("event_type") == "view", whole).otherwise(F.concat(whole, F.lit("."), longer))
    clicks = _clicks(spark, sf_dir, moment)
    return clicks.select("page_url", F.date_format("event_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("event_ts"))


@query(
    """
    SELECT CAST(user_id AS VARCHAR) AS user_id, count(*) AS clicks, count(*) FILTER (WHERE event_type <> 'error') AS in_sessions
    FROM events GROUP BY 1
    """
)
def clicks_unreadable_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors have a time that cannot be read; none of them is lost."""
    clicks = _clicks(spark, sf_dir, F.when(F.col("event_type") == "error", "soon").otherwise(second_text("ts")))
    return clicks.groupBy("user_id").agg(F.count(F.lit(1)).alias("clicks"), F.count("session_id").alias("in_sessions"))


@query(
    """
    SELECT 'kept' AS place, count(DISTINCT user_id) AS rows FROM events WHERE event_type <> 'error'
    UNION ALL SELECT 'listed', count(*) FROM events WHERE event_type = 'error'
    """
)
def returns_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of kind error have no return; each of them is listed."""
    changes = _changes(spark, sf_dir)
    changes = changes.withColumn("return_id", F.when(F.col("status") != "error", F.col("return_id")))
    kept = returns_state(changes).select(F.lit("kept").alias("place"))
    listed = unkeyed_returns(changes).select(F.lit("listed").alias("place"))
    return kept.unionByName(listed).groupBy("place").agg(F.count(F.lit(1)).alias("rows"))


@query(MERGED)
def merged_cdc_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third change arrives after all others, many of them older than what is there."""
    changes = _changes(spark, sf_dir)
    late = F.col("invoice_no").cast("bigint") % 3 == 0
    state = returns_state(changes.where(late), returns_state(changes.where(~late)))
    return _merged(returns_snapshot(state, date(2024, 1, 31)))


@query(
    f"""
    WITH months AS (
      SELECT l_suppkey AS w, date_trunc('month', l_shipdate) AS m,
             CAST(sum(CASE WHEN l_returnflag = 'A' THEN CAST(l_quantity AS BIGINT)
                           WHEN l_returnflag = 'N' THEN -CAST(l_quantity AS BIGINT) ELSE 0 END) AS BIGINT) AS net
      FROM lineitem GROUP BY ALL)
    SELECT CAST(w AS VARCHAR) AS warehouse_id, strftime(m, {SECOND}) AS snapshot_ts,
           CAST(sum(net) OVER (PARTITION BY w ORDER BY m) AS BIGINT) AS backlog_units
    FROM months
    """
)
def kpi_in_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three spans of months, each loaded with the balance of the one before."""
    lines = table(spark, sf_dir, "lineitem")
    flag = F.col("l_returnflag")
    moves = raw_shaped(
        lines.where(flag != "A"),
        "inventory_movements",
        warehouse_id=text("l_suppkey"),
        movement_type=F.when(flag == "R", "IN").otherwise("OUT"),
        quantity=F.col("l_quantity"),
        movement_ts=F.col("l_shipdate"),
    )
    picks = raw_shaped(lines.where(flag == "A"), "warehouse_picks", warehouse_id=text("l_suppkey"), quantity=F.col("l_quantity"), picked_at=F.col("l_shipdate"))
    out, opening = None, None
    for since, until in (("0001-01-01", "1994-01-01"), ("1994-01-01", "1996-05-01"), ("1996-05-01", "9999-01-01")):
        own = moves.where((F.col("movement_ts") >= since) & (F.col("movement_ts") < until))
        part = warehouse_kpi_snapshot(own, picks.where((F.col("picked_at") >= since) & (F.col("picked_at") < until)), grain="MONTH", opening=opening)
        opening = closing_backlog(part, opening)
        out = part if out is None else out.unionByName(part)
    return out.select("warehouse_id", second_text("snapshot_ts").alias("snapshot_ts"), "backlog_units")


# Drops that come beside or after one another.


def _load(spark: SparkSession, feed: str, rows: DataFrame, root: str, name: str, values: dict[str, str] | None) -> int:
    path = f"{root}/drops/{name}"
    writer = rows.write.partitionBy(*[c for c in rows.columns if c in RAW[feed].feed.delivered]) if values is None else rows.write
    writer.csv(path, nullValue="\\N")
    return load_feed(spark, feed, path, f"{root}/warehouse", f"{root}/quarantine", values)


def _stored(spark: SparkSession, feed: str, root: str) -> DataFrame:
    return read_table(spark, table_path(f"{root}/warehouse", RAW[feed]), RAW[feed])


def _tracking(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = RAW["shipment_tracking"].delivered_columns.fieldNames()
    none = F.lit(None).cast("string")
    filled = {"tracking_no": text("event_id"), "carrier": F.col("event_type")}
    return table(spark, sf_dir, "events").select("value", *[filled.get(c, none).alias(c) for c in wanted])


@query(
    f"""
    SELECT CASE WHEN value >= 100 THEN 'fedex' ELSE 'ups' END AS carrier_partition, '2024-01-30 05:00:00' AS hour, count(*) AS row_count
    FROM events WHERE value >= 100 OR (value < 100 AND event_type = 'error') GROUP BY ALL
    """
)
def load_sibling_drops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two carriers deliver for one hour, and one of them delivers again, without most of its rows."""
    root, rows = scratch_path(spark, "load_sibling_drops"), _tracking(spark, sf_dir)
    low, high = rows.where("value < 100").drop("value"), rows.where("value >= 100").drop("value")
    for number, (carrier, own) in enumerate([("ups", low), ("fedex", high), ("ups", low.where("carrier = 'error'"))]):
        _load(spark, "shipment_tracking", own, root, str(number), {"date_ts": "2024013005", "carrier_partition": carrier})
    stored = _stored(spark, "shipment_tracking", root)
    return stored.groupBy("carrier_partition", second_text("partition_ts").alias("hour")).agg(F.count(F.lit(1)).alias("row_count"))


@query("SELECT '2024-01-30 00:00:00' AS hour, count(*) AS row_count FROM events")
def load_daily_and_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A drop of a day and one of its first hour are two drops of one hour."""
    root, rows = scratch_path(spark, "load_daily_and_hour"), _tracking(spark, sf_dir)
    for number, (hour, own) in enumerate([("20240130", rows.where("value < 100")), ("2024013000", rows.where("value >= 100"))]):
        _load(spark, "shipment_tracking", own.drop("value"), root, str(number), {"date_ts": hour, "carrier_partition": "ups"})
    stored = _stored(spark, "shipment_tracking", root)
    return stored.groupBy(second_text("partition_ts").alias("hour")).agg(F.count(F.lit(1)).alias("row_count"))


@query(
    """
    SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS row_count FROM events
    WHERE event_type = 'error' OR ts >= TIMESTAMP '2024-01-10' GROUP BY ALL
    """
)
def reload_smaller_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signals other than errors come as one drop, and again without the first days."""
    contract, path = RAW["fraud_signals"], scratch_path(spark, "reload_smaller_drop")
    events = table(spark, sf_dir, "events")
    kind = F.col("event_type") == "error"
    signals = raw_shaped(events, "fraud_signals", customer_id=text("event_id"), signal_ts=F.col("ts"), signal_date=F.when(kind, "a").otherwise("b"))
    signals = signals.withColumn(DROP, F.concat(F.lit("signal_date="), "signal_date"))
    write_drops(signals, path, contract)
    again = signals.where((F.col("signal_date") == "b") & (F.col("signal_ts") >= F.lit("2024-01-10").cast("timestamp")))
    write_drops(again, path, contract, "signal_date=b")
    read = read_table(spark, path, contract)
    return read.groupBy(F.date_format("signal_ts", "yyyy-MM-dd").alias("day")).agg(F.count(F.lit(1)).alias("row_count"))


@query(
    """
    SELECT 'table' AS place, count(*) AS row_count FROM events
    UNION ALL SELECT 'quarantine', count(*) FROM events WHERE event_type = 'error'
    """
)
def load_folders_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All drops in folders, then the later days again; errors have a quantity that is no number."""
    root = scratch_path(spark, "load_folders_twice")
    none = F.lit(None).cast("string")
    kind = F.col("event_type")
    filled = {"invoice_no": text("event_id"), "quantity": F.when(kind == "error", "many").otherwise("1")}
    wanted = RAW["sales_retail"].delivered_columns.fieldNames()
    day = F.date_format("ts", "yyyyMMdd").alias("date_ts")
    rows = table(spark, sf_dir, "events").select(*[filled.get(c, none).alias(c) for c in wanted], day)
    _load(spark, "sales_retail", rows, root, "all", None)
    _load(spark, "sales_retail", rows.where("date_ts >= '20240115'"), root, "later", None)
    stored = _stored(spark, "sales_retail", root).select(F.lit("table").alias("place"))
    listed = spark.read.schema("table_name string").parquet(f"{root}/quarantine/sales_retail").select(F.lit("quarantine").alias("place"))
    return stored.unionByName(listed).groupBy("place").agg(F.count(F.lit(1)).alias("row_count"))


# Records that used to stop a load.


@query(
    """
    SELECT CAST(event_id AS VARCHAR) AS event_id, CASE WHEN event_type <> 'error' THEN event_type END AS kind,
           event_type = 'error' AS listed
    FROM events
    """
)
def land_json_repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors carry a key of their properties twice."""
    path = scratch_path(spark, "land_json_repeated_keys")
    again = F.when(F.col("event_type") == "error", ',"kind":"x"').otherwise("")
    line = F.concat(F.lit('{"event_id":"'), text("event_id"), F.lit('","properties":{"kind":"'), F.col("event_type"), F.lit('"'), again, F.lit("}}"))
    table(spark, sf_dir, "events").select(line.alias("value")).write.text(path)
    checked = land(spark, "mobile_events", path, {"event_date": "20240130", "hour_bucket": "5"}).checked
    return checked.select("event_id", F.try_variant_get("properties", "$.kind", "string").alias("kind"), F.array_contains("_failed", "properties").alias("listed"))


@query(
    """
    SELECT CAST(event_id AS VARCHAR) AS invoice_no, 'say "' || event_type || '", ok' AS description, event_id AS quantity, false AS listed
    FROM events
    """
)
def land_csv_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Descriptions with doubled quotes and commas inside quotes."""
    path = scratch_path(spark, "land_csv_quotes")
    line = F.concat(text("event_id"), F.lit(',s,"say ""'), F.col("event_type"), F.lit('"", ok",'), text("event_id"), F.lit(",,1,c,FR"))
    table(spark, sf_dir, "events").select(line.alias("value")).write.text(path)
    checked = land(spark, "sales_retail", path, {"date_ts": "2024013005"}).checked
    return checked.select("invoice_no", "description", "quantity", F.col("_original").isNotNull().alias("listed"))


@query(
    """
    SELECT CAST(event_id AS VARCHAR) AS sku, CASE WHEN event_type <> 'error' THEN event_id END AS quantity, event_type = 'error' AS listed
    FROM events
    """
)
def land_parquet_type_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks and errors come in files where the quantity is text, that of errors no number."""
    path = scratch_path(spark, "land_parquet_type_change")
    events = table(spark, sf_dir, "events")
    kind = F.col("event_type")
    as_text = F.when(kind == "error", "many").otherwise(text("event_id"))
    sku = text("event_id").alias("sku")
    events.where(~kind.isin("click", "error")).select(sku, F.col("event_id").alias("quantity")).write.parquet(path)
    events.where(kind.isin("click", "error")).select(sku, as_text.alias("quantity")).write.mode("append").parquet(path)
    checked = land(spark, "inventory_movements", path, {"year": "2024", "month": "1", "day": "30"}).checked
    return checked.select("sku", "quantity", F.array_contains("_failed", "quantity").alias("listed"))


# Checks that must find something.


@query(
    """
    SELECT column_name, difference, CAST(sum(n) AS BIGINT) AS rows FROM (
      SELECT unnest(['quantity', 'color']) AS column_name, unnest(['string', 'added']) AS difference, count(*) AS n
      FROM events WHERE event_type IN ('click', 'error')
      UNION ALL
      SELECT unnest(['movement_id', 'warehouse_id', 'bin_location', 'movement_type', 'movement_ts', 'reference_doc', 'operator_id', 'reason_code']),
             'missing', count(*)
      FROM events)
    GROUP BY ALL
    """
)
def check_file_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of two schemas: in those of clicks and errors the quantity is text, and a column is new."""
    path = scratch_path(spark, "check_file_columns")
    events = table(spark, sf_dir, "events")
    other = F.col("event_type").isin("click", "error")
    sku = text("event_id").alias("sku")
    events.where(~other).select(sku, F.col("event_id").alias("quantity")).write.parquet(path)
    events.where(other).select(sku, text("event_id").alias("quantity"), sku.alias("color")).write.mode("append").parquet(path)
    values = {"year": "2024", "month": "1", "day": "30"}
    parts = parquet_parts(spark, RAW["inventory_movements"], path, values, every=True)
    report = checks.file_column_drift(parts, RAW["inventory_movements"])
    return report.groupBy("column_name", "difference").agg(F.sum("rows").alias("rows"))


@query(
    """
    SELECT strftime(ts, '%Y%m%d') AS event_date, key_name, count(*) AS lines
    FROM (SELECT ts, 'kind_' || event_type AS key_name FROM events
          UNION ALL SELECT ts, 'context.browser' FROM events WHERE event_type = 'error')
    GROUP BY ALL
    """
)
def check_json_keys_by_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each line has a key named after its kind, and errors one inside a declared object."""
    kind = F.col("event_type")
    inside = F.when(kind == "error", ',"browser":"b"').otherwise("")
    line = F.concat(
        F.lit('{"event_id":"'), text("event_id"), F.lit('","properties":{"any":1},"kind_'), kind,
        F.lit('":1,"context":{"ip":"1.1.1.1"'), inside, F.lit("}}"),
    )
    lines = table(spark, sf_dir, "events").select(line.alias("value"), F.date_format("ts", "yyyyMMdd").alias("event_date"))
    return checks.json_key_drift_by_load(lines, RAW["mobile_events"], ["event_date"])


@query(
    """
    SELECT CAST(user_id AS VARCHAR) AS key_value, count(*) AS source_rows, count(*) AS target_rows,
           count(*) FILTER (WHERE event_type = 'error') = 0 AS passed
    FROM events GROUP BY 1
    """
)
def check_parity_shifted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In errors a value moved from one column to its neighbour."""
    none = F.lit(None).cast("string")
    source = table(spark, sf_dir, "events").select("user_id", "event_type", text("event_id").alias("a"), none.alias("b"))
    moved = F.col("event_type") == "error"
    target = source.select("user_id", "event_type", F.when(~moved, F.col("a")).alias("a"), F.when(moved, F.col("a")).alias("b"))
    return checks.parity_report(source, target, "user_id")


@query(
    """
    SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS key_value, count(*) AS source_rows,
           count(*) AS target_rows, count(*) FILTER (WHERE o_orderstatus = 'P') = 0 AS passed
    FROM orders GROUP BY ALL
    """
)
def check_round_trip_damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts of pending orders are stored with their last decimal lost."""
    contract, path = RAW["supplier_invoices"], scratch_path(spark, "check_round_trip_damaged")
    exact = F.col("o_totalprice").cast("decimal(18,2)") + F.lit("0.000000001").cast("decimal(10,9)")
    source = raw_shaped(table(spark, sf_dir, "orders"), "supplier_invoices", invoice_no=text("o_orderkey"), currency=F.col("o_orderstatus"), total_amount=exact, feed_date=F.trunc("o_orderdate", "MONTH"))
    cut = F.when(F.col("currency") == "P", F.round("total_amount", 8).cast(NUMERIC)).otherwise(F.col("total_amount"))
    write_table(source.withColumn("total_amount", cut), path, contract)
    return checks.parity_report(source, read_table(spark, path, contract), contract.key.column)


@query(
    """
    SELECT strftime(ts, '%Y%m%d%H') AS partition_value, count(DISTINCT event_type) > 1 AS overlaps
    FROM events GROUP BY ALL
    """
)
def check_clusters_unsorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files written without regard to the cluster column, two of them in each hour."""
    contract, path = RAW["mobile_events"], scratch_path(spark, "check_clusters_unsorted")
    apps = events_as_app(spark, sf_dir)
    hour = F.date_format("event_timestamp", "yyyyMMddHH")
    rows = apps.withColumn("_p", hour).select("_p", *contract.names)
    ends = rows.groupBy("_p").agg(F.min("platform").alias("_low"), F.max("platform").alias("_high"))
    marked = rows.join(ends, "_p")
    # Both files hold the least and the greatest kind, so their ranges overlap wherever these differ.
    twice = marked.where((F.col("platform") == F.col("_low")) | (F.col("platform") == F.col("_high")))
    for part in (marked, twice):
        part.drop("_low", "_high").repartition("_p").write.mode("append").partitionBy("_p").parquet(path)
    report = checks.cluster_report(spark, path, contract)
    return report.select("partition_value", (F.col("overlapping") > 0).alias("overlaps"))
