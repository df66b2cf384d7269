"""The ten cleansing jobs over the driver's tables, shaped as the feeds they read."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harness.tables import MICRO, SECOND, micro_text, money, ratio, raw_shaped, second_text, shaped, table, text
from millrace.contracts import STAGING
from millrace.functions.text import address_hash, digits, normal_email
from millrace.plans.addresses import ADDRESS, geocoded_addresses as geocode
from millrace.plans.carriers import normalized_carrier_events
from millrace.plans.clickstream import clicks_of, clicks_state, dedup_clickstream as dedup
from millrace.plans.customers import TRACKED, cleansed_customers as cleanse_customers
from millrace.plans.fraud import fraud_scored as score
from millrace.plans.loyalty import parsed_loyalty_events
from millrace.plans.orders import cleansed_orders as cleanse_orders, orders_of, orders_state
from millrace.plans.products import cleansed_products as cleanse_products, products_of, products_state
from millrace.plans.returns import fold_returns, merged_returns_cdc, read_returns, returns_snapshot, returns_state, unkeyed_returns
from millrace.plans.warehouse import kpi_state, kpis_of, late_kpis, warehouse_kpi_snapshot, with_late
from millrace.session import scratch_path, written

QUERIES = {}
ORACLES = {}


def query(oracle: str):
    def register(function):
        QUERIES[function.__name__] = function
        ORACLES[function.__name__] = oracle
        return function

    return register


@query(
    f"""
    WITH tills AS (
      SELECT o_orderkey // 2 AS k, *,
             row_number() OVER (PARTITION BY o_orderkey // 2 ORDER BY o_orderdate DESC,
               CAST(o_custkey AS VARCHAR) DESC, CAST(o_orderkey AS VARCHAR) DESC) AS rn
      FROM orders),
    pos AS (
      SELECT CAST(k AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
             CAST(o_orderkey AS VARCHAR) AS invoice_no, strftime(o_orderdate, {SECOND}) AS txn_ts,
             CAST(NULL AS BIGINT) AS line_count, CAST(o_totalprice AS DECIMAL(18,2)) AS gross,
             CAST(CASE WHEN o_orderstatus = 'P' THEN 1.25 ELSE NULL END AS DECIMAL(18,2)) AS discount,
             CAST(2.5 AS DECIMAL(18,2)) AS tax, o_orderpriority AS tender_type, 'pos' AS source_feed,
             strftime(o_orderdate, '%Y-%m-%d') AS order_date
      FROM tills WHERE rn = 1),
    retail AS (
      SELECT CAST(l_orderkey AS VARCHAR) AS order_id, max(CAST(l_suppkey AS VARCHAR)) AS customer_id,
             CAST(l_orderkey AS VARCHAR) AS invoice_no, strftime(max(l_shipdate), {SECOND}) AS txn_ts,
             count(*) AS line_count,
             CAST(sum(CAST(l_quantity AS BIGINT) * CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS gross,
             CAST(0 AS DECIMAL(18,2)) AS discount, CAST(0 AS DECIMAL(18,2)) AS tax,
             CAST(NULL AS VARCHAR) AS tender_type, 'retail' AS source_feed,
             strftime(max(l_shipdate), '%Y-%m-%d') AS order_date
      FROM lineitem GROUP BY l_orderkey)
    SELECT order_id, customer_id, invoice_no, txn_ts, line_count, CAST(gross AS DOUBLE) AS gross_amount,
           CAST(discount AS DOUBLE) AS discount, CAST(tax AS DOUBLE) AS tax,
           CAST(gross - coalesce(discount, 0) + tax AS DOUBLE) AS net_amount, tender_type, source_feed, order_date
    FROM (SELECT * FROM pos UNION ALL SELECT * FROM retail)
    """
)
def cleansed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of orders stand for till records sent twice, order lines for the retail export."""
    return _order_rows(cleanse_orders(*_order_feeds(spark, sf_dir)))


@query(ORACLES["cleansed_orders"])
def orders_in_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same records in three loads that cut most invoices and many pairs of till records apart."""
    tills, retail = _order_feeds(spark, sf_dir)
    state = None
    for n in range(3):
        some_tills = tills.where(F.pmod(F.xxhash64("invoice_no"), F.lit(3)) == n)
        some_lines = retail.where(F.pmod(F.xxhash64("stock_code"), F.lit(3)) == n)
        state = written(orders_state(some_tills, some_lines, state), "orders-state")
    return _order_rows(orders_of(state))


def _order_feeds(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    tills = raw_shaped(
        table(spark, sf_dir, "orders"),
        "pos_transactions",
        txn_id=F.floor(F.col("o_orderkey") / 2),
        customer_id=text("o_custkey"),
        invoice_no=text("o_orderkey"),
        txn_ts=F.col("o_orderdate"),
        gross_amount=F.col("o_totalprice").cast("decimal(18,2)"),
        discount_amount=F.when(F.col("o_orderstatus") == "P", F.lit("1.25").cast("decimal(18,2)")),
        tax_amount=F.lit("2.5").cast("decimal(18,2)"),
        tender_type=F.col("o_orderpriority"),
    )
    retail = raw_shaped(
        table(spark, sf_dir, "lineitem"),
        "sales_retail",
        invoice_no=text("l_orderkey"),
        stock_code=text("l_partkey"),
        quantity=F.col("l_quantity"),
        invoice_date=second_text("l_shipdate"),
        unit_price=F.col("l_extendedprice").cast("decimal(18,2)"),
        customer_id=text("l_suppkey"),
    )
    return tills, retail


def _order_rows(orders: DataFrame) -> DataFrame:
    amounts = ("gross_amount", "discount", "tax", "net_amount")
    return orders.withColumns(
        {
            "txn_ts": second_text("txn_ts"),
            "order_date": text("order_date"),
            **{a: money(a) for a in amounts},
        }
    )


def _signups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with the address of their nation; customers in debt gave no address."""
    nations = table(spark, sf_dir, "nation")
    customers = table(spark, sf_dir, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    owing = F.col("c_acctbal") < 0
    return raw_shaped(
        customers,
        "customer_signups",
        customer_id=text("c_custkey"),
        email=F.concat(F.lit(" "), F.col("c_name"), F.lit("@Example.com ")),
        phone=F.concat(F.lit("+1 ("), text("c_custkey"), F.lit(") "), text("c_nationkey")),
        first_name=F.concat(F.lit(" "), F.col("c_name")),
        last_name=F.col("c_mktsegment"),
        addr_city=F.when(~owing, F.concat(F.lit(" "), F.col("n_name"))),
        addr_region=F.when(~owing, text("n_regionkey")),
        signup_date=F.lit("2024-01-01"),
    )


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as results of geocoding their nation."""
    nations = table(spark, sf_dir, "nation")
    suppliers = table(spark, sf_dir, "supplier").join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
    address = {c: F.lit(None).cast("string") for c in ADDRESS}
    address["addr_city"] = F.col("n_name")
    address["addr_region"] = text("n_regionkey")
    return suppliers.select(
        address_hash([address[c] for c in ADDRESS]).alias("raw_addr_hash"),
        F.col("s_acctbal").alias("lat"),
        F.col("s_suppkey").cast("double").alias("lon"),
        (F.floor(F.col("s_acctbal") / 5000) * F.lit("0.125").cast("decimal(4,3)")).alias("confidence"),
        F.col("s_name").alias("provider"),
    )


ADDRESS_HASH = """sha256('{"p1":"' || lower(n_name) || '","p2":"' || n_regionkey || '"}')"""
PLACES = f"""
    best AS (
      SELECT * FROM (
        SELECT {ADDRESS_HASH} AS h, s_acctbal AS lat, CAST(s_suppkey AS DOUBLE) AS lon,
               floor(s_acctbal / 5000) * 0.125 AS confidence, s_name AS provider,
               row_number() OVER (PARTITION BY s_nationkey
                 ORDER BY floor(s_acctbal / 5000) DESC, s_name) AS rn
        FROM supplier JOIN nation ON s_nationkey = n_nationkey)
      WHERE rn = 1)"""


@query(
    f"""
    WITH {PLACES.strip()}
    SELECT DISTINCT h AS raw_addr_hash, lower(n_name) AS addr_city, CAST(n_regionkey AS VARCHAR) AS addr_region,
           lat, lon, CAST(confidence AS DOUBLE) AS confidence, provider, '2024-02-01' AS load_date
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN best ON h = {ADDRESS_HASH}
    WHERE c_acctbal >= 0
    """
)
def geocoded_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = geocode(_signups(spark, sf_dir), _candidates(spark, sf_dir), date(2024, 2, 1))
    return placed.select(
        "raw_addr_hash", "addr_city", "addr_region", "lat", "lon",
        ratio("confidence", 3).alias("confidence"), "provider", text("load_date").alias("load_date"),
    )


RECORD_HASH = """sha256('{"email_norm":"' || email_norm || '","phone_norm":"' || phone_norm || '","first_name":"' || first_name
  || '","last_name":"' || last_name || '"' || coalesce(',"addr_city":"' || addr_city || '"', '')
  || coalesce(',"addr_region":"' || addr_region || '"', '')
  || coalesce(',"geocoded_lat":' || geocoded_lat, '') || coalesce(',"geocoded_lon":' || geocoded_lon, '')
  || '}')"""


@query(
    f"""
    WITH {PLACES.strip()},
    located AS (
      SELECT CAST(c_custkey AS VARCHAR) AS customer_id, lower(c_name) || '@example.com' AS email_norm,
             '1' || c_custkey || c_nationkey AS phone_norm, c_name AS first_name, c_mktsegment AS last_name,
             CASE WHEN c_acctbal >= 0 THEN n_name END AS addr_city,
             CASE WHEN c_acctbal >= 0 THEN CAST(n_regionkey AS VARCHAR) END AS addr_region,
             lat AS geocoded_lat, lon AS geocoded_lon, c_mktsegment
      FROM customer JOIN nation ON c_nationkey = n_nationkey
      LEFT JOIN best ON c_acctbal >= 0 AND h = {ADDRESS_HASH})
    SELECT customer_id, email_norm, phone_norm, first_name, last_name, addr_city, addr_region,
           geocoded_lat, geocoded_lon, '2024-02-01 03:00:00' AS eff_from_ts,
           '2024-02-01' AS load_date,
           {RECORD_HASH} AS record_hash
    FROM located
    WHERE NOT (c_mktsegment = 'MACHINERY' AND geocoded_lat IS NULL)
    """
)
def cleansed_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers are in the history without coordinates, and those of one segment with their
    name as it is now: such a customer is emitted only if coordinates came in."""
    signups = _signups(spark, sf_dir)
    places = geocode(signups, _candidates(spark, sf_dir), date(2024, 2, 1))
    known = signups.select(
        "customer_id",
        normal_email(F.col("email")).alias("email_norm"),
        digits(F.col("phone")).alias("phone_norm"),
        F.when(F.col("last_name") == "MACHINERY", F.trim("first_name")).alias("first_name"),
        "last_name",
        *[F.trim(c).alias(c) for c in ADDRESS],
        F.lit(None).cast("double").alias("geocoded_lat"),
        F.lit(None).cast("double").alias("geocoded_lon"),
    ).withColumn("record_hash", F.sha2(F.to_json(F.struct(*TRACKED)), 256))
    history = shaped(
        known,
        STAGING["cleansed_customers"],
        customer_id=F.col("customer_id"),
        record_hash=F.col("record_hash"),
        eff_from_ts=F.lit("2024-01-01 00:00:00"),
        load_date=F.lit("2024-01-01"),
    )
    changed = cleanse_customers(signups, places, datetime(2024, 2, 1, 3), history)
    return changed.select(
        "customer_id", "email_norm", "phone_norm", "first_name", "last_name", "addr_city", "addr_region",
        "geocoded_lat", "geocoded_lon", second_text("eff_from_ts").alias("eff_from_ts"),
        text("load_date").alias("load_date"), "record_hash",
    )


@query(
    """
    SELECT p_brand || '/' || p_name AS sku, CAST(p_partkey AS VARCHAR) AS upc, lower(p_name) AS name_norm,
           lower(p_type) AS category_norm, CAST(p_size AS VARCHAR) AS size_norm,
           CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS DOUBLE) AS msrp,
           p_size <= 30 AND p_size > 5 AS available, '2024-01-31' AS load_date
    FROM (SELECT *, row_number() OVER (PARTITION BY p_brand, p_name
            ORDER BY p_size DESC, CAST(p_partkey AS VARCHAR) DESC) AS rn FROM part)
    WHERE rn = 1
    """
)
def cleansed_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of one brand and name are versions of one product, the largest being the newest."""
    return _products(cleanse_products(_catalog(spark, sf_dir), date(2024, 1, 31)))


@query(ORACLES["cleansed_products"])
def products_in_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same feeds in three loads, the newest feed dates first."""
    feed = _catalog(spark, sf_dir)
    newer = F.col("feed_date") >= F.lit("2023-01-30").cast("date")
    odd = F.xxhash64("upc") % 2 != 0
    state = None
    for part in (newer, ~newer & odd, ~newer & ~odd):
        state = written(products_state(feed.where(part), state), "products-state")
    return _products(products_of(state, date(2024, 1, 31)))


def _catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    return raw_shaped(
        table(spark, sf_dir, "part"),
        "product_catalog_feed",
        sku=F.concat_ws("/", "p_brand", "p_name"),
        upc=text("p_partkey"),
        name=F.concat(F.lit("  "), F.upper("p_name"), F.lit(" ")),
        category=F.regexp_replace("p_type", " ", "   "),
        size=text("p_size"),
        msrp=F.col("p_retailprice").cast("decimal(10,2)"),
        available_from=F.when(size > 10, F.date_add(F.lit("2024-01-01").cast("date"), size)),
        discontinued_at=F.when(size <= 5, F.lit("2024-01-31").cast("date")),
        feed_date=F.date_add(F.lit("2023-01-01").cast("date"), size),
    )


def _products(cleaned: DataFrame) -> DataFrame:
    return cleaned.select(
        "sku", "upc", "name_norm", "category_norm", "size_norm", money("msrp").alias("msrp"), "available",
        text("load_date").alias("load_date"),
    )


@query(
    f"""
    WITH shaped AS (
      SELECT ts, CAST(user_id AS VARCHAR) AS visitor, event_type AS page,
             CASE WHEN event_type IN ('view', 'click') THEN NULL
                  WHEN event_type = 'error' THEN 'app-' || user_id END AS given,
             event_type IN ('view', 'click') AS web, value, event_id
      FROM events),
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY visitor, date_trunc('hour', ts), page
                                   ORDER BY ts, event_id) AS rn
      FROM shaped),
    kept AS (SELECT * FROM ranked WHERE rn = 1),
    marked AS (
      SELECT *, CASE WHEN lag(ts) OVER w IS NULL THEN ts
                     WHEN given IS NULL AND ts - lag(ts) OVER w > INTERVAL 30 MINUTE THEN ts END AS start_mark
      FROM kept WINDOW w AS (PARTITION BY visitor, given ORDER BY ts)),
    started AS (
      SELECT *, max(start_mark) OVER (PARTITION BY visitor, given ORDER BY ts) AS start_ts FROM marked),
    counted AS (
      SELECT *, CAST(count(*) OVER s AS HUGEINT) AS n,
             CAST(greatest(epoch_us(max(ts) OVER s) - epoch_us(start_ts), 60000000) AS HUGEINT) AS lasted
      FROM started WINDOW s AS (PARTITION BY visitor, given, start_ts))
    SELECT coalesce(given, visitor || '-' || epoch_us(start_ts)) AS session_id, visitor AS user_id,
           strftime(ts, {MICRO}) AS event_ts, CASE WHEN web THEN page END AS page_url,
           CASE WHEN value > 100 THEN 'de' END AS country,
           CASE WHEN value > 100 THEN 'DE' ELSE 'ZZ' END AS country_partition,
           (n * 60000000 // lasted) || '.' || lpad(CAST(n * 60000000 % lasted * 1000000000 // lasted AS VARCHAR), 9, '0')
             AS bot_score,
           strftime(ts, '%Y-%m-%d') AS event_date
    FROM counted
    """
)
def dedup_clickstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views and clicks come from the web, the rest from the app, where errors carry a session.
    Events of one kind in one hour count as repeats."""
    return _clicks(dedup(*_click_feeds(table(spark, sf_dir, "events")), repeat_grain="HOUR"))


@query(ORACLES["dedup_clickstream"])
def clicks_in_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events in four loads: two parts of the month that cut sessions in two, then late events of
    both, which repeat, lengthen and bridge what is there, then the rest."""
    events = table(spark, sf_dir, "events")
    late = F.col("event_id") % 5 == 0
    second = F.col("ts") >= F.lit("2024-01-14 12:00:00").cast("timestamp")
    last = F.col("ts") >= F.lit("2024-01-22 12:10:00").cast("timestamp")
    state = None
    for part in (~late & ~second, ~late & second & ~last, late & ~last, last):
        web, app = _click_feeds(events.where(part))
        state = written(clicks_state(web, app, state, repeat_grain="HOUR"), "clicks-state")
    return _clicks(clicks_of(state))


def _click_feeds(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    kind = F.col("event_type")
    is_web = kind.isin("view", "click")
    country = F.when(F.col("value") > 100, F.lit("de"))
    web = events.where(is_web).select(
        micro_text("ts").alias("event_ts"),
        F.lit(None).cast("string").alias("ip"),
        kind.alias("url"),
        text("user_id").alias("user_id"),
        country.alias("country"),
        F.date_trunc("HOUR", "ts").alias("partition_ts"),
    )
    session = F.when(kind == "error", F.concat(F.lit("app-"), text("user_id")))
    nothing = F.lit(None).cast("string")
    app = raw_shaped(
        events.where(~is_web),
        "mobile_events",
        event_id=kind,
        event_ts=F.col("ts"),
        user_id=text("user_id"),
        context=F.struct(
            nothing.alias("ip"), country.alias("country"), session.alias("session_id"), nothing.alias("referrer")
        ),
        event_timestamp=F.date_trunc("HOUR", "ts"),
    )
    return web, app


def _clicks(clicks: DataFrame) -> DataFrame:
    return clicks.select(
        "session_id", "user_id", micro_text("event_ts").alias("event_ts"), "page_url", "country",
        "country_partition", text("bot_score").alias("bot_score"), text("event_date").alias("event_date"),
    )


@query(
    f"""
    SELECT strftime(ts, {MICRO}) AS event_ts, CAST(user_id AS VARCHAR) AS member_id, event_type,
           CASE WHEN event_type = 'click' THEN NULL ELSE CAST(floor(value) AS BIGINT) END AS points,
           CAST(json_extract(props, '$.k') AS BIGINT) AS k, strftime(ts, '%Y-%m-%d') AS event_date
    FROM events
    """
)
def parsed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of clicks are written with decimals and cannot be read as whole numbers."""
    whole = F.floor("value").cast("string")
    points = F.when(F.col("event_type") == "click", F.concat(whole, F.lit(".5"))).otherwise(
        F.concat(F.lit(" "), whole, F.lit(" "))
    )
    lines = raw_shaped(
        table(spark, sf_dir, "events"),
        "loyalty_events",
        event_ts_str=micro_text("ts"),
        member_id=text("user_id"),
        event_type=F.col("event_type"),
        points=points,
        meta_raw=F.col("props"),
        partition_ts=F.date_trunc("HOUR", "ts"),
    )
    parsed = parsed_loyalty_events(lines)
    return parsed.select(
        micro_text("event_ts").alias("event_ts"), "member_id", "event_type", "points",
        F.try_variant_get("meta", "$.k", "bigint").alias("k"), text("event_date").alias("event_date"),
    )


def _changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    op = F.when(kind == "signup", "I").when(kind == "error", "D").otherwise("U")
    return raw_shaped(
        table(spark, sf_dir, "events"),
        "returns_cdc",
        return_id=F.col("user_id"),
        invoice_no=text("event_id"),
        return_ts=F.col("ts"),
        refund_amount=F.col("value").cast("decimal(12,2)"),
        status=kind,
        op=op,
        snapshot_date=F.to_date("ts"),
    )


MERGED = f"""
    SELECT return_id, invoice_no, strftime(ts, {MICRO}) AS return_ts, refund_amount, status,
           is_deleted, '2024-01-31' AS snapshot_date
    FROM (
      SELECT user_id AS return_id, CAST(event_id AS VARCHAR) AS invoice_no, ts,
             CAST(CAST(value AS DECIMAL(12,2)) AS DOUBLE) AS refund_amount, event_type AS status,
             event_type = 'error' AS is_deleted,
             row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_type = 'error' DESC, event_id DESC) AS rn
      FROM events)
    WHERE rn = 1"""


def _merged(frame: DataFrame) -> DataFrame:
    return frame.select(
        "return_id", "invoice_no", micro_text("return_ts").alias("return_ts"),
        money("refund_amount").alias("refund_amount"), "status", "is_deleted",
        text("snapshot_date").alias("snapshot_date"),
    )


@query(MERGED)
def merged_cdc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged(merged_returns_cdc(_changes(spark, sf_dir), date(2024, 1, 31)))


@query(MERGED)
def merged_cdc_in_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same changes folded in two loads come to the same snapshot."""
    changes = _changes(spark, sf_dir)
    middle = F.lit("2024-01-20").cast("date")
    first = returns_state(changes.where(F.col("snapshot_date") < middle))
    rest = changes.where(F.col("snapshot_date") >= middle)
    return _merged(merged_returns_cdc(rest, date(2024, 1, 31), previous=first))


@query(MERGED)
def merged_cdc_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same changes folded into a state in buckets: the later half, the earlier one, and that once more."""
    changes = _changes(spark, sf_dir)
    late = F.col("snapshot_date") >= F.lit("2024-01-20").cast("date")
    path = scratch_path(spark, "returns-buckets")
    for part in (late, ~late, ~late):
        fold_returns(changes.where(part), path, 8)
    return _merged(returns_snapshot(read_returns(spark, path), date(2024, 1, 31)))


@query(
    f"""
    WITH shipped AS (
      SELECT CAST(o_orderkey AS VARCHAR) AS tracking_no, o_orderdate, o_orderstatus,
             CASE WHEN o_orderpriority LIKE '1%' THEN 'fedex' ELSE lower(o_orderpriority) END AS carrier,
             min(l_shipdate) AS first_ts, max(l_shipdate) AS last_ts
      FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL),
    unpivoted AS (
      SELECT tracking_no, carrier, 'shipped' AS event_type, first_ts AS event_ts FROM shipped
      UNION ALL
      SELECT tracking_no, carrier, 'delivered', last_ts FROM shipped WHERE o_orderstatus = 'F'
      UNION ALL
      SELECT tracking_no, carrier, 'estimated_delivery', o_orderdate + INTERVAL 7 DAY FROM shipped
      UNION ALL
      SELECT tracking_no, carrier, 'in_transit', o_orderdate FROM shipped WHERE o_orderstatus = 'O')
    SELECT tracking_no, carrier, event_type, strftime(event_ts, {SECOND}) AS event_ts, 'Rome' AS location_city,
           CAST(NULL AS VARCHAR) AS location_region, 'IT' AS location_country,
           strftime(event_ts, '%Y-%m-%d') AS event_date
    FROM unpivoted
    """
)
def carrier_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.min("l_shipdate").alias("first_ts"), F.max("l_shipdate").alias("last_ts")
    )
    orders = table(spark, sf_dir, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    status = F.col("o_orderstatus")
    priority = F.col("o_orderpriority")
    shipments = raw_shaped(
        orders,
        "shipment_tracking",
        tracking_no=text("o_orderkey"),
        carrier=F.when(priority.startswith("1"), " Federal  Express").otherwise(priority),
        shipped_at=F.col("first_ts"),
        delivered_at=F.when(status == "F", F.col("last_ts")),
        status=F.when(status == "O", "In  Transit").when(status == "F", "Complete").otherwise(" SHIPPED"),
        last_location=F.lit("Rome,  , IT"),
        estimated_eta=F.col("o_orderdate") + F.expr("INTERVAL 7 DAYS"),
        partition_ts=F.col("o_orderdate"),
    )
    events = normalized_carrier_events(shipments)
    return events.withColumns({"event_ts": second_text("event_ts"), "event_date": text("event_date")})


@query(
    f"""
    WITH sale AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'),
    signal AS (
      SELECT user_id, ts, value / 500 AS score, [props, 'k' || CAST(floor(value / 100) AS BIGINT)] AS codes
      FROM events WHERE event_type <> 'purchase'),
    matched AS (
      SELECT sale.event_id, max(score) AS score, list_sort(list_distinct(flatten(list(codes)))) AS codes
      FROM sale JOIN signal ON sale.user_id = signal.user_id
        AND signal.ts > sale.ts - INTERVAL 24 HOUR AND signal.ts <= sale.ts
      GROUP BY ALL),
    scored AS (
      SELECT sale.*, coalesce(score, 0) AS s, codes
      FROM sale LEFT JOIN matched USING (event_id))
    SELECT event_id AS txn_id, CAST(user_id AS VARCHAR) AS customer_id, CAST(CAST(s AS DECIMAL(38,9)) AS DOUBLE) AS fraud_score,
           CASE WHEN s >= 0.7 THEN 'high' WHEN s >= 0.3 THEN 'medium' ELSE 'low' END AS risk_band,
           coalesce(array_to_string(codes, ','), '') AS signals, strftime(ts, {MICRO}) AS scored_at,
           strftime(ts, '%Y-%m-%d') AS score_date
    FROM scored
    """
)
def fraud_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases are the transactions, all other events the signals."""
    events = table(spark, sf_dir, "events")
    sales = raw_shaped(
        events.where(F.col("event_type") == "purchase"),
        "pos_transactions",
        txn_id=F.col("event_id"),
        customer_id=text("user_id"),
        txn_ts=F.col("ts"),
    )
    level = F.concat(F.lit("k"), F.floor(F.col("value") / 100).cast("string"))
    signals = raw_shaped(
        events.where(F.col("event_type") != "purchase"),
        "fraud_signals",
        customer_id=text("user_id"),
        score=F.col("value") / 500,
        reason_codes=F.array(F.col("props"), level),
        signal_ts=F.col("ts"),
    )
    scored = score(sales, signals)
    return scored.withColumns(
        {
            "fraud_score": F.col("fraud_score").cast("double"),
            "signals": F.array_join("signals", ","),
            "scored_at": micro_text("scored_at"),
            "score_date": text("score_date"),
        }
    )


@query(
    f"""
    WITH moved AS (
      SELECT l_suppkey AS w, date_trunc('month', l_shipdate) AS m,
             CAST(sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS BIGINT) AS units_in,
             CAST(sum(CASE WHEN l_returnflag = 'N' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS BIGINT) AS units_shipped
      FROM lineitem WHERE l_returnflag <> 'A' GROUP BY ALL),
    picked AS (
      SELECT l_suppkey AS w, date_trunc('month', l_shipdate) AS m,
             CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS units_picked,
             CAST(sum(CAST(floor(l_extendedprice) AS BIGINT)) AS BIGINT) AS ms, count(*) AS n
      FROM lineitem WHERE l_returnflag = 'A' GROUP BY ALL),
    joined AS (
      SELECT w, m, coalesce(units_in, 0) AS units_in, coalesce(units_picked, 0) AS units_picked,
             coalesce(units_shipped, 0) AS units_shipped, ms, n
      FROM moved FULL OUTER JOIN picked USING (w, m))
    SELECT CAST(w AS VARCHAR) AS warehouse_id, strftime(m, {SECOND}) AS snapshot_ts, units_in, units_picked,
           units_shipped, ((units_picked * 360000000 * 2 + ms) // (2 * ms)) / 100.0 AS pick_rate_uph,
           CAST(sum(units_picked - units_shipped) OVER (PARTITION BY w ORDER BY m) AS BIGINT) AS backlog_units,
           (2 * ms + n) // (2 * n) AS avg_pick_ms, strftime(m, '%Y-%m-%d') AS snapshot_date
    FROM joined
    """
)
def kpi_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers are the warehouses, months the hours; lines flagged A are picks."""
    return _figures(warehouse_kpi_snapshot(*_warehouse_feeds(table(spark, sf_dir, "lineitem")), grain="MONTH"))


@query(ORACLES["kpi_snapshot"])
def kpi_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lines, of which a third of the orders come late and a sixth later still, for months long past."""
    lines = table(spark, sf_dir, "lineitem")
    turn = F.greatest(F.col("l_orderkey") % 6 - 3, F.lit(0))
    state = written(kpi_state(*_warehouse_feeds(lines.where(turn == 0)), grain="MONTH"), "kpi-state")
    for n in (1, 2):
        late = late_kpis(state, *_warehouse_feeds(lines.where(turn == n)), grain="MONTH")
        state = written(with_late(state, written(late, "kpi-late")), "kpi-state")
    return _figures(kpis_of(state))


def _warehouse_feeds(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    flag = F.col("l_returnflag")
    moves = raw_shaped(
        lines.where(flag != "A"),
        "inventory_movements",
        warehouse_id=text("l_suppkey"),
        movement_type=F.when(flag == "R", "IN").otherwise("OUT"),
        quantity=F.col("l_quantity"),
        movement_ts=F.col("l_shipdate"),
    )
    picks = raw_shaped(
        lines.where(flag == "A"),
        "warehouse_picks",
        warehouse_id=text("l_suppkey"),
        quantity=F.col("l_quantity"),
        picked_at=F.col("l_shipdate"),
        duration_ms=F.floor("l_extendedprice"),
    )
    return moves, picks


def _figures(figures: DataFrame) -> DataFrame:
    return figures.withColumns(
        {
            "snapshot_ts": second_text("snapshot_ts"),
            "pick_rate_uph": money("pick_rate_uph"),
            "snapshot_date": text("snapshot_date"),
        }
    )
