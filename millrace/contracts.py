"""Declared tables: columns, partition key, cluster keys, and how each raw feed is delivered.

Every column is nullable. The partition key is the last column unless the key is a data column.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

from millrace.functions.types import NUMERIC

# Type names used in the column lists below.
TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "numeric": NUMERIC,
    "json": T.VariantType(),
    "strings": T.ArrayType(T.StringType()),
    "gps": T.StructType().add("lat", T.DoubleType()).add("lon", T.DoubleType()),
    "geo": T.StructType().add("country", "string").add("region", "string").add("city", "string"),
    "context": (
        T.StructType()
        .add("ip", "string")
        .add("country", "string")
        .add("session_id", "string")
        .add("referrer", "string")
    ),
    "items": T.ArrayType(T.StructType().add("sku", "string").add("qty", T.LongType()).add("price", NUMERIC)),
    "lines": T.ArrayType(
        T.StructType().add("sku", "string").add("qty", T.LongType()).add("unit_price", NUMERIC)
    ),
}


def columns(text: str) -> T.StructType:
    """``"name type, name type"`` to a schema of nullable columns."""
    schema = T.StructType()
    for item in text.split(","):
        name, type_name = item.split()
        schema.add(T.StructField(name, TYPES[type_name], True))
    return schema


@dataclass(frozen=True)
class Key:
    """The column a table is partitioned by, and the grain: date, hour, day or month."""

    column: str
    grain: str


@dataclass(frozen=True)
class Feed:
    """How a raw table is delivered.

    ``delivered`` are the partition columns of the drop folders with their feed types; ``rule``
    names the way the declared key is made from them.
    """

    format: str
    delivered: dict[str, str]
    rule: str
    options: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Contract:
    layer: str
    name: str
    schema: T.StructType
    key: Key
    cluster: tuple[str, ...] = ()
    feed: Feed | None = None
    # The column naming the drop, where the key comes from the rows and drops share its partitions.
    drop: str | None = None

    @property
    def table(self) -> str:
        return f"{self.layer}.{self.name}"

    @property
    def names(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def delivered_columns(self) -> T.StructType:
        """Data columns found inside the feed files: all but the key and the folder columns."""
        outside = set(self.feed.delivered)
        if self.feed.rule != "signal_day":
            outside.add(self.key.column)
        return T.StructType([f for f in self.schema.fields if f.name not in outside])


HOUR_TEXT = {"date_ts": "string"}
CSV, TSV, JSON, PARQUET = "csv", "tsv", "json", "parquet"

RAW: dict[str, Contract] = {}
STAGING: dict[str, Contract] = {}


def _raw(
    name: str, text: str, key: Key, feed: Feed, cluster: tuple[str, ...] = (), drop: str | None = None
) -> None:
    RAW[name] = Contract("raw", name, columns(text), key, cluster, feed, drop)


def _hourly(name: str, text: str, file_format: str, promoted: str | None = None) -> None:
    """A feed dropped by hour text, some of them also by one promoted column."""
    delivered = dict(HOUR_TEXT)
    cluster = ()
    if promoted:
        text = f"{text}, {promoted} string"
        delivered[promoted] = "string"
        cluster = (promoted,)
    text = f"{text}, partition_ts timestamp"
    _raw(name, text, Key("partition_ts", "hour"), Feed(file_format, delivered, "hour_text"), cluster)


def _staging(name: str, text: str, key: str, cluster: tuple[str, ...] = ()) -> None:
    STAGING[name] = Contract("staging", name, columns(text), Key(key, "date"), cluster)


# The declared tables of both layers.

_hourly(
    "sales_retail",
    "invoice_no string, stock_code string, description string, quantity bigint, "
    "invoice_date string, unit_price numeric, customer_id string, country string",
    CSV,
)
_hourly("omniture_logs", ", ".join(f"col_{i} string" for i in range(1, 61)), TSV)
_hourly(
    "pos_transactions",
    "txn_id bigint, store_id string, register_id string, cashier_id string, customer_id string, "
    "invoice_no string, txn_ts timestamp, line_count bigint, gross_amount numeric, "
    "discount_amount numeric, tax_amount numeric, tender_type string, void_flag boolean",
    PARQUET,
)
_hourly(
    "loyalty_events",
    "event_ts_str string, member_id string, event_type string, points string, store_id string, "
    "tx_id string, meta_raw string",
    "regex",
)
_hourly(
    "email_campaign_clicks",
    "campaign_id string, send_id string, recipient string, clicked_at timestamp, click_url string, "
    "user_agent string, ip_address string, geo geo, utm json",
    JSON,
)
_hourly(
    "return_authorizations",
    "rma_id string, customer_id string, invoice_no string, stock_code string, quantity bigint, "
    "reason_code string, reason_text string, requested_at timestamp, approved boolean, "
    "refund_amount numeric",
    TSV,
)
_hourly(
    "delivery_routes",
    "route_id string, driver_id string, vehicle_id string, planned_stops bigint, actual_stops bigint, "
    "miles_driven numeric, fuel_used numeric, start_ts timestamp, end_ts timestamp",
    CSV,
)
_hourly(
    "driver_logs",
    "driver_id string, event_ts timestamp, event_type string, gps gps, notes string, extras json",
    JSON,
)
_hourly(
    "customer_complaints",
    "complaint_id string, customer_id string, invoice_no string, channel string, severity string, "
    "summary string, body string, created_at timestamp, resolved_at timestamp, csat_score bigint",
    TSV,
)
_hourly(
    "chat_transcripts",
    "chat_id string, customer_id string, agent_id string, started_at timestamp, ended_at timestamp, "
    "duration_sec bigint, message_count bigint, transcript string, sentiment numeric",
    TSV,
)
_hourly(
    "shipment_tracking",
    "tracking_no string, carrier string, invoice_no string, customer_id string, shipped_at timestamp, "
    "delivered_at timestamp, status string, last_location string, estimated_eta timestamp",
    CSV,
    promoted="carrier_partition",
)
_hourly(
    "warehouse_picks",
    "pick_id bigint, warehouse_id string, bin_id string, sku string, picker_id string, "
    "quantity bigint, picked_at timestamp, duration_ms bigint",
    PARQUET,
    promoted="warehouse_id_partition",
)
_raw(
    "inventory_movements",
    "movement_id bigint, sku string, warehouse_id string, bin_location string, movement_type string, "
    "quantity bigint, movement_ts timestamp, reference_doc string, operator_id string, "
    "reason_code string, movement_date date",
    Key("movement_date", "date"),
    Feed(PARQUET, {"year": "int", "month": "int", "day": "int"}, "date_parts"),
)
_raw(
    "supplier_invoices",
    "invoice_no string, supplier_id string, invoice_date date, due_date date, total_amount numeric, "
    "currency string, line_items lines, raw_xml string, feed_date date",
    Key("feed_date", "month"),
    Feed("sequence", {"feed_year": "int", "feed_month": "int"}, "month_parts"),
)
_raw(
    "product_catalog_feed",
    "sku string, supplier_id string, upc string, name string, category string, subcategory string, "
    "color string, size string, msrp numeric, cost numeric, available_from date, "
    "discontinued_at date, metadata json, feed_date date",
    Key("feed_date", "date"),
    Feed("rcfile", {"feed_date": "string"}, "date_text"),
)
_raw(
    "mobile_events",
    "event_id string, event_ts timestamp, user_id string, app_version string, device_type string, "
    "platform string, properties json, context context, items items, event_timestamp timestamp",
    Key("event_timestamp", "hour"),
    Feed(JSON, {"event_date": "string", "hour_bucket": "int"}, "date_and_hour"),
    ("platform",),
)
_raw(
    "returns_cdc",
    "return_id bigint, invoice_no string, customer_sk bigint, return_ts timestamp, "
    "refund_amount numeric, reason_code string, status string, op string, snapshot_date date",
    Key("snapshot_date", "date"),
    Feed(CSV, {"snapshot_date": "date"}, "native"),
)
_raw(
    "customer_signups",
    "customer_id string, email string, phone string, first_name string, last_name string, "
    "addr_line1 string, addr_city string, addr_region string, addr_country string, "
    "addr_postal string, signup_source string, marketing_opt_in boolean, signup_date date",
    Key("signup_date", "date"),
    Feed("avro", {"signup_date": "string"}, "date_text"),
)
_raw(
    "fraud_signals",
    "customer_id string, signal_type string, score double, risk_band string, reason_codes strings, "
    "signal_ts timestamp, vendor string, signal_date string",
    Key("signal_ts", "day"),
    Feed("avro", {"signal_date": "string"}, "signal_day", {"millis": "signal_ts"}),
    drop="signal_date",
)

_staging(
    "cleansed_customers",
    "customer_id string, email_norm string, phone_norm string, first_name string, last_name string, "
    "addr_line1 string, addr_city string, addr_region string, addr_country string, "
    "addr_postal string, geocoded_lat double, geocoded_lon double, eff_from_ts timestamp, "
    "record_hash string, load_date date",
    "load_date",
)
_staging(
    "cleansed_orders",
    "order_id string, customer_id string, invoice_no string, txn_ts timestamp, line_count bigint, "
    "gross_amount numeric, discount numeric, tax numeric, net_amount numeric, tender_type string, "
    "source_feed string, order_date date",
    "order_date",
)
_staging(
    "cleansed_products",
    "sku string, upc string, name_norm string, category_norm string, subcategory string, "
    "color_norm string, size_norm string, msrp numeric, cost numeric, supplier_id string, "
    "available boolean, load_date date",
    "load_date",
)
_staging(
    "dedup_clickstream",
    "session_id string, user_id string, event_ts timestamp, page_url string, referrer_url string, "
    "ip string, country string, bot_score numeric, device_type string, country_partition string, "
    "event_date date",
    "event_date",
    ("country_partition", "user_id"),
)
_staging(
    "fraud_scored",
    "txn_id bigint, customer_id string, fraud_score numeric, risk_band string, signals strings, "
    "scored_at timestamp, score_date date",
    "score_date",
)
_staging(
    "geocoded_addresses",
    "raw_addr_hash string, addr_line1 string, addr_city string, addr_region string, "
    "addr_country string, addr_postal string, lat double, lon double, confidence numeric, "
    "provider string, load_date date",
    "load_date",
)
_staging(
    "merged_returns_cdc",
    "return_id bigint, invoice_no string, customer_sk bigint, return_ts timestamp, "
    "refund_amount numeric, reason_code string, status string, is_deleted boolean, "
    "snapshot_date date",
    "snapshot_date",
)
_staging(
    "normalized_carrier_events",
    "tracking_no string, carrier string, event_type string, event_ts timestamp, "
    "location_city string, location_region string, location_country string, event_date date",
    "event_date",
)
_staging(
    "parsed_loyalty_events",
    "event_ts timestamp, member_id string, event_type string, points bigint, store_id string, "
    "tx_id string, meta json, event_date date",
    "event_date",
)
_staging(
    "warehouse_kpi_snapshot",
    "warehouse_id string, snapshot_ts timestamp, units_in bigint, units_picked bigint, "
    "units_shipped bigint, pick_rate_uph numeric, backlog_units bigint, avg_pick_ms bigint, "
    "snapshot_date date",
    "snapshot_date",
)
