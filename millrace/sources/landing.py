"""One landing function per feed: read the drop, conform it, give table rows and quarantine."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from millrace.contracts import RAW
from millrace.operators.conform import Landing, conform
from millrace.sources.readers import Values, read_parts


def land(spark: SparkSession, feed: str, path: str, partition_values: Values = None, **options) -> Landing:
    contract = RAW[feed]
    parts = read_parts(spark, contract, path, partition_values, **options)
    return Landing(contract, reduce(DataFrame.unionByName, [conform(part, contract).checked for part in parts]))


def land_frame(feed: str, frame: DataFrame) -> Landing:
    """Land a feed that is already a DataFrame, such as a table of another catalog."""
    return conform(frame, RAW[feed])


def _lander(feed: str):
    def lander(spark: SparkSession, path: str, partition_values: Values = None, **options) -> Landing:
        return land(spark, feed, path, partition_values, **options)

    lander.__name__ = f"land_{feed}"
    lander.__doc__ = f"Land ``{feed}``, delivered as {RAW[feed].feed.format}."
    return lander


LANDERS = {feed: _lander(feed) for feed in RAW}

land_sales_retail = LANDERS["sales_retail"]
land_omniture_logs = LANDERS["omniture_logs"]
land_pos_transactions = LANDERS["pos_transactions"]
land_loyalty_events = LANDERS["loyalty_events"]
land_email_campaign_clicks = LANDERS["email_campaign_clicks"]
land_return_authorizations = LANDERS["return_authorizations"]
land_delivery_routes = LANDERS["delivery_routes"]
land_driver_logs = LANDERS["driver_logs"]
land_customer_complaints = LANDERS["customer_complaints"]
land_chat_transcripts = LANDERS["chat_transcripts"]
land_shipment_tracking = LANDERS["shipment_tracking"]
land_warehouse_picks = LANDERS["warehouse_picks"]
land_inventory_movements = LANDERS["inventory_movements"]
land_supplier_invoices = LANDERS["supplier_invoices"]
land_product_catalog_feed = LANDERS["product_catalog_feed"]
land_mobile_events = LANDERS["mobile_events"]
land_returns_cdc = LANDERS["returns_cdc"]
land_customer_signups = LANDERS["customer_signups"]
land_fraud_signals = LANDERS["fraud_signals"]
