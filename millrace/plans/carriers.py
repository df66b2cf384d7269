"""Shipment rows turned into one event per known time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.contracts import STAGING
from millrace.functions.text import blank_to_null, normal_text

# Our own spelling tables; a value outside them is kept in its normal form.
CARRIERS = {
    "fed ex": "fedex",
    "federal express": "fedex",
    "united parcel service": "ups",
    "u.p.s.": "ups",
    "deutsche post dhl": "dhl",
    "us postal service": "usps",
}
STATUSES = {
    "in transit": "in_transit",
    "transit": "in_transit",
    "out for delivery": "out_for_delivery",
    "shipped": "shipped",
    "dispatched": "shipped",
    "delivered": "delivered",
    "complete": "delivered",
    "returned to sender": "returned",
    "lost": "exception",
    "damaged": "exception",
}


def normalized_carrier_events(
    shipment_tracking: DataFrame,
    carriers: dict[str, str] = CARRIERS,
    statuses: dict[str, str] = STATUSES,
) -> DataFrame:
    """Events ``shipped``, ``delivered`` and ``estimated_delivery`` at their times, and the status
    as an event at the time of the drop when it says something else. The last of several parts of
    a location is its country, of three or more the one before it is the region, and the city is all
    that is left; a single part is a city. ``untimed_shipments`` lists rows that lose an event, or
    all of them, because a time is missing.

    The small spelling tables are literals inside the projection, so the job has no shuffle.
    """
    status = _spelling(F.col("status"), statuses)
    other = F.when(~status.isin("shipped", "delivered"), F.col("partition_ts"))
    timed = [
        _event(F.lit("shipped"), F.col("shipped_at")),
        _event(F.lit("delivered"), F.col("delivered_at")),
        _event(F.lit("estimated_delivery"), F.col("estimated_eta")),
        _event(status, other),
    ]
    parts = F.split("last_location", ",")
    count = F.size(parts)
    # The city may hold commas of its own, such as a street before it.
    city = F.slice(parts, 1, count - F.least(count - 1, F.lit(2)))
    location = {
        "city": F.array_join(F.filter(F.transform(city, lambda part: F.trim(part)), lambda part: part != ""), ", "),
        "region": F.when(count > 2, F.element_at(parts, -2)),
        "country": F.when(count > 1, F.element_at(parts, -1)),
    }
    events = shipment_tracking.select(
        "tracking_no",
        _spelling(F.col("carrier"), carriers).alias("carrier"),
        *[blank_to_null(value).alias(f"location_{part}") for part, value in location.items()],
        F.inline(F.array(*timed)),
    )
    dated = events.where(F.col("event_ts").isNotNull()).withColumn("event_date", F.to_date("event_ts"))
    return dated.select(*STAGING["normalized_carrier_events"].names)


def untimed_shipments(shipment_tracking: DataFrame, statuses: dict[str, str] = STATUSES) -> DataFrame:
    """Shipments that give no event at all, and those whose status gives none because its time is
    missing, in the form of the quarantine. The failed columns are the times that are missing: all
    of them for the former, that of the status for the latter."""
    status = _spelling(F.col("status"), statuses)
    time_of = {
        "shipped_at": status == "shipped",
        "delivered_at": status == "delivered",
        "estimated_eta": F.lit(False),
        "partition_ts": ~status.isin("shipped", "delivered"),
    }
    dated = F.coalesce("shipped_at", "delivered_at", "estimated_eta").isNotNull()
    none = ~dated & (F.col("partition_ts").isNull() | ~F.coalesce(time_of["partition_ts"], F.lit(False)))
    failed = [F.when(F.col(name).isNull() & (none | wanted), F.lit(name)) for name, wanted in time_of.items()]
    listed = shipment_tracking.withColumn("_failed", F.array_compact(F.array(*failed))).where(F.size("_failed") > 0)
    return listed.select(
        F.lit(STAGING["normalized_carrier_events"].table).alias("table_name"),
        F.col("_failed").alias("failed_columns"),
        F.to_json(F.struct(*shipment_tracking.columns)).alias("original"),
    )


def _event(event_type: Column, event_ts: Column) -> Column:
    return F.struct(event_type.alias("event_type"), event_ts.alias("event_ts"))


def _spelling(value: Column, table: dict[str, str]) -> Column:
    normal = normal_text(value)
    if not table:
        return normal
    pairs = [F.lit(item) for pair in table.items() for item in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), normal), normal)
