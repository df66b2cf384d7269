"""Loyalty events with their text fields parsed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.contracts import STAGING
from millrace.functions.keys import parse_timestamp

EVENT_TIME_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm:ss.SSSSSS", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def parsed_loyalty_events(
    loyalty_events: DataFrame, event_time_formats: tuple[str, ...] = EVENT_TIME_FORMATS
) -> DataFrame:
    """Text that cannot be read becomes NULL, and ``unread_loyalty_events`` lists its row.
    ``event_date`` is the date of the drop, or of the event where the drop has none."""
    event_ts = parse_timestamp(F.col("event_ts_str"), event_time_formats)
    return loyalty_events.select(
        event_ts.alias("event_ts"),
        "member_id",
        "event_type",
        F.col("points").try_cast("bigint").alias("points"),
        "store_id",
        "tx_id",
        F.try_parse_json("meta_raw").alias("meta"),
        F.coalesce(F.to_date("partition_ts"), F.to_date(event_ts)).alias("event_date"),
    ).select(*STAGING["parsed_loyalty_events"].names)


def unread_loyalty_events(
    loyalty_events: DataFrame, event_time_formats: tuple[str, ...] = EVENT_TIME_FORMATS
) -> DataFrame:
    """Events with text that cannot be read, such as JSON with a repeated key, in the form of the
    quarantine."""
    read = {
        "event_ts_str": parse_timestamp(F.col("event_ts_str"), event_time_formats),
        "points": F.col("points").try_cast("bigint"),
        "meta_raw": F.try_parse_json("meta_raw"),
    }
    failed = [F.when(F.col(name).isNotNull() & value.isNull(), F.lit(name)) for name, value in read.items()]
    listed = loyalty_events.withColumn("_failed", F.array_compact(F.array(*failed))).where(F.size("_failed") > 0)
    return listed.select(
        F.lit(STAGING["parsed_loyalty_events"].table).alias("table_name"),
        F.col("_failed").alias("failed_columns"),
        F.to_json(F.struct(*loyalty_events.columns)).alias("original"),
    )
