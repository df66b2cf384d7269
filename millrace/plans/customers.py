"""Cleaned customers: the rows that changed since the last load."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.contracts import STAGING
from millrace.functions.text import address_hash, digits, normal_email
from millrace.operators.latest import has_key, latest_per_key, without_key
from millrace.plans.addresses import ADDRESS

TRACKED = ["email_norm", "phone_norm", "first_name", "last_name", *ADDRESS, "geocoded_lat", "geocoded_lon"]


def cleansed_customers(
    customer_signups: DataFrame,
    geocoded: DataFrame,
    load_ts: datetime,
    history: DataFrame | None = None,
    current: DataFrame | None = None,
) -> DataFrame:
    """Latest sign-up per customer, with its coordinates, where any tracked column changed.

    ``history`` is the table of earlier loads; a customer's newest row in it is the one to differ
    from. ``current`` has one row per customer, kept by ``current_customers``; with it the cost of a
    load does not grow with the loads before. Sign-ups without a customer are left out; ``unkeyed_customers`` lists them.
    """
    latest = latest_per_key(customer_signups.where(has_key(["customer_id"])), ["customer_id"], ["signup_date"])
    cleaned = latest.select(
        "customer_id",
        normal_email(F.col("email")).alias("email_norm"),
        digits(F.col("phone")).alias("phone_norm"),
        F.trim("first_name").alias("first_name"),
        F.trim("last_name").alias("last_name"),
        *[F.trim(c).alias(c) for c in ADDRESS],
    )
    # Customers without an address get a key of their own, so that they do not meet in one task.
    hashed = address_hash([F.col(c) for c in ADDRESS])
    keyed = cleaned.withColumn("_place", F.coalesce(hashed, F.concat(F.lit("none "), "customer_id")))
    places = latest_per_key(
        geocoded.select("raw_addr_hash", "load_date", "lat", "lon"), ["raw_addr_hash"], ["load_date"]
    ).select(
        F.col("raw_addr_hash").alias("_place"),
        F.col("lat").alias("geocoded_lat"),
        F.col("lon").alias("geocoded_lon"),
    )
    located = keyed.join(places, "_place", "left")

    loaded = F.lit(load_ts.isoformat(sep=" ")).cast("timestamp")
    # A NULL is left out of the JSON text while empty text stays in it, so both hash differently.
    tracked = located.withColumn("record_hash", F.sha2(F.to_json(F.struct(*TRACKED)), 256))
    stamped = tracked.withColumn("eff_from_ts", loaded).withColumn("load_date", F.to_date(loaded))
    if current is None and history is not None:
        current = latest_per_key(
            history.where(has_key(["customer_id"])).select("customer_id", "record_hash", "eff_from_ts"),
            ["customer_id"],
            ["eff_from_ts"],
        )
    if current is not None:
        known = current.select(F.col("customer_id").alias("_customer"), F.col("record_hash").alias("_hash"))
        same = (F.col("customer_id") == F.col("_customer")) & (F.col("record_hash") == F.col("_hash"))
        stamped = stamped.join(known, same, "left_anti")
    return stamped.select(*STAGING["cleansed_customers"].names)


def unkeyed_customers(customer_signups: DataFrame) -> DataFrame:
    """Sign-ups without a customer, in the form of the quarantine."""
    return without_key(customer_signups, STAGING["cleansed_customers"].table, ["customer_id"])


def current_customers(changed: DataFrame, current: DataFrame | None = None) -> DataFrame:
    """(customer_id, record_hash) of each customer after a load that found ``changed``."""
    new = changed.select("customer_id", "record_hash", F.lit(1).alias("_turn"))
    if current is not None:
        new = new.unionByName(current.select("customer_id", "record_hash", F.lit(0).alias("_turn")))
    return new.groupBy("customer_id").agg(F.max_by("record_hash", "_turn").alias("record_hash"))
