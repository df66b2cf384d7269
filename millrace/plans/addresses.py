"""Distinct sign-up addresses with the best result of the geocoding providers."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.contracts import STAGING
from millrace.functions.text import address_hash, normal_text
from millrace.functions.types import NUMERIC
from millrace.operators.latest import first_per_key, total_order

ADDRESS = ["addr_line1", "addr_city", "addr_region", "addr_country", "addr_postal"]


def geocoded_addresses(customer_signups: DataFrame, candidates: DataFrame, load_date: date) -> DataFrame:
    """``candidates(raw_addr_hash, lat, lon, confidence, provider)`` are the providers' results.

    Each side is reduced to one row per address before the join, so that an address shared by very
    many customers, or with very many candidates, does not fill one task. Addresses without a
    result and results without an address are left out; ``unplaced_addresses`` lists them.
    """
    addresses = _addresses(customer_signups)
    found = candidates.select(
        "raw_addr_hash",
        "lat",
        "lon",
        F.col("confidence").try_cast(NUMERIC).alias("confidence"),
        "provider",
    ).where(F.col("raw_addr_hash").isNotNull())
    order = [F.col("confidence").desc_nulls_last(), F.col("provider").asc_nulls_last()]
    order = total_order(found, order, ["confidence", "provider", "raw_addr_hash"])
    best = first_per_key(found, [F.col("raw_addr_hash")], order)
    placed = addresses.join(best, "raw_addr_hash").withColumn("load_date", F.lit(load_date.isoformat()).cast("date"))
    return placed.select(*STAGING["geocoded_addresses"].names)


def unplaced_addresses(customer_signups: DataFrame, candidates: DataFrame) -> DataFrame:
    """Addresses that no provider answered, once each, and every result that names no address, in
    the form of the quarantine.

    Only distinct hashes of the results meet the distinct addresses.
    """
    addresses = _addresses(customer_signups)
    answered = candidates.select("raw_addr_hash").where(F.col("raw_addr_hash").isNotNull()).distinct()
    unanswered = _listed(addresses.join(answered, "raw_addr_hash", "left_anti"), ["lat", "lon"])
    return unanswered.unionByName(_listed(candidates.where(F.col("raw_addr_hash").isNull()), ["raw_addr_hash"]))


def _addresses(customer_signups: DataFrame) -> DataFrame:
    return (
        customer_signups.select(*[normal_text(F.col(c)).alias(c) for c in ADDRESS])
        .distinct()
        .withColumn("raw_addr_hash", address_hash([F.col(c) for c in ADDRESS]))
        .where(F.col("raw_addr_hash").isNotNull())
    )


def _listed(rows: DataFrame, failed: list[str]) -> DataFrame:
    return rows.select(
        F.lit(STAGING["geocoded_addresses"].table).alias("table_name"),
        F.array(*[F.lit(name) for name in failed]).alias("failed_columns"),
        F.to_json(F.struct(*rows.columns)).alias("original"),
    )
