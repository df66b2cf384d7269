"""The product catalogue as of a date."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.contracts import STAGING
from millrace.functions.text import normal_text
from millrace.operators.latest import has_key, latest_per_key, without_key


def cleansed_products(product_catalog_feed: DataFrame, load_date: date) -> DataFrame:
    """Newest feed row per product. A product is available from its first day until the day before
    it is discontinued; a missing end leaves that side open. Feed rows without a product number are
    left out; ``unkeyed_products`` lists them."""
    return products_of(products_state(product_catalog_feed), load_date)


def products_state(product_catalog_feed: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    """The newest feed row of each product with its date, after a load that follows the ``previous`` state.

    With it a day reads the feed of that day and one row per product, not all feeds. A feed that comes
    late counts by its date. Feeds are reduced to a row per product before they meet the state.
    """
    numbered = product_catalog_feed.drop("metadata").where(has_key(["sku"]))
    latest = latest_per_key(numbered, ["sku"], ["feed_date"])
    if previous is None:
        return latest
    return latest_per_key(latest.unionByName(previous), ["sku"], ["feed_date"])


def products_of(state: DataFrame, load_date: date) -> DataFrame:
    """The declared table of a state as of a date."""
    day = F.lit(load_date.isoformat()).cast("date")
    started = F.coalesce(day >= F.col("available_from"), F.lit(True))
    going_on = F.coalesce(day < F.col("discontinued_at"), F.lit(True))
    return state.select(
        "sku",
        "upc",
        normal_text(F.col("name")).alias("name_norm"),
        normal_text(F.col("category")).alias("category_norm"),
        "subcategory",
        normal_text(F.col("color")).alias("color_norm"),
        normal_text(F.col("size")).alias("size_norm"),
        "msrp",
        "cost",
        "supplier_id",
        (started & going_on).alias("available"),
        day.alias("load_date"),
    ).select(*STAGING["cleansed_products"].names)


def unkeyed_products(product_catalog_feed: DataFrame) -> DataFrame:
    """Feed rows without a product number, in the form of the quarantine."""
    return without_key(product_catalog_feed, STAGING["cleansed_products"].table, ["sku"])
