"""The driver's tables, and how their columns stand in for the feeds.

Timestamps of the driver tables have no zone. They are cast to timestamps on the way in, and all
queries give times, dates and exact numbers out as text or plain numbers, so that results do not
depend on the session's zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.contracts import RAW, Contract


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    frame = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    zoneless = [f.name for f in frame.schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
    return frame.withColumns({n: F.col(n).cast("timestamp") for n in zoneless})


def shaped(frame: DataFrame, contract: Contract, **columns: Column) -> DataFrame:
    """The declared columns of a contract, NULL where not given."""
    return frame.select(
        *[
            columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in contract.schema.fields
        ]
    )


def raw_shaped(frame: DataFrame, feed: str, **columns: Column) -> DataFrame:
    return shaped(frame, RAW[feed], **columns)


def text(name: str) -> Column:
    return F.col(name).cast("string")


def second_text(name: str) -> Column:
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss")


def micro_text(name: str) -> Column:
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def money(value: Column | str) -> Column:
    """An amount for comparison: two decimals, as a plain number."""
    value = F.col(value) if isinstance(value, str) else value
    return value.cast("decimal(18,2)").cast("double")


def ratio(value: Column | str, scale: int) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return value.cast(f"decimal(15,{scale})").cast("double")


SECOND = "'%Y-%m-%d %H:%M:%S'"
MICRO = "'%Y-%m-%d %H:%M:%S.%f'"
