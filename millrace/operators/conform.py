"""Conforming a feed to its declared table.

Rows are never lost here. A value that does not fit its declared type becomes NULL in the table,
and the row is listed in the quarantine with its original text and the columns that failed.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.contracts import Contract
from millrace.functions import keys
from millrace.functions.types import cast_failed, cast_to

BAD_RECORD = "_bad"
FAILED = "_failed"
ORIGINAL = "_original"
DROP = "_drop"

KEY_RULES: dict[str, Callable[[], Column]] = {
    "hour_text": lambda: keys.hour_from_text(F.col("date_ts")),
    "date_parts": lambda: keys.date_from_parts(F.col("year"), F.col("month"), F.col("day")),
    "month_parts": lambda: keys.month_from_parts(F.col("feed_year"), F.col("feed_month")),
    "date_text": lambda: keys.parse_date(F.col("_key_text")),
    "date_and_hour": lambda: keys.hour_from_date_and_bucket(F.col("event_date"), F.col("hour_bucket")),
    "native": lambda: F.col("_key_text").try_cast("date"),
}


@dataclass(frozen=True)
class Landing:
    """A conformed feed: ``rows`` go to the table, ``quarantine`` lists what did not fit.

    ``checked`` holds both, and with each row the name of its drop.
    """

    contract: Contract
    checked: DataFrame

    @property
    def rows(self) -> DataFrame:
        return self.checked.select(*self.contract.names)

    @property
    def quarantine(self) -> DataFrame:
        return self.unfit.drop(DROP)

    @property
    def unfit(self) -> DataFrame:
        """The quarantine with the drop of each row."""
        return self.checked.where(F.col(ORIGINAL).isNotNull()).select(
            DROP,
            F.lit(self.contract.table).alias("table_name"),
            F.col(FAILED).alias("failed_columns"),
            F.col(ORIGINAL).alias("original"),
        )


def conform(feed: DataFrame, contract: Contract) -> Landing:
    """Cast every declared column, add the partition key, put the columns in declared order."""
    rule = contract.feed.rule
    if rule in ("date_text", "native"):
        feed = feed.withColumn("_key_text", F.col(contract.key.column))
    present = {f.name: f.dataType for f in feed.schema.fields}

    values: list[Column] = []
    failures: list[Column] = []
    for field in contract.schema.fields:
        value, failed = _conform_column(field, present, contract)
        values.append(value.alias(field.name))
        if failed is not None:
            failures.append(F.when(failed, F.lit(field.name)))

    failed_names = F.array_compact(F.array(*failures)) if failures else F.array().cast("array<string>")
    source = F.to_json(F.struct(*[F.col(n) for n in present if n not in (BAD_RECORD, "_key_text")]))
    bad = F.col(BAD_RECORD) if BAD_RECORD in present else F.lit(None).cast("string")
    folders = [
        F.concat(F.lit(f"{n}="), F.coalesce(F.col(n).cast("string"), F.lit("")))
        for n in contract.feed.delivered
        if n in present
    ]
    checked = feed.select(
        *values,
        F.concat_ws("&", *folders).alias(DROP),
        failed_names.alias(FAILED),
        F.when((F.size(failed_names) > 0) | bad.isNotNull(), F.coalesce(bad, source)).alias(ORIGINAL),
    )
    return Landing(contract, checked)


def _conform_column(
    field: T.StructField, present: dict[str, T.DataType], contract: Contract
) -> tuple[Column, Column | None]:
    rule = contract.feed.rule
    if field.name == contract.key.column and rule in KEY_RULES:
        key = KEY_RULES[rule]()
        return key, key.isNull()
    if field.name not in present:
        return F.lit(None).cast(field.dataType), None
    value, feed_type = F.col(field.name), present[field.name]
    if contract.feed.options.get("millis") == field.name and not isinstance(feed_type, T.TimestampType):
        cast = F.timestamp_millis(value.try_cast("bigint"))
    else:
        cast = cast_to(value, feed_type, field.dataType)
    return cast, cast_failed(value, cast, feed_type, field.dataType)
