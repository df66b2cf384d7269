"""The served views. The current date is a parameter, so that a run can be repeated."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Column of the web log -> column of the view.
OMNITURE_COLUMNS = {
    "col_2": "event_ts",
    "col_8": "ip",
    "col_13": "url",
    "col_14": "user_id",
    "col_50": "city",
    "col_51": "country",
    "col_53": "state",
    "partition_ts": "partition_ts",
}


def omniture(omniture_logs: DataFrame) -> DataFrame:
    """Eight named columns of the untyped web log."""
    return omniture_logs.select(*[F.col(c).alias(name) for c, name in OMNITURE_COLUMNS.items()])


def fraud_signals_recent(fraud_signals: DataFrame, as_of: date, prune_key: bool = False) -> DataFrame:
    """Signals dated yesterday or later; signals without a date are left out.

    The date is text, and the table is partitioned by ``signal_ts``. ``prune_key`` adds the same
    bound on the key; give it only where a check has shown that both always agree.
    """
    yesterday = F.date_sub(F.lit(as_of.isoformat()).cast("date"), 1)
    recent = fraud_signals.where(F.col("signal_date") >= F.date_format(yesterday, "yyyyMMdd"))
    return recent.where(F.col("signal_ts") >= yesterday.cast("timestamp")) if prune_key else recent


def returns_pending(return_authorizations: DataFrame, as_of: date) -> DataFrame:
    """Returns not approved, or not decided, with the days since they were asked for."""
    today = F.lit(as_of.isoformat()).cast("date")
    pending = return_authorizations.where(~F.coalesce(F.col("approved"), F.lit(False)))
    return pending.select(
        "rma_id",
        "customer_id",
        "invoice_no",
        "stock_code",
        "quantity",
        "requested_at",
        F.datediff(today, F.to_date("requested_at")).cast("bigint").alias("days_pending"),
    )
