"""Transactions scored by the fraud signals of the day before them."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.contracts import STAGING
from millrace.functions.types import NUMERIC
from millrace.operators.trailing import trailing_summary

MEDIUM_FROM, HIGH_FROM = 0.3, 0.7


def fraud_scored(
    pos_transactions: DataFrame,
    fraud_signals: DataFrame,
    scored_at: datetime | None = None,
    span_hours: int = 24,
    slice_minutes: int = 10,
) -> DataFrame:
    """Greatest score and distinct reasons among the customer's signals in the span up to the
    transaction. Scores that are not numbers are ignored. A score that NUMERIC cannot hold, such as
    an infinite one, is NULL but keeps its band, and ``unfit_scores`` lists the row. Without
    ``scored_at`` a transaction counts as scored at its own time."""
    sales = pos_transactions.select("txn_id", "customer_id", "txn_ts")
    score = F.when(~F.isnan("score"), F.col("score"))
    summary = trailing_summary(
        sales.select(F.col("customer_id").alias("key"), F.col("txn_ts").alias("moment")),
        fraud_signals.select(
            F.col("customer_id").alias("key"),
            F.col("signal_ts").alias("ts"),
            score.alias("score"),
            F.col("reason_codes").alias("codes"),
        ),
        span_hours * 60,
        slice_minutes,
    )
    # Sales without a customer get a key of their own, so that they do not meet in one task.
    keyed = sales.withColumn("key", F.coalesce("customer_id", F.concat(F.lit("none "), F.col("txn_id").cast("string"))))
    matched = (
        (F.col("key") == F.col("_key")) & (F.col("txn_ts") == F.col("moment")) & F.col("customer_id").isNotNull()
    )
    joined = keyed.join(summary.withColumnRenamed("key", "_key"), matched, "left")

    greatest = F.coalesce(F.col("score"), F.lit(0.0))
    at = F.col("txn_ts") if scored_at is None else F.lit(scored_at.isoformat(sep=" ")).cast("timestamp")
    band = (
        F.when(greatest >= HIGH_FROM, "high")
        .when(greatest >= MEDIUM_FROM, "medium")
        .otherwise("low")
    )
    return joined.select(
        "txn_id",
        "customer_id",
        greatest.try_cast(NUMERIC).alias("fraud_score"),
        band.alias("risk_band"),
        F.coalesce(F.col("codes"), F.array().cast("array<string>")).alias("signals"),
        at.alias("scored_at"),
        F.to_date(at).alias("score_date"),
    ).select(*STAGING["fraud_scored"].names)


def unfit_scores(scored: DataFrame) -> DataFrame:
    """Scored transactions whose score NUMERIC cannot hold, in the form of the quarantine."""
    contract = STAGING["fraud_scored"]
    return scored.where(F.col("fraud_score").isNull()).select(
        F.lit(contract.table).alias("table_name"),
        F.array(F.lit("fraud_score")).alias("failed_columns"),
        F.to_json(F.struct(*contract.names)).alias("original"),
    )
