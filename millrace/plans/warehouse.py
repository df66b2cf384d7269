"""Hourly warehouse figures from stock movements and picks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.contracts import STAGING
from millrace.functions.types import NUMERIC

MILLIS_PER_HOUR = 3_600_000


IN_TYPES, SHIPPED_TYPES = ("IN", "RECEIPT"), ("OUT", "SHIP")
HOUR = ["warehouse_id", "snapshot_ts"]
SUMS = ["units_in", "units_picked", "units_shipped", "pick_ms", "timed_units", "timed_picks"]


def warehouse_kpi_snapshot(
    inventory_movements: DataFrame,
    warehouse_picks: DataFrame,
    grain: str = "HOUR",
    in_types: tuple[str, ...] = IN_TYPES,
    shipped_types: tuple[str, ...] = SHIPPED_TYPES,
    opening: DataFrame | None = None,
) -> DataFrame:
    """One row per (warehouse, hour) with any movement or pick.

    ``opening`` has the backlog of each warehouse before the rows given, so that a day can be loaded
    without the days before it; ``closing_backlog`` makes the next one. The pick rate is of the picks
    with a duration.
    """
    return kpis_of(kpi_state(inventory_movements, warehouse_picks, grain, in_types, shipped_types, opening))


def kpi_state(
    inventory_movements: DataFrame,
    warehouse_picks: DataFrame,
    grain: str = "HOUR",
    in_types: tuple[str, ...] = IN_TYPES,
    shipped_types: tuple[str, ...] = SHIPPED_TYPES,
    opening: DataFrame | None = None,
) -> DataFrame:
    """The sums of each (warehouse, hour) and the backlog after it, kept beside the declared table, which
    holds rounded quotients. The backlog runs over the sums, so a warehouse with very many rows still has one
    row per hour in the window."""
    summed = _sums(inventory_movements, warehouse_picks, grain, in_types, shipped_types)
    so_far = Window.partitionBy("warehouse_id").orderBy("snapshot_ts").rowsBetween(Window.unboundedPreceding, 0)
    before = F.lit(0).cast("bigint")
    if opening is not None:
        brought = opening.select(F.col("warehouse_id").alias("_warehouse"), F.col("backlog_units").alias("_opening"))
        summed = summed.join(brought, F.col("warehouse_id").eqNullSafe(F.col("_warehouse")), "left")
        before = F.coalesce("_opening", before)
    backlog = before + F.sum(F.col("units_picked") - F.col("units_shipped")).over(so_far)
    return summed.select(*HOUR, *SUMS, backlog.alias("backlog_units"))


def late_kpis(
    state: DataFrame,
    inventory_movements: DataFrame,
    warehouse_picks: DataFrame,
    grain: str = "HOUR",
    in_types: tuple[str, ...] = IN_TYPES,
    shipped_types: tuple[str, ...] = SHIPPED_TYPES,
) -> DataFrame:
    """The rows of ``state`` that further movements and picks add or change, whichever hours they are of.

    What an hour adds to the backlog is passed on to all later hours of its warehouse. Only those are read;
    hours whose sums and backlog stay the same are not returned. ``with_late`` puts the rows into the state.
    """
    more = _sums(inventory_movements, warehouse_picks, grain, in_types, shipped_types)
    more = more.withColumn("_net", F.col("units_picked") - F.col("units_shipped"))
    # Hours without a time come first, as in the window of the state.
    at = F.coalesce(F.unix_micros("snapshot_ts"), F.lit(-(2**63)).cast("bigint"))
    begins = more.groupBy(F.col("warehouse_id").alias("_warehouse")).agg(F.min(at).alias("_from"))
    near = state.join(begins, F.col("warehouse_id").eqNullSafe(F.col("_warehouse")))
    later = near.where(at >= F.col("_from")).select(*HOUR, *SUMS, F.col("backlog_units").alias("_old"))
    base = near.where(at < F.col("_from")).groupBy("_warehouse").agg(F.max_by("backlog_units", at).alias("_base"))
    hours = later.unionByName(more, allowMissingColumns=True).groupBy(*HOUR).agg(
        *[F.sum(c).alias(c) for c in SUMS], F.max("_old").alias("_old"), F.sum("_net").alias("_net")
    )
    so_far = Window.partitionBy("warehouse_id").orderBy("snapshot_ts").rowsBetween(Window.unboundedPreceding, 0)
    moved = hours.withColumn("_moved", F.coalesce(F.sum("_net").over(so_far), F.lit(0)))
    moved = moved.withColumn("_last", F.last("_old", ignorenulls=True).over(so_far))
    changed = moved.where((F.col("_moved") != 0) | F.col("_net").isNotNull())
    ready = changed.join(base, F.col("warehouse_id").eqNullSafe(F.col("_warehouse")), "left")
    backlog = F.coalesce("_last", "_base", F.lit(0).cast("bigint")) + F.col("_moved")
    return ready.select(*HOUR, *SUMS, backlog.alias("backlog_units"))


def with_late(state: DataFrame, late: DataFrame) -> DataFrame:
    """The state with late rows in the place of their hours. For a table by days, only the days of late rows have
    to be written again."""
    marks = late.select(F.col("warehouse_id").alias("_w"), F.col("snapshot_ts").alias("_h"))
    same = F.col("warehouse_id").eqNullSafe(F.col("_w")) & F.col("snapshot_ts").eqNullSafe(F.col("_h"))
    return state.join(marks, same, "left_anti").unionByName(late)


def _sums(
    inventory_movements: DataFrame,
    warehouse_picks: DataFrame,
    grain: str,
    in_types: tuple[str, ...],
    shipped_types: tuple[str, ...],
) -> DataFrame:
    """Both inputs are stacked and summed once, which gives what a full outer join of two sums gives
    with half the shuffles."""
    none = F.lit(None).cast("bigint")

    def units(of_types: tuple[str, ...]) -> Column:
        return F.when(F.col("movement_type").isin(*of_types), F.col("quantity"))

    moved = inventory_movements.select(
        "warehouse_id",
        F.date_trunc(grain, "movement_ts").alias("snapshot_ts"),
        units(in_types).alias("units_in"),
        units(shipped_types).alias("units_shipped"),
        none.alias("units_picked"),
        none.alias("duration_ms"),
    )
    picked = warehouse_picks.select(
        "warehouse_id",
        F.date_trunc(grain, "picked_at").alias("snapshot_ts"),
        none.alias("units_in"),
        none.alias("units_shipped"),
        F.col("quantity").alias("units_picked"),
        "duration_ms",
    )
    timed = F.when(F.col("duration_ms").isNotNull(), F.col("units_picked"))
    return (
        moved.unionByName(picked)
        .groupBy(*HOUR)
        .agg(
            *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("units_in", "units_picked", "units_shipped")],
            F.sum("duration_ms").alias("pick_ms"),
            F.coalesce(F.sum(timed), F.lit(0)).alias("timed_units"),
            F.count("duration_ms").alias("timed_picks"),
        )
    )


def kpis_of(state: DataFrame) -> DataFrame:
    """The declared table of a state."""
    hundredths = _half_up(_wide("timed_units") * F.lit(100 * MILLIS_PER_HOUR).cast("decimal(12,0)"), _wide("pick_ms"))
    rate = hundredths.cast("decimal(20,0)") * F.lit("0.01").cast("decimal(3,2)")
    return state.select(
        "warehouse_id",
        "snapshot_ts",
        "units_in",
        "units_picked",
        "units_shipped",
        rate.cast(NUMERIC).alias("pick_rate_uph"),
        "backlog_units",
        _half_up(_wide("pick_ms"), _wide("timed_picks")).alias("avg_pick_ms"),
        F.to_date("snapshot_ts").alias("snapshot_date"),
    ).select(*STAGING["warehouse_kpi_snapshot"].names)


def closing_backlog(snapshot: DataFrame, opening: DataFrame | None = None) -> DataFrame:
    """(warehouse_id, backlog_units) after a snapshot; warehouses without rows in it keep theirs."""
    last = snapshot.groupBy("warehouse_id").agg(F.max_by("backlog_units", "snapshot_ts").alias("backlog_units"))
    if opening is None:
        return last
    ranked = opening.select("warehouse_id", "backlog_units", F.lit(0).alias("_turn")).unionByName(
        last.withColumn("_turn", F.lit(1))
    )
    return ranked.groupBy("warehouse_id").agg(F.max_by("backlog_units", "_turn").alias("backlog_units"))


def _wide(name: str) -> Column:
    return F.col(name).cast("decimal(20,0)")


def _half_up(top: Column, bottom: Column) -> Column:
    """The nearest whole number of top / bottom, halves up, NULL when bottom is 0 or missing."""
    two = F.lit(2).cast("decimal(1,0)")
    over, under = top * two + bottom, bottom * two
    # Whole division goes towards zero, so a negative quotient with a rest is one too high.
    down = F.call_function("div", over, under) - F.when((over < 0) & (over % under != 0), 1).otherwise(0)
    return F.when(bottom > 0, down)
