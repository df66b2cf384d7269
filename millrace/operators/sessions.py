"""Sessions: events of one visitor with no pause longer than a gap.

A window over all events of a visitor would put a very busy visitor into one task. Instead, events
are first counted per (visitor, time slice). A slice is no longer than the gap, so events of one
slice are always in one session, and only slices have to be walked in order. Their number depends
on how much time passed, not on how many events there were. Events then find their session by an
equi-join on (visitor, slice).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MICROS_PER_MINUTE = 60_000_000


def slice_of(micros: Column, width: int) -> Column:
    """The number of the time slice, in whole-number arithmetic that also holds before 1970."""
    size = F.lit(width).cast("bigint")
    return F.call_function("div", micros - F.pmod(micros, size), size)


def slice_number(ts: Column, slice_minutes: int) -> Column:
    return slice_of(F.unix_micros(ts), slice_minutes * MICROS_PER_MINUTE)


def session_slices(
    events: DataFrame, visitor: list[str], ts: str, gap_minutes: int, slice_minutes: int, known: str
) -> DataFrame:
    """One row per (visitor columns, ``_slice``) with its session's start, end and event count.

    ``known`` is a visitor column holding a session id that the feed already gave; such events are
    one session whatever their pauses.
    """
    if slice_minutes > gap_minutes:
        raise ValueError("a slice must not be longer than the gap")
    gap = gap_minutes * MICROS_PER_MINUTE
    sliced = events.groupBy(*visitor, slice_number(F.col(ts), slice_minutes).alias("_slice")).agg(
        F.min(F.unix_micros(F.col(ts))).alias("_first"),
        F.max(F.unix_micros(F.col(ts))).alias("_last"),
        F.count(F.lit(1)).alias("_events"),
    )
    in_order = Window.partitionBy(*visitor).orderBy("_slice")
    pause = F.col("_first") - F.lag("_last").over(in_order)
    starts = F.when(pause.isNull() | ((pause > gap) & F.col(known).isNull()), F.col("_first"))
    marked = sliced.withColumn("_starts", starts).withColumn(
        "session_start", F.max("_starts").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    )
    whole = Window.partitionBy(*visitor, "session_start")
    return marked.select(
        *visitor,
        "_slice",
        "session_start",
        F.max("_last").over(whole).alias("session_end"),
        F.sum("_events").over(whole).alias("session_events"),
    )
