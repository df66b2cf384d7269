"""Web and app events without repeats, in sessions, with a score for machine-like pace."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.contracts import STAGING
from millrace.functions.keys import parse_timestamp
from millrace.functions.numbers import UNIT, with_decimal
from millrace.operators.latest import first_per_key, has_key, total_order
from millrace.operators.sessions import MICROS_PER_MINUTE, session_slices, slice_number
from millrace.session import written

WEB_TIME_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm:ss.SSSSSS")


SAME_EVENT = ["_visitor", "_moment", "_page"]
DECIDING = ["event_ts", "_given"]


def dedup_clickstream(
    omniture: DataFrame,
    mobile_events: DataFrame,
    gap_minutes: int = 30,
    slice_minutes: int = 5,
    repeat_grain: str | None = None,
    web_time_formats: tuple[str, ...] = WEB_TIME_FORMATS,
) -> DataFrame:
    """The earliest event per (visitor, time, page), where the visitor is the user or else the
    address, and the page is the URL or else the event id.

    ``repeat_grain`` widens "same time" from equal times to one hour, day and so on. Events without
    a session get one by pauses longer than the gap. ``bot_score`` is the session's events per
    minute, cut after nine decimals. An event without a visitor, a readable time or a page repeats no
    other and is kept.
    """
    state = clicks_state(omniture, mobile_events, None, gap_minutes, slice_minutes, repeat_grain, web_time_formats)
    return clicks_of(state)


def clicks_state(
    omniture: DataFrame,
    mobile_events: DataFrame,
    previous: DataFrame | None = None,
    gap_minutes: int = 30,
    slice_minutes: int = 5,
    repeat_grain: str | None = None,
    web_time_formats: tuple[str, ...] = WEB_TIME_FORMATS,
) -> DataFrame:
    """The kept events with their sessions, after a load that follows the ``previous`` state.

    The declared table holds neither the page nor the given session by which events are told apart, so
    this state is kept beside it. However events are dealt to loads, and however late, the state after
    the last one is that of a single load of all: sessions that a load reaches, and those with a
    repeat of its events, are formed anew from their events and the new ones; all others are passed on.
    """
    events = _from_web(omniture, web_time_formats).unionByName(_from_app(mobile_events))
    if previous is None:
        return _kept_in_sessions(events, gap_minutes, slice_minutes, repeat_grain)
    events = written(events, "clicks-new")
    reached = _reached(previous, events, gap_minutes, slice_minutes, repeat_grain)
    reached = reached.withColumnsRenamed({"_visitor": "_v", "_given": "_g", "session_start": "_s"})
    of_session = (F.col("_visitor") == F.col("_v")) & F.col("_given").eqNullSafe(F.col("_g")) & (F.col("session_start") == F.col("_s"))
    again = previous.join(reached, of_session, "left_semi").select(*events.columns)
    formed = _kept_in_sessions(events.unionByName(again), gap_minutes, slice_minutes, repeat_grain)
    return previous.join(reached, of_session, "left_anti").unionByName(formed)


def clicks_of(state: DataFrame) -> DataFrame:
    """The declared table of a state."""
    made_id = F.concat_ws("-", "_visitor", F.col("session_start").cast("string"))
    country = F.coalesce(F.upper("country"), F.lit("ZZ"))
    return _with_bot_score(state).select(
        F.coalesce(F.col("_given"), F.when(F.col("session_start").isNotNull(), made_id)).alias("session_id"),
        "user_id",
        "event_ts",
        "page_url",
        "referrer_url",
        "ip",
        "country",
        "bot_score",
        "device_type",
        country.alias("country_partition"),
        F.coalesce(F.to_date("event_ts"), F.to_date("_loaded")).alias("event_date"),
    ).select(*STAGING["dedup_clickstream"].names)


def _moment(grain: str | None) -> Column:
    return F.col("event_ts") if grain is None else F.date_trunc(grain, "event_ts")


def _kept_in_sessions(events: DataFrame, gap_minutes: int, slice_minutes: int, grain: str | None) -> DataFrame:
    """The first event of each key with the start, the end and the number of events of its session.

    An event without a key gets a number of its own, which only has to differ from all others, so that
    one scan and one reduction in the input tasks serve the events with and without a key.
    """
    own = F.when(~has_key(SAME_EVENT), F.monotonically_increasing_id())
    marked = events.withColumn("_moment", _moment(grain))
    order = total_order(
        marked, [F.col(c).asc_nulls_first() for c in DECIDING], [*DECIDING, *SAME_EVENT], descending=False
    )
    numbered = marked.withColumn("_own", own)
    unique = first_per_key(numbered, [F.col(c) for c in [*SAME_EVENT, "_own"]], order)

    # Which events survive, found again from the few columns that decide it, so that the sessions
    # are computed from a narrow scan instead of from the full rows.
    timed = numbered.where(F.col("_visitor").isNotNull() & F.col("_moment").isNotNull())
    survivors = (
        timed.groupBy(*SAME_EVENT, "_own")
        .agg(F.min(F.struct(*DECIDING)).alias("_first"))
        .select("_visitor", "_first.event_ts", "_first._given")
    )
    sessions = session_slices(
        survivors, ["_visitor", "_given"], "event_ts", gap_minutes, slice_minutes, "_given"
    ).withColumnsRenamed({"_visitor": "_v", "_given": "_g", "_slice": "_s"})

    # Events that cannot be placed get a join key of their own, so that they do not meet in one task.
    place = F.coalesce(slice_number(F.col("event_ts"), slice_minutes), F.xxhash64("_page", "ip", "_given"))
    matched = (
        (F.coalesce("_visitor", F.concat(F.lit("none "), F.col("_place").cast("string"))) == F.col("_v"))
        & F.col("_given").eqNullSafe(F.col("_g"))
        & (F.col("_place") == F.col("_s"))
        & F.col("_visitor").isNotNull()
        & F.col("event_ts").isNotNull()
    )
    placed = unique.withColumn("_place", place).join(sessions, matched, "left")
    return placed.select(*events.columns, "session_start", "session_end", "session_events")


def _reached(previous: DataFrame, events: DataFrame, gap_minutes: int, slice_minutes: int, grain: str | None) -> DataFrame:
    """(visitor, given, start) of the sessions that new events may change.

    Sessions and slices of new events are both spans of time in which no pause is longer than the gap, so one
    walk over the spans of a visitor finds which of them come together.
    """
    visitor, start = ["_visitor", "_given"], "session_start"
    old = previous.where(F.col(start).isNotNull()).groupBy(*visitor, start).agg(F.max("session_end").alias("_last"))
    old = old.select(*visitor, F.col(start).alias("_first"), "_last", F.col(start).alias("_old"))
    micros = F.unix_micros("event_ts")
    timed = events.where(F.col("_visitor").isNotNull() & F.col("event_ts").isNotNull())
    new = timed.groupBy(*visitor, slice_number(F.col("event_ts"), slice_minutes).alias("_slice")).agg(
        F.min(micros).alias("_first"), F.max(micros).alias("_last")
    )
    spans = old.unionByName(new.drop("_slice"), allowMissingColumns=True)
    in_order = Window.partitionBy(*visitor).orderBy("_first", "_last", F.col("_old").asc_nulls_first())
    pause = F.col("_first") - F.max("_last").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    apart = (pause > gap_minutes * MICROS_PER_MINUTE) & F.col("_given").isNull()
    spans = spans.withColumn("_apart", F.coalesce(apart, F.lit(False)).cast("bigint"))
    spans = spans.withColumn("_group", F.sum("_apart").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    joined_by_new = F.max(F.col("_old").isNull()).over(Window.partitionBy(*visitor, "_group"))
    near = spans.withColumn("_near", joined_by_new).where(F.col("_near") & F.col("_old").isNotNull())

    keys = events.withColumn("_moment", _moment(grain)).where(has_key(SAME_EVENT)).select(*SAME_EVENT).distinct()
    repeated = previous.withColumn("_moment", _moment(grain)).join(keys, SAME_EVENT, "left_semi")
    return near.select(*visitor, F.col("_old").alias(start)).unionByName(repeated.select(*visitor, start)).distinct()


def _with_bot_score(state: DataFrame) -> DataFrame:
    """Events per minute; a session counts as a minute at least.

    The whole part and the billionths are divided apart, since a decimal quotient is rounded to six
    decimals.
    """
    lasted, events = F.col("_lasted"), F.col("_events")
    of_session = {
        "_lasted": F.greatest(F.col("session_end") - F.col("session_start"), F.lit(MICROS_PER_MINUTE)).cast("decimal(20,0)"),
        "_events": F.col("session_events").cast("decimal(20,0)") * F.lit(MICROS_PER_MINUTE).cast("decimal(8,0)"),
    }
    whole = F.call_function("div", events, lasted).cast("decimal(20,0)")
    rest = F.call_function("div", (events % lasted) * F.lit(UNIT).cast("decimal(10,0)"), lasted).cast("decimal(10,0)")
    score = (whole * F.lit(UNIT).cast("decimal(10,0)") + rest).cast("decimal(38,0)")
    scored = F.when(F.col("session_events").isNotNull(), score)
    return with_decimal(state.withColumns(of_session), "bot_score", scored).drop(*of_session)


def _event(**columns: Column) -> list[Column]:
    return [column.alias(name) for name, column in columns.items()]


def _from_web(omniture: DataFrame, formats: tuple[str, ...]) -> DataFrame:
    none = F.lit(None).cast("string")
    return omniture.select(
        *_event(
            _visitor=F.coalesce(F.col("user_id"), F.col("ip")),
            _page=F.col("url"),
            _given=none,
            _loaded=F.col("partition_ts"),
            user_id=F.col("user_id"),
            event_ts=parse_timestamp(F.col("event_ts"), formats),
            page_url=F.col("url"),
            referrer_url=none,
            ip=F.col("ip"),
            country=F.col("country"),
            device_type=none,
        )
    )


def _from_app(mobile_events: DataFrame) -> DataFrame:
    none = F.lit(None).cast("string")
    return mobile_events.select(
        *_event(
            _visitor=F.coalesce(F.col("user_id"), F.col("context.ip")),
            _page=F.col("event_id"),
            _given=F.col("context.session_id"),
            _loaded=F.col("event_timestamp"),
            user_id=F.col("user_id"),
            event_ts=F.col("event_ts"),
            page_url=none,
            referrer_url=F.col("context.referrer"),
            ip=F.col("context.ip"),
            country=F.col("context.country"),
            device_type=F.col("device_type"),
        )
    )
