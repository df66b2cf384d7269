"""What happened to a key in the hours before a moment, without pairing rows.

For each distinct (key, moment), the events with ``moment - span < ts <= moment`` are summarised by
their greatest score and their set of codes. A join on key and time range would emit every pair,
which grows with the square of a busy key. Here time is cut into slices and the span is taken apart
into three pieces:

* the slice of the moment, up to the moment;
* the whole slices between both ends;
* the slice of ``moment - span``, after that time.

For scores, the two end pieces are running maxima inside (key, slice). The whole slices are first
reduced to one row each; between them, time is cut again into blocks as long as the span, and the
same two running maxima inside (key, block) give the rest.

Codes are first reduced to (key, slice, code) with their first and last time. A code is in the near
end if its first time is not after the moment, in the far end if its last time is after the start.
Between them, the slices of a (key, code) form runs without a gap of a span, and a run covers the
slices that see it. So what is joined grows with the codes that come out, not with the events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.sessions import MICROS_PER_MINUTE, slice_of
from millrace.session import written


def trailing_summary(
    moments: DataFrame, events: DataFrame, span_minutes: int = 24 * 60, slice_minutes: int = 10
) -> DataFrame:
    """``moments(key, moment)`` and ``events(key, ts, score, codes)`` to
    ``(key, moment, score, codes)``; moments with no event in their span are left out.

    ``codes`` comes out as a sorted array of distinct values. The distinct moments and the events, reduced
    to a score per moment and to codes per slice, are written to the shared scratch folder first.
    """
    if span_minutes % slice_minutes:
        raise ValueError("the span must be a whole number of slices")
    span = span_minutes * MICROS_PER_MINUTE
    width = slice_minutes * MICROS_PER_MINUTE

    probes = (
        moments.where(F.col("key").isNotNull() & F.col("moment").isNotNull())
        .select("key", "moment", F.unix_micros("moment").alias("at"))
        .distinct()
    )
    signals = events.where(F.col("key").isNotNull() & F.col("ts").isNotNull()).select(
        "key", F.unix_micros("ts").alias("at"), "score", "codes"
    )
    # Each is read by several of the branches below, none of which reads a feed again.
    asked = written(probes.select("key", "at", slice_of(F.col("at"), width).alias("slice")), "trailing-asked")
    highest = written(signals.groupBy("key", "at").agg(F.max("score").alias("score")), "trailing-scores")
    scores = _scores(asked, highest, span, width)
    codes = _codes(asked, written(_spells(signals, width), "trailing-codes"), span, width)
    none = F.array().cast("array<string>")
    summary = (
        scores.withColumn("codes", none)
        .unionByName(codes.withColumn("score", F.lit(None).cast("double")))
        .groupBy("key", "at")
        .agg(
            F.max("score").alias("score"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("codes")))).alias("codes"),
        )
    )
    return summary.select("key", F.timestamp_micros("at").alias("moment"), "score", "codes")


def _scores(asked: DataFrame, signals: DataFrame, span: int, width: int) -> DataFrame:
    """(key, at, score) of the moments with an event; up to three rows each."""
    # The last slice and the first, row by row. An event at the moment itself is inside the span.
    ends = _both_ends(asked.select("key", "at"), signals, span, width, inside=True)
    # The whole slices before the moment's own, and after the one where the span begins.
    slices = signals.groupBy("key", slice_of(F.col("at"), width).alias("at")).agg(F.max("score").alias("score"))
    count = span // width
    whole = _both_ends(asked.select("key", F.col("slice").alias("at")).distinct(), slices, count, count, inside=False)
    between = asked.join(whole.withColumnRenamed("at", "slice"), ["key", "slice"]).drop("slice")
    return ends.unionByName(between)


def _spells(signals: DataFrame, width: int) -> DataFrame:
    """(key, slice, code, first, last): when each code was first and last in a slice."""
    return (
        signals.select("key", "at", F.explode("codes").alias("code"))
        .where(F.col("code").isNotNull())
        .groupBy("key", slice_of(F.col("at"), width).alias("slice"), "code")
        .agg(F.min("at").alias("first"), F.max("at").alias("last"))
    )


def _codes(asked: DataFrame, found: DataFrame, span: int, width: int) -> DataFrame:
    """(key, at, codes) of the moments with a code; up to three rows each."""
    count = span // width
    near = asked.join(found, ["key", "slice"]).where(F.col("first") <= F.col("at"))
    start = F.col("at") - F.lit(span).cast("bigint")
    begun = asked.select("key", "at", (F.col("slice") - count).alias("slice"))
    far = begun.join(found, ["key", "slice"]).where(F.col("last") > start)
    ends = near.select("key", "at", "code").unionByName(far.select("key", "at", "code"))
    ends = ends.groupBy("key", "at").agg(F.collect_set("code").alias("codes"))

    # Runs of slices with the code: the slices after the first one, as far as the last one is seen.
    in_order = Window.partitionBy("key", "code").orderBy("slice")
    begins = F.col("slice") - F.lag("slice").over(in_order) > count - 1
    runs = found.withColumn("run", F.sum(F.coalesce(begins, F.lit(False)).cast("int")).over(in_order))
    runs = runs.groupBy("key", "code", "run").agg((F.min("slice") + 1).alias("low"), (F.max("slice") + count - 1).alias("high"))
    blocks = F.explode(F.sequence(F.floor(F.col("low") / count), F.floor(F.col("high") / count)))
    spread = runs.where("low <= high").select("key", "code", "low", "high", blocks.alias("block"))
    slices = asked.select("key", "slice", F.floor(F.col("slice") / count).alias("block")).distinct()
    seen = slices.join(spread, ["key", "block"]).where(F.col("slice").between(F.col("low"), F.col("high")))
    whole = seen.groupBy("key", "slice").agg(F.collect_set("code").alias("codes"))
    return ends.unionByName(asked.join(whole, ["key", "slice"]).select("key", "at", "codes"))


def _both_ends(probes: DataFrame, events: DataFrame, span: int, width: int, inside: bool) -> DataFrame:
    """For each probe (key, at), two greatest scores: of the events in its own slice up to ``at``, and of
    those in the slice of ``at - span`` after that time. Ends that hold no event give no row.

    ``turn`` orders rows of equal time. A probe that must not see events of its own time comes
    before them, one that must comes after.
    """
    no_score = F.lit(None).cast("double")
    near_turn = 2 if inside else 0

    def probe(asked_at: Column, far: bool) -> DataFrame:
        return probes.select(
            "key",
            F.col("at").alias("asked"),
            asked_at.alias("at"),
            F.lit(0 if far else near_turn).alias("turn"),
            F.lit(far).alias("far"),
            no_score.alias("score"),
        )

    happened = events.select(
        "key",
        F.lit(None).cast("bigint").alias("asked"),
        "at",
        F.lit(1).alias("turn"),
        F.lit(None).cast("boolean").alias("far"),
        "score",
    )
    rows = (
        probe(F.col("at"), False)
        .unionByName(probe(F.col("at") - F.lit(span).cast("bigint"), True))
        .unionByName(happened)
        .withColumn("slice", slice_of(F.col("at"), width))
    )
    group = Window.partitionBy("key", "slice")
    so_far = (Window.unboundedPreceding, Window.currentRow)
    up_to = group.orderBy(F.col("at").asc(), F.col("turn").asc()).rowsBetween(*so_far)
    after = group.orderBy(F.col("at").desc(), F.col("turn").asc()).rowsBetween(*so_far)
    is_event = F.col("asked").isNull()

    def summary(window: Window, side: str) -> list[Column]:
        return [
            F.max("score").over(window).alias(f"score_{side}"),
            F.max(is_event).over(window).alias(f"seen_{side}"),
        ]

    walked = rows.select("key", "asked", "far", *summary(up_to, "near"), *summary(after, "far"))

    def pick(name: str) -> Column:
        return F.when(F.col("far"), F.col(f"{name}_far")).otherwise(F.col(f"{name}_near"))

    return walked.where(~is_event & pick("seen")).select(
        "key", F.col("asked").alias("at"), pick("score").alias("score")
    )
