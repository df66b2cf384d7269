"""Mixing sources to target weights by balanced sampling with the cube method.

Sources in code-point order, null last, weigh 5, 2, 1, 5, 2, 1, ... and share ``SHARE`` of all words;
what a source cannot give (more than ``MOST`` times its words) is shared out again by weight. So a
source is taken at a rate between 0 and ``MOST``: each document as often as the whole part of the rate,
and once more with the probability of its fraction. Which documents are taken once more is decided by
the cube method: inclusion probabilities move along the null space of the constraints (the number of
documents and of words taken) until each is 0 or 1, which keeps both totals.

The flight is a tree within each source. The undecided documents of a source are dealt by hash to
shards of about ``SHARD``; in each the flight ends with fewer than three, and those of all shards of the
source are dealt anew, to fewer shards, until one is left. A source that fits one shard is landed at
once: there ``ASIDE`` documents of various lengths are put aside before the flight, and the landing
decides these and the last ones: of all possible endings it takes the one whose words, then whose number
come nearest. Sources of one shard share tasks, each whole. So the number of rounds is the logarithm of
the largest source to the base ``SHARD`` / 2, whatever the number of sources, and no task holds more than
a shard of a large source. Random directions come from hashes, so a mix is the same each time.

Cases: a null text has no words, and such documents are mixed like others; a source without words has
the target 0 and gives nothing; a null source is a source of its own. Repeated rows are decided one by
one; wholly equal rows are interchangeable, and their count is what is decided. Extra columns are
ignored by ``mixed`` and passed on by ``mixture``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import fresh, orderable, slices, written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
SHARD = 2_000
ASIDE = 9
SEED = 7
NEAR = 1e-9


def sized(frame: DataFrame, text: str, name: str, keep: list[str], hashed: str) -> DataFrame:
    """The ``keep`` columns, the words of ``text`` as ``name`` and a hash of the text."""
    narrow = frame.select(*[F.col(f"`{k}`") for k in keep if k != text], F.col(f"`{text}`").cast("string").alias(text), F.xxhash64(F.lit(SEED), F.col(f"`{text}`")).alias(hashed))
    at, out = narrow.columns.index(text), [c for c in narrow.columns if c in keep or c == hashed]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, at):
            words = [len((t or b"").split()) for t in part.column(at).cast(pa.large_binary()).to_pylist()]
            kept = [part.column(part.schema.get_field_index(c)) for c in out]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(words, pa.int64())], names=[*out, name])

    types = ", ".join(f"`{c}` {narrow.schema[c].dataType.simpleString()}" for c in out)
    return narrow.mapInArrow(run, f"{types}, `{name}` bigint")


def targets(sizes: DataFrame, share: float = SHARE, most: float = MOST, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source, source_size, target) from (source, size) rows; one row per source meets in a window.

    Sharing the excess again and again ends where a common level times the weight, or the cap if that
    is less, adds up to the share. Sources are capped in the order of their cap per weight.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights)) + 1)
    full = most * F.col("source_size").cast("double")
    ranked = sources.withColumn("weight", weight).withColumn("cap", full)
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    left = share * F.sum("source_size").over(Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    level = (left - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    levels = ranked.withColumn("level", level)
    # The level of the first source that is not capped; all before it are.
    open_level = F.first(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level")), ignorenulls=True)
    common = open_level.over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    reached = F.when(common.isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), common * F.col("weight")))
    return levels.select("source", "source_size", reached.alias("target"))


def flight(chance: np.ndarray, words: np.ndarray, noise: np.ndarray) -> np.ndarray:
    """Move the chances until fewer than three are undecided, keeping their sum and that of words.

    Works on three documents at a time: their null space under two constraints is a line. ``noise``
    in [0, 1) chooses the way along it, so that each chance is kept on average.
    """
    chance = chance.copy()
    undecided = [i for i in range(len(chance)) if NEAR < chance[i] < 1 - NEAR]
    values, sizes, random = chance.tolist(), words.tolist(), noise.tolist()
    held: list[int] = []
    queue = iter(undecided)
    while True:
        while len(held) < 3:
            following = next(queue, None)
            if following is None:
                for i, v in enumerate(values):
                    chance[i] = round(v) if min(v, 1 - v) <= NEAR else v
                return chance
            held.append(following)
        a, b, c = held
        move = (sizes[c] - sizes[b], sizes[a] - sizes[c], sizes[b] - sizes[a])
        if not any(move):
            move = (1.0, -1.0, 0.0)
        up = down = float("inf")
        for i, m in zip(held, move, strict=True):
            if m > 0:
                up, down = min(up, (1 - values[i]) / m), min(down, values[i] / m)
            elif m < 0:
                up, down = min(up, values[i] / -m), min(down, (1 - values[i]) / -m)
        step = up if random[a] * (up + down) < down else -down
        random[a] = (random[a] * 1103515245.0 + 0.12345) % 1.0
        for i, m in zip(held, move, strict=True):
            values[i] = min(1.0, max(0.0, values[i] + step * m))
        held = [i for i in held if NEAR < values[i] < 1 - NEAR]


def aside(chance: np.ndarray, words: np.ndarray, most: int = ASIDE) -> np.ndarray:
    """Places of undecided documents, at even steps of their order by length."""
    undecided = np.flatnonzero((chance > NEAR) & (chance < 1 - NEAR))
    ordered = undecided[np.argsort(words[undecided], kind="stable")]
    return ordered[np.unique(np.linspace(0, len(ordered) - 1, min(most, len(ordered))).astype(int))]


def landing(chance: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Decide the last few: of all endings, the one whose words and number come nearest."""
    last = np.flatnonzero((chance > NEAR) & (chance < 1 - NEAR))
    out = np.round(chance)
    if len(last):
        endings = np.array(list(product((0, 1), repeat=len(last))), dtype=float)
        off_words = np.abs(endings @ words[last] - chance[last] @ words[last])
        off_number = np.abs(endings.sum(axis=1) - chance[last].sum())
        out[last] = endings[np.lexsort((off_number, np.round(off_words + off_number * words[last].mean() / 50, 6)))[0]]
    return out


def landed(chance: np.ndarray, words: np.ndarray, noise: np.ndarray) -> np.ndarray:
    """The flight of all but a few documents, and the landing of these."""
    free = np.ones(len(chance), dtype=bool)
    free[aside(chance, words)] = False
    out = chance.copy()
    out[free] = flight(chance[free], words[free], noise[free])
    return landing(out, words)


def flown(frame: DataFrame) -> DataFrame:
    """One round: rows (shard, last, source, key, size, chance, ...); chances moved within each source
    of a shard, and landed where ``last``."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pandas()
        rows["source"] = rows["source"].astype(object).where(rows["source"].notna(), None)
        rows["none"] = rows["source"].isna()
        rows = rows.sort_values(["none", "source", "key", "size"], kind="stable").reset_index(drop=True)
        chance, last = rows["chance"].to_numpy().copy(), rows["last"].to_numpy()
        words = rows["size"].to_numpy().astype(float)
        noise = (rows["key"].to_numpy().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(11)) / float(1 << 53)
        start = np.flatnonzero((rows["source"].fillna("").ne(rows["source"].fillna("").shift()) | rows["none"].ne(rows["none"].shift())).to_numpy())
        for a, b in zip(start, [*start[1:], len(rows)], strict=True):
            chance[a:b] = (landed if last[a] else flight)(chance[a:b], words[a:b], noise[a:b])
        rows["chance"] = chance
        return pa.Table.from_pandas(rows[table.column_names], schema=table.schema.remove_metadata(), preserve_index=False)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema.fields)
    return frame.groupBy("shard").applyInArrow(run, schema)


def dealt(units: DataFrame, shard: int) -> tuple[DataFrame, bool]:
    """Units with shard and last, and whether all sources are in their last round. A source of several
    shards has them for itself; the others are dealt whole to shards that they share."""
    counts = written(units.groupBy("source").agg(F.count(F.lit(1)).alias("n")), "mixing-counts")
    small = F.col("n") <= shard
    sums = counts.agg(F.sum(F.when(small, F.col("n"))).alias("few"), F.coalesce(F.max("n"), F.lit(0)).alias("most")).first()
    shared = F.lit(-(-(sums.few or 0) // shard) or 1)
    own = F.pmod(F.xxhash64(F.lit(SEED + 1), F.col("n"), "key"), F.ceil(F.col("n") / shard))
    place = F.when(small, F.pmod(F.xxhash64("source"), shared)).otherwise(F.xxhash64("source", own))
    counts = counts.select(F.col("source").alias("counted"), "n")
    rows = units.join(counts, F.col("source").eqNullSafe(F.col("counted")))
    return rows.withColumn("shard", place).withColumn("last", small).drop("counted", "n"), sums.most <= shard


def decided(units: DataFrame, shard: int = SHARD) -> DataFrame:
    """(key, source, size, chance, ...) with every chance moved to 0 or 1. A round leaves at most two
    units per shard, so shards of eight and more leave fewer each time."""
    undecided = (F.col("chance") > NEAR) & (F.col("chance") < 1 - NEAR)
    open_, parts, done = units.where(undecided), [units.where(~undecided)], False
    while not done:
        rows, done = dealt(open_, max(8, shard))
        moved = written(flown(rows), "mixing-round").select(*units.columns)
        parts.append(moved.where(~undecided))
        open_ = moved.where(undecided)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def copies(sizes: DataFrame) -> DataFrame:
    """(source, hash, size, n, source_size, target, whole, more): n equal rows are each taken ``whole``
    times, and ``more`` of them once again. Rows are (doc_id, source, size, hash)."""
    goal = written(targets(sizes), "mixing-targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rate = F.least(F.round(rate, 12), F.lit(float(MOST)))
    on = F.col("source").eqNullSafe(F.col("goal_source"))
    units = sizes.groupBy("doc_id", "source", "size", "hash").agg(F.count(F.lit(1)).alias("n"))
    units = units.join(goal.withColumnRenamed("source", "goal_source"), on).drop("goal_source")
    # Each of n equal rows has the same chance: together they are taken whole times, and one unit is left.
    units = units.withColumn("whole", F.floor(rate)).withColumn("again", F.col("n") * (rate - F.col("whole")))
    units = units.withColumn("sure", F.floor(F.round("again", 9))).withColumn("chance", F.greatest(F.lit(0.0), F.col("again") - F.col("sure")))
    units = written(units.withColumn("key", F.xxhash64(F.lit(SEED), "doc_id", "source", "size", "hash")), "mixing-units")
    moved = decided(units.select("key", "source", "size", "chance", "doc_id", "hash"))
    picked = moved.where(F.col("chance") > 0.5).select(*[F.col(c).alias(f"p_{c}") for c in ("doc_id", "source", "size", "hash")])
    same = [F.col(c).eqNullSafe(F.col(f"p_{c}")) for c in ("doc_id", "source", "size", "hash")]
    joined = units.join(picked, same[0] & same[1] & same[2] & same[3], "left")
    more = F.col("sure") + F.when(F.col("p_size").isNotNull(), 1).otherwise(0)
    return joined.select("doc_id", "source", "size", "hash", "n", "source_size", "target", "whole", more.alias("more"))


def measured(frame: DataFrame, key: str, text: str, source: str) -> DataFrame:
    rows = frame.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{source}`").cast("string").alias("source"), F.col(f"`{text}`").alias("text"))
    return written(sized(rows, "text", "size", ["doc_id", "source"], "hash"), "mixing-sizes")


def times(whole: Column, more: Column, place: Column) -> Column:
    """How often the row at a place among its equals is taken."""
    return (whole + F.when(place <= more, 1).otherwise(0)).cast("bigint")


def mixed(frame: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(doc_id, size, source_size, target, taken) for each row of the frame."""
    each = copies(measured(frame, key, text, source)).withColumn("place", F.explode(F.sequence(F.lit(1).cast("bigint"), "n")))
    taken = F.col("size") * times(F.col("whole"), F.col("more"), F.col("place"))
    return each.select("doc_id", "size", "source_size", "target", taken.alias("taken"))


def mixture(frame: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The rows of the frame, each as often as the mix takes it, with the columns of the frame."""
    counted = copies(measured(frame, key, text, source)).where((F.col("whole") > 0) | (F.col("more") > 0))
    size, hashed, place, often = (fresh(n, frame.columns) for n in ("size", "hash", "place", "times"))
    rows = frame.withColumn(hashed, F.xxhash64(F.lit(SEED), F.col(f"`{text}`")))
    chosen = counted.select(*[F.col(c).alias(f"{size}_{c}") for c in ("doc_id", "source", "hash", "n", "whole", "more")])
    on = F.col(f"`{key}`").eqNullSafe(F.col(f"{size}_doc_id")) & F.col(f"`{source}`").cast("string").eqNullSafe(F.col(f"{size}_source")) & (F.col(hashed) == F.col(f"{size}_hash"))
    joined = rows.join(chosen, on)
    columns = [F.col(f"`{c}`") for c in frame.columns]
    # Among equal rows it does not matter which is taken once more, so a row takes its share of the
    # total, rounded at its place; only rows that have equals need a place.
    single = joined.where(F.col(f"{size}_n") == 1).withColumn(place, F.lit(1))
    order = Window.partitionBy(f"`{key}`", f"{size}_source", hashed).orderBy(*orderable(frame, (key, source, text)) or [F.lit(1)])
    equal = joined.where(F.col(f"{size}_n") > 1).withColumn(place, F.row_number().over(order))
    both = single.unionByName(equal)
    both = both.withColumn(often, times(F.col(f"{size}_whole"), F.col(f"{size}_more"), F.col(place)))
    return both.where(F.col(often) > 0).withColumn(place, F.explode(F.sequence(F.lit(1).cast("bigint"), often))).select(*columns)
