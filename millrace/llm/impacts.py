"""Exact top-k inner products from an impact-ordered index, score at a time.

The index is a table of shards, one row each. A shard holds ``SHARD`` distinct vectors, dealt by hash,
as postings per component: a component's range is cut into ``LEVELS`` equal steps, and the
vectors of a step are one segment. Beside them lie the integer components for rescoring.

A query meets a shard so: from each component it has the segments in order of falling impact, the
query's component times the step, measured from the end of the range that is worst for it, so that no
impact is negative. All segments are processed by falling impact, and each adds its impact to its vectors.
At each of ``LOOKS`` two bounds are known of each vector: its sum, and its sum with the rounding of the
steps and what its missing components can still add, which is for each the impact of the next segment of
that component. The vectors with the highest sums are scored exactly, and those whose upper bound lies
below the k best of them, or of the shards before, are proven out. Processing stops only when all but a small share of the vectors
are out; and the rest are scored exactly from their integers. If that never happens, all segments are processed.

Queries are dealt in blocks of ``BLOCK`` and shards in lanes of ``LANE``; a task streams the shards of a lane
past a block of queries and keeps the k best of each, whose last score helps to stop in the next shard.
So memory is one shard, one block of queries and its k best, whatever the table's size, and no
query set is broadcast.

Equal vectors are indexed once with as many of their smallest ids as a query can use, which loses nothing.

Cases: vectors that are null or hold null, NaN or infinite components take no part, nor do rows without an
id; zero and empty vectors do. Of vectors of different lengths the missing components count as 0. Components
beyond 2**62 after scaling count as that, and scores beyond a long as its end. Equal rows count once; of
rows that share an id but not the vector the best counts, and none is found for a query of its id (for that
as many more vectors are asked for as the most that share an id). Ties go to the smaller id. An empty table gives no row; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import shuffle_partitions, written

SHARD = 4096
LEVELS = 32
BLOCK = 256
LANE = 4
NEAREST = 10
SCALE = 1024
#: Shares of a shard's postings after which bounds are looked at, and the share of its vectors left to rescore.
LOOKS, LEFT = (0.25, 0.4, 0.5, 0.6, 0.7, 0.85), 1 / 16
MOST = 1 << 62
LEAST_LONG, MOST_LONG = -(1 << 63), (1 << 63) - 1


def usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False))


def integers(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component x as double."""
    return F.transform(vector, lambda v: F.floor(F.greatest(F.least(v.cast("double") * scale, F.lit(float(MOST))), F.lit(-float(MOST)))).cast("bigint"))


def distinct(frame: DataFrame, key: str, vector: str, most: int, shards: int) -> DataFrame:
    """(shard, vec, ids): each distinct integer vector with at most ``most`` of its ids, the smallest."""
    rows = frame.select("id", "vec", F.xxhash64("vec").alias("h"))
    first = rows.withColumn("rank", F.dense_rank().over(Window.partitionBy("h", "vec").orderBy("id"))).where(F.col("rank") <= most)
    whole = first.groupBy("h", "vec").agg(F.sort_array(F.collect_set("id")).alias("ids"))
    return whole.select(F.pmod(F.xxhash64("h"), F.lit(shards)).alias("shard"), "vec", "ids")


def rectangle(column: pa.ListArray, width: int) -> np.ndarray:
    """Vectors as rows, filled up with zeros."""
    flat, ends = np.asarray(column.flatten(), dtype=np.int64), np.asarray(column.offsets)
    sizes = np.diff(ends)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width), dtype=np.int64)
    out[np.arange(width)[None, :] < sizes[:, None]] = flat
    return out


@dataclass
class Shard:
    values: np.ndarray  # vectors by components
    low: np.ndarray  # least value of each component
    step: np.ndarray  # width of its levels
    postings: np.ndarray  # vectors by (component, level)
    ends: np.ndarray  # of the segments
    ids: np.ndarray
    id_ends: np.ndarray

    @classmethod
    def build(cls, values: np.ndarray, ids: np.ndarray, id_ends: np.ndarray, levels: int = LEVELS) -> Shard:
        low, high = values.min(axis=0), values.max(axis=0)
        step = (high.astype(object) - low.astype(object)) // levels + 1
        step = np.array(step, dtype=np.int64).reshape(len(low))
        # In halves, because a range may be wider than a long.
        level = np.array((values.astype(object) - low.astype(object)) // step.astype(object), dtype=np.int64) if (np.abs(values) > MOST // 2).any() else (values - low) // step
        place = (level + np.arange(values.shape[1]) * levels).T.ravel()
        order = np.argsort(place, kind="stable")
        postings = (order % len(values)).astype(np.uint16 if len(values) <= 1 << 16 else np.int32)
        ends = np.concatenate([[0], np.cumsum(np.bincount(place, minlength=values.shape[1] * levels))])
        return cls(values, low, step, postings, ends, ids, id_ends)

    @property
    def levels(self) -> int:
        return (len(self.ends) - 1) // max(1, len(self.low))

    @cached_property
    def level(self) -> np.ndarray:
        """Vectors by components: the level of each value."""
        out = np.empty(self.values.size, dtype=np.uint8)
        sizes = np.diff(self.ends)
        place = np.repeat(np.arange(len(sizes)) // max(1, self.levels) * len(self.values), sizes) + self.postings
        out[place] = np.repeat((np.arange(len(sizes)) % max(1, self.levels)).astype(np.uint8), sizes)
        return np.ascontiguousarray(out.reshape(self.values.shape[::-1]).T)


def exact(values: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products as integers, of Python's where a long could overflow, then cut to the range of a long."""
    if not values.size:
        return np.zeros(len(values), dtype=np.int64)
    most = float(np.abs(values.astype(float)).max()) * float(np.abs(query.astype(float)).sum())
    if most < 2**62:
        return values @ query
    return np.array([max(LEAST_LONG, min(MOST_LONG, s)) for s in values.astype(object) @ query.astype(object)], dtype=np.int64)


def members(
    shard: Shard, query: np.ndarray, k: int, floor: float = -np.inf, looks: tuple[float, ...] = LOOKS, left: float = LEFT
) -> tuple[np.ndarray, int]:
    """Vectors that may be among the k best of the shard and score ``floor`` at least, and the postings read."""
    n, width, levels = len(shard.values), len(shard.low), shard.levels
    used = np.flatnonzero(query)
    if n <= k or not len(used) or not width:
        return np.arange(n), 0
    weight = np.abs(query[used]).astype(float)
    up = query[used] > 0
    step = shard.step[used].astype(float)
    # Segments by rank from the best: an impact is exact up to weight * (step - 1).
    ranks = np.arange(levels)
    impact = (weight * step)[:, None] * (levels - 1 - ranks)[None, :]
    segment = used[:, None] * levels + np.where(up[:, None], levels - 1 - ranks[None, :], ranks[None, :])
    order = np.argsort(-impact, axis=None, kind="stable")
    order = order[(shard.ends[segment + 1] > shard.ends[segment]).ravel()[order]]
    segment, gain, owner, rank = segment.ravel()[order], impact.ravel()[order], order // levels, order % levels
    starts, sizes = shard.ends[segment], shard.ends[segment + 1] - shard.ends[segment]
    # Sums are measured from the worst corner of the shard's ranges.
    corner = np.where(up, shard.low[used].astype(float), shard.low[used] + step * levels - 1)
    base = float((query[used].astype(float) * corner).sum())
    error = weight * (step - 1)
    slack = 1e-9 * (abs(base) + float((weight * step * levels).sum()) + 1)  # for sums of doubles
    own = shard.level if len(used) == width else shard.level[:, used]
    own = np.where(up, np.uint8(levels - 1) - own, own)
    total, alive = np.zeros(n), np.arange(n)
    read = np.cumsum(sizes)
    cuts = np.unique(np.append(np.searchsorted(read, np.array(looks) * read[-1]), len(segment)))
    start = 0
    for end in cuts[cuts > 0].tolist():
        part = np.concatenate([shard.postings[a : a + m] for a, m in zip(starts[start:end].tolist(), sizes[start:end].tolist(), strict=True)])
        total += np.bincount(part, weights=np.repeat(gain[start:end], sizes[start:end]), minlength=n)
        start = end
        rest, first = np.unique(owner[end:], return_index=True)
        following, ahead = np.full(len(used), levels, np.uint8), np.zeros(len(used))
        following[rest], ahead[rest] = rank[end:][first], gain[end:][first]
        best = np.argpartition(total, n - 2 * k)[n - 2 * k :] if n > 2 * k else np.arange(n)
        floor = max(floor, float(np.sort(exact(shard.values[best], query).astype(float))[-k]) - slack)
        upper = total[alive] + error.sum() + (own[alive] >= following).astype(float) @ ahead
        alive = alive[upper >= floor - base - slack]
        if len(alive) <= max(k, left * n):
            break
    return alive, int(read[end - 1])


def best_of(ids: np.ndarray, scores: np.ndarray, query_id: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best by score, then id, each id once and without the query's own."""
    other = ids != query_id
    ids, scores = ids[other], scores[other]
    order = np.lexsort((ids, ~scores))  # falling, without overflow
    ids, scores = ids[order], scores[order]
    _, first = np.unique(ids, return_index=True)
    keep = np.sort(first)[:k]
    return ids[keep], scores[keep]


def searched(shard: Shard, query: np.ndarray, query_id: int, held: tuple[np.ndarray, np.ndarray], k: int, shared: int = 1) -> tuple[tuple[np.ndarray, np.ndarray], int]:
    """The k best of those held and of the shard, and the postings read. An id has at most ``shared`` vectors;
    one more id than k is asked for, because the query's own may be among them."""
    if len(query) < shard.values.shape[1]:
        query = np.concatenate([query, np.zeros(shard.values.shape[1] - len(query), dtype=np.int64)])
    query = query[: shard.values.shape[1]]
    floor = float(held[1][-1]) if len(held[0]) == k else -np.inf
    may, read = members(shard, query, (k + 1) * shared, floor)
    scores = exact(shard.values[may], query)
    sizes = np.diff(shard.id_ends)[may]
    starts = np.repeat(shard.id_ends[may] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) if len(may) else np.zeros(0, int)
    ids = shard.ids[starts + np.arange(sizes.sum())]
    scores = np.repeat(scores, sizes)
    return best_of(np.concatenate([held[0], ids]), np.concatenate([held[1], scores]), query_id, k), read


PARTS = ["vecs", "low", "step", "postings", "ends", "ids", "id_ends"]
INDEX = "shard bigint, width int, " + ", ".join(f"{c} binary, {c}_kind string" for c in PARTS)


def packed(array: np.ndarray) -> tuple[bytes, str]:
    """An integer array in the narrowest type that holds it."""
    if array.dtype == np.int64 and len(array):
        least, most = int(array.min()), int(array.max())
        for kind in (np.int8, np.int16, np.int32):
            if np.iinfo(kind).min <= least and most <= np.iinfo(kind).max:
                array = array.astype(kind)
                break
    return array.tobytes(), array.dtype.str


def index(vectors: DataFrame) -> DataFrame:
    """One row per shard of vectors (shard, vec, ids)."""

    def build(table: pa.Table) -> pa.Table:
        column, own = table.column("vec").combine_chunks(), table.column("ids").combine_chunks()
        width = int(np.diff(np.asarray(column.offsets)).max(initial=0))
        shard = Shard.build(rectangle(column, width), np.asarray(own.flatten(), dtype=np.int64), np.asarray(own.offsets, dtype=np.int64) - own.offsets[0].as_py())
        row = {"shard": table.column("shard")[0].as_py(), "width": width}
        for name, array in zip(PARTS, (shard.values.ravel(), shard.low, shard.step, shard.postings, shard.ends.astype(np.int64), shard.ids, shard.id_ends), strict=True):
            row[name], row[f"{name}_kind"] = packed(array)
        return pa.Table.from_pylist([row], schema)

    kinds = {"shard": pa.int64(), "width": pa.int32()}
    for c in PARTS:
        kinds |= {c: pa.binary(), f"{c}_kind": pa.string()}
    schema = pa.schema(list(kinds.items()))
    return vectors.groupBy("shard").applyInArrow(build, INDEX)


def loaded(row: dict) -> Shard:
    arrays = [np.frombuffer(row[c], dtype=np.dtype(row[f"{c}_kind"])) for c in PARTS]
    values, low, step, postings, ends, ids, id_ends = arrays
    values = values.astype(np.int64).reshape(-1, row["width"]) if row["width"] else np.zeros((len(id_ends) - 1, 0), np.int64)
    return Shard(values, low.astype(np.int64), step.astype(np.int64), postings, ends.astype(np.int64), ids.astype(np.int64), id_ends.astype(np.int64))


def top(frame: DataFrame, queries: Column, key: str = "vec_id", vector: str = "embedding", k: int = NEAREST, shard: int = SHARD) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows with the highest integer inner product for each query."""
    spark = frame.sparkSession
    rows = frame.where(F.col(f"`{key}`").isNotNull() & usable(F.col(f"`{vector}`")))
    ready = rows.select(F.col(f"`{key}`").cast("bigint").alias("id"), integers(F.col(f"`{vector}`")).alias("vec"), queries.alias("asks"))
    each = ready.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.count_distinct(F.xxhash64("vec")).alias("vectors"))
    count, shared = each.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("vectors"), F.lit(1))).collect()[0]
    shards = max(1, -(-count // shard))
    asked = written(ready.where("asks").select("id", "vec").distinct(), "impact-queries")
    blocks, lanes = max(1, -(-asked.count() // BLOCK)), max(1, -(-shards // LANE))
    shelf = written(index(distinct(ready, key, vector, k + 1, shards)), "impact-index")

    own = asked.select(F.pmod(F.xxhash64("id", "vec"), F.lit(blocks)).alias("block"), F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))).alias("lane"), F.col("id").alias("query_id"), "vec")
    stored = shelf.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.pmod(F.col("shard"), F.lit(lanes)).alias("lane"), "*")
    both = own.unionByName(stored, allowMissingColumns=True)
    # A partition per block and lane, or several in turn: by hash, some would meet and others stay empty.
    parts = min(blocks * lanes, max(blocks, 16 * shuffle_partitions(spark)))
    dealt = both.repartitionById(parts, F.pmod(F.col("block") * lanes + F.col("lane"), F.lit(parts)).cast("int"))
    dealt = dealt.sortWithinPartitions("block", "lane", F.col("shard").asc_nulls_first(), "query_id")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, asking, held = None, [], []

        def found() -> pa.RecordBatch:
            ids = np.concatenate([np.full(len(h[0]), q) for (q, _), h in zip(asking, held, strict=True)])
            vecs = np.concatenate([h[0] for h in held])
            scores = np.concatenate([h[1] for h in held])
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(vecs, pa.int64()), pa.array(scores, pa.int64())], names=["query_id", "vec_id", "score"])

        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(n)[i].as_py() for n, name in enumerate(batch.schema.names)}
                if (row["block"], row["lane"]) != at:
                    if asking:
                        yield found()
                    at, asking, held = (row["block"], row["lane"]), [], []
                if row["shard"] is None:
                    asking.append((row["query_id"], np.array(row["vec"], dtype=np.int64)))
                    held.append((np.zeros(0, np.int64), np.zeros(0, np.int64)))
                    continue
                if asking:
                    here = loaded(row)
                    for n, (query_id, query) in enumerate(asking):
                        held[n], _ = searched(here, query, query_id, held[n], k, shared)
        if asking:
            yield found()

    pairs = dealt.mapInArrow(search, "query_id bigint, vec_id bigint, score bigint")
    single = pairs.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = single.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
