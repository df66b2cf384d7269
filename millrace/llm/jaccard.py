"""Near duplicates by an n-gram Jaccard join with rare-first prefix filtering.

Two documents link if their sets of word shingles have a Jaccard similarity of at least
``PERCENT`` / 100. The join goes from cheap to exact:

1. Documents with equal sets become one node, the one with the smallest id.
2. Screening. Under the order of hashes, two linked sets share at least ``l`` shingles within their
   prefixes extended by ``l``. Hashes of those prefixes meet by range, packed as sorted numbers, each
   at most once per task and range, so a hot shingle stays cheap. Nodes that do not share enough with
   others cannot link and are done. Only for the others are the whole sets built.
3. Prefix filter. Shingles are ordered by document frequency, rare first. A set of n shingles can only
   link with sets that share one of its first n - ceil(0.75 n) + 1; those found once cannot be shared.
4. Pairs that share a prefix shingle pass a length, a positional and a suffix filter (the parts of both
   sets by hash must not differ by more than the allowed difference) and are verified once, by
   intersecting the sets.

Only components are asked for, so the pairs within a group of near copies are not all made. In the
first round each node is verified against one node, of all that come first in its lists the one it
shares most lists with. Components are built, and later rounds look only at lists that still hold several, comparing
their first 4, 16, 64, ... nodes with those of other components, until each list holds one component
or all its pairs have been compared. So no link between different components is lost.

Cases: words are runs of characters other than ASCII white space, with A-Z lower-cased; with fewer
than ``WORDS`` of them the whole sequence is the one shingle; a null text or one without words has an
empty set and links with nothing. Rows that share an id are one node's. A row without an id takes no
part and has a null component. Extra columns are ignored by ``classes`` and passed on by ``unique``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import codes, fresh, orderable, shuffle_partitions, slices, written
from millrace.llm.components import components

WORDS = 5
PERCENT = 75
EXTENSION = 15  # per cent of a set, by which prefixes are extended when screening
RANGES = 8  # per shuffle partition
PARTS = 32
SLICE = 6_000_000
PART = 1_000_000
ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed(value: np.ndarray) -> np.ndarray:
    value = (value ^ (value >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    value = (value ^ (value >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return value ^ (value >> np.uint64(31))


def shingle_sets(texts: list[bytes | None], size: int = WORDS) -> list[np.ndarray]:
    """The distinct shingles of each text as sorted 64-bit hashes; about ``PART`` bytes are held as words at a time."""
    ends = np.cumsum([len(t or b"") for t in texts])
    cuts = np.flatnonzero(np.diff(ends // PART, prepend=0)) if len(ends) else []
    out = []
    for a, b in zip([0, *cuts], [*cuts, len(texts)], strict=True):
        out += sets_of(texts[a:b], size)
    return out


def sets_of(texts: list[bytes | None], size: int) -> list[np.ndarray]:
    split = [(t or b"").lower().split() for t in texts]
    numbers, distinct = codes([w for words in split for w in words])
    hashes = pd.util.hash_array(distinct, categorize=False) if len(distinct) else np.zeros(0, np.uint64)
    flat = hashes[numbers] if len(numbers) else np.zeros(0, np.uint64)
    running = np.zeros(max(0, len(flat) - size + 1), dtype=np.uint64)
    for k in range(size):
        running = mixed(running * ODD + flat[k : k + len(running)])
    out, at = [], 0
    for words in split:
        n = len(words)
        if n >= size:
            out.append(np.unique(running[at : at + n - size + 1]))
        elif n:
            value = np.array([n], dtype=np.uint64)
            for h in flat[at : at + n]:
                value = mixed(value * ODD + h)
            out.append(value)
        else:
            out.append(np.zeros(0, np.uint64))
        at += n
    return out


def signature(own: np.ndarray) -> tuple[int, int]:
    """Two numbers that equal sets share."""
    first = mixed(own + ODD).sum(dtype=np.uint64).view(np.int64)
    second = np.bitwise_xor.reduce(mixed(own * ODD + np.uint64(1))).view(np.int64) if len(own) else 0
    return int(first), int(second)


def needed(n: int | np.ndarray) -> int | np.ndarray:
    """How many shingles a set of n shares at least with any set that it links with."""
    return -(-PERCENT * n // 100)


def extension(n: np.ndarray) -> np.ndarray:
    return np.maximum(1, EXTENSION * n // 100)


def narrowed(frame: DataFrame, key: str, text: str) -> DataFrame:
    return frame.select(F.col(f"`{key}`").cast("bigint").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))


def signed(rows: DataFrame) -> DataFrame:
    """(id, n, s1, s2) of rows (id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 1, SLICE):
            sets = shingle_sets(part.column(1).cast(pa.large_binary()).to_pylist())
            both = [signature(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([b[0] for b in both], pa.int64()), pa.array([b[1] for b in both], pa.int64())],
                names=["id", "n", "s1", "s2"],
            )

    return rows.mapInArrow(run, "id bigint, n bigint, s1 bigint, s2 bigint")


def packed(values: np.ndarray) -> bytes:
    """Numbers by byte planes, so that the shuffle's compression finds what sorted numbers share."""
    return values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def unpacked(data: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, dtype=np.uint8).reshape(size, -1).T).view(kind).reshape(-1)


def screened(rows: DataFrame) -> DataFrame:
    """(id, shared): how many of its extended prefix's shingles a set shares with different sets.

    In a task, equal sets count once, for the smallest id.
    """
    ranges = RANGES * shuffle_partitions(rows.sparkSession)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, part in enumerate(slices(batches, 1, SLICE)):
            ids = part.column(0).to_pylist()
            sets = shingle_sets(part.column(1).cast(pa.large_binary()).to_pylist())
            first: dict[tuple[int, int], int] = {}
            for i, own in enumerate(sets):
                if len(own) and ids[i] is not None:
                    mark = signature(own)
                    if mark not in first or ids[i] < ids[first[mark]]:
                        first[mark] = i
            chosen = sorted(first.values())
            if not chosen:
                continue
            sizes = np.array([len(sets[i]) for i in chosen], dtype=np.int64)
            lengths = np.minimum(sizes, sizes - needed(sizes) + extension(sizes))
            keys = np.concatenate([sets[i][:m] for i, m in zip(chosen, lengths.tolist(), strict=True)])
            owners = np.repeat(np.array([ids[i] for i in chosen], dtype=np.int64), lengths)
            distinct, at, which, times = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
            again = owners[times[which] > 1]
            if len(again):
                own, credit = np.unique(again, return_counts=True)
                yield message([int(own[0]) % ranges], [True], [b""], [packed(own)], [packed(credit)])
            place = (distinct % np.uint64(ranges)).astype(np.int64)
            order = np.argsort(place, kind="stable")
            bounds = np.searchsorted(place[order], np.arange(ranges + 1))
            out: list[list] = [[], [], [], [], []]
            for r in np.flatnonzero(np.diff(bounds)).tolist():
                own = order[bounds[r] : bounds[r + 1]]
                row = (r, False, packed(distinct[own]), packed(owners[at[own]]), packed((times[own] == 1).astype(np.uint8)))
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            yield message(*out)

    def meet(table: pa.Table) -> pa.Table:
        credited = table.column("credited").to_pylist()
        keys, owners, extra = (table.column(c).to_pylist() for c in ("keys", "owners", "extra"))
        known = [i for i, c in enumerate(credited) if c]
        ids = [unpacked(owners[i], "<i8") for i in known]
        counts = [unpacked(extra[i], "<i8") for i in known]
        lists = [i for i, c in enumerate(credited) if not c]
        if lists:
            _, which, times = np.unique(np.concatenate([unpacked(keys[i], "<u8") for i in lists]), return_inverse=True, return_counts=True)
            owner = np.concatenate([unpacked(owners[i], "<i8") for i in lists])
            alone = np.concatenate([np.frombuffer(extra[i], np.uint8) for i in lists]) == 1
            ids.append(owner[alone & (times[which] > 1)])
            counts.append(np.ones(len(ids[-1]), np.int64))
        own, where = np.unique(np.concatenate(ids), return_inverse=True)
        total = np.bincount(where, np.concatenate(counts), minlength=len(own)).astype(np.int64)
        return pa.table({"id": pa.array(own, pa.int64()), "shared": pa.array(total, pa.int64())})

    sent = rows.mapInArrow(send, "place bigint, credited boolean, keys binary, owners binary, extra binary")
    met = sent.groupBy("place").applyInArrow(meet, "id bigint, shared bigint")
    return met.groupBy("id").agg(F.sum("shared").alias("shared"))


def message(place: list, credited: list, keys: list, owners: list, extra: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(place, pa.int64()), pa.array(credited, pa.bool_()), pa.array(keys, pa.binary()), pa.array(owners, pa.binary()), pa.array(extra, pa.binary())],
        names=["place", "credited", "keys", "owners", "extra"],
    )


def whole_sets(rows: DataFrame) -> DataFrame:
    """(node, n, hashes, parts) of rows (id, text); parts counts the hashes by their last bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 1, SLICE):
            sets = shingle_sets(part.column(1).cast(pa.large_binary()).to_pylist())
            lengths = np.array([len(s) for s in sets])
            ends = np.append(0, np.cumsum(lengths)).astype(np.int32)
            flat = np.concatenate(sets).view(np.int64)
            counts = [np.bincount((s & np.uint64(PARTS - 1)).astype(np.int64), minlength=PARTS) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array(lengths, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                    pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32) * PARTS), pa.array(np.concatenate(counts).astype(np.int32))),
                ],
                names=["node", "n", "hashes", "parts"],
            )

    return rows.mapInArrow(run, "node bigint, n bigint, hashes array<bigint>, parts array<int>")


def ceil_share(n: Column) -> Column:
    return F.floor((PERCENT * n + 99) / 100)


def prefixes(sets: DataFrame) -> DataFrame:
    """(h, node, n, pos, ones, place, members): shared shingles of the rare-first prefixes.

    ``ones`` is the number of the set's shingles that are in no other, ``place`` that within the list
    of the shingle, and ``members`` the length of the list.
    """
    each = sets.select("node", "n", F.explode("hashes").alias("h"))
    often = each.groupBy("h").agg(F.count(F.lit(1)).alias("f")).where("f > 1")
    shared = each.join(often, "h")
    of_set = Window.partitionBy("node", "n")
    ranked = shared.withColumn("ones", F.col("n") - F.count(F.lit(1)).over(of_set))
    ranked = ranked.withColumn("pos", F.row_number().over(of_set.orderBy("f", "h")) + F.col("ones"))
    kept = ranked.where(F.col("pos") <= F.col("n") - ceil_share(F.col("n")) + 1).select("h", "node", "n", "pos", "ones")
    place = F.row_number().over(Window.partitionBy("h").orderBy("node", "n"))
    return kept.withColumn("place", place).withColumn("members", F.count(F.lit(1)).over(Window.partitionBy("h")))


def may_link(a: str, b: str) -> Column:
    """The length and positional filters for two postings of one shingle, and the prefix filter for
    the overlap that two sets of these sizes need, which is more than either needs with a smaller one.

    Both sets hold the shingle, what comes after it, and of what comes before it only the shingles
    that are in some other set.
    """
    na, nb, pa_, pb, ua, ub = (F.col(f"{s}{c}") for c in ("n", "pos", "ones") for s in (a, b))
    length = 100 * F.least(na, nb) >= PERCENT * F.greatest(na, nb)
    bound = 1 + F.least(pa_ - 1 - ua, pb - 1 - ub) + F.least(na - pa_, nb - pb)
    overlap = F.floor((PERCENT * (na + nb) + 99 + PERCENT) / (100 + PERCENT))
    prefix = (pa_ + overlap <= na + 1) & (pb + overlap <= nb + 1)
    return length & prefix & (bound >= overlap)


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, linked) of pairs (a, b), each verified once; pairs that fail the suffix filter are left out."""
    small = sets.select("node", "n", "parts")
    sides = []
    for s in ("a", "b"):
        sides.append(small.select(F.col("node").alias(s), F.col("n").alias(f"n{s}"), F.col("parts").alias(f"parts_{s}")))
    near = pairs.join(sides[0], "a").join(sides[1], "b")
    differing = F.aggregate(F.zip_with("parts_a", "parts_b", lambda x, y: F.abs(x - y)), F.lit(0), lambda t, v: t + v)
    both = F.col("na") + F.col("nb")
    near = near.where((100 + PERCENT) * (both - differing) >= 2 * PERCENT * both).select("a", "b").distinct()
    near = written(near, "jaccard-pairs")
    left = sets.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("hashes").alias("hb"))
    right = sets.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("hashes").alias("ha"))
    met = near.join(left, "b").join(right, "a")
    common = F.size(F.array_intersect("ha", "hb"))
    linked = 100 * common >= PERCENT * (F.col("na") + F.col("nb") - common)
    return met.select("a", "b", linked.alias("linked")).groupBy("a", "b").agg(F.max("linked").alias("linked"))


def first_pairs(postings: DataFrame) -> DataFrame:
    """For each node the one node, of those first in its lists, with which it shares most lists."""
    heads = postings.where("place = 1").select("h", F.col("node").alias("a"), F.col("n").alias("an"), F.col("pos").alias("apos"), F.col("ones").alias("aones"))
    met = heads.join(postings.where("place > 1").select("h", F.col("node").alias("b"), F.col("n").alias("bn"), F.col("pos").alias("bpos"), F.col("ones").alias("bones")), "h")
    counted = met.where(may_link("a", "b") & (F.col("a") != F.col("b"))).groupBy("a", "b").agg(F.count(F.lit(1)).alias("lists"))
    best = counted.groupBy("b").agg(F.max(F.struct("lists", (-F.col("a")).alias("less"))).alias("best"))
    return best.select((-F.col("best.less")).alias("a"), "b")


def later_pairs(mixed_lists: DataFrame, done: int, first: int) -> DataFrame:
    """Pairs of different components of a list, one of them among the list's first nodes.

    The first ``done`` nodes were compared with all that follow them, or were of one component.
    """
    heads = mixed_lists.where((F.col("place") > done) & (F.col("place") <= first))
    heads = heads.select("h", F.col("node").alias("a"), F.col("n").alias("an"), F.col("pos").alias("apos"), F.col("ones").alias("aones"), F.col("place").alias("aplace"), F.col("component").alias("ca"))
    rest = mixed_lists.select("h", F.col("node").alias("b"), F.col("n").alias("bn"), F.col("pos").alias("bpos"), F.col("ones").alias("bones"), F.col("place").alias("bplace"), F.col("component").alias("cb"))
    met = heads.join(rest, "h").where((F.col("aplace") < F.col("bplace")) & (F.col("ca") != F.col("cb")) & may_link("a", "b"))
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def linked_nodes(postings: DataFrame, sets: DataFrame, given: DataFrame) -> DataFrame:
    """(node, component) of all nodes with links, some links (a, b) being given."""
    checked = written(verified(first_pairs(postings), sets), "jaccard-checked")
    links = checked.where("linked").select("a", "b").unionByName(given)
    found = components(links)
    done, first = 0, 4
    while True:
        own = found.select("node", F.col("component").alias("known"))
        labelled = postings.join(own, "node", "left").withColumn("component", F.coalesce("known", "node")).drop("known")
        spread = labelled.groupBy("h").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
        lists = written(labelled.join(spread.select("h"), "h", "left_semi"), "jaccard-lists")
        if lists.isEmpty():
            return found
        before = checked.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        again = later_pairs(lists, done, first).join(before, ["a", "b"], "left_anti")
        new = written(verified(again, sets), "jaccard-checked")
        more = new.where("linked").select("a", "b")
        if not more.isEmpty():
            links = links.unionByName(more)
            found = components(links)
        checked = checked.unionByName(new)
        if lists.where(F.col("members") > first).isEmpty():
            return found
        done, first = first, 4 * first


def classes(frame: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of the frame."""
    rows = narrowed(frame, key, text)
    keys = written(signed(rows), "jaccard-keys")
    full = keys.where("n > 0 and id is not null")
    nodes = written(full.groupBy("s1", "s2", "n").agg(F.min("id").alias("node")), "jaccard-nodes")
    least = F.greatest(F.lit(1), F.floor(EXTENSION * ceil_share(F.col("n")) / 100))
    shared = screened(rows).withColumnRenamed("id", "node")
    busy = nodes.join(shared, "node").where(F.col("shared") >= least).select(F.col("node").alias("id")).distinct()
    texts = rows.join(written(busy, "jaccard-busy"), "id", "left_semi").dropDuplicates(["id", "text"])
    sets = written(whole_sets(texts), "jaccard-sets")
    postings = written(prefixes(sets), "jaccard-postings")
    placed = written(keys.join(nodes, ["s1", "s2", "n"], "left").select("id", "n", "node"), "jaccard-placed")
    # The sets of one id are one document's, so their nodes belong together.
    several = placed.groupBy("id").agg(F.min("node").alias("a"), F.max("node").alias("last")).where("a < last")
    given = placed.join(several, "id").where("node > a").select("a", F.col("node").alias("b")).distinct()
    found = linked_nodes(postings, sets, written(given, "jaccard-given"))
    return placed.join(found, "node", "left").select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("component", "node", "id")).alias("component_id"),
    )


def unique(frame: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component, that of the smallest id, and all rows without an id."""
    kept = classes(frame, key, text).where("doc_id = component_id").select(F.col("doc_id").alias(id_ := fresh("id", frame.columns)))
    kept = written(kept.distinct(), "jaccard-kept")
    chosen = frame.join(kept, F.col(f"`{key}`").cast("bigint") == F.col(id_), "left_semi")
    place = fresh("place", frame.columns)
    order = Window.partitionBy(F.col(f"`{key}`")).orderBy(*orderable(frame, (key,)))
    single = chosen.withColumn(place, F.row_number().over(order)).where(F.col(place) == 1).drop(place)
    return single.unionByName(frame.where(F.col(f"`{key}`").isNull()))
