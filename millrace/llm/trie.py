"""Prefix trie of conversations by ROLLUP over positional columns of turn ids.

A conversation is cut into blocks of ``WIDTH`` turns. A block is one row: its number, the node where it
starts and the ids of its turns in columns t1, t2, ... One ``GROUP BY block, node, ROLLUP (t1, ...)``
gives all prefixes of all blocks at once, and ``grouping_id`` says how many columns a group has. So a
long conversation goes on in the next block, keyed by the node where the last one ended, and all blocks are
aggregated together.

A node is known by its depth and two 64-bit sums (exclusive or) of hashes of (place, turn) on its path,
which each row can form by itself; the trie is never walked from block to block. A node's number is its smallest
member. Every node has one owner, that member, and the nodes that a conversation owns are the end of its
path. What a subtree holds is therefore the sum over its members of what they own in it:

1. A first ROLLUP gives each node's members, smallest and longest member.
2. Owned nodes are summed from the end of each owner's path (one window over distinct nodes).
3. A second ROLLUP sums these over the members of each node: leaves, saved bytes, children.

Counts are summed in the tasks that read before anything is shuffled, so common first turns and common
conversations do not meet in one task.

Cases: a null role or text is empty; turns are ordered by turn (null first), then by the hash of role
and text; rows without a conversation id are left out; repeated rows are repeated turns; a very long text is
hashed and measured where it is read, and goes no further; conversations without turns are members of the
root; an empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import written

#: Turns of a block.
WIDTH = 4
SEEDS = (11, 12)


def hashed_turns(frame: DataFrame, conversation: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, turn, id, bytes): each turn's id for its role and text, and the UTF-8 bytes of its text."""
    role_text = [F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in (role, text)]
    both = F.concat(F.length(role_text[0]).cast("string"), F.lit(":"), *role_text)
    return frame.where(F.col(f"`{conversation}`").isNotNull()).select(
        F.col(f"`{conversation}`").cast("bigint").alias("conv"),
        F.col(f"`{turn}`").alias("turn"),
        F.unhex(F.left(F.sha2(both, 256), F.lit(32))).alias("id"),
        F.octet_length(role_text[1]).cast("bigint").alias("bytes"),
    )


def placed(turns: DataFrame) -> DataFrame:
    """Turns with their place in the conversation, from 1."""
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "id")
    return turns.withColumn("place", F.row_number().over(order).cast("bigint"))


def step(place: Column, turn: Column, seed: int) -> Column:
    """What a turn adds to the sums of the nodes behind it."""
    return F.xxhash64(F.lit(seed), place, turn)


def blocks_of(turns: DataFrame, width: int = WIDTH) -> DataFrame:
    """(conv, block, p1, p2, t1, ..., goes_on): one row per block of turns (conv, place, id, bytes).

    ``p1`` and ``p2`` are the sums of the node before the block; each turn is (id, bytes), or null past the
    end; ``goes_on`` says that another block follows.
    """
    order = Window.partitionBy("conv").orderBy("place")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    at = F.expr(f"(place - 1) % {width} + 1")
    first = {f"p{n}": F.coalesce(F.bit_xor(step(F.col("place"), F.col("id"), seed)).over(before), F.lit(0)) for n, seed in enumerate(SEEDS, 1)}
    path = turns.select(
        "conv", "id", "bytes", *[c.alias(p) for p, c in first.items()],
        F.expr(f"(place - 1) div {width}").alias("block"), at.alias("at"), F.lead("place").over(order).isNotNull().alias("more"),
    )
    columns = [F.max(F.when(F.col("at") == i, F.struct("id", "bytes"))).alias(f"t{i}") for i in range(1, width + 1)]
    starts = [F.max(F.when(F.col("at") == 1, F.col(p))).alias(p) for p in first]
    return path.groupBy("conv", "block").agg(*starts, *columns, F.max((F.col("at") == width) & F.col("more")).alias("goes_on"))


def key(seed: int, n: int, width: int, level: Column) -> Column:
    """A sum of the node at this level of a block."""
    zero = F.lit(0).cast("bigint")
    steps = [F.when(level >= i, step(F.col("block") * width + i, F.col(f"t{i}.id"), seed)).otherwise(zero) for i in range(1, width + 1)]
    return reduce(lambda a, b: a.bitwiseXOR(b), steps, F.col(f"p{n}"))


def rolled(blocks: DataFrame, width: int, sums: str) -> DataFrame:
    """One row per node but the root: (depth, level, k1, k2, last) and the sums over the blocks that reach it."""
    columns = [f"t{i}" for i in range(1, width + 1)]
    grouped = blocks.sparkSession.sql(
        f"SELECT block, p1, p2, {', '.join(columns)}, grouping_id() AS gid, {sums} "
        f"FROM {{blocks}} GROUP BY block, p1, p2, ROLLUP ({', '.join(columns)})",
        blocks=blocks,
    )
    # A group of i columns leaves out the last ones, whose bits in the grouping id are the lowest.
    level = reduce(lambda c, i: c.when(F.col("gid") == (1 << (width - i)) - 1, i), range(1, width + 1), F.when(F.lit(False), 0))
    named = grouped.withColumn("level", level).where("level IS NOT NULL")
    named = named.withColumn("last", F.element_at(F.array(*columns), F.col("level"))).where("last IS NOT NULL")
    keys = [key(seed, n, width, F.col("level")).alias(f"k{n}") for n, seed in enumerate(SEEDS, 1)]
    return named.select("*", (F.col("block") * width + F.col("level")).alias("depth"), *keys)


def at_level(name: str, width: int) -> Column:
    return F.element_at(F.array(*[f"{name}{i}" for i in range(1, width + 1)]), F.col("level"))


def first_roll(blocks: DataFrame, width: int) -> DataFrame:
    """(conv, depth, k1, k2, u1, u2, n_convs, saved, leaf) per node; conv is its owner, u1 and u2 its parent's sums."""
    follows = [f"t{i + 1} IS NOT NULL" for i in range(1, width)] + ["goes_on"]
    sums = ", ".join(f"max({c}) AS m{i}" for i, c in enumerate(follows, 1))
    nodes = rolled(blocks, width, f"count(*) AS n_convs, min(conv) AS conv, {sums}")
    above = [F.col(f"k{n}").bitwiseXOR(step(F.col("depth"), F.col("last.id"), seed)).alias(f"u{n}") for n, seed in enumerate(SEEDS, 1)]
    return nodes.select(
        "conv", "depth", "k1", "k2", *above, "n_convs",
        ((F.col("n_convs") - 1) * F.col("last.bytes")).alias("saved"),
        (~at_level("m", width)).alias("leaf"),
    )


def owners(nodes: DataFrame, width: int) -> tuple[DataFrame, DataFrame]:
    """(conv, first, length, total, leaf, parent) of each owner, and what it owns from each place on, by blocks.

    A conversation's nodes are ordered by depth and those it owns are the last of them.
    """
    down = Window.partitionBy("conv").orderBy(F.desc("depth"))
    own = nodes.withColumn("rest", F.sum("saved").over(down.rowsBetween(Window.unboundedPreceding, 0)))
    per = own.groupBy("conv").agg(
        F.min("depth").alias("first"),
        F.max("depth").alias("length"),
        F.max("rest").alias("total"),
        F.max("leaf").cast("bigint").alias("leaf"),
        F.min_by(F.struct("u1", "u2"), "depth").alias("u"),
    )
    per = per.select("*", F.col("u.u1").alias("k1"), F.col("u.u2").alias("k2"), (F.col("first") - 1).alias("depth")).drop("u")
    above = nodes.select(F.col("conv").alias("parent"), "depth", "k1", "k2")
    per = per.join(above, ["depth", "k1", "k2"], "left").drop("depth", "k1", "k2")
    place = own.select("conv", "rest", F.expr(f"(depth - 1) div {width}").alias("block"), F.expr(f"(depth - 1) % {width} + 1").alias("at"))
    rests = place.groupBy("conv", "block").agg(*[F.max(F.when(F.col("at") == i, F.col("rest"))).alias(f"s{i}") for i in range(1, width + 1)])
    return per, rests


def second_roll(blocks: DataFrame, per: DataFrame, rests: DataFrame, width: int) -> DataFrame:
    """(conv_id, depth, parent, n_convs, n_children, n_leaves, saved_tokens, k1, k2) per node but the root."""
    zero = F.lit(0).cast("bigint")
    rows = blocks.join(per, "conv", "left").join(rests, ["conv", "block"], "left")
    ready = rows.select(
        "conv", "block", "p1", "p2", *[f"t{i}" for i in range(1, width + 1)], "first", "parent",
        F.coalesce("leaf", zero).alias("leaf"),
        *[F.coalesce(f"s{i}", "total", zero).alias(f"s{i}") for i in range(1, width + 1)],
        *[
            F.coalesce((F.col("block") * width + i + 1).between(F.col("first"), F.col("length")).cast("bigint"), zero).alias(f"o{i}")
            for i in range(1, width + 1)
        ],
    )
    levels = ", ".join(f"sum({c}{i}) AS {c}{i}" for c in "so" for i in range(1, width + 1))
    nodes = rolled(ready, width, f"count(*) AS n_convs, min(struct(conv, first, parent)) AS owner, sum(leaf) AS n_leaves, {levels}")
    return nodes.select(
        F.col("owner.conv").alias("conv_id"),
        "depth",
        F.when(F.col("depth") > F.col("owner.first"), F.col("owner.conv")).otherwise(F.col("owner.parent")).alias("parent"),
        "n_convs",
        at_level("o", width).alias("n_children"),
        "n_leaves",
        at_level("s", width).alias("saved_tokens"),
        "k1",
        "k2",
    )


def trie(turns: DataFrame, conversations: DataFrame, width: int = WIDTH) -> tuple[DataFrame, DataFrame]:
    """The nodes of the trie of turns (conv, place, id, bytes), and where each of the conversations (conv) ends.

    Nodes: (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, k1, k2); ends: (conv,
    depth, k1, k2). Places count from 1 without gaps.
    """
    blocks = written(blocks_of(turns, width), "trie-blocks")
    first = written(first_roll(blocks, width), "trie-nodes")
    nodes = second_roll(blocks, *owners(first, width), width)

    size = reduce(lambda a, b: a + b, [F.col(f"t{i}").isNotNull().cast("bigint") for i in range(1, width + 1)])
    last = blocks.where("NOT goes_on").withColumn("level", size)
    ends = last.select("conv", (F.col("block") * width + F.col("level")).alias("depth"), *[key(s, n, width, F.col("level")).alias(f"k{n}") for n, s in enumerate(SEEDS, 1)])
    zero = F.lit(0).cast("bigint")
    known = conversations.select("conv").distinct()
    ends = known.join(ends, "conv", "left").select("conv", *[F.coalesce(c, zero).alias(c) for c in ("depth", "k1", "k2")])

    everyone = known.agg(F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
    whole = first.agg(F.sum((F.col("depth") == 1).cast("bigint")).alias("n_children"), F.sum(F.col("leaf").cast("bigint")).alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    top = everyone.withColumn("one", F.lit(1)).join(whole.withColumn("one", F.lit(1)), "one").drop("one")
    root = top.select(
        "conv_id",
        zero.alias("depth"),
        F.lit(None).cast("bigint").alias("parent_conv_id"),
        "n_convs",
        F.coalesce("n_children", zero).alias("n_children"),
        F.coalesce("n_leaves", F.lit(1).cast("bigint")).alias("n_leaves"),
        F.coalesce("saved_tokens", zero).alias("saved_tokens"),
        zero.alias("k1"),
        zero.alias("k2"),
    )
    # The root is the parent of all first turns; its number is one value.
    least = known.agg(F.min("conv").alias("least")).collect()[0]["least"]
    parent = F.coalesce("parent", F.lit(least).cast("bigint")).alias("parent_conv_id")
    below = nodes.select("conv_id", "depth", parent, "n_convs", "n_children", "n_leaves", "saved_tokens", "k1", "k2")
    return root.unionByName(below), ends
