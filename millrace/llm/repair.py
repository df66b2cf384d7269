"""Conversation structure repair by dynamic programming over a grammar shared by all conversations.

A conversation should alternate user and assistant, open with a user or one system turn and end with
an assistant, or be empty. Turns are kept (0), given the role user or assistant (3) or deleted (4);
empty turns of either role may be put in anywhere (3). Blank and repeated turns have to go; a
truncated turn that stays costs 3. Of the cheapest repairs the one whose edit initials (D, I, K, R) come
first in ASCII order is taken.

1. Each turn becomes one of nine symbols: its role's kind with or without truncation, or "must go".
2. Re-Pair over the distinct symbol blocks of all conversations: each round makes a rule of each of the
   ``WIDTH`` most frequent pairs. A pair without a rule is simply not shortened, so the bound on rules
   (``WIDTH * ROUNDS``) bounds what is broadcast and drops nothing.
3. Every rule gets one min-plus transfer matrix over the four states of the role pattern, made from those
   of its two parts. A cell holds the cost, the state between the parts (the node of its audit
   rope) and the place of its audit among those of its row.
4. A conversation is solved over its shortened symbols, and ropes are unrolled into edits.

Why places are enough: insertions stand before the turn that follows them, so every audit of a symbol
ends with the letter of its last turn, and no audit of the same turns is a proper prefix of another.
Equal letters lead to equal states, so the audits of a row differ, and comparing the first part decides.

Turns are ordered by turn (null first), then role, then a hash of role and text. The place of a
turn and its symbol are found without texts; texts are shuffled once, when the edits are applied. The
edits of a conversation come from one task as a stream, because they and any digest of them are one
sequence; what is held of it are its letters.

Cases: a null role or text is one space; a null conversation is one of its own; repeated rows are
repeated turns; a very long text is passed on in Arrow and only measured at its end; a role of another
name has to be changed or deleted; an empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import shuffle_partitions, slices, written

SPACE = "\t\n\x0b\x0c\r "
KINDS = "sua"  # role initials with a place in the pattern; all others are of one more kind
MUST_GO = 8
TERMINALS = 9
CHANGE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3

#: Turns of a block of symbols; longer conversations are several blocks.
BLOCK = 4096
#: Pairs that become rules in a round, and rounds.
WIDTH, ROUNDS = 64, 12

FAR = 1 << 40
#: States: nothing yet, after the system turn, after a user, after an assistant.
STATES = 4
AFTER_USER = (2, 2, None, 2)
AFTER_ASSISTANT = (None, None, 3, None)
#: Insertions that end the conversation from each state.
ENDING = (0, 2, 1, 0)


def kept_state(kind: int, state: int) -> int | None:
    if kind == 0:
        return 1 if state == 0 else None
    return (AFTER_USER, AFTER_ASSISTANT, (None,) * STATES)[kind - 1][state]


def next_role(state: int) -> tuple[str, int]:
    """The role that an inserted or changed turn gets in this state, and the state after it."""
    return ("assistant", 3) if state == 2 else ("user", 2)


def letters_of(symbol: int, state: int) -> dict[int, tuple[int, str]]:
    """For each state after a turn of this symbol, the cheapest edits and their cost."""
    best: dict[int, tuple[int, str]] = {}

    def offer(after: int | None, cost: int, audit: str) -> None:
        if after is not None and (after not in best or (cost, audit) < best[after]):
            best[after] = (cost, audit)

    for times in range(3):
        spent, before = INSERT * times, "I" * times
        offer(state, spent + DELETE, before + "D")
        if symbol != MUST_GO:
            kind, more = symbol % 4, TRUNCATED * (symbol >= 4)
            offer(kept_state(kind, state), spent + more, before + "K")
            offer(next_role(state)[1], spent + more + CHANGE, before + "R")
        state = next_role(state)[1]
    return best


@dataclass
class Grammar:
    """Rules in the order made; symbol ``TERMINALS + i`` stands for the pair of rule i."""

    rounds: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.texts = [[letters_of(x, i) for i in range(STATES)] for x in range(TERMINALS)]
        self.cost, self.via, self.order = [], [], []
        for rows in self.texts:
            cost, order = np.full((STATES, STATES), FAR), np.full((STATES, STATES), STATES)
            for i, cells in enumerate(rows):
                for j, (spent, _) in cells.items():
                    cost[i, j] = spent
                for n, j in enumerate(sorted(cells, key=lambda j: cells[j][1])):
                    order[i, j] = n
            self.cost.append(cost)
            self.via.append(np.zeros((STATES, STATES), np.int8))
            self.order.append(order)

    def add(self, pairs: list[tuple[int, int]]) -> None:
        """One round: a rule and its matrix for each pair of symbols that exist already."""
        self.rounds.append(np.array(pairs, dtype=np.int64).reshape(-1, 2))
        for a, b in pairs:
            total = self.cost[a][:, :, None] + self.cost[b][None, :, :]
            key = np.minimum(total, FAR) * 8 + self.order[a][:, :, None]
            via = key.argmin(axis=1)
            cost = np.minimum(np.take_along_axis(total, via[:, None, :], 1)[:, 0, :], FAR)
            first = np.take_along_axis(self.order[a], via, 1)
            then = self.order[b][via, np.arange(STATES)[None, :]]
            rank = np.where(cost < FAR, first * 8 + then, 99)
            self.pairs.append((a, b))
            self.cost.append(cost)
            self.via.append(via.astype(np.int8))
            self.order.append(rank.argsort(axis=1, kind="stable").argsort(axis=1, kind="stable"))

    def shorten(self, symbols: np.ndarray) -> np.ndarray:
        """Symbols with every rule applied, round by round; negative ones are walls between sequences."""
        first = TERMINALS
        for pairs in self.rounds:
            if not len(pairs):
                continue
            scale = int(max(symbols.max(initial=0), pairs.max())) + 2
            codes = pairs[:, 0] * scale + pairs[:, 1]
            order = np.argsort(codes)
            own = np.where((symbols[:-1] < 0) | (symbols[1:] < 0), -1, symbols[:-1] * scale + symbols[1:])
            at = np.searchsorted(codes[order], own).clip(max=len(codes) - 1)
            hit = codes[order][at] == own
            # Of pairs that overlap in a chain, every other one is replaced, from the left.
            start = np.where(hit & ~np.concatenate([[False], hit[:-1]]), np.arange(len(hit)), 0)
            hit &= (np.arange(len(hit)) - np.maximum.accumulate(start)) % 2 == 0 if len(hit) else True
            made = symbols.copy()
            made[:-1][hit] = first + order[at[hit]]
            symbols = made[np.concatenate([[True], ~hit])] if len(hit) else made
            first += len(pairs)
        return symbols

    def route(self, symbols: list[int]) -> tuple[int, list[tuple[int, int]], int]:
        """The cost, (state before, state after) of each symbol, and the insertions at the end."""
        ahead = [np.array(ENDING) * INSERT]
        for x in reversed(symbols):
            ahead.append((self.cost[x] + ahead[-1]).min(axis=1))
        ahead.reverse()
        state, steps = 0, []
        for x, rest in zip(symbols, ahead[1:], strict=True):
            after = int(((self.cost[x][state] + rest) * 8 + self.order[x][state]).argmin())
            steps.append((state, after))
            state = after
        return int(ahead[0][0]), steps, ENDING[state]

    def unrolled(self, symbol: int, before: int, after: int) -> str:
        """The audit of one cell, from its rope."""
        parts, stack = [], [(symbol, before, after)]
        while stack:
            x, i, j = stack.pop()
            if x < TERMINALS:
                parts.append(self.texts[x][i][j][1])
            else:
                a, b = self.pairs[x - TERMINALS]
                k = int(self.via[x][i, j])
                stack += [(b, k, j), (a, i, k)]
        return "".join(parts)


def joined(blocks: list[bytes]) -> np.ndarray:
    """The symbols of all blocks, each followed by a wall."""
    wall = bytes([255])
    flat = np.frombuffer(b"".join(block + wall for block in blocks), dtype=np.uint8).astype(np.int64)
    flat[flat == 255] = -1
    return flat


def split(symbols: np.ndarray) -> list[list[int]]:
    """The sequences between the walls."""
    ends = np.flatnonzero(symbols < 0)
    flat = symbols.tolist()
    return [flat[a:b] for a, b in zip([0, *(ends[:-1] + 1).tolist()], ends.tolist(), strict=False)]


def learnt(blocks: DataFrame, width: int = WIDTH, rounds: int = ROUNDS) -> Grammar:
    """Re-Pair over the distinct values of ``symbols``: what the driver sees of a round are its pairs."""
    spark = blocks.sparkSession
    distinct = written(blocks.select("symbols").distinct(), "repair-distinct")
    grammar = Grammar()
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(grammar.rounds)

        def counted(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            own = Grammar()
            own.rounds = shared.value
            for batch in batches:
                x = own.shorten(joined(batch.column(0).to_pylist()))
                near = np.stack([x[:-1], x[1:]])[:, (x[:-1] >= 0) & (x[1:] >= 0)]
                found, n = np.unique(near, axis=1, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found[0]), pa.array(found[1]), pa.array(n)], names=["a", "b", "n"])

        pairs = distinct.mapInArrow(counted, "a bigint, b bigint, n bigint").groupBy("a", "b").agg(F.sum("n").alias("n"))
        best = pairs.where("n > 1").orderBy(F.desc("n"), "a", "b").limit(width).collect()
        shared.unpersist()
        if not best:
            break
        grammar.add([(row["a"], row["b"]) for row in best])
    return grammar


def symbol(role: Column, last: Column) -> Column:
    """A turn's symbol as far as the turn alone decides it."""
    kind = F.lit(3)
    for n, initial in enumerate(KINDS):
        kind = F.when(F.startswith(role, F.lit(initial)), n).otherwise(kind)
    return F.when(last == "", F.lit(MUST_GO)).otherwise(kind + F.when(last.isin(".", "!", "?"), 0).otherwise(4)).cast("int")


def marked(frame: DataFrame, conversation: str, turn: str, role: str, text: str) -> DataFrame:
    """Rows as (conv, turn, role, text, key); a null role or text is one space."""
    rows = frame.select(
        F.col(f"`{conversation}`").alias("conv"),
        F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(f"`{text}`"), F.lit(" ")).alias("text"),
    )
    both = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    return rows.withColumn("key", F.unhex(F.left(F.sha2(both, 256), F.lit(32))))


def turns(rows: DataFrame) -> DataFrame:
    """(conv, place, turn, key, code, illegal, fresh): each turn's place and symbol, without its text."""
    last = F.right(F.rtrim("text", F.lit(SPACE)), F.lit(1))
    initial = F.left("role", F.lit(1))
    light = rows.select("conv", "turn", "role", "key", initial.alias("initial"), symbol(F.col("role"), last).alias("code"))
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "role", "key")
    pair = F.concat(F.lag("initial").over(order), F.col("initial"))
    before = F.lag("turn").over(order)
    return light.select(
        "conv", "turn", "key", "code",
        F.row_number().over(order).cast("bigint").alias("place"),
        (F.row_number().over(order) > 1).alias("later"),
        F.coalesce(pair.isin("su", "ua", "au"), F.lit(False)).alias("legal"),
        (F.col("turn").isNotNull() & (before.isNull() | (before != F.col("turn")))).alias("fresh"),
    ).withColumn("illegal", F.col("later") & ~F.col("legal")).drop("later", "legal")


def symbols_of(entries: pa.ListArray) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """Each block's symbols with its blank, repeated and truncated turns counted.

    An entry is (place, code); the code -1 stands before that of the first turn with its role and text.
    """
    flat = entries.flatten()
    code = np.asarray(flat.field("code"), dtype=np.int64)
    first = np.concatenate([[False], code[:-1] == -1]) if len(code) else np.zeros(0, bool)
    row = code >= 0
    blank, repeated = row & (code == MUST_GO), row & (code != MUST_GO) & ~first
    truncated = row & first & (code >= 4) & (code != MUST_GO)
    made = np.where(repeated, MUST_GO, code)
    owner = np.repeat(np.arange(len(entries)), np.diff(np.asarray(entries.offsets)))
    sums = [np.bincount(owner[x], minlength=len(entries)) for x in (blank, repeated, truncated)]
    sizes = np.bincount(owner[row], minlength=len(entries))
    ends = np.concatenate([[0], np.cumsum(sizes)])
    flat_symbols = made[row].astype(np.uint8).tobytes()
    return [flat_symbols[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)], *sums


COUNTS = ["blank", "duplicate", "truncated", "illegal", "fresh"]


def blocks_of(light: DataFrame, size: int = BLOCK) -> DataFrame:
    """(conv, block, symbols, counts, least, most): the symbols of at most ``size`` turns in a row."""
    firsts = light.groupBy("conv", "key").agg(F.min("place").alias("place"))
    rows = light.select("conv", "place", "code", "turn", F.col("illegal").cast("bigint"), F.col("fresh").cast("bigint"))
    marks = firsts.select("conv", "place", F.lit(-1).alias("code"))
    entries = rows.unionByName(marks, allowMissingColumns=True).groupBy("conv", F.expr(f"(place - 1) div {size}").alias("block"))
    entries = entries.agg(
        F.sort_array(F.collect_list(F.struct("place", "code"))).alias("entries"),
        F.sum("illegal").alias("illegal"),
        F.sum("fresh").alias("fresh"),
        F.min("turn").alias("least"),
        F.max("turn").alias("most"),
    )
    names = ["conv", "block", "illegal", "fresh", "least", "most"]

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            symbols, blank, repeated, truncated = symbols_of(batch.column(0))
            columns = [pa.array(symbols, pa.binary()), pa.array(blank), pa.array(repeated), pa.array(truncated), *batch.columns[1:]]
            yield pa.RecordBatch.from_arrays(columns, names=["symbols", "blank", "duplicate", "truncated", *names])

    out = entries.select("entries", *names)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema.fields[1:])
    return out.mapInArrow(made, f"symbols binary, blank bigint, duplicate bigint, truncated bigint, {kinds}")


def routes(blocks: DataFrame, grammar: Grammar) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audits): one row per conversation."""
    shared = blocks.sparkSession.sparkContext.broadcast(grammar)
    kind = blocks.schema["conv"].dataType.simpleString()
    whole = blocks.groupBy("conv").agg(
        *[F.sum(c).alias(c) for c in COUNTS],
        F.min("least").alias("least"),
        F.max("most").alias("most"),
        F.sort_array(F.collect_list(F.struct("block", "symbols"))).alias("parts"),
    )
    whole = whole.withColumn("gaps", F.coalesce(F.expr("most - least + 1 - fresh"), F.lit(0)).cast("bigint"))
    names = ["conv", "gaps", *COUNTS[:4]]

    def solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = shared.value
        for batch in batches:
            parts = batch.column(0)
            short = split(grammar.shorten(joined(parts.flatten().field("symbols").to_pylist())))
            ends = np.asarray(parts.offsets) - parts.offsets[0].as_py()
            found = [repair(short[a:b], grammar) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            costs, audits = [cost for cost, _ in found], [texts for _, texts in found]
            columns = [pa.array(costs, pa.int64()), pa.array(audits, pa.list_(pa.string())), *batch.columns[1:]]
            yield pa.RecordBatch.from_arrays(columns, names=["cost", "audits", *names])

    out = whole.select("parts", *names)
    return out.mapInArrow(solved, f"cost bigint, audits array<string>, conv {kind}, " + ", ".join(f"{c} bigint" for c in names[1:]))


def repair(short: list[list[int]], grammar: Grammar) -> tuple[int, list[str]]:
    """The cost of a conversation's repair and its audit, by blocks of shortened symbols."""
    cost, steps, ending = grammar.route([x for own in short for x in own])
    audits, at = [], 0
    for own in short:
        audits.append("".join(grammar.unrolled(x, *steps[at + n]) for n, x in enumerate(own)))
        at += len(own)
    audits[-1] += "I" * ending
    return cost, audits


def edits(rows: DataFrame, routes: DataFrame) -> DataFrame:
    """(conv, edit, role, text): all turns of each conversation in order, with deleted and inserted ones.

    The turns of a conversation come one after another from one task, so a stream over the partitions can
    digest them without another shuffle.
    """
    audits = routes.select("conv", F.posexplode("audits").alias("block", "audit"))
    both = rows.select("conv", "turn", "role", "key", "text").unionByName(audits, allowMissingColumns=True)
    both = both.withColumn("block", F.coalesce("block", F.lit(2**31 - 1)))
    dealt = both.repartition(shuffle_partitions(rows.sparkSession), "conv")
    dealt = dealt.sortWithinPartitions("conv", "block", F.col("turn").asc_nulls_first(), "role", "key")
    kind = rows.schema["conv"].dataType.simpleString()

    def applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = object()
        conv, audit, at, state, arrow_kind = none, "", 0, 0, None
        for whole in batches:
            for batch in slices(iter([whole]), 3):
                arrow_kind = batch.column(0).type
                convs, found, roles = (batch.column(i).to_pylist() for i in range(3))
                out_conv, out_edit, out_role, out_text = [], [], [], []

                def put(edit: str, role: str, text: int | None) -> None:
                    out_conv.append(conv)  # noqa: B023
                    out_edit.append(edit)  # noqa: B023
                    out_role.append(role)  # noqa: B023
                    out_text.append(text)  # noqa: B023

                for n, own in enumerate(convs):
                    if found[n] is not None and (conv is none or own != conv or at):
                        while at < len(audit):
                            role, state = next_role(state)
                            put("I", role, None)
                            at += 1
                        conv, audit, at, state = own, "", 0, 0
                    if found[n] is not None:
                        audit += found[n]
                        continue
                    while audit[at] == "I":
                        role, state = next_role(state)
                        put("I", role, None)
                        at += 1
                    edit, role = audit[at], roles[n]
                    at += 1
                    if edit == "R":
                        role, state = next_role(state)
                    elif edit == "K":
                        state = kept_state(KINDS.index(role[0]), state)
                    put(edit, role, n)
                texts = pc.fill_null(batch.column(3).cast(pa.large_string()).take(pa.array(out_text, pa.int64())), "")
                columns = [pa.array(out_conv, arrow_kind), pa.array(out_edit), pa.array(out_role, pa.string()), texts.cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["conv", "edit", "role", "text"])
        last = []
        while at < len(audit):
            role, state = next_role(state)
            last.append(role)
            at += 1
        if last:
            n = len(last)
            columns = [pa.array([conv] * n, arrow_kind), pa.array(["I"] * n), pa.array(last), pa.array([""] * n)]
            yield pa.RecordBatch.from_arrays(columns, names=["conv", "edit", "role", "text"])

    return dealt.select("conv", "audit", "role", "text").mapInArrow(applied, f"conv {kind}, edit string, role string, text string")


def repaired(
    frame: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """The edits (conv, edit, role, text) in order, and per conversation its faults and cost
    (conv, gaps, blank, duplicate, truncated, illegal, cost)."""
    rows = marked(frame, conversation, turn, role, text)
    blocks = written(blocks_of(written(turns(rows), "repair-turns")), "repair-blocks")
    found = written(routes(blocks, learnt(blocks)), "repair-routes")
    return edits(rows, found), found.drop("audits")
