"""Packing of token ids into fixed windows: best fit, longest piece first.

A document's ids are closed by id 0. Documents longer than a window are first cut into full windows;
the remainders of a buffer of documents are then placed from the longest to the shortest, each in the
open window with the least room that still takes it. A segment tree over the remaining capacities
finds that window. Buffers are filled within the task that reads the documents, so nothing is
shuffled, memory is bounded by ``BUFFER_TOKENS`` and one document, and a lost task is simply run
again: a sequence number is made of its task's partition and a counter.

Cases: a null or empty text is its closing id alone; repeated rows and null ids are packed like any
others; ties keep the order of the rows; an empty table gives no piece. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import slices
from millrace.llm.tokens import ID, encoder

WINDOW = 1024
BUFFER_TOKENS = 6_000_000
SLICE = 2_000_000
COUNTER_BITS = 36


class Room:
    """Open windows by remaining capacity, under a segment tree over capacities."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.some = [False] * (2 * self.leaves)  # whether a node's capacities have an open window
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def put(self, capacity: int, number: int) -> None:
        self.open[capacity].append(number)
        node = capacity + self.leaves
        while node and not self.some[node]:
            self.some[node] = True
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(capacity, number) of an open window with the least capacity that is at least ``need``."""
        some, node = self.some, need + self.leaves
        while not some[node]:
            while node & 1:  # a right child: go up until there is a sibling to the right
                node >>= 1
            if not node:
                return None
            node += 1
        while node < self.leaves:
            node = 2 * node if some[2 * node] else 2 * node + 1
        capacity = node - self.leaves
        number = self.open[capacity].pop()
        if not self.open[capacity]:
            while node:
                some[node] = node < self.leaves and (some[2 * node] or some[2 * node + 1])
                if some[node]:
                    break
                node >>= 1
        return capacity, number


def best_fit(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Each piece's window and offset, and how many windows were opened; longest pieces go first."""
    numbers, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    room, opened = Room(window), 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        found = room.take(need)
        if found is None:
            capacity, number = window, opened
            opened += 1
        else:
            capacity, number = found
        numbers[i], offsets[i] = number, window - capacity
        if capacity > need:
            room.put(capacity - need, number)
    return numbers, offsets, opened


def layout(totals: np.ndarray, window: int) -> tuple[dict[str, np.ndarray], int]:
    """Pieces of documents of these lengths: document, start, length, window, offset."""
    full = totals // window
    doc = np.repeat(np.arange(len(totals)), full)
    start = (np.arange(len(doc)) - np.repeat(np.cumsum(full) - full, full)) * window
    rest = totals - full * window
    left = np.flatnonzero(rest)
    numbers, offsets, opened = best_fit(rest[left], window)
    pieces = {
        "doc": np.concatenate([doc, left]),
        "start": np.concatenate([start, full[left] * window]),
        "length": np.concatenate([np.full(len(doc), window), rest[left]]),
        "window": np.concatenate([opened + np.arange(len(doc)), numbers]),
        "offset": np.concatenate([np.zeros(len(doc), np.int64), offsets]),
    }
    return pieces, opened + len(doc)


def buffers(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[tuple[list[pa.Array], list[np.ndarray]]]:
    """(keys, ids) of as many documents as fill a buffer; columns are key and text."""
    keys, ids, held = [], [], 0
    for part in slices(batches, 1, SLICE):
        own = encoder(path).encode(part.column(1))
        keys.append(part.column(0))
        ids += own
        held += sum(map(len, own))
        if held >= BUFFER_TOKENS:
            yield keys, ids
            keys, ids, held = [], [], 0
    if ids:
        yield keys, ids


def narrowed(frame: DataFrame, key: str, text: str) -> tuple[DataFrame, str]:
    narrow = frame.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    return narrow, narrow.schema["doc_id"].dataType.simpleString()


def numbered(windows: int, counter: int) -> np.ndarray:
    context = TaskContext.get()
    return ((context.partitionId() if context else 0) << COUNTER_BITS) + counter + np.arange(windows, dtype=np.int64)


def pieces(frame: DataFrame, path: str, key: str = "doc_id", text: str = "text", window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids)."""
    narrow, key_type = narrowed(frame, key, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = 0
        for keys, ids in buffers(batches, path):
            totals = np.array([len(i) for i in ids], dtype=np.int64)
            found, windows = layout(totals, window)
            sequences = numbered(windows, counter)
            counter += windows
            cut = [ids[d][s : s + n] for d, s, n in zip(found["doc"].tolist(), found["start"].tolist(), found["length"].tolist(), strict=True)]
            columns = {
                "doc_id": pa.chunked_array(keys).combine_chunks().take(pa.array(found["doc"])),
                "start": pa.array(found["start"]),
                "length": pa.array(found["length"]),
                "ids_crc32": pa.array([zlib.crc32(c) for c in cut], pa.int64()),
                "doc_tokens": pa.array(totals[found["doc"]]),
                "sequence_id": pa.array(sequences[found["window"]]),
                "offset": pa.array(found["offset"]),
            }
            if with_ids:
                columns["ids"] = pa.array([c.astype(np.int32) for c in cut], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(columns)

    more = ", ids array<int>" if with_ids else ""
    return narrow.mapInArrow(
        run,
        f"doc_id {key_type}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
        f"sequence_id bigint, offset bigint{more}",
    )


__all__ = ["ID", "WINDOW", "best_fit", "buffers", "layout", "narrowed", "numbered", "pieces"]
