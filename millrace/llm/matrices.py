"""Packed token-id matrices as binary rows, with segment lengths and position resets.

Each row is one line of a matrix: ``ids``, the window's ids in little-endian bytes of ``ID_BYTES``
each, filled up with ``PAD``; ``cu_seqlens``, the cumulative segment lengths from 0 to the filled part;
``resets``, the places where positions start again from 0, one per segment; and for each segment its
document and its start in the document, so that documents can be put together again without loss.
Pieces are placed as in ``packing``: overlong documents are cut into full windows first, then the
remainders go, longest first, where the least room is left. Rows are written by Spark's Parquet
writer, so that tasks of lost executors are committed once.

Cases: as in ``packing``. Ids beyond the width of an id raise an error instead of being cut.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm import packing
from millrace.llm.packing import WINDOW

ID_BYTES = 2
PAD = 50256
ROWS = 1024  # of an Arrow batch
SEGMENT = "struct<doc_id:{key},start:bigint,doc_tokens:bigint>"


def rows(frame: DataFrame, path: str, key: str = "doc_id", text: str = "text", window: int = WINDOW, id_bytes: int = ID_BYTES, pad: int = PAD) -> DataFrame:
    """(sequence_id, ids, cu_seqlens, resets, segments) of all documents."""
    narrow, key_type = packing.narrowed(frame, key, text)
    width = np.dtype(f"<u{id_bytes}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = 0
        for keys, ids in packing.buffers(batches, path):
            totals = np.array([len(i) for i in ids], dtype=np.int64)
            found, windows = packing.layout(totals, window)
            if max(int(i.max()) for i in ids) > np.iinfo(width).max:
                raise ValueError(f"an id does not fit {id_bytes} bytes")
            sequences = packing.numbered(windows, counter)
            counter += windows
            order = np.lexsort((found["offset"], found["window"]))
            piece = {name: values[order] for name, values in found.items()}
            docs = pa.chunked_array(keys).combine_chunks().take(pa.array(piece["doc"]))
            bounds = np.searchsorted(piece["window"], np.arange(windows + 1))
            for first in range(0, windows, ROWS):
                last = min(first + ROWS, windows)
                a, b = int(bounds[first]), int(bounds[last])
                matrix = np.full((last - first, window), pad, dtype=width)
                for d, s, n, w, o in zip(*(piece[c][a:b].tolist() for c in ("doc", "start", "length", "window", "offset")), strict=True):
                    matrix[w - first, o : o + n] = ids[d][s : s + n]
                breaks = (bounds[first : last + 1] - a).astype(np.int32)
                ends = piece["offset"][a:b] + piece["length"][a:b]
                cumulative = np.insert(ends, breaks[:-1], 0)
                segments = pa.StructArray.from_arrays(
                    [docs.slice(a, b - a), pa.array(piece["start"][a:b]), pa.array(totals[piece["doc"][a:b]])],
                    names=["doc_id", "start", "doc_tokens"],
                )
                yield pa.RecordBatch.from_pydict(
                    {
                        "sequence_id": pa.array(sequences[first:last]),
                        "ids": pa.array([line.tobytes() for line in matrix], pa.binary()),
                        "cu_seqlens": pa.ListArray.from_arrays(
                            pa.array(breaks + np.arange(len(breaks), dtype=np.int32)), pa.array(cumulative.astype(np.int32))
                        ),
                        "resets": pa.ListArray.from_arrays(pa.array(breaks), pa.array(piece["offset"][a:b].astype(np.int32))),
                        "segments": pa.ListArray.from_arrays(pa.array(breaks), segments),
                    }
                )

    segment = SEGMENT.format(key=key_type)
    return narrow.mapInArrow(
        run, f"sequence_id bigint, ids binary, cu_seqlens array<int>, resets array<int>, segments array<{segment}>"
    )


def positions(cu_seqlens: list[int], window: int = WINDOW) -> np.ndarray:
    """The position of each place of a window: counted from the start of its segment, 0 in the padding."""
    out = np.zeros(window, dtype=np.int32)
    for a, b in zip(cu_seqlens[:-1], cu_seqlens[1:], strict=True):
        out[a:b] = np.arange(b - a)
    return out


def unpacked(frame: DataFrame, id_bytes: int = ID_BYTES, with_ids: bool = False) -> DataFrame:
    """One row per segment of packed rows: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    segment = frame.schema["segments"].dataType.elementType
    key_type = segment["doc_id"].dataType.simpleString()
    width = np.dtype(f"<u{id_bytes}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            segments = batch.column(3).flatten()
            sequence, offset, length, crc, ids = [], [], [], [], []
            for number, line, cuts in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                values = np.frombuffer(line.as_buffer(), dtype=width)
                for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                    own = values[a:b].astype("<u4")
                    sequence.append(number)
                    offset.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(own))
                    if with_ids:
                        ids.append(own.astype(np.int32))
            columns = {
                "doc_id": segments.field("doc_id"),
                "start": segments.field("start"),
                "length": pa.array(length, pa.int64()),
                "ids_crc32": pa.array(crc, pa.int64()),
                "doc_tokens": segments.field("doc_tokens"),
                "sequence_id": pa.array(sequence, pa.int64()),
                "offset": pa.array(offset, pa.int64()),
            }
            if with_ids:
                columns["ids"] = pa.array(ids, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(columns)

    more = ", ids array<int>" if with_ids else ""
    return frame.select("sequence_id", "ids", "cu_seqlens", "segments").mapInArrow(
        run,
        f"doc_id {key_type}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
        f"sequence_id bigint, offset bigint{more}",
    )
