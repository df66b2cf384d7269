"""Helpers shared by the operators that read whole texts inside Spark tasks."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import scratch_path

#: Characters of text that a task holds as Python objects at a time.
SLICE_CHARS = 2_000_000


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def written(frame: DataFrame, name: str) -> DataFrame:
    """The frame cut off from its lineage: written to the shared scratch folder and read again."""
    spark = frame.sparkSession
    path = scratch_path(spark, f"llm/{name}")
    schema = frame.schema
    frame.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def fresh(prefix: str, taken: list[str]) -> str:
    """A column name that no input column has, whatever its case."""
    name, lower = f"_{prefix}", {c.lower() for c in taken}
    while name.lower() in lower:
        name = f"_{prefix}_{uuid.uuid4().hex[:8]}"
    return name


def given_back() -> None:
    """Return freed memory of this Python worker to the system: workers wait, with all they hold, for later tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def orderable(frame: DataFrame, without: tuple[str, ...] = ()) -> list[Column]:
    """The columns of a frame as something that rows can be ordered by: maps and semi-structured values as text."""
    out = []
    for f in frame.schema.fields:
        if f.name not in without:
            kind = f.dataType.simpleString()
            column = F.col(f"`{f.name}`")
            out.append(F.to_json(F.struct(column)) if "map<" in kind or "variant" in kind else column)
    return out


def slices(batches: Iterator[pa.RecordBatch], column: int, most: int = SLICE_CHARS) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the texts of a slice hold about ``most`` bytes or are one row; at their end,
    freed memory is given back."""
    for batch in batches:
        sizes = batch.column(column).cast(pa.large_binary())
        lengths = np.asarray(pa.compute.fill_null(pa.compute.binary_length(sizes), 0), dtype=np.int64)
        start, held = 0, 0
        for i, n in enumerate(lengths):
            if i > start and held + n > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(n)
        if start < batch.num_rows:
            yield batch.slice(start)
    given_back()


def codes(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Each word's number in order of first use, and the distinct words."""
    values = np.empty(len(words), dtype=object)
    values[:] = words
    return pd.factorize(values)
