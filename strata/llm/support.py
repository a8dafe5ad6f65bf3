"""What several operators share: cut lineage, row keys, whole groups out of sorted batches."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def settle(df: DataFrame) -> DataFrame:
    """The rows of ``df``, written to the shared checkpoint folder and cut from their lineage.

    The folder is the one in ``spark.checkpoint.dir``. Only a local master
    without that setting gets a temporary folder of its own.
    """
    session = df.sparkSession
    context = session.sparkContext
    if not context.getCheckpointDir():
        base = session.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not context.master.startswith("local[") and context.master != "local":
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            base = tempfile.mkdtemp(prefix="strata-")
        context.setCheckpointDir(base)
    return df.checkpoint()


@contextmanager
def small_batches(session: SparkSession, rows: int) -> Iterator[None]:
    """Jobs run inside send at most ``rows`` rows at once to the Python workers; a lower setting of the session stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = session.conf.get(name)
    session.conf.set(name, str(min(int(before), rows) if int(before) > 0 else rows))
    try:
        yield
    finally:
        session.conf.set(name, before)


def row_key(*columns: Column) -> Column:
    """A 128-bit key of some columns; a null differs from every value."""
    parts = [F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("-")) for c in columns]
    lengths = [F.length(p).cast("string") for p in parts]
    return F.md5(F.concat_ws(",", *lengths, *parts).cast("binary"))


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables that each hold only whole groups of ``key``, from batches sorted by it.

    The key is a binary, string or integer column without nulls. What is held back
    between two batches is the last, unfinished group.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key)
        last = keys[batch.num_rows - 1]
        if held and held[-1].column(key)[held[-1].num_rows - 1] != keys[0]:
            yield pa.Table.from_batches(held)
            held = []
        if keys[0] == last:
            held.append(batch)
            continue
        low, high = 0, batch.num_rows - 1  # first row of the last group
        while low < high:
            middle = (low + high) // 2
            low, high = (low, middle) if keys[middle] == last else (middle + 1, high)
        yield pa.Table.from_batches([*held, batch.slice(0, low)])
        held = [batch.slice(low)]
    if held:
        yield pa.Table.from_batches(held)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column in one array, and the n + 1 offsets of its rows; null is empty."""
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) else "")
    wide = column.cast(pa.large_binary() if pa.types.is_binary(column.type) else pa.large_string())
    _, offsets, data = wide.buffers()
    bounds = np.frombuffer(offsets, np.int64)[wide.offset : wide.offset + len(wide) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = int(bounds[0]) if len(bounds) else 0
    return raw[first : int(bounds[-1]) if len(bounds) else 0], bounds - first


def row_slices(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes each, or of one row."""
    start, rows = 0, len(offsets) - 1
    while start < rows:
        stop = int(np.searchsorted(offsets, offsets[start] + most, "right")) - 1
        stop = min(max(stop, start + 1), rows)
        yield start, stop
        start = stop


def binary_array(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A binary column from bytes and n + 1 offsets."""
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
    ).cast(pa.binary())
