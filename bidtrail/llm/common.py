"""What the operators share: reading the tables, Arrow helpers, session settings."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..session import configure

# Rows cross to Python in batches bounded by bytes as well as rows, so that long texts do not fill a worker's memory.
ARROW_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}


def tuned(spark: SparkSession) -> SparkSession:
    """The session with the library's and this package's run-time settings."""
    configure(spark)
    for key, value in ARROW_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tuned(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def buckets_of(spark: SparkSession) -> int:
    """Number of shuffle buckets: the cluster's own setting, which is sized with its data."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, one text after the other, and each text's length; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column) or column.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(column), np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, np.diff(offsets)


def texts(column: pa.Array) -> list[bytes]:
    """Each text as UTF-8 bytes; null counts as empty."""
    return [b"" if value is None else value for value in column.cast(pa.binary()).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of about `most` bytes of one text column; a longer row stands alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(utf8(batch.column(column))[1])
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + most, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def spaces(data: np.ndarray) -> np.ndarray:
    """True at the bytes 0x20 and 0x09-0x0D."""
    return (data == 32) | ((data >= 9) & (data <= 13))


def word_starts(data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start of every word of texts laid end to end, and the number of words of each text.

    A word is a longest run of bytes other than 0x20 and 0x09-0x0D inside one text.
    """
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(len(lengths), np.int64)
    inside = ~spaces(data)
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    firsts = np.cumsum(lengths) - lengths
    first = firsts[lengths > 0]
    begins[first] = inside[first]
    starts = np.flatnonzero(begins)
    return starts, np.diff(np.searchsorted(starts, np.append(firsts, len(data))))
