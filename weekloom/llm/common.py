"""Helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


BATCH = 1000


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, by exact name and first position.

    Other columns may carry any name, also one that differs by case only or repeats.
    """
    fresh = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    return fresh.select(*[F.col(f"_{df.columns.index(n)}").alias(n) for n in names])


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """64-bit identity of a row: equal for repeated rows, whatever the partitioning."""
    return F.xxhash64(F.col(doc_id), F.col(text), F.length(text))


def keep_rows(docs: DataFrame, kept: DataFrame, once: bool = False) -> DataFrame:
    """Rows of ``docs`` whose ``row_key`` is in ``kept(key)``, with all columns of ``docs``.

    ``once`` keeps a single row of those that repeat id and text.
    """
    plain = [f"_{i}" for i in range(len(docs.columns))]
    ids, texts = (plain[docs.columns.index(n)] for n in ("doc_id", "text"))
    keyed = docs.toDF(*plain).withColumn("_key", row_key(ids, texts))
    rows = keyed.join(kept.select(F.col("key").alias("_key")), "_key", "left_semi")
    if once:
        rows = rows.dropDuplicates(["_key"])
    return rows.select(*plain).toDF(*docs.columns)


def byte_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a binary column; null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"")
    wide = pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    n = len(column)
    if n == 0 or offsets is None:
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    ends = np.frombuffer(offsets, kind, n + 1, column.offset * np.dtype(kind).itemsize)
    ends = ends.astype(np.int64)
    raw = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return ends - ends[0], raw[ends[0] : ends[-1]]


def long_rows(df: DataFrame) -> DataFrame:
    """``df``, in a session that hands Python at most ``BATCH`` rows at once.

    Texts are long: the usual ten thousand rows of a batch would be most of a worker's
    memory.
    """
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark = df.sparkSession
    if not 0 < int(spark.conf.get(setting)) <= BATCH:
        spark.conf.set(setting, str(BATCH))
    return df


def slices(batch: pa.RecordBatch, column: int, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch where its texts reach ``limit`` bytes, so that buffers stay small.

    A single text is never cut: a slice holds one row at least.
    """
    return cut_at(batch, byte_view(batch.column(column))[0], limit)


def cut_at(batch: pa.RecordBatch, upto: np.ndarray, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch where ``upto``, the size of all rows before each, has grown by ``limit``."""
    start = 0
    while start < batch.num_rows:
        stop = int(np.searchsorted(upto, upto[start] + limit, "right")) - 1
        stop = min(max(stop, start + 1), batch.num_rows)
        yield batch.slice(start, stop - start)
        start = stop


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads 64-bit values (wrapping multiplication)."""
    x = x ^ (x >> np.uint64(30))  # the only copy
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64, grown by doubling and kept per process."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(1024, 1 << (n - 1).bit_length()) if n else 1024
        out = np.empty(size, np.uint64)
        out[0] = 1
        filled = 1
        while filled < size:
            step = np.uint64(pow(base, filled, 1 << 64))
            out[filled : 2 * filled] = out[:filled] * step
            filled *= 2
        _POWERS[base] = have = out
    return have[:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every byte span ``data[start:end]``, by one prefix sum."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_ODD, len(data)), out=sums[1:])
    back = _powers(_INVERSE, len(data) + 1)
    return mix64((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))
