"""Arrow batches of whole texts as byte arrays, cut at a bounded number of bytes.

``mapInArrow`` hands over a few thousand rows at a time. ``text_slices`` cuts such a batch further,
always between documents, so that the numpy work on one slice stays within some tens of MB however
long the texts are; a single longer text is a slice of its own.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

BATCH_BYTES = 8 << 20
SLICE_BYTES = 1 << 19
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def bounded_batches(spark: SparkSession, rows: int = 1_000) -> None:
    """Bound the batches between Spark and Python by rows and bytes, where the session leaves them open."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


# caches that outlive a task; dropped when another kind of work starts in the same worker
HELD: dict[str, object] = {}


def map_batches(df: DataFrame, function, schema: str, keeps_caches: bool = False) -> DataFrame:
    """``mapInArrow`` with bounded batches; ``function`` makes dicts of columns from the batches."""
    bounded_batches(df.sparkSession)
    arrow = pa.schema(_arrow_fields(df.sparkSession, schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keeps_caches:
            HELD.clear()
        release_memory()
        for columns in function(batches):
            yield pa.RecordBatch.from_arrays(
                [_as_array(columns[f.name], f.type) for f in arrow], schema=arrow
            )
        release_memory()

    return df.mapInArrow(run, schema)


def filter_batches(df: DataFrame, function) -> DataFrame:
    """The rows of ``df`` for which ``function`` says so; it makes a boolean array from each batch."""
    bounded_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        HELD.clear()
        release_memory()
        for batch in batches:
            yield batch.filter(pa.array(function(batch)))
        release_memory()

    return df.mapInArrow(run, df.schema)


def fresh_name() -> str:
    """A column name that no table has."""
    return f"_{uuid.uuid4().hex}"


def release_memory() -> None:
    """Give memory that is no longer used back to the system: workers outlive their tasks and share a machine."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library can
        ctypes.CDLL(None).malloc_trim(0)


def _arrow_fields(spark: SparkSession, schema: str) -> list[pa.Field]:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return list(to_arrow_schema(StructType.fromDDL(schema)))


def _as_array(values, kind: pa.DataType) -> pa.Array:
    return values.cast(kind) if isinstance(values, pa.Array) else pa.array(values, kind)


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``first row, end row, bytes, offsets`` for runs of rows of about ``limit`` bytes; null is empty."""
    filled = column.fill_null("")
    _, places, data = filled.buffers()
    n = len(filled)
    wide = pa.types.is_large_string(filled.type) or pa.types.is_large_binary(filled.type)
    offsets = np.frombuffer(places, np.int64 if wide else np.int32)[filled.offset : filled.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        end = min(end, n)
        own = offsets[first : end + 1]
        yield first, end, raw[own[0] : own[-1]], own - own[0]
        first = end


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose bits all depend on all bits of ``x``."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """Splits slices of bytes into words and hashes them; keeps the power tables between calls."""

    def __init__(self, separators, lower: bool = True):
        self.separator = np.zeros(256, bool)
        self.separator[list(separators)] = True
        self.fold = np.arange(256, dtype=np.uint8)
        if lower:
            self.fold[65:91] += 32
        self._grow(SLICE_BYTES + 1)

    def _grow(self, n: int) -> None:
        self.power = np.cumprod(np.full(n, _BASE, np.uint64))
        self.inverse = np.cumprod(np.full(n, _BASE_INVERSE, np.uint64))

    def __call__(self, raw: np.ndarray, offsets: np.ndarray):
        """``hashes, starts, ends, bounds``: words ``bounds[i]:bounds[i + 1]`` are those of text ``i``."""
        n = len(raw)
        if n == 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
        if n > len(self.power):
            self._grow(n + (n >> 1))
        text = self.fold[raw]
        inside = ~self.separator[text]
        before = np.empty(n, bool)
        before[0], before[1:] = False, inside[:-1]
        before[offsets[:-1][offsets[:-1] < n]] = False
        after = np.empty(n, bool)
        after[-1], after[:-1] = False, inside[1:]
        ends_of_texts = offsets[1:]
        after[ends_of_texts[ends_of_texts > 0] - 1] = False
        starts = np.flatnonzero(inside & ~before)
        ends = np.flatnonzero(inside & ~after) + 1
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((text.astype(np.uint64) + np.uint64(1)) * self.power[:n], out=sums[1:])
        hashes = mixed((sums[ends] - sums[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64))
        return hashes, starts, ends, np.searchsorted(starts, offsets)
