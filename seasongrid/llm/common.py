"""Small helpers shared by the operators: stored tables, runs of sorted rows, digests."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seasongrid.session import fresh_dir

_M1 = np.uint64(0x9E3779B97F4A7C15)
_M2 = np.uint64(0xBF58476D1CE4E5B9)
_S = np.uint64(29)


#: Bytes of a batch on its way to a Python worker while a table is written: both sides hold a few of them.
BATCH = 8 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def stored(df: DataFrame, name: str, batch: int | None = BATCH) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage, so that later jobs survive lost executors without a new
    run of everything before, and gives Spark the true size.  Batches for Python
    have about ``batch`` bytes, the session's size if ``None``.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, name)
    before = spark.conf.get(_BATCH_SETTING, None)
    if batch:
        spark.conf.set(_BATCH_SETTING, str(batch))
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if batch and before is not None:
            spark.conf.set(_BATCH_SETTING, before)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def batches_of(spark: SparkSession, size: int) -> Iterator[None]:
    """What is written inside sends batches of about ``size`` bytes to Python; the session's size comes back."""
    before = spark.conf.get(_BATCH_SETTING, None)
    spark.conf.set(_BATCH_SETTING, str(size))
    try:
        yield
    finally:
        spark.conf.unset(_BATCH_SETTING) if before is None else spark.conf.set(_BATCH_SETTING, before)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def mix(a: np.ndarray, b: np.ndarray | None = None) -> np.ndarray:
    """A 64-bit hash of one or two arrays of unsigned 64-bit integers."""
    x = (a ^ (a >> _S)) * _M1
    if b is not None:
        x = x ^ b
    x = (x ^ (x >> _S)) * _M2
    return x ^ (x >> np.uint64(32))


def release_memory() -> None:
    """Give back what an earlier task of this worker process held; workers serve many stages."""
    from seasongrid.llm.tokens import encoder

    encoder.cache_clear()
    trim_memory()


def trim_memory() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only this allocator has the call
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def crc(ids: np.ndarray | bytes) -> int:
    """Unsigned crc32 of little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids if isinstance(ids, bytes) else np.asarray(ids, "<u4").tobytes())


def starts_of_runs(*columns: np.ndarray) -> np.ndarray:
    """Positions where the combination of the sorted columns changes; the first is 0."""
    n = len(columns[0])
    if n == 0:
        return np.zeros(0, np.int64)
    new = np.zeros(n, bool)
    new[0] = True
    for column in columns:
        new[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(new)


def _pieces(batch: pa.RecordBatch, rows: int, room: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about as many rows or bytes each."""
    step = max(1, min(rows, batch.num_rows * room // max(batch.nbytes, 1)))
    return (batch.slice(at, step) for at in range(0, batch.num_rows, step))


def whole_runs(
    batches: Iterator[pa.RecordBatch], keys: Sequence[str], rows: int = 200_000, room: int = 64 << 20
) -> Iterator[pa.Table]:
    """Tables cut only where the keys change, from batches that are sorted by them.

    A table holds about ``rows`` rows or ``room`` bytes and never part of a run.
    """
    held: list[pa.RecordBatch] = []
    size = space = 0
    for batch in (piece for whole in batches for piece in _pieces(whole, rows, room)):
        held.append(batch)
        size += batch.num_rows
        space += batch.nbytes
        if size < rows and space < room:
            continue
        table_ = pa.Table.from_batches(held).combine_chunks()
        last = int(starts_of_runs(*(table_[k].to_numpy() for k in keys))[-1])
        if last:
            yield table_.slice(0, last)
        rest = table_.slice(last).combine_chunks()
        held = rest.to_batches()
        size, space = rest.num_rows, rest.nbytes
        rows, room = max(rows, 2 * size), max(room, 2 * space)  # a long run is not copied for every batch
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def unique_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores until no column of ``df`` has it (names ignore case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def document_key(text: str = "text", doc_id: str = "doc_id") -> Column:
    """A hash that tells texts of one id apart, and a null id from any other."""
    return F.xxhash64(F.col(doc_id).isNull(), F.col(text).cast("string"))
