"""Token ids as Parquet list columns in ascending ``doc_id`` order.

Ids and counts are integer columns written with delta encoding or a dictionary
(``encoding``); row groups and pages are kept small and every page has its
bounds in the page index, so a reader of some documents, or of the metadata
columns alone, skips the rest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from seasongrid.llm.common import batches_of, crc, trim_memory
from seasongrid.llm.tokens import ENCODED, encoder, groups, tokenizer_path, with_end

#: Bytes of a batch for the encoder: with its offsets it is encoded at once, not in a large and a tiny part.
BATCH = ENCODED * 3 // 4
#: Rows of one id that a task can take.
HOT_ID = 100_000
SCHEMA = "doc_id long, n_tokens int, ids array<int>"


def encode(docs: DataFrame, tokenizer: str, end_id: int | None, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``(doc_id, n_tokens, ids)`` of whole texts, with ``end_id`` after each; null counts as empty."""

    def ids_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trim_memory()
        encode_ = encoder(tokenizer).encode
        for batch in batches:
            for a, b in groups(batch["t"], ENCODED):
                part = batch.slice(a, b - a)
                offsets, ids = with_end(*encode_(part["t"]), end_id)
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids.view(np.int32)))
                yield pa.RecordBatch.from_arrays([part["d"], pa.array(np.diff(offsets).astype(np.int32)), lists], ["doc_id", "n_tokens", "ids"])
        trim_memory()

    rows = docs.select(F.col(doc_id).cast("long").alias("d"), F.col(text).cast("string").alias("t"))
    return rows.mapInArrow(ids_of, SCHEMA)


def write(
    docs: DataFrame,
    path: str,
    tokenizer: str | None = None,
    end_id: int | None = 1,
    encoding: str = "delta",
    row_group_bytes: int = 16 << 20,
    page_bytes: int = 256 << 10,
    page_rows: int = 2000,
) -> None:
    """Write the ids of ``docs`` as files whose names ascend with ``doc_id``.

    Rows go to files by ranges of ``doc_id``; within a file they are sorted by
    it, then by text.  Where an id has more than ``HOT_ID`` rows, ranges and
    order go by a hash of the text after the id, so that its rows are several
    files.  A null id comes first; repeated ids stay, each a row.
    Columns other than ``doc_id`` and ``text`` are ignored.  An empty table
    makes a folder without rows.
    """
    if encoding not in ("delta", "dictionary"):
        raise ValueError("encoding is delta or dictionary")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    hottest = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    keys = ["doc_id"]
    if hottest > HOT_ID:  # the ranges are sampled on the driver: ids and hashes, no texts
        rows, keys = rows.withColumn("hash", F.xxhash64("text")), ["doc_id", "hash"]
    rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys, "text")
    options = {
        "parquet.writer.version": "v2",
        "parquet.enable.dictionary": str(encoding == "dictionary").lower(),
        "parquet.block.size": row_group_bytes,
        "parquet.page.size": page_bytes,
        "parquet.page.row.count.limit": page_rows,
        "compression": "zstd",
    }
    with batches_of(docs.sparkSession, BATCH):
        encode(rows, tokenizer or tokenizer_path(), end_id).write.options(**options).parquet(path)


def read(spark: SparkSession, path: str, columns: list[str] | None = None, first: int | None = None, last: int | None = None) -> DataFrame:
    """Rows of written ids; only the asked columns and, by the page index, the asked ids are read."""
    rows = spark.read.schema(SCHEMA).parquet(path)
    if first is not None:
        rows = rows.where(F.col("doc_id") >= first)
    if last is not None:
        rows = rows.where(F.col("doc_id") <= last)
    return rows.select(*columns) if columns else rows


def _file_number() -> Column:
    """The place of a file in ascending order: its task, then its number among the files of that task."""
    name = F.col("_metadata.file_name")
    task, number = (F.regexp_extract(name, pattern, 1).cast("long") for pattern in (r"part-(\d+)", r"-c(\d+)\."))
    return F.shiftleft(task, 20) + number


def digests(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` as the files say.

    ``start`` counts the ids of all rows before, in the order of the files.
    It is a sum of the files' totals, a row for each file, and a running sum
    within each file.
    """

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch["ids"]
            offsets = ids.offsets.to_numpy()
            values = memoryview(ids.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)).cast("B")
            found = [crc(bytes(values[4 * a : 4 * b])) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            n = np.diff(offsets).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch["file"], batch["place"], batch["doc_id"], pa.array(n), pa.array(found, pa.int64())], ["file", "place", "doc_id", "n_tokens", "ids_crc32"])

    rows = read(spark, path).select(
        _file_number().alias("file"),
        F.col("_metadata.row_index").alias("place"),
        "doc_id",
        "ids",
    )
    found = rows.mapInArrow(sums, "file long, place long, doc_id long, n_tokens long, ids_crc32 long")
    totals = read(spark, path).select(_file_number().alias("of"), "n_tokens")
    totals = totals.groupBy("of").agg(F.sum("n_tokens").alias("n"))
    before = totals.select("of", (F.sum("n").over(Window.orderBy("of")) - F.col("n")).alias("before"))
    within = F.sum("n_tokens").over(Window.partitionBy("file").orderBy("place")) - F.col("n_tokens")
    return (
        found.join(before, found["file"] == before["of"])
        .select("doc_id", (F.col("before") + within).alias("start"), "n_tokens", "ids_crc32")
    )
