"""Stupid-backoff scores of documents, as joins of n-gram counts and exploded n-grams.

Tokens are a public tokenizer's, so the unigram table is bounded by its
vocabulary and may be broadcast.  Bigram counts are summed per task, then by
key, and hold the whole corpus.  A document's score is the sum over its
bigrams of the logarithm of

    c(v, w) / c(v)        where c(v, w) reaches ``least``,
    alpha * c(w) / N      otherwise.

The bigrams of a document travel with their number.  Those among the ``hot``
most frequent ones of the corpus find their score in a broadcast table of that
many rows; the others are shuffled to the count table by key.  So no frequent
bigram gathers its rows in one task, and every bigram is scored alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seasongrid.llm.common import release_memory, stored
from seasongrid.llm.tokens import encoder, groups, tokenizer_path

#: Bits of a token id in a bigram's key; a vocabulary must be smaller.
ID_BITS = 20
#: The id that stands before a document's first token.
BEFORE = (1 << ID_BITS) - 1
HOT = 1 << 16


def _keys(offsets: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The key of each token and the one before it, document by document."""
    ids = ids.astype(np.int64)
    before = np.concatenate([[BEFORE], ids[:-1]])
    starts = offsets[:-1]
    before[starts[starts < offsets[1:]]] = BEFORE
    return before << ID_BITS | ids


def tokens(docs: DataFrame, tokenizer: str, text: str, doc_id: str) -> DataFrame:
    """``(row, doc_id, ids)`` of whole texts, written once."""

    def ids_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        for batch in batches:
            for a, b in groups(batch["t"]):
                part = batch.slice(a, b - a)
                offsets, ids = encode(part["t"])
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids.view(np.int32)))
                yield pa.RecordBatch.from_arrays([part["row"], part["d"], lists], ["row", "doc_id", "ids"])
        release_memory()

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).cast("long").alias("d"), F.col(text).cast("string").alias("t"))
    return stored(rows.mapInArrow(ids_of, "row long, doc_id long, ids array<int>"), "tokens")


def _parts(batch: pa.RecordBatch, size: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Documents of about ``size`` tokens at a time, a longer one alone."""
    block = batch["ids"].offsets.to_numpy()[1:].astype(np.int64) // size
    cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        part = batch.slice(a, b - a)
        offsets = part["ids"].offsets.to_numpy().astype(np.int64)
        yield part, offsets - offsets[0], part["ids"].flatten().to_numpy()


def bigram_counts(ids: DataFrame) -> DataFrame:
    """``(key, n)`` over all documents."""

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        for batch in batches:
            for _, offsets, values in _parts(batch, 1 << 20):
                keys, n = np.unique(_keys(offsets, values), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n.astype(np.int64))], ["key", "n"])

    return ids.select("ids").mapInArrow(local, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def exploded(ids: DataFrame) -> DataFrame:
    """``(row, key, n)``: the bigrams of each document with their number in it."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        for batch in batches:
            for part, offsets, values in _parts(batch, 1 << 18):
                keys = _keys(offsets, values)
                owner = np.repeat(np.arange(part.num_rows, dtype=np.int64), np.diff(offsets))
                both, n = np.unique(owner << 2 * ID_BITS | keys, return_counts=True)
                rows = part["row"].to_numpy()[both >> 2 * ID_BITS]
                yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(both & (1 << 2 * ID_BITS) - 1), pa.array(n.astype(np.int64))], ["row", "key", "n"])

    return ids.select("row", "ids").mapInArrow(each, "row long, key long, n long")


def score(
    docs: DataFrame,
    tokenizer: str | None = None,
    alpha: float = 0.4,
    least: int = 2,
    hot: int = HOT,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """``(doc_id, n_tokens, log_score, mean_log_score)``, a row for every row of ``docs``.

    Null texts and texts without a token have no tokens, a ``log_score`` of 0
    and a null mean.  Rows of a repeated id are scored each.  Equal counts at the
    edge of the hot table only decide which of two equal ways a bigram takes.
    Other columns are ignored; an empty table gives no rows.
    """
    tokenizer = tokenizer or tokenizer_path()
    if encoder(tokenizer).library.get_vocab_size() > BEFORE:
        raise ValueError(f"a vocabulary has at most {BEFORE} ids")
    ids = tokens(docs, tokenizer, text, doc_id)
    pairs = stored(bigram_counts(ids), "bigrams")
    before, word = F.shiftright("key", ID_BITS), F.col("key").bitwiseAND((1 << ID_BITS) - 1)
    contexts = pairs.groupBy(before.alias("v")).agg(F.sum("n").alias("n_context"))
    words = pairs.groupBy(word.alias("w")).agg(F.sum("n").alias("n_word"))
    total = pairs.agg(F.sum("n")).first()[0] or 1
    seen = pairs.select("key", "n", before.alias("v"), word.alias("w"))
    # contexts and words have at most as many rows as the vocabulary and one
    logs = (
        seen.join(F.broadcast(contexts), "v").join(F.broadcast(words), "w")
        .select("key", "n", F.log(F.when(F.col("n") >= least, F.col("n") / F.col("n_context")).otherwise(alpha * F.col("n_word") / total)).alias("log"))
    )
    logs = stored(logs, "scores")
    top = stored(logs.orderBy(F.desc("n"), "key").limit(hot), "hot").select(F.col("key").alias("of"), "log")
    rows = exploded(ids)
    found = rows.join(F.broadcast(top), F.col("key") == F.col("of"), "left").drop("of")
    # one pass: sums of the hot bigrams, and the others as they are
    kept = F.when(F.col("log").isNull(), F.col("key"))
    summed = found.groupBy("row", kept.alias("key")).agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("log")).alias("log_score"))
    summed = stored(summed, "sums")
    cold = summed.where("key is not null").select("row", "key", "n").join(logs.select("key", "log"), "key")
    parts = summed.where("key is null").select("row", "n", "log_score").union(cold.select("row", "n", F.col("n") * F.col("log")))
    sums = parts.groupBy("row").agg(F.sum("n").alias("n_tokens"), F.sum("log_score").alias("log_score"))
    named = ids.select(F.col("row").alias("of"), "doc_id")
    out = named.join(sums, F.col("of") == F.col("row"), "left").select(
        "doc_id", F.coalesce("n_tokens", F.lit(0)).alias("n_tokens"), F.coalesce("log_score", F.lit(0.0)).alias("log_score")
    )
    return out.withColumn("mean_log_score", F.when(F.col("n_tokens") > 0, F.col("log_score") / F.col("n_tokens")))
