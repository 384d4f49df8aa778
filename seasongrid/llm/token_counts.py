"""Token totals of a corpus for every context limit, from one exact histogram."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from seasongrid.llm.tokens import encoder, groups, tokenizer_path


def lengths(docs: DataFrame, tokenizer: str | None = None, end_id: int | None = 1, text: str = "text") -> DataFrame:
    """``(length, n_docs)``: how many whole texts encode to each length."""
    path, more = tokenizer or tokenizer_path(), int(end_id is not None)

    @F.arrow_udf("long")
    def length(column: pa.Array) -> pa.Array:
        encode = encoder(path).encode
        found = [np.diff(encode(column.slice(a, b - a))[0]) + more for a, b in groups(column)]
        return pa.array(np.concatenate(found) if found else np.zeros(0, np.int64), pa.int64())

    return docs.select(length(F.col(text).cast("string")).alias("length")).groupBy("length").agg(F.count(F.lit(1)).alias("n_docs"))


def report(histogram: DataFrame) -> DataFrame:
    """For every length as a context limit what fits, what is cut and what is kept.

    Columns: ``length``, ``n_docs``, ``n_tokens`` of that length; ``docs_longer``
    and ``tokens_longer`` beyond it (suffix sums); ``truncated_total``, the tokens
    that remain when every document is cut to the limit; ``quantile``, the share
    of documents that fit; ``total_docs`` and ``total_tokens``.  A limit between
    two lengths truncates to ``truncated_total`` of the smaller one plus
    ``docs_longer`` times the difference.  One row for each length that occurs,
    never more than the longest document has tokens, so the windows are small.
    An empty histogram gives no row.
    """
    tokens = F.col("length") * F.col("n_docs")
    after = Window.orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    rows = histogram.select(
        "length", "n_docs", tokens.alias("n_tokens"),
        F.coalesce(F.sum("n_docs").over(after), F.lit(0)).alias("docs_longer"),
        F.coalesce(F.sum(tokens).over(after), F.lit(0)).alias("tokens_longer"),
        F.sum("n_docs").over(every).alias("total_docs"),
        F.sum(tokens).over(every).alias("total_tokens"),
    )
    return rows.select(
        "length", "n_docs", "n_tokens", "docs_longer", "tokens_longer",
        (F.col("total_tokens") - F.col("tokens_longer") + F.col("docs_longer") * F.col("length")).alias("truncated_total"),
        (1 - F.col("docs_longer") / F.col("total_docs")).alias("quantile"),
        "total_docs", "total_tokens",
    )


def token_counts(docs: DataFrame, tokenizer: str | None = None, end_id: int | None = 1, text: str = "text") -> DataFrame:
    """The report on ``docs``: whole texts, null as empty, every row counted; other columns are ignored."""
    return report(lengths(docs, tokenizer, end_id, text))
