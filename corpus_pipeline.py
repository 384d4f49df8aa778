"""From raw documents to packed sequences: five stages, each on all that the one before kept.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the
last return the columns of ``documents``.  ``run`` writes each result as Parquet
to the shared folder and reads it again for the next.  Null and empty texts,
repeated rows and empty tables are handled as each operator's docstring says.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seasongrid.llm import decontaminate, language_id, packing, simhash, suffixes
from seasongrid.llm.common import stored, table

#: SQL does not express nearest centroids, lattice-free range joins or packing.
ORACLE_SQL = None


#: Columns that stages read by name; all others travel beside them, out of the operators' way.
_READ = ("doc_id", "text", "lang")


def _slim(docs: DataFrame) -> DataFrame:
    """The columns that are read, and the others as one."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in _READ]
    return docs.select(*[c for c in docs.columns if c in _READ], F.struct(*others, F.lit(0).alias("_")).alias("_rest"))


def _whole(slim: DataFrame, columns: list[str], **new: Column) -> DataFrame:
    """The columns of ``documents`` again, some of them new."""
    old = {c: F.col(c) if c in _READ else F.col(f"_rest.`{c}`") for c in columns}
    return slim.select(*[new.get(c, old[c]).alias(c) for c in columns])


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is accepted; ``lang`` and all other columns stay as they were, whatever their names."""
    model = language_id.fit(docs.where(~language_id.held_out()))
    return _whole(language_id.predict(_slim(docs), model).where("accepted"), docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one row: the smallest id (null last), then the smallest hash of the text.

    Rows of a null or repeated id are judged by their own texts; rows of equal id and text are one document.
    """
    return simhash.without_copies(docs)


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of passages that occur before; a null text stays null.

    A character that lost some of its bytes goes too.  ``n_chars`` follows the
    text, all other columns stay, whatever their names.
    """
    found = suffixes.remove(_slim(docs))
    text = F.when(F.col("n_removed") > 0, suffixes.as_text(F.col("kept"))).otherwise(F.col("text"))
    found = found.withColumn("text", text)
    return _whole(found, docs.columns, n_chars=F.length("text").cast("long"))


def decontaminate_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item; rows of a null or repeated id each by its own text."""
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences, with their ids."""
    return packing.pack(docs)


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", remove_repeated_passages),
    ("decontamination", decontaminate_documents),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
