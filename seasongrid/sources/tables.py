"""Typed tables at rest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seasongrid.schemas import Schemas
from seasongrid.sources.stores import FolderStore

SILVER_TABLES = ("drivers_standings", "teams_standings", "circuits", "drivers_by_race", "drivers", "teams")
GOLD_TABLES = (
    "dim_driver",
    "dim_team",
    "dim_race",
    "fact_driver_results",
    "fact_team_results",
    "ui_play_timeline",
)


def read_table(
    spark: SparkSession,
    path: str,
    seasons: Sequence[int] | None = None,
    merge_schema: bool = False,
    fmt: str = "parquet",
) -> DataFrame:
    """A table; ``seasons`` prunes partitions, ``merge_schema`` takes columns of every file."""
    reader = spark.read.format(fmt)
    if merge_schema:
        reader = reader.option("mergeSchema", "true")
    table = reader.load(path)
    return table if seasons is None else table.where(F.col("year").isin(list(seasons)))


def _register(
    spark: SparkSession, root: str, names: Sequence[str], prefix: str, fmt: str, schemas: Schemas
) -> dict[str, DataFrame]:
    store = FolderStore(spark, root, fmt, schemas)
    tables = {name: store.read(name) for name in names}
    for name, table in tables.items():
        table.createOrReplaceTempView(f"{prefix}_{name}")
    return tables


def register_silver(
    spark: SparkSession, silver_root: str, fmt: str = "parquet", schemas: Schemas = Schemas()
) -> dict[str, DataFrame]:
    """Expose the typed tables, in their declared schema, as views named ``silver_*``."""
    return _register(spark, silver_root, SILVER_TABLES, "silver", fmt, schemas)


def register_star(
    spark: SparkSession, gold_root: str, fmt: str = "parquet", schemas: Schemas = Schemas()
) -> dict[str, DataFrame]:
    """Expose the star, in its declared schema, as views named ``gold_*``, read in place."""
    return _register(spark, gold_root, GOLD_TABLES, "gold", fmt, schemas)


def create_tables(
    spark: SparkSession, root: str, names: Sequence[str], prefix: str, fmt: str = "parquet"
) -> list[str]:
    """Name the tables below ``root`` in the session's catalog, for every session that shares it.

    The files stay where they are and are not copied.  Call it again after a
    load: a name then gets the columns and partitions there are.
    """
    created = []
    for name in names:
        table, path = f"{prefix}_{name}", f"{root}/{name}"
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.catalog.createTable(table, path, fmt)
        if any(column.isPartition for column in spark.catalog.listColumns(table)):
            spark.catalog.recoverPartitions(table)
        created.append(table)
    return created


def store_bucketed(
    df: DataFrame, table: str, path: str, key: str, buckets: int, by: str | None = None, fmt: str = "parquet"
) -> DataFrame:
    """Store ``df`` under a name, its rows dealt to files by a hash of ``key`` and sorted by it; the stored table.

    Two tables with as many buckets of the same key join on it without moving a
    row.  Rows are dealt out before the write, so a bucket of a season (``by``)
    is one file.  Choose ``buckets`` for the larger table, a few hundred MB each:
    a scan reads a bucket in one task.
    """
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    writer = df.repartition(buckets, key).write.format(fmt).bucketBy(buckets, key).sortBy(key).option("path", path)
    (writer.partitionBy(by) if by else writer).saveAsTable(table)
    return spark.table(table)
