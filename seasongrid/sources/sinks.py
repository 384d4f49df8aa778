"""Writes: season partitions, whole tables, landed JSON.

Partition overwrite is chosen per write, never through the session, and
always on a path: a Parquet ``saveAsTable`` would replace every season.  ``fmt``
is any file or table format the session has.  Loads of several tables write
through :mod:`seasongrid.sources.stores`, which shows them all at once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, DataFrameWriter
from pyspark.sql import functions as F

from seasongrid.session import fresh_dir
from seasongrid.sources.files import Folder

#: Formats that are nothing but their files; others keep a log of them, and are changed through it.
PLAIN_FORMATS = frozenset({"parquet", "orc", "json", "csv", "avro", "text"})


def balanced(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Bring rows of a partition together for few files.

    A rebalance, unlike a repartition, lets adaptive execution cut an
    oversized partition into several tasks.
    """
    return df.hint("rebalance", *[F.col(c) for c in by])


def _overwriting(df: DataFrame, fmt: str, scope: str) -> DataFrameWriter:
    writer = df.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", scope)
    # Formats with a table schema of their own grow it on write; Parquet does on read.
    return writer.option("mergeSchema", "true")


def overwrite_seasons(
    df: DataFrame,
    path: str,
    by: Sequence[str] = ("year",),
    arrange: bool = True,
    fmt: str = "parquet",
    seasons: Sequence[int] | None = None,
) -> None:
    """Replace only the partitions present in ``df``, and all of ``seasons`` if they are given.

    The write itself replaces old files when it commits, so one that fails
    leaves them.  Only then the given seasons that got no new file are emptied.
    A format with a log of its own does both in one commit.
    """
    rows = balanced(df, by) if arrange else df
    if seasons is None:
        _overwriting(rows, fmt, "dynamic").partitionBy(*by).save(path)
    elif fmt in PLAIN_FORMATS:
        folders = [Folder(df.sparkSession, f"{path}/{by[0]}={season}") for season in seasons]
        before = [folder.files() for folder in folders]
        _overwriting(rows, fmt, "dynamic").partitionBy(*by).save(path)
        for folder, files in zip(folders, before, strict=True):
            if folder.files() == files:
                folder.delete()
    else:
        these = f"{by[0]} IN ({', '.join(str(int(season)) for season in seasons)})" if seasons else "false"
        _overwriting(rows, fmt, "static").option("replaceWhere", these).partitionBy(*by).save(path)


def overwrite_table(df: DataFrame, path: str, fmt: str = "parquet", by: Sequence[str] = ()) -> None:
    """Replace the whole table, partitioned if ``by`` is given."""
    if by:
        _overwriting(balanced(df, by), fmt, "static").partitionBy(*by).save(path)
    else:
        _overwriting(df, fmt, "static").save(path)


def write_all(writes: Iterable[Callable[[], None]], at_once: int = 4) -> None:
    """Run writes that do not depend on each other, a few at a time; the first failure is raised."""
    with ThreadPoolExecutor(at_once) as pool:
        for write in [pool.submit(write) for write in writes]:
            write.result()


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    For a result that several later steps read: it is computed once, survives
    lost executors, and those steps prune its columns and plan on its real
    size, by which Spark decides about broadcasts.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, name)
    overwrite_table(df, path)
    return spark.read.schema(df.schema).parquet(path)


def date_ordered(df: DataFrame, season: str = "year", order: Sequence[str] = ("date_start", "meeting_key")) -> DataFrame:
    """Ready for a season-partitioned write with date order in each file.

    Range partitioning over season and date cuts a large season into several
    files of disjoint date ranges; the writer needs the season first in the sort.
    """
    columns = [season, *order]
    return df.repartitionByRange(*columns).sortWithinPartitions(*columns)


def land_json(df: DataFrame, path: str, entity: str, by: Sequence[str] = (), mode: str = "append") -> None:
    """Land records as ``{entity}-*.json`` below ``path``.

    ``overwrite`` clears everything below ``path`` first.
    """
    rows = balanced(df, by) if by else df
    writer = rows.write.mode(mode).option("partitionOverwriteMode", "static")
    writer = writer.option("mapreduce.output.basename", entity)
    (writer.partitionBy(*by) if by else writer).json(path)


def replace_season(landed: Mapping[str, DataFrame], season_path: str, folder: str = "race_folder") -> None:
    """Land one season anew: the first write clears the season, stale folders too.

    Frames with the ``folder`` column go to one folder per race, the others to
    the season's own folder.
    """
    mode = "overwrite"
    for entity, records in landed.items():
        land_json(records, season_path, entity, [folder] if folder in records.columns else [], mode)
        mode = "append"
