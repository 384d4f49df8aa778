"""Which landed files a load has seen: their path, length and time of change.

The list comes from the file system alone; no file is opened for it.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seasongrid.functions.text import folder_from_path, season_by_pattern
from seasongrid.sources.files import Folder
from seasongrid.sources.stores import Store

TABLE = "landed_files"
#: What every race folder of a complete season holds.
REQUIRED = ("drivers_standings", "teams_standings", "drivers")


def landed_seasons(spark: SparkSession, bronze: str, season_dir: str = "{year}") -> dict[int, str]:
    """Season folders below ``bronze`` by their season."""
    before, after = season_dir.split("{year}")
    pattern = re.compile(re.escape(before) + r"(\d{4})" + re.escape(after))
    found = [(pattern.fullmatch(folder.name), folder) for folder in Folder(spark, bronze).folders()]
    return {int(match.group(1)): folder.path for match, folder in found if match}


def listing(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``(path, length, modified, year)`` of the JSON files below ``paths``; only the file system is asked."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json")
    path = F.col("path")
    return files.load(list(paths)).select(
        path, "length", F.col("modificationTime").alias("modified"), season_by_pattern(path).alias("year")
    )


def changed_seasons(typed: Store, landed: Mapping[int, str]) -> list[int]:
    """Landed seasons with a file that is new, gone or different since their load."""
    if not landed:
        return []
    now = listing(typed.spark, list(landed.values()))
    if not typed.exists(TABLE):
        return sorted(landed)
    seen = typed.read(TABLE, sorted(landed)).select(now.columns)
    same = [now[c].eqNullSafe(seen[c]) for c in now.columns]
    differ = now.join(seen, same, "left_anti").union(seen.join(now, same, "left_anti"))
    return sorted(row[0] for row in differ.select("year").distinct().collect())


def complete_seasons(catalog: DataFrame, files: DataFrame, seasons: Sequence[int]) -> list[int]:
    """Of ``seasons`` those with a catalog whose race folders all hold what is required."""
    entity = F.regexp_extract("path", rf"/({'|'.join(REQUIRED)})(?:-[^/]*)?\.json$", 1)
    held = (
        files.select("year", folder_from_path(F.col("path")).alias("folder_name"), entity.alias("entity"))
        .where("entity <> ''")
        .groupBy("year", "folder_name")
        .agg(F.count_distinct("entity").alias("held"))
    )
    races = catalog.select("year", "folder_name").join(held, ["year", "folder_name"], "left")
    full = races.groupBy("year").agg(F.min(F.coalesce("held", F.lit(0))).alias("held")).where(F.col("held") == len(REQUIRED))
    return sorted(row[0] for row in full.where(F.col("year").isin(list(seasons))).select("year").collect())
