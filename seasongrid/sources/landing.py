"""Scans of the JSON landing zone.

Layout: ``bronze/{season}/{round_folder}/{entity}.json``, with season-level
entities one level higher.  Files put there by hand carry the entity as their
whole name; files landed by Spark start with it (``{entity}-00000-….json``).
A scan takes both.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seasongrid.functions.text import folder_from_path, season_by_pattern, season_from_path
from seasongrid.schemas import CORRUPT, ERROR_FIELD, Schemas, with_diagnostics

SOURCE_PATH = "source_path"
#: Fields of a record that no schema declares, as text; null if there are none.
RESCUED = "rescued"


def entity_files(entity: str) -> str:
    return f"{{{entity}.json,{entity}-*.json}}"


def scan_json(
    spark: SparkSession, paths: str | Sequence[str], files: str, schema: T.StructType
) -> DataFrame:
    """All records in files of a given name below ``paths``, with their source file.

    One line may hold a record or a whole array of records.  What does not
    parse stays as a row with the corrupt-record column set.
    """
    return (
        spark.read.schema(with_diagnostics(schema))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", files)
        .json(paths if isinstance(paths, str) else list(paths))
        .select("*", F.col("_metadata.file_path").alias(SOURCE_PATH))
    )


def scan_entity(
    spark: SparkSession, paths: str | Sequence[str], entity: str, schemas: Schemas = Schemas()
) -> DataFrame:
    return scan_json(spark, paths, entity_files(entity), schemas.record(entity))


def scan_rescued(
    spark: SparkSession, paths: str | Sequence[str], files: str, columns: Sequence[str]
) -> DataFrame:
    """A scan of the declared ``columns`` as text that keeps what they do not name.

    Each line is parsed once, as a variant, whose fields become a map; declared
    ones leave it for their column.  ``RESCUED`` holds the others, nested values
    as JSON.  Everything else is as for :func:`scan_json`: a line is a record or
    an array of records, and one that does not parse is a corrupt record.
    """
    declared = [*columns, *[c for c in (ERROR_FIELD,) if c not in columns]]
    lines = (
        spark.read.schema("value string")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", files)
        .text(paths if isinstance(paths, str) else list(paths))
        .select("value", F.col("_metadata.file_path").alias(SOURCE_PATH))
        .where(F.trim("value") != "")
    )
    parsed = lines.withColumn("_line", F.try_parse_json("value"))
    in_array = F.try_variant_get("_line", "$", "array<variant>")
    records = parsed.select(
        SOURCE_PATH,
        "value",
        F.col("_line").isNull().alias("_broken"),
        F.explode_outer(F.coalesce(in_array, F.array("_line"))).alias("_record"),
    ).where(F.col("_broken") | F.col("_record").isNotNull())  # an empty array has no record
    fields = F.try_variant_get("_record", "$", "map<string,variant>")
    held = records.withColumn("_fields", F.transform_values(fields, lambda _, v: v.cast("string")))
    unknown = F.map_filter("_fields", lambda k, _: ~k.isin(declared))
    return held.select(
        *[F.try_element_at("_fields", F.lit(c)).alias(c) for c in declared],
        F.when(F.col("_fields").isNull(), F.col("value")).alias(CORRUPT),
        SOURCE_PATH,
        F.when(F.size(unknown) > 0, unknown).alias(RESCUED),
    )


def unknown_fields(scan: DataFrame) -> DataFrame:
    """``(year, field, records, example)`` of the fields a scan rescued."""
    each = with_season_by_pattern(scan).select("year", F.explode(RESCUED).alias("field", "value"))
    return each.groupBy("year", "field").agg(F.count(F.lit(1)).alias("records"), F.min("value").alias("example"))


def _reject_reason() -> Column:
    return (
        F.when(F.col(CORRUPT).isNotNull(), F.lit("malformed"))
        .when(F.col(ERROR_FIELD).isNotNull(), F.lit("error payload"))
    )


def accepted(scan: DataFrame) -> DataFrame:
    """Records proper: neither an error payload nor malformed text."""
    return scan.where(_reject_reason().isNull()).drop(ERROR_FIELD, CORRUPT, RESCUED)


def quarantined(scan: DataFrame) -> DataFrame:
    """The rest, as source file, reason and payload."""
    return scan.select(
        SOURCE_PATH,
        _reject_reason().alias("reason"),
        F.coalesce(F.col(CORRUPT), F.col(ERROR_FIELD)).alias("payload"),
    ).where("reason is not null")


def with_path_columns(scan: DataFrame) -> DataFrame:
    """Season and race folder by their position in the path."""
    path = F.col(SOURCE_PATH)
    return scan.withColumns({"race_folder_name": folder_from_path(path), "year": season_from_path(path)})


def with_season_by_pattern(scan: DataFrame) -> DataFrame:
    return scan.withColumn("year", season_by_pattern(F.col(SOURCE_PATH)))
