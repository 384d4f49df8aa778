from __future__ import annotations

from conftest import day, rows
from pyspark.sql import functions as F

from seasongrid.session import fresh_dir
from seasongrid.sources import sinks
from seasongrid.sources.tables import read_table


def test_only_the_given_seasons_are_replaced(spark, make):
    path = fresh_dir(spark, "t")
    sinks.overwrite_seasons(make("k int, year int", (1, 2023), (2, 2024), (3, 2024)), path)
    sinks.overwrite_seasons(make("k int, year int", (4, 2024)), path)
    assert rows(read_table(spark, path), "k", "year") == [(1, 2023), (4, 2024)]


def test_the_session_setting_does_not_matter(spark, make):
    path = fresh_dir(spark, "t")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        sinks.overwrite_table(make("k int", (1,), (2,)), path)
        sinks.overwrite_table(make("k int", (3,)), path)
        season = fresh_dir(spark, "season")
        sinks.replace_season({"x": make("k int, race_folder string", (1, "a"), (2, "b"))}, season)
        sinks.replace_season({"x": make("k int, race_folder string", (3, "b"))}, season)
        assert rows(spark.read.option("recursiveFileLookup", "true").json(season), "k") == [(3,)]
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert rows(read_table(spark, path)) == [(3,)]


def test_new_columns_are_merged_on_read(spark, make):
    path = fresh_dir(spark, "t")
    sinks.overwrite_seasons(make("k int, year int", (1, 2023)), path)
    sinks.overwrite_seasons(make("k int, extra string, year int", (2, "x", 2024)), path)
    merged = read_table(spark, path, merge_schema=True)
    assert rows(merged, "k", "extra", "year") == [(1, None, 2023), (2, "x", 2024)]


def test_files_are_date_ordered_and_a_large_season_is_split(spark):
    days = spark.range(4000).select(
        F.lit(2023).alias("year"),
        F.col("id").alias("meeting_key"),
        F.timestamp_seconds(F.col("id") * 7919 % 4000).alias("date_start"),
    )
    path = fresh_dir(spark, "t")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.overwrite_seasons(sinks.date_ordered(days.repartition(5)), path, arrange=False)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = (
        spark.read.parquet(path)
        .select("date_start", "_metadata.file_path", "_metadata.row_index")
        .groupBy("file_path")
        .agg(
            F.min("date_start").alias("low"),
            F.max("date_start").alias("high"),
            F.sort_array(F.collect_list(F.struct("row_index", "date_start"))).alias("kept"),
            F.sort_array(F.collect_list("date_start")).alias("sorted"),
        )
        .orderBy("low")
        .collect()
    )
    assert len(files) > 1
    assert all([r.date_start for r in f.kept] == f.sorted for f in files)
    assert all(a.high < b.low for a, b in zip(files, files[1:]))


def test_stored_results_are_read_back(spark, make):
    df = make("k int, d timestamp", (1, day("2023-01-01")))
    kept = sinks.stored(df, "kept")
    assert kept.schema == df.schema
    assert rows(kept) == rows(df)
