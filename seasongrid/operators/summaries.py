"""Aggregates a report column or a scalar lookup falls back to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def total_race_points(star: DataFrame, by: Sequence[str]) -> DataFrame:
    """Race points add up."""
    return star.groupBy(*by).agg(F.sum(F.col("Race_Points").cast("double")).alias("Race_Points"))


def top_season_points(star: DataFrame, by: Sequence[str]) -> DataFrame:
    """Season points are cumulative, so their largest value stands for a group."""
    return star.groupBy(*by).agg(F.max(F.col("Season_Points").cast("double")).alias("Season_Points"))


def selected_value(column: str) -> Column:
    """The single value of a group, null if it has several or none.

    Equal to counting distinct values, in one pass with two plain buffers;
    a null counts as a value of its own.
    """
    no_null = F.count(column) == F.count(F.lit(1))
    return F.when((F.min(column) == F.max(column)) & no_null, F.max(column))
