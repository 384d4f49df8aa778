"""Cumulative series: previous value, running maximum, per-race delta.

All three are window functions over one (entrant, season) group.  After the
builders reduce repeated rows, such a group holds at most one row per race of
the season.  For a calendar with very many races per season every function
takes a ``block``: a column that never decreases along the order (the month
of the date, say).  Then rows are windowed per (group, block), blocks are
summarised map-side, and the summaries, one row per block, carry values from
block to block.  The results are the same.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _group(keys: Sequence[str], order: Sequence[str]):
    ordered = Window.partitionBy(*keys).orderBy(*order)
    return ordered, ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _with_carry(
    df: DataFrame,
    keys: Sequence[str],
    block: str,
    summary: Column,
    carry: Callable[[Column], Column],
) -> DataFrame:
    """Join to each row what the earlier blocks of its group hand over."""
    summaries = df.groupBy(*keys, block).agg(summary.alias("_summary"))
    earlier = Window.partitionBy(*keys).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    carried = summaries.select(
        *[F.col(k).alias(f"_c_{k}") for k in [*keys, block]],
        carry(F.col("_summary")).over(earlier).alias("_carry"),
    )
    match = F.lit(True)
    for k in [*keys, block]:
        match = match & F.col(k).eqNullSafe(F.col(f"_c_{k}"))
    return df.join(carried, match).drop(*[f"_c_{k}" for k in [*keys, block]])


def previous_value(
    df: DataFrame,
    value: str,
    keys: Sequence[str],
    order: Sequence[str],
    out: str,
    default: float = 0.0,
    block: str | None = None,
) -> DataFrame:
    """The value one row earlier in the group; ``default`` on its first row."""
    fallback = F.lit(default).cast(df.schema[value].dataType)
    if block is None:
        ordered, _ = _group(keys, order)
        return df.withColumn(out, F.lag(value, 1, default).over(ordered))
    last_of_block = F.max_by(F.struct(F.col(value).alias("v")), F.struct(*order))
    joined = _with_carry(df, keys, block, last_of_block, F.last)
    ordered, _ = _group([*keys, block], order)
    first = F.row_number().over(ordered) == 1
    return (
        joined.withColumn("_first", first)
        .withColumn("_lag", F.lag(value).over(ordered))
        .withColumn(
            out,
            F.when(~F.col("_first"), F.col("_lag"))
            .when(F.col("_carry").isNull(), fallback)
            .otherwise(F.col("_carry")["v"]),
        )
        .drop("_first", "_lag", "_carry")
    )


def running_max(
    df: DataFrame,
    value: str,
    keys: Sequence[str],
    order: Sequence[str],
    out: str,
    block: str | None = None,
) -> DataFrame:
    """The largest value up to each row: repairs a cumulative series that drops."""
    if block is None:
        _, so_far = _group(keys, order)
        return df.withColumn(out, F.max(value).over(so_far))
    joined = _with_carry(df, keys, block, F.max(value), F.max)
    _, so_far = _group([*keys, block], order)
    return joined.withColumn(out, F.greatest(F.max(value).over(so_far), F.col("_carry"))).drop("_carry")


def clamped_delta(current: Column, previous: Column) -> Column:
    """What was added since the previous value, never below zero, as a float."""
    gained = (current - previous).cast("float")
    return F.when(gained < 0, F.lit(0.0).cast("float")).otherwise(gained)


def value_spans(df: DataFrame, keys: Sequence[str], at: str, value: str, since: str = "since", until: str = "until") -> DataFrame:
    """A running maximum as the spans it holds for: ``(keys, since, until, value)``.

    A span begins where the maximum rises and ends, exclusively, where the next
    begins; the last one is open (null).  Rows without a value or a place on the
    axis say nothing, and several of one place are one.  There is a row for each
    rise, however long the axis goes on.
    """
    known = df.where(F.col(value).isNotNull() & F.col(at).isNotNull())
    daily = known.groupBy(*keys, at).agg(F.max(value).alias("_value"))
    ordered, _ = _group(keys, [at])
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.max("_value").over(before)
    rises = daily.withColumn("_earlier", earlier).where(F.col("_earlier").isNull() | (F.col("_value") > F.col("_earlier")))
    return rises.select(*keys, F.col(at).alias(since), F.lead(at).over(ordered).alias(until), F.col("_value").alias(value))


def spans_at(spans: DataFrame, asked: DataFrame, at: str, since: str = "since", until: str = "until") -> DataFrame:
    """The spans that hold at the places ``asked`` for (column ``at``), one row for each span and place.

    The places travel as one sorted array, and a span unfolds the part of it that
    it covers: a range join without a product.  There are as many as dates on a
    report's axis, never more than a calendar has.
    """
    places = asked.where(F.col(at).isNotNull()).agg(F.sort_array(F.collect_set(at))).scalar()
    covered = F.filter("_places", lambda d: (d >= F.col(since)) & (F.col(until).isNull() | (d < F.col(until))))
    return spans.withColumn("_places", places).withColumn(at, F.explode(covered)).drop("_places", since, until)
