"""One row per key, and exact copies as counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_COPIES_PER_ROW = 1 << 16


def first_per_group(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """Keep the first row of each group under ``order``.

    ``order`` has to be total for a repeatable result.  The ``rn = 1`` filter
    lets Spark cut every map task to one row per key ahead of the shuffle, so
    a hot key costs one row per task and not its whole group.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rn", rank).where("_rn = 1").drop("_rn")


def collapse_copies(df: DataFrame, count: str = "copies") -> DataFrame:
    """Equal rows become one row with their number, combined map-side."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(count))


def expand_copies(df: DataFrame, count: str, number: str) -> DataFrame:
    """Undo :func:`collapse_copies`; ``number`` counts the copies from 1.

    Rows are unfolded where they are.  Only a count too large for one array is
    cut into blocks, and only those blocks move, spread over all tasks by a
    fixed number of partitions, since adaptive execution would join the few
    bytes of blocks in one.
    """
    times, width = F.col(count), F.lit(_COPIES_PER_ROW).cast("long")
    few = df.where(times <= width).withColumn(number, F.explode(F.sequence(F.lit(1).cast("long"), times)))
    last_block = F.expr(f"({count} - 1) div {_COPIES_PER_ROW}L")
    blocks = df.where(times > width).withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), last_block)))
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = blocks.repartition(tasks, *[F.col(c) for c in blocks.columns])
    first, last = F.col("_block") * width + 1, F.least((F.col("_block") + 1) * width, times)
    many = spread.withColumn(number, F.explode(F.sequence(first, last))).drop("_block")
    return few.unionByName(many).drop(count)
