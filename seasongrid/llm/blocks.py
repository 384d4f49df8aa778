"""Compare the members of cells pair by pair without gathering a large cell.

A cell of more than ``width`` members is cut into blocks; each pair of blocks
becomes one group of at most two blocks, and a member travels to the groups of
its block.  So a group is bounded whatever a cell holds, every pair of a cell
meets in a group, and the groups of a hot cell are spread over all tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seasongrid.llm.common import stored

WIDTH = 2048


def in_blocks(members: DataFrame, cell: str, member: str, width: int = WIDTH) -> DataFrame:
    """Members with ``part`` and ``block``, dealt out and sorted by cell and block.

    ``member`` tells members apart and spreads them over parts; ``part`` is -1 in
    a cell that is not cut, where ``block`` is 0.  Else ``block`` names two parts,
    the smaller in the upper bits.  Members of one part meet in several blocks.
    """
    sizes = members.groupBy(cell).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > width)
    large = sizes.select(F.col(cell).alias("_cell"), F.ceil(F.col("_n") / width).cast("int").alias("_blocks"))
    large = stored(large, "large-cells")  # few, so that Spark mostly need not move the members for this join
    joined = members.join(large, members[cell] == large["_cell"], "left").drop("_cell")
    pairs = F.expr(
        "if(_blocks is null, array(0L), transform(filter(sequence(0, _blocks - 1), x -> x != part),"
        " x -> shiftleft(bigint(least(x, part)), 31) + greatest(x, part)))"
    )
    return (
        joined.withColumn("part", F.coalesce(F.pmod(F.xxhash64(member), F.col("_blocks")).cast("int"), F.lit(-1)))
        .withColumn("block", F.explode(pairs))
        .drop("_blocks")
        .repartition(cell, "block")
        .sortWithinPartitions(cell, "block")
    )
