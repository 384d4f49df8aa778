"""Three-letter display codes that stay distinct between race names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seasongrid.functions.text import code3


def _names(df: DataFrame, name: str) -> DataFrame:
    return df.select(F.col(name).alias("_name")).distinct().withColumn("_code", code3(F.col("_name")))


def names_per_code(df: DataFrame, name: str, out: str = "Distinct_GPs") -> DataFrame:
    """Each row with the number of different names that share its code.

    Only the distinct names meet by code; rows are joined by their name, so a
    popular code gathers no rows anywhere.
    """
    names = _names(df, name)
    counts = names.groupBy(F.col("_code").alias("_shared")).agg(F.count("_name").cast("int").alias(out))
    named = names.join(counts, F.col("_code").eqNullSafe(F.col("_shared")), "left").select("_name", out)
    joined = df.withColumn("Default_Code", code3(F.col(name))).join(named, F.col(name).eqNullSafe(F.col("_name")), "left")
    return joined.drop("_name")


def display_code(df: DataFrame, name: str, alternative: str, out: str = "GP_Display") -> DataFrame:
    """The code of ``name``, or of ``alternative`` where several names share it.

    The check spans all seasons, so a new season can change codes of old ones.
    Whether a code is shared needs no count: its smallest and largest name differ.
    """
    names = _names(df, name)
    shared = names.groupBy("_code").agg((F.min("_name") != F.max("_name")).alias("_shared")).where("_shared")
    named = names.join(shared, "_code").select("_name", "_shared")
    return df.join(named, F.col(name) == F.col("_name"), "left").select(
        *df.columns,
        F.when(F.col("_shared"), code3(F.col(alternative))).otherwise(code3(F.col(name))).alias(out),
    )
