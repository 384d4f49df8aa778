"""Checks on the star schema: as tables of offending keys, or counted while a table is written."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def orphan_keys(facts: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Fact keys without a dimension row, with their number of fact rows.

    Facts are reduced to their distinct keys before the join, so a hot key is
    one row there.  A null key refers to nothing and is no orphan.
    """
    used = facts.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    return used.join(dimension.select(key), key, "left_anti")


# ---- counted in the pass that writes a table --------------------------------


@dataclass(frozen=True)
class Limits:
    """How many rows of a load may break a rule; ``None`` only counts them."""

    duplicate_keys: int | None = None
    orphan_keys: int | None = None


class LoadRejected(ValueError):
    """A load broke its limits; what it staged was not published."""


@dataclass
class Watch:
    """Counts of a load, by table: ``rows``, ``duplicate_keys``, and ``orphans_<key>`` of each key looked up."""

    limits: Limits = Limits()
    observed: dict[str, Observation] = field(default_factory=dict)

    def dimension(self, name: str, df: DataFrame, key: str) -> DataFrame:
        """``df`` as it is; rows beyond the first of a key are counted when it is written."""
        number = F.row_number().over(Window.partitionBy(key).orderBy(F.lit(0)))
        return self._counted(name, df.withColumn("_number", number), df.columns, duplicate_keys=F.col("_number") > 1)

    def fact(self, name: str, df: DataFrame, dimensions: Mapping[str, DataFrame]) -> DataFrame:
        """``df`` as it is; rows whose key no dimension row has are counted when it is written.

        A null key refers to nothing and is no orphan.  Dimensions are reduced to
        their distinct keys; their size decides how Spark joins them.
        """
        looked, broken = df, {}
        for key, dimension in dimensions.items():
            known = dimension.select(F.col(key).alias(f"_{key}"), F.lit(True).alias(f"_has_{key}")).distinct()
            looked = looked.join(known, F.col(key) == F.col(f"_{key}"), "left")
            broken[f"orphans_{key}"] = F.col(key).isNotNull() & F.col(f"_has_{key}").isNull()
        return self._counted(name, looked, df.columns, **broken)

    def _counted(self, name: str, df: DataFrame, columns: Sequence[str], **broken: Column) -> DataFrame:
        observation = self.observed[name] = Observation()
        counts = [F.count_if(rule).alias(rule_name) for rule_name, rule in broken.items()]
        return df.observe(observation, F.count(F.lit(1)).alias("rows"), *counts).select(*columns)

    def counts(self) -> dict[str, dict[str, int]]:
        """All counts; the tables have to be written."""
        return {name: {k: v or 0 for k, v in observation.get.items()} for name, observation in self.observed.items()}

    def enforce(self) -> dict[str, dict[str, int]]:
        """The counts, or an error that names the tables beyond the limits."""
        counts = self.counts()
        broken = []
        for name, of in counts.items():
            for rule, n in of.items():
                limit = self.limits.duplicate_keys if rule == "duplicate_keys" else self.limits.orphan_keys
                if rule != "rows" and limit is not None and n > limit:
                    broken.append(f"{name}: {n} {rule}, {limit} allowed")
        if broken:
            raise LoadRejected("; ".join(broken))
        return counts
