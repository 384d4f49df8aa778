"""Where a load keeps its tables: in folders, or under names of the catalog.

A load stages: each table is written to a folder of its own beside the old
files, and read back from there by the steps that follow.  ``publish`` makes all
of it visible at the end.  A load that fails before has changed nothing.

* ``FolderStore`` moves the staged files into place, a rename for each season.
  Formats that keep a log of their files are replaced by the format itself.
* ``CatalogStore`` points the catalog's partitions to the staged folders, so a
  season changes in one step, no file moves, and queries that run on the old
  files can finish.  ``drop_unused`` deletes folders no partition refers to.

Tables are read with their declared schema: no footer is read for it, and files
of an earlier version show the defaults of columns they lack.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seasongrid.schemas import Schemas, partition_column
from seasongrid.sources import sinks
from seasongrid.sources.files import Folder


#: The name of the partition of rows without a season.
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


@dataclass
class Staged:
    path: str
    by: str | None
    seasons: list[int] | None  # all if None


def conform(df: DataFrame, schema: T.StructType | None) -> DataFrame:
    """The declared columns in their types; one that is missing or null gets its default, if it has one."""
    if schema is None:
        return df

    def column(field: T.StructField):
        default = F.expr(field.metadata.get("CURRENT_DEFAULT", "NULL")).cast(field.dataType)
        own = F.col(field.name).cast(field.dataType) if field.name in df.columns else default
        return (F.coalesce(own, default) if field.metadata else own).alias(field.name)

    return df.select(*[column(field) for field in schema.fields])


class Store:
    """What both kinds share: staging, and reads that see what is staged."""

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet", schemas: Schemas = Schemas()) -> None:
        self.spark, self.root, self.fmt, self.schemas = spark, root.rstrip("/"), fmt, schemas
        self.staged: dict[str, Staged] = {}
        self._begun: list[str] = []

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    # -- for the two kinds to say

    def exists(self, name: str) -> bool:
        raise NotImplementedError

    def published(self, name: str) -> DataFrame:
        raise NotImplementedError

    def publish(self) -> None:
        raise NotImplementedError

    # -- reads

    def _scan(self, path: str, name: str) -> DataFrame:
        reader = self.spark.read.format(self.fmt)
        schema = self.schemas.table(name)
        return (reader if schema is None else reader.schema(schema)).load(path)

    def read(self, name: str, seasons: Sequence[int] | None = None) -> DataFrame:
        """A table as it will be after ``publish``; ``seasons`` prunes partitions."""
        staged, by = self.staged.get(name), partition_column(name)
        if staged is None:
            table = self.published(name)
        else:
            table = self._scan(staged.path, name)
            others = None if seasons is None or staged.seasons is None else set(seasons) - set(staged.seasons)
            if staged.seasons is not None and others != set() and self.exists(name):
                old = self.published(name)
                others_of = old.where(F.col(by).isNull() | ~F.col(by).isin(staged.seasons))
                table = others_of.unionByName(table.select(old.columns))
        return table if seasons is None else table.where(F.col(by).isin(list(seasons)))

    # -- writes

    def replace(self, name: str, df: DataFrame, seasons: Sequence[int] | None = None, arrange: bool = True) -> None:
        """Stage the whole table, or the given seasons of it, also those without a row."""
        by = partition_column(name)
        rows = conform(df, self.schemas.table(name))
        path = f"{self.path(name)}/_load-{uuid.uuid4().hex}"
        self._begun.append(path)
        writer = (sinks.balanced(rows, [by]) if by and arrange else rows).write.format(self.fmt)
        (writer.partitionBy(by) if by else writer).save(path)
        staged = Staged(path, by, None)
        if seasons is not None and by is not None:  # those that rows came for are replaced too
            staged.seasons = sorted({*seasons, *(int(v) for v in self._folders(staged) if v.isdigit())})
        self.staged[name] = staged

    def discard(self) -> None:
        """Drop what is staged, also what a failed write left."""
        for path in self._begun:
            Folder(self.spark, path).delete()
        self._forget()

    def _forget(self) -> None:
        self.staged.clear()
        self._begun.clear()

    def _folders(self, staged: Staged) -> dict[str, Folder]:
        """The staged partitions, by the value in their folder's name."""
        folders = Folder(self.spark, staged.path).folders()
        return {f.name.split("=", 1)[1]: f for f in folders if f.name.startswith(f"{staged.by}=")}


class FolderStore(Store):
    """Tables below one folder."""

    @property
    def plain(self) -> bool:
        return self.fmt in sinks.PLAIN_FORMATS

    def exists(self, name: str) -> bool:
        return bool(Folder(self.spark, self.path(name)).visible())

    def published(self, name: str) -> DataFrame:
        return self._scan(self.path(name), name)

    def replace(self, name: str, df: DataFrame, seasons: Sequence[int] | None = None, arrange: bool = True) -> None:
        if self.plain:
            super().replace(name, df, seasons, arrange)
            return
        by, rows = partition_column(name), conform(df, self.schemas.table(name))
        if by is None or seasons is None:
            sinks.overwrite_table(rows, self.path(name), self.fmt, [by] if by else [])
        else:
            sinks.overwrite_seasons(rows, self.path(name), [by], arrange, self.fmt, seasons)

    def publish(self) -> None:
        """Move staged files into place; the old ones of a season step aside first and go last."""
        for name, staged in self.staged.items():
            table, source = Folder(self.spark, self.path(name)), Folder(self.spark, staged.path)
            new = source.visible()
            if staged.seasons is None:
                old = table.visible()
            else:
                leaving = {f"{staged.by}={season}" for season in staged.seasons} | {f.name for f in new}
                old = [entry for entry in table.visible() if entry.name in leaving]
            aside = table.child(f"_old-{uuid.uuid4().hex}")
            for entry in old:
                entry.move(aside)
            for entry in new:
                entry.move(table)
            aside.delete()
            source.delete()
        self._forget()


class CatalogStore(Store):
    """Tables named ``{prefix}{table}`` in the catalog, their files below ``root``."""

    def __init__(
        self, spark: SparkSession, root: str, prefix: str, fmt: str = "parquet", schemas: Schemas = Schemas()
    ) -> None:
        super().__init__(spark, root, fmt, schemas)
        self.prefix = prefix

    def table(self, name: str) -> str:
        return f"{self.prefix}{name}"

    def exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(self.table(name))

    def published(self, name: str) -> DataFrame:
        return conform(self.spark.table(self.table(name)), self.schemas.table(name))

    def publish(self) -> None:
        for name, staged in self.staged.items():
            self._define(name, staged)
            if staged.by is None:
                self.spark.sql(f"ALTER TABLE {self.table(name)} SET LOCATION '{staged.path}'")
            else:
                self._switch(name, staged)
            self.spark.catalog.refreshTable(self.table(name))
        self._forget()

    def _define(self, name: str, staged: Staged) -> None:
        """The table, or the columns it lacks."""
        schema = self.schemas.table(name) or self._scan(staged.path, name).schema

        def definition(field: T.StructField) -> str:
            default = field.metadata.get("CURRENT_DEFAULT")
            return f"`{field.name}` {field.dataType.simpleString()}" + (f" DEFAULT {default}" if default else "")

        if not self.exists(name):
            columns = ", ".join(definition(field) for field in schema.fields)
            by = f"PARTITIONED BY ({staged.by})" if staged.by else ""
            self.spark.sql(f"CREATE TABLE {self.table(name)} ({columns}) USING {self.fmt} {by} LOCATION '{self.path(name)}'")
            return
        known = {column.lower() for column in self.spark.table(self.table(name)).columns}
        more = [definition(field) for field in schema.fields if field.name.lower() not in known]
        if more:
            self.spark.sql(f"ALTER TABLE {self.table(name)} ADD COLUMNS ({', '.join(more)})")

    def _partitions(self, name: str) -> set[str]:
        return {row[0].split("=", 1)[1] for row in self.spark.sql(f"SHOW PARTITIONS {self.table(name)}").collect()}

    def _switch(self, name: str, staged: Staged) -> None:
        """Point each staged partition to its new folder; one that ended without a row leaves the table."""
        table, new, old = self.table(name), self._folders(staged), self._partitions(name)
        leaving = old if staged.seasons is None else old & {str(season) for season in staged.seasons}
        for value, folder in new.items():
            spec = f"PARTITION ({staged.by}={'null' if value == _NO_VALUE else value})"
            how = f"ALTER TABLE {table} {spec} SET" if value in old else f"ALTER TABLE {table} ADD {spec}"
            self.spark.sql(f"{how} LOCATION '{folder.path}'")
        for value in leaving - set(new):
            self.spark.sql(f"ALTER TABLE {table} DROP PARTITION ({staged.by}={value})")

    def location(self, name: str, value: str | None = None) -> str:
        """Where the catalog says a table, or a partition of it, lies."""
        what = f"{self.table(name)} PARTITION ({partition_column(name)}={value})" if value else self.table(name)
        rows = self.spark.sql(f"DESCRIBE FORMATTED {what}").where("col_name = 'Location'").select("data_type").collect()
        return rows[0][0]

    def drop_unused(self, name: str) -> int:
        """Delete the load folders that the catalog does not refer to; call it when no query reads old files."""
        values = self._partitions(name) if partition_column(name) else [None]
        used = {self.location(name, value) for value in values}
        loads = [f for f in Folder(self.spark, self.path(name)).folders() if f.name.startswith("_load-")]
        unused = [f for f in loads if not any(f"/{f.name}" in place for place in used)]
        for folder in unused:
            folder.delete()
        return len(unused)
