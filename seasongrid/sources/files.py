"""Folders of any file system Spark can write to."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Folder:
    """A path, whether anything is there or not."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        context = spark.sparkContext
        self._path = context._jvm.org.apache.hadoop.fs.Path(path)
        self._system = self._path.getFileSystem(context._jsc.hadoopConfiguration())

    @property
    def name(self) -> str:
        return self._path.getName()

    def child(self, name: str) -> Folder:
        return Folder(self.spark, f"{self.path}/{name}")

    def _entries(self) -> list:
        return list(self._system.listStatus(self._path)) if self._system.exists(self._path) else []

    def folders(self) -> list[Folder]:
        return [self.child(e.getPath().getName()) for e in self._entries() if e.isDirectory()]

    def visible(self) -> list[Folder]:
        """Files and folders that a scan of this one reads."""
        names = [e.getPath().getName() for e in self._entries()]
        return [self.child(n) for n in names if not n.startswith(("_", "."))]

    def files(self) -> set[str]:
        """Names of all files below, those of nested folders too."""
        found: set[str] = set()
        if self._system.exists(self._path):
            listed = self._system.listFiles(self._path, True)
            while listed.hasNext():
                found.add(listed.next().getPath().toString())
        return found

    def delete(self) -> None:
        self._system.delete(self._path, True)

    def move(self, into: Folder) -> None:
        """Into a folder, which is made if need be."""
        self._system.mkdirs(into._path)
        if not self._system.rename(self._path, into.child(self.name)._path):
            raise OSError(f"{self.path} could not be moved to {into.path}")
