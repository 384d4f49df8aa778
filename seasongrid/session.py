"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "seasongrid", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the plans are tuned for.

    Nothing here is required for right results: the builders pass write
    options themselves and never rely on session state.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, for tables that are written and read again.

    It is named by ``spark.checkpoint.dir``.  Where that is unset it lies below
    the warehouse, which all executors share as well.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    return root or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new folder for written tables, below one folder per application."""
    return f"{run_root(spark)}/{name}-{uuid.uuid4().hex}"


def run_root(spark: SparkSession) -> str:
    return f"{shared_root(spark).rstrip('/')}/{spark.sparkContext.applicationId}"


def clear_run(spark: SparkSession) -> None:
    """Delete what this application has written by :func:`fresh_dir`; call it at the end of a run."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(run_root(spark))
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
