from __future__ import annotations

import datetime as dt
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from seasongrid.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "seasongrid-tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def day(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def rows(df, *columns: str) -> list[tuple]:
    """Rows as tuples of the given columns, sorted, nulls first."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: [(v is not None, v) for v in r])


@pytest.fixture(scope="session")
def make(spark):
    """Small frames from rows, with a declared schema."""

    def build(schema: str, *data: tuple):
        return spark.createDataFrame(list(data), schema)

    return build
