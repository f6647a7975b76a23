from __future__ import annotations

import os
import sys
import uuid
from pathlib import Path

import pytest
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from repopulse.session import configure  # noqa: E402
from repopulse.sources.tables import Tables  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path / uuid.uuid4().hex)


@pytest.fixture
def tables(folder):
    return Tables(f"{folder}/tables")


def records(rows: DataFrame, *columns: str) -> list[tuple]:
    """Rows as sorted tuples of the named columns, or of all of them."""
    picked = rows.select(*columns) if columns else rows
    return sorted((tuple(row) for row in picked.collect()), key=repr)
