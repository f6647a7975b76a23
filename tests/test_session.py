from __future__ import annotations

from types import SimpleNamespace

import pytest

from repopulse.session import adaptive, arrow_batches, run_dir, shared_dir, staged, stream_session


def session_with(named=None, context_dir=None, warehouse="file:///warehouse", master="local[8]"):
    """Just what `shared_dir` asks a session for."""
    settings = {"spark.checkpoint.dir": named, "spark.sql.warehouse.dir": warehouse}
    context = SimpleNamespace(getCheckpointDir=lambda: context_dir, master=master)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda k, *_: settings[k]), sparkContext=context)


def test_the_folder_the_cluster_names_is_used():
    assert shared_dir(session_with("hdfs:///shared/")) == "hdfs:///shared"
    assert shared_dir(session_with(None, "hdfs:///set")) == "hdfs:///set"
    assert shared_dir(session_with()) == "file:///warehouse"
    assert shared_dir(session_with(warehouse="s3a://shared/", master="yarn")) == "s3a://shared"
    with pytest.raises(ValueError):
        shared_dir(session_with(master="yarn"))


def test_every_run_has_a_folder_of_its_own(spark):
    assert run_dir(spark, "x") != run_dir(spark, "x")


def test_staged_rows_keep_their_schema_and_lose_their_lineage(spark):
    rows = spark.range(5).selectExpr("id", "cast(id as string) as name")
    found = staged(spark, rows, "test")
    assert found.dtypes == rows.dtypes and found.count() == 5
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Range" not in plan and "FileScan parquet" in plan


def test_stream_session_leaves_the_given_one_alone(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    session = stream_session(spark, state_partitions=7)
    assert session.conf.get("spark.sql.shuffle.partitions") == "7"
    assert "RocksDB" in session.conf.get("spark.sql.streaming.stateStore.providerClass")
    assert session.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_adaptive_is_switched_back_even_after_an_error(spark):
    session = spark.newSession()
    session.conf.set("spark.sql.adaptive.enabled", "false")
    with pytest.raises(OSError):
        with adaptive(session):
            assert session.conf.get("spark.sql.adaptive.enabled") == "true"
            raise OSError
    assert session.conf.get("spark.sql.adaptive.enabled") == "false"


def test_the_limit_of_arrow_batches_ends_with_its_jobs(spark):
    session, name = spark.newSession(), "spark.sql.execution.arrow.maxBytesPerBatch"
    with pytest.raises(OSError):
        with arrow_batches(session, 1000):
            assert session.conf.get(name) == "1000"
            raise OSError
    assert session.conf.get(name, None) is None
    session.conf.set(name, "500")
    with arrow_batches(session, 1000):
        assert session.conf.get(name) == "500"
    assert session.conf.get(name) == "500"
