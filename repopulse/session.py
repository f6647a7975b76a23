"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Pin what results depend on (UTC) and what plans rely on (AQE)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as Spark itself is configured with it.

    The checkpoint folder where one is named, else the warehouse. On a cluster a
    warehouse that nobody named lies in the driver's own file system, which no other
    host can see; that is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    if warehouse.startswith("file:") and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return warehouse.rstrip("/")


def run_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder for one run below the shared folder.

    All folders of an application are removed when it ends.
    """
    root = f"{shared_dir(spark)}/repopulse/{spark.sparkContext.applicationId}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return f"{root}/{label}-{uuid.uuid4().hex}"


def folder_names(
    spark: SparkSession, path: str, prefix: str, required: bool = False
) -> list[str]:
    """What follows `prefix` in the names of the folders below `path`, in order.

    Only names are listed: one per partition, and no file is opened. A path that is
    absent has none, or is an error if `required`.
    """
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(folder):
        if required:
            raise FileNotFoundError(path)
        return []
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    return sorted(name.removeprefix(prefix) for name in names if name.startswith(prefix))


def claim_number(spark: SparkSession, path: str, prefix: str) -> int:
    """A number above those of the files `<prefix><number>` in a folder, claimed by creating its file.

    Creation fails if another host was faster; then the next number is tried.
    """
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(folder)
    number = max(map(int, folder_names(spark, path, prefix)), default=0) + 1
    while True:
        try:
            files.create(jvm.org.apache.hadoop.fs.Path(f"{path}/{prefix}{number}"), False).close()
            return number
        except Py4JJavaError as error:
            if "FileAlreadyExistsException" not in error.java_exception.getClass().getName():
                raise
            number += 1


def matching_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern of Hadoop's file systems."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(status.getPath().toString() for status in files.globStatus(path) or [])


def make_folder(spark: SparkSession, path: str) -> None:
    """An empty folder, whose name is all it tells."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(folder)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder that a newer one replaces."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def staged(spark: SparkSession, rows: DataFrame, label: str) -> DataFrame:
    """Rows written to the shared folder and read back.

    For results that several later steps read: none of them recomputes the rows,
    and losing an executor costs no more than its tasks.
    """
    path = run_dir(spark, label)
    rows.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


@contextmanager
def arrow_batches(session: SparkSession, size: int) -> Iterator[None]:
    """About `size` bytes at most in a batch that Python tasks get, for jobs that run inside.

    Spark's own limit is a number of rows, however long. A limit in bytes that the
    session already has stays.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if session.conf.get(name, None) is not None:
        yield
        return
    session.conf.set(name, str(size))
    try:
        yield
    finally:
        session.conf.unset(name)


# State in RocksDB, checkpointed as changes instead of whole copies. Idle
# batches would only evict state earlier, at the price of empty files.
STREAM_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


def stream_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """Session for stateful streams with a chosen number of state partitions.

    That number is fixed for the life of a checkpoint, so it is an argument; by
    default it follows the cores of the cluster.
    """
    session = configure(spark.newSession())
    partitions = state_partitions or spark.sparkContext.defaultParallelism
    session.conf.set("spark.sql.shuffle.partitions", str(partitions))
    for name, value in STREAM_SETTINGS.items():
        session.conf.set(name, value)
    return session


@contextmanager
def adaptive(session: SparkSession) -> Iterator[None]:
    """Adaptive execution for what a micro-batch callback derives from its batch.

    Spark turns it off for a stream, as the partitions of state must not change.
    The batch itself is planned before the callback starts, so joins and writes
    inside the callback may adapt: small sides broadcast, hot partitions split,
    and small files merge.
    """
    before = session.conf.get("spark.sql.adaptive.enabled")
    session.conf.set("spark.sql.adaptive.enabled", "true")
    try:
        yield
    finally:
        session.conf.set("spark.sql.adaptive.enabled", before)
