"""Shared scratch space for tables that mark a stage boundary."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it.

    Only a local session may go without the setting; it then gets a folder of
    its own. On a cluster a machine-local folder would lose data, so that raises.
    """
    configured = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    # The setting itself cannot change while a session runs; its context has the folder instead.
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="pixelframe-"))
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; no two calls share one."""
    return f"{shared_dir(spark)}/pixelframe/{name}-{uuid.uuid4().hex}"


# Files a task may hold open at once before it sorts its rows by partition value.
OPEN_WRITERS = 8


@contextmanager
def temporary_setting(spark: SparkSession, name: str, value: int) -> Iterator[None]:
    """A session setting for the length of a block."""
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def unsorted_writes(spark: SparkSession) -> AbstractContextManager[None]:
    """Let partitioned writes keep several files open instead of sorting each task's rows.

    A task that meets more partition values than that falls back to sorting.
    """
    name = "spark.sql.maxConcurrentOutputFileWriters"
    return temporary_setting(spark, name, max(OPEN_WRITERS, int(spark.conf.get(name))))


def materialize(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The result has no lineage above the files: a lost executor re-reads them.
    Joins on it start from plain shuffles, which is what adaptive execution
    needs to split a hot key.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with unsorted_writes(spark):
        df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(stored: DataFrame) -> None:
    """Remove the files of a table from ``materialize``, not partitioned, that nothing reads any more."""
    spark = stored.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in stored.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
        path.getFileSystem(conf).delete(path, True)
