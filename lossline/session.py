"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A skewed join is split even where that costs one more shuffle afterwards.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Bounds the rows that one task aggregates and sorts: keys alone are packed to few bytes in a shuffle, so the usual
    # 64 MB may be more than ten million of them, held in every aggregate of the task.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
}

#: Partitions a shuffle begins with at least, so that large ones can keep to that size; Spark joins small ones again.
INITIAL_PARTITIONS = 512


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings. Cluster sizing (memory, least partitions) stays with the submitter."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    partitions = max(INITIAL_PARTITIONS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(partitions))
    return spark


def configure_state_store(spark: SparkSession) -> SparkSession:
    """Stateful streaming operators keep their state in RocksDB, not on the executor heap; sessions are merged before a shuffle."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    spark.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    return spark


#: Whether shuffle files go when their query has ended, instead of when the driver happens to collect its garbage.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Writes inside leave no shuffle files behind them. Nothing else should run an action twice on one DataFrame meanwhile."""
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(DROP_SHUFFLES)
        else:
            spark.conf.set(DROP_SHUFFLES, before)


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the cluster in spark.checkpoint.dir.

    Only a session in one process (a local test run) that names none gets a fresh local folder; on a cluster that would
    be another folder on every machine, so it is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="lossline-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; no two calls return the same one."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write a table that several later passes read to the shared folder, and read it from there.

    Cuts the lineage at a fan-out point; the files outlive the executors that wrote them.
    """
    path = work_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
