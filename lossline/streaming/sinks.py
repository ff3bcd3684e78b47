"""Batch-id keyed sinks: a micro-batch that runs again replaces what it wrote before."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from lossline.operators import events as ev
from lossline.session import materialise

BATCH = "batch_id"


def append_batches(path: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch function that appends to a table of one folder per batch, created if missing."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")

    return write


def latest(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Of an update-mode sink read back, the row of the last batch for each key."""
    rest = [c for c in rows.columns if c not in keys]
    last = F.max_by(F.struct(*rest), BATCH).alias("last")
    return rows.groupBy(*keys).agg(last).select(*keys, *[f"last.{c}" for c in rest])


def upsert_batches(path: str, keys: list[str], day: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch function that keeps one row per key: the one of the last batch that said something of it.

    The table has a folder per day of the column `day` (part of the key); a batch reads and overwrites the days it speaks
    of, so neither a batch nor a reader meets the updates of the past. A batch that runs again replaces its own rows.
    """
    folder = f"{day}_day"

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = materialise(batch.withColumn(folder, F.date_format(day, "yyyy-MM-dd")), "batch")
        days = [r[0] for r in rows.select(folder).distinct().collect()]  # names of the folders that are written
        if not days:
            return
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
        if hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
            held = spark.read.schema(rows.schema).parquet(path).filter(F.col(folder).isin(days))
            said = rows.select(*[F.col(k).alias(f"_{i}") for i, k in enumerate(keys)])
            same = [F.col(k).eqNullSafe(F.col(f"_{i}")) for i, k in enumerate(keys)]
            rows = materialise(held.join(said, same, "left_anti").unionByName(rows), "merged")
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(folder).parquet(path)

    return write


def route_batches(
    valid_path: str, dead_path: str, subscribers: dict[str, dict[str, list[str]]] | None = None
) -> Callable[[DataFrame, int], None]:
    """foreachBatch function that writes valid events and dead letters of judged events.

    subscribers maps a path to the field values it wants; each gets its share of the valid
    events. The batch is kept while it is written, so its text is parsed once.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            valid = ev.valid_events(batch)
            append_batches(valid_path)(valid, batch_id)
            append_batches(dead_path)(ev.dead_letters(batch), batch_id)
            for path, wanted in (subscribers or {}).items():
                append_batches(path)(ev.filter_attributes(valid, **wanted), batch_id)
        finally:
            batch.unpersist()

    return write


def route_late(on_time_path: str, late_path: str, processed_at: Column | None = None) -> Callable[[DataFrame, int], None]:
    """foreachBatch function for events with lateness_seconds: late ones to a table of their own, the others to on_time_path.

    The batch is kept while it is written, so state is read once and both tables come from the same rows.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            late = F.col("lateness_seconds").isNotNull()
            append_batches(on_time_path)(batch.filter(~late).drop("lateness_seconds"), batch_id)
            found = batch.filter(late).select(
                "claim_id",
                F.col("event_time").alias("original_timestamp"),
                F.col("arrival_ts").alias("arrival_timestamp"),
                "lateness_seconds",
                F.col("value").alias("raw_data"),
                (F.current_timestamp() if processed_at is None else processed_at).alias("processing_timestamp"),
            )
            append_batches(late_path)(found, batch_id)
        finally:
            batch.unpersist()

    return write
