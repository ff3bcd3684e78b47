"""Helpers shared by the operators: columns by position, shared folder, ranks over the whole table."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from lossline.session import configure, materialise

#: Rows that one Python step handles at once; bounds its memory together with SLICE_BYTES.
SLICE_ROWS, SLICE_BYTES = 4096, 1 << 20


#: Rows and bytes that Spark hands to a Python step at once: texts are long, and a batch is held several times.
BATCH_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
}


def settle(spark: SparkSession) -> None:
    """Apply the settings that the operators rely on to the session."""
    configure(spark)
    for key, value in BATCH_SETTINGS.items():
        spark.conf.set(key, value)


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns. Matched by exact name and position, so other columns may clash with them or with ours."""
    at = [df.columns.index(name) for name in names]
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return plain.select(*[F.col(f"c{i}").alias(name) for i, name in zip(at, names)])


def hidden(df: DataFrame, *names: str) -> tuple[DataFrame, list[str], list[str]]:
    """Every column under a name of its own (c0, c1, ...), the original names, and the new names of those asked for."""
    plain = [f"c{i}" for i in range(len(df.columns))]
    return df.toDF(*plain), df.columns, [plain[df.columns.index(name)] for name in names]


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into pieces of few rows and bytes (one long text may exceed the bytes alone)."""
    for batch in batches:
        sizes = batch.column(batch.schema.names.index(text)).nbytes
        rows = max(1, min(SLICE_ROWS, int(limit / max(1.0, sizes / max(1, batch.num_rows)))))
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    pa.default_memory_pool().release_unused()  # the worker lives on for other stages


def write(df: DataFrame, name: str) -> DataFrame:
    """A table in the shared folder that later steps read; executors may be lost afterwards."""
    return materialise(df, name)


def parts(df: DataFrame) -> int:
    """As many partitions as the session deals shuffles out to."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def ranked(df: DataFrame, rank: str, *order) -> DataFrame:
    """Number all rows from 0 by a total order, without bringing them to one task.

    Rows are dealt out by range and sorted; the position in the partition plus the rows of the partitions before it
    is the rank. The sorted rows are written first, so that a lost task cannot change a number that was already used.
    Only one row per partition is sorted in one place.
    """
    placed = write(
        df.repartitionByRange(parts(df), *order)
        .sortWithinPartitions(*order)
        .withColumn("__place", F.monotonically_increasing_id()),
        "ranked",
    )
    part, at = F.shiftright("__place", 33), F.col("__place").bitwiseAND(F.lit((1 << 33) - 1))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        placed.groupBy(part.alias("__part"))
        .agg(F.count(F.lit(1)).alias("__rows"))
        .select("__part", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before"))
    )
    # One row per partition: a size known from the session, whatever the rows.
    joined = placed.withColumn("__part", part).withColumn("__at", at).join(F.broadcast(totals), "__part")
    return joined.withColumn(rank, F.col("__before") + F.col("__at")).drop("__place", "__part", "__at", "__before")
