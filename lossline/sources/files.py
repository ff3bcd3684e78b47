"""File sources: declared schemas, folders and globs, and folders watched for new files."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from lossline.sources.schemas import RAW_SCHEMAS

READABLE = ("csv", "parquet", "pq")


def read_csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """CSV with a header. Types are declared; inference is for exploration only."""
    reader = spark.read.option("header", True)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).option("mode", "FAILFAST").option("enforceSchema", False).csv(path)


def load_raw_tables(
    spark: SparkSession, folder: str, fmt: str = "csv", schemas: Mapping[str, str] = RAW_SCHEMAS
) -> dict[str, DataFrame]:
    """The raw tables of a folder holding <table>.<fmt>; a missing one raises AnalysisException."""
    if fmt not in ("csv", "parquet"):
        raise ValueError(f"unknown format: {fmt}")
    found = {}
    for name, schema in schemas.items():
        path = f"{folder}/{name}.{fmt}"
        found[f"raw_{name}"] = read_csv(spark, path, schema) if fmt == "csv" else spark.read.parquet(path)
    return found


def read_glob(spark: SparkSession, path: str, schema: str, fmt: str) -> DataFrame:
    """All files of a format below a file, folder or glob, with the file each row came from."""
    if fmt not in READABLE:
        raise ValueError(f"cannot read {fmt}: only {', '.join(READABLE)}")
    ends = "*.csv*" if fmt == "csv" else "*.{parquet,pq}"
    reader = spark.read.schema(schema).option("pathGlobFilter", ends).option("recursiveFileLookup", True)
    rows = reader.option("header", True).csv(path) if fmt == "csv" else reader.parquet(path)
    return rows.withColumn("source_file", F.col("_metadata.file_path"))


def read_folder(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All csv and parquet files below a folder or glob as one table, with format and source_file of each row.

    schema holds for both; a format without any file adds no rows.
    """
    both = [read_glob(spark, path, schema, fmt).withColumn("format", F.lit(fmt)) for fmt in ("csv", "parquet")]
    return both[0].unionByName(both[1])


def new_files(spark: SparkSession, folder: str, schema: str, checkpoint: str, sink) -> StreamingQuery:
    """Hand files not seen before to sink(batch, batch_id), then stop.

    The checkpoint remembers the files, so a second call sees only what arrived since.
    """
    rows = (
        spark.readStream.schema(schema).option("header", True).option("pathGlobFilter", "*.csv").csv(folder)
    ).withColumn("source_file", F.col("_metadata.file_name"))
    query = (
        rows.writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
