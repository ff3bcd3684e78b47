"""Profiles of tables and folders."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

#: Types whose least and greatest value Parquet keeps in the footers of a file, and those that have an order at all.
IN_FOOTERS = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DateType)
ORDERED = (*IN_FOOTERS, T.StringType, T.TimestampType, T.TimestampNTZType, T.DecimalType)
FORMATS = {"csv": "csv", "parquet": "parquet", "pq": "parquet"}


def profile_columns(df: DataFrame) -> DataFrame:
    """Type, nulls, least and greatest value of every column, in one pass over the table."""
    figures = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.count_if(F.col(f"`{f.name}`").isNull()).alias("null_count"),
            F.min(f"`{f.name}`").cast("string").alias("min_value"),
            F.max(f"`{f.name}`").cast("string").alias("max_value"),
            F.count("*").alias("row_count"),
            F.lit(len(df.columns)).alias("column_count"),
        ).alias(f"c{i}")
        for i, f in enumerate(df.schema.fields)
    ]
    row = df.agg(*figures)
    return row.select(F.explode(F.array(*row.columns)).alias("p")).select("p.*")


@contextmanager
def _footers_first(spark: SparkSession) -> Iterator[None]:
    """Aggregates without a filter are read from the footers of Parquet files while this lasts."""
    settings = {"spark.sql.parquet.aggregatePushdown": "true", "spark.sql.sources.useV1SourceList": ""}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def shown(value: Column, kind: T.DataType) -> Column:
    """A value as text that two engines print alike: numbers with ten digits, instants to the second."""
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.when(value.isNotNull(), F.format_string("%.9e", value.cast("double")))
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(value, "yyyy-MM-dd HH:mm:ss")
    return value.cast("string")


def _plain(kind: T.DataType) -> bool:
    return not isinstance(kind, (T.ArrayType, T.MapType, T.StructType))


def footer_counts(table: DataFrame) -> DataFrame:
    """One row: the rows (n) and the values of every column that is not nested (c0, c1, ...)."""
    fields = enumerate(table.schema.fields)
    return table.agg(F.count(F.lit(1)).alias("n"), *[F.count(F.col(f"`{f.name}`")).alias(f"c{i}") for i, f in fields if _plain(f.dataType)])


def bounds(table: DataFrame, places: list[int]) -> DataFrame:
    """One row: least and greatest value of the columns at these places (low0, high0, ...)."""
    named = [(i, F.col(f"`{table.schema.fields[i].name}`")) for i in places]
    return table.agg(*[side(c).alias(f"{name}{i}") for i, c in named for name, side in (("low", F.min), ("high", F.max))])


def profile_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """(table_name, column_name, data_type, row_count, null_count, min_value, max_value) for every column of a Parquet table.

    Row counts, null counts and the bounds of numbers and dates come from the footers; columns of other types are scanned
    for their bounds, and so are those of files whose footers lack them (of nulls alone, or written without statistics).
    Nested columns have no bounds. One row per column is all that reaches the driver.
    """
    table = spark.read.parquet(path)
    fields = table.schema.fields
    with _footers_first(spark):
        told = footer_counts(spark.read.parquet(path)).first().asDict()
    nested = [F.count(F.col(f"`{f.name}`")).alias(f"c{i}") for i, f in enumerate(fields) if not _plain(f.dataType)]
    if nested:
        told |= table.agg(*nested).first().asDict()
    filled = [i for i, f in enumerate(fields) if isinstance(f.dataType, ORDERED) and told[f"c{i}"]]
    known = [i for i in filled if isinstance(fields[i].dataType, IN_FOOTERS)]
    try:
        with _footers_first(spark):
            told |= bounds(spark.read.parquet(path), known).first().asDict() if known else {}
    except (PySparkException, Py4JError):  # a file says nothing of a column
        known = []
    scanned = [i for i in filled if i not in known]
    if scanned:
        told |= bounds(table, scanned).first().asDict()
    out = None
    for i, f in enumerate(fields):
        low, high = (
            shown(F.lit(told.get(f"{side}{i}")).cast(f.dataType), f.dataType) if isinstance(f.dataType, ORDERED) else F.lit(None).cast("string")
            for side in ("low", "high")
        )
        row = spark.range(1).select(
            F.lit(name).alias("table_name"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.lit(told["n"]).cast("bigint").alias("row_count"),
            F.lit(told["n"] - told[f"c{i}"]).cast("bigint").alias("null_count"),
            low.alias("min_value"),
            high.alias("max_value"),
        )
        out = row if out is None else out.unionByName(row)
    return out


def profile_sample(df: DataFrame, rows: int, order: list[str]) -> DataFrame:
    """The first rows in a stated order (a top-k, not a sort of the table)."""
    return df.orderBy(*order).limit(rows)


def profile_directory(spark: SparkSession, folder: str) -> DataFrame:
    """Size and format of every data file below a folder. File contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path", "length")
    suffix = F.lower(F.regexp_extract("path", r"\.([A-Za-z]+)$", 1))
    name = F.element_at(F.split("path", "/"), -1)
    kind = F.lit(None).cast("string")
    for end, fmt in FORMATS.items():
        kind = F.when(suffix == end, fmt).otherwise(kind)
    return files.select(name.alias("file_name"), kind.alias("format"), F.col("length").alias("size_bytes")).filter(
        F.col("format").isNotNull()
    )


def directory_totals(files: DataFrame) -> DataFrame:
    return files.agg(
        F.count("*").alias("files"),
        F.sum("size_bytes").alias("total_size_bytes"),
        F.count_if(F.col("format") == "csv").alias("csv_count"),
        F.count_if(F.col("format") == "parquet").alias("parquet_count"),
    )


def file_rows(df: DataFrame) -> DataFrame:
    """Rows per file of a table read from files."""
    return df.groupBy(F.element_at(F.split("_metadata.file_path", "/"), -1).alias("file_name")).agg(
        F.count("*").alias("row_count")
    )
