"""Table sinks: full refresh, export, partitioned layout, partition backfill, compaction."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from lossline.session import materialise

log = logging.getLogger(__name__)

TARGET_FILE_BYTES = 512 * 1024 * 1024

WAREHOUSE_EXPORTS = (
    "dim_date",
    "dim_policyholder",
    "dim_policy",
    "dim_coverage",
    "fct_claims",
    "fct_claim_payments",
    "rpt_loss_triangle",
    "rpt_claim_frequency",
)
PRICING_EXPORTS = (
    "feat_policy_experience",
    "feat_risk_segments",
    "feat_historical_benchmarks",
    "model_training_set",
    "model_predictions",
    "model_scoring",
    "model_evaluation",
)
# Year column source and sort columns of the partitioned tables.
LAYOUT = {
    "stg_claims": ("accident_date", ["claim_status", "cause_of_loss"]),
    "stg_claim_payments": ("payment_date", ["payment_type"]),
    "int_claims_enriched": ("accident_date", ["coverage_type", "claim_status"]),
    "int_claim_payments_cumulative": ("payment_date", ["coverage_type", "payment_type"]),
    "fct_claims": ("accident_date", ["coverage_type", "claim_status"]),
    "fct_claim_payments": ("payment_date", ["coverage_type", "payment_type"]),
}


def full_refresh(df: DataFrame, path: str) -> DataFrame:
    """Replace a table."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def export_csv(tables: Mapping[str, DataFrame], folder: str, must: bool = True) -> dict[str, str]:
    """One CSV folder with header per table. With must=False a failing table is logged and left out."""
    paths = {}
    for name, table in tables.items():
        path = f"{folder}/{name}"
        try:
            table.write.mode("overwrite").option("header", True).csv(path)
            paths[name] = path
        except PySparkException as error:
            if must:
                raise
            log.warning("could not export %s: %s", name, error)
    return paths


def write_partitioned(
    df: DataFrame, path: str, day: str, cluster: Sequence[str], mode: str = "overwrite"
) -> DataFrame:
    """A table partitioned by the year of a date and sorted by the cluster columns inside each file.

    Rows are rebalanced by year: a large year is cut into as many tasks as its bytes ask for, small ones share one.
    """
    year = f"{day}_year"
    rows = df.withColumn(year, F.year(day))
    (
        rows.hint("rebalance", F.col(year))
        .sortWithinPartitions(year, *cluster)
        .write.mode(mode)
        .partitionBy(year)
        .parquet(path)
    )
    return df.sparkSession.read.schema(rows.schema).parquet(path)


def backfill_partitions(df: DataFrame, path: str, partition: str) -> None:
    """Replace exactly the partitions df has rows for; a repeated run changes nothing."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


def compact(spark: SparkSession, source: str, target: str, file_bytes: int = TARGET_FILE_BYTES) -> int:
    """Rewrite a folder of many files as few large ones; returns the number of files asked for."""
    size = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", True)
        .load(source)
        .agg(F.sum("length").alias("bytes"))
        .first()["bytes"]
    )
    files = max(1, -(-(size or 0) // file_bytes))
    spark.read.parquet(source).repartition(files).write.mode("overwrite").parquet(target)
    return files


# --- compaction in place ------------------------------------------------------------------------


def _files(spark: SparkSession, path: str) -> DataFrame:
    """path, folder and length of the data files below a folder; hidden ones and those in hidden folders are no data."""
    found = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).load(path).select("path", "length")
    )
    return found.withColumn("folder", F.regexp_replace("path", "/[^/]*$", "")).filter(~F.col("path").rlike("/[_.][^/=]*/"))


def _file_system(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs
    return hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration()), hadoop.Path


def _finish(spark: SparkSession, path: str, stage: str) -> None:
    """Move the staged files to their folders, then remove those they stand for; may be done again at any point."""
    fs, at = _file_system(spark, path)
    for row in _files_of(spark, f"{stage}/data"):
        home = at(f"{path}/{row.relative}").getParent()
        fs.mkdirs(home)
        if not fs.rename(at(f"{stage}/data/{row.relative}"), at(f"{path}/{row.relative}")):
            raise OSError(f"could not move {row.relative}")
    for row in spark.read.parquet(f"{stage}/replaced").toLocalIterator():
        fs.delete(at(row.path), False)
    fs.delete(at(stage), True)


def _files_of(spark: SparkSession, folder: str) -> list:
    fs, at = _file_system(spark, folder)
    root, found = at(folder), []
    if fs.exists(root):
        prefix = fs.resolvePath(root).toUri().getPath().rstrip("/") + "/"
        files = fs.listFiles(root, True)
        while files.hasNext():
            full = files.next().getPath().toUri().getPath()
            if full.endswith(".parquet"):
                found.append(_Relative(full[full.index(prefix) + len(prefix) :]))
    return found


class _Relative:
    def __init__(self, relative: str):
        self.relative = relative


def compact_small_files(spark: SparkSession, path: str, file_bytes: int = TARGET_FILE_BYTES, small: float = 0.5) -> int:
    """Pack the small files of every partition folder into files of about file_bytes; returns how many were replaced.

    A file below `small` of file_bytes is small. Small files of a folder are dealt into packs by their running bytes; a
    pack is written by one task, straight from its files. Large files, and a small one alone in its folder, stay as they
    are, and so do partition folders. New files are staged beside a list of those they replace, so a run that was cut
    short is finished by the next one before anything else.
    """
    fs, at = _file_system(spark, path)
    for left in fs.globStatus(at(f"{path}/_compact-*")) or []:
        stage = left.getPath().toString()
        if fs.exists(at(f"{stage}/replaced/_SUCCESS")):
            _finish(spark, path, stage)
        else:
            fs.delete(at(stage), True)
    files = materialise(_files(spark, path).filter(F.col("length") < small * file_bytes), "small-files")
    # One row per file of a folder; the running total never meets file contents.
    running = Window.partitionBy("folder").orderBy("path").rowsBetween(Window.unboundedPreceding, 0)
    packs = files.withColumn("pack", F.floor((F.sum("length").over(running) - 1) / file_bytes))
    several = Window.partitionBy("folder", "pack")
    packs = packs.withColumn("n", F.count(F.lit(1)).over(several)).filter("n > 1")
    number = F.dense_rank().over(Window.orderBy("folder", "pack")) - 1  # one row per file
    packs = materialise(packs.select("path", "length", number.alias("number")), "packs")
    total = packs.agg(F.count(F.lit(1)).alias("files"), (F.max("number") + 1).alias("packs")).first()
    if not total.files:
        return 0
    stage = f"{path.rstrip('/')}/_compact-{uuid.uuid4().hex}"
    whole = spark.read.option("basePath", path).parquet(path)
    known = {c.name for c in whole.schema} - set(spark.read.parquet(packs.first().path).columns)
    partition = [c for c in whole.columns if c in known]
    rows = whole.select("*", F.col("_metadata.file_path").alias("_file"))
    name = F.regexp_replace(F.regexp_replace("_file", "^file:/+", "/"), "%20", " ")
    plain = packs.select(F.regexp_replace("path", "^file:/+", "/").alias("_path"), "number")
    packed = rows.withColumn("_path", name).join(plain, "_path").drop("_path", "_file")
    dealt = packed.repartitionById(int(total.packs), F.col("number").cast("int")).drop("number")
    writer = dealt.write.option("maxRecordsPerFile", 0)
    (writer.partitionBy(*partition) if partition else writer).parquet(f"{stage}/data")
    packs.select("path").write.parquet(f"{stage}/replaced")
    _finish(spark, path, stage)
    return int(total.files)


# --- upsert of touched partitions ------------------------------------------------------------------


def upsert_partitions(updates: DataFrame, path: str, key: str, partition: str) -> list:
    """Merge updates into a table partitioned by one column, by key; returns the partitions that were written.

    Touched are the partitions that updates belong to and those that hold one of their keys (a key may move). Only they
    are read, merged and overwritten; files of others keep their names. Every row of a touched key is replaced by its
    update. A key that is null or twice in the updates is an error. The merged rows are written to the shared folder
    before they replace anything, and a run may be repeated.
    """
    spark = updates.sparkSession
    updates = materialise(updates, "updates")
    bad = updates.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col(key).isNull() | (F.col("n") > 1)).limit(3).collect()
    if bad:
        raise ValueError(f"keys that are null or repeated in the updates: {[r[0] for r in bad]}")
    target = spark.read.parquet(path)
    keys = updates.select(key)
    held = target.select(key, partition).join(keys, key, "left_semi").select(partition)
    touched = [r[0] for r in updates.select(partition).union(held).distinct().collect()]  # names of partition folders
    column = F.col(partition)
    known = [t for t in touched if t is not None]
    inside = column.isin(known) if known else F.lit(False)
    if None in touched:
        inside = inside | column.isNull()
    stays = target.filter(inside).join(keys, key, "left_anti")
    merged = materialise(stays.unionByName(updates.select(*target.columns)), "merged")
    emptied = {r[0] for r in target.filter(inside).select(partition).distinct().collect()} - {r[0] for r in merged.select(partition).distinct().collect()}
    backfill_partitions(merged, path, partition)
    fs, at = _file_system(spark, path)
    for value in emptied:  # all rows of the folder moved to others
        fs.delete(at(f"{path}/{partition}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}"), True)
    return sorted(touched, key=str)
