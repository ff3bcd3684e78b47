"""Streaming forms of the event operators: source, watermark, windows, dedup, sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from lossline.config import StreamConfig
from lossline.operators import events as ev


def event_text_stream(spark: SparkSession, cfg: StreamConfig, files_per_batch: int | None = None) -> DataFrame:
    """Event texts (column value) from a folder of JSON lines that grows."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(cfg.input_path)


def kafka_stream(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Event texts from a topic. Needs the Kafka connector on the class path."""
    raw = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).load()
    return raw.select(F.col("value").cast("string").alias("value"), F.col("timestamp").alias("arrival_ts"))


def table_stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A parquet table of the folder read as a stream."""
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(folder)


def with_lateness(events: DataFrame, cfg: StreamConfig) -> DataFrame:
    return events.withWatermark("event_time", cfg.lateness)


def windowed(events: DataFrame, cfg: StreamConfig, slide: str | None = None) -> DataFrame:
    """Window summaries: every change in update mode, one final row per window in append mode.

    The window state outlives the window by the allowed lateness; older events are dropped.
    """
    return ev.window_summary(with_lateness(events, cfg), cfg.window, slide)


def deduplicated(events: DataFrame, cfg: StreamConfig) -> DataFrame:
    """One event per claim and window; state is dropped once the watermark has passed the window.

    The window takes over as the event-time column, so event_time is rebuilt as a plain one.
    """
    plain = F.timestamp_micros(F.unix_micros("event_time"))
    keyed = with_lateness(events, cfg).withColumns({"window": F.window("event_time", cfg.window), "event_time": plain})
    return keyed.dropDuplicates(["claim_id", "window"])


def sessions(events: DataFrame, cfg: StreamConfig, gap: str = "30 minutes") -> DataFrame:
    return (
        with_lateness(events, cfg)
        .groupBy("policy_id", F.session_window("event_time", gap).alias("s"))
        .agg(
            F.min("event_time").alias("session_start"),
            F.max("event_time").alias("last_event"),
            F.count("*").alias("claim_count"),
            F.round(F.sum("estimated_amount"), 2).cast("double").alias("total_amount_mxn"),
        )
        .drop("s")
    )


def run_available(
    stream: DataFrame, sink, checkpoint: str, mode: str = "append"
) -> StreamingQuery:
    """Process what is there now, in as many batches as the source gives, then stop."""
    query = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def start(stream: DataFrame, sink, checkpoint: str, cfg: StreamConfig, mode: str = "update") -> StreamingQuery:
    """Run until stopped, one batch per early firing interval."""
    return (
        stream.writeStream.outputMode(mode)
        .foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=f"{cfg.early_firing_seconds} seconds")
        .start()
    )
