"""Shards that each have the mixture of the whole: rows are shuffled within their source, then sources are interleaved.

A row's fractional rank is its place in the seeded shuffle of its source over the rows of the source. Sorted by that, any
stretch of rows holds every source in proportion; the sorted rows are cut into shards whose counts differ by one at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lossline.llm.common import pick, ranked, write

#: Added to the bytes of a text, for its length and id in a file.
OVERHEAD = 16


def interleave(docs: DataFrame, shards: int, seed: int = 0) -> DataFrame:
    """doc_id, source, size, text_crc32, fraction, shard, slot (place in the shard, from 0) for every row.

    The shuffle orders the rows of a source by a hash of seed and text, then of the doc_id: rows of equal text lie side
    by side, in every source at about the same fraction, so they share a shard unless their group is larger than what a
    shard takes of it (the law is on counts, so a hot text is cut). All numbers come from ranks by range, so a source or
    a text may hold any part of the rows. Null sources are one source; null texts have no bytes; null doc_ids and
    repeated rows are rows like others. With fewer rows than shards, some shards stay empty.
    """
    read = pick(docs, "doc_id", "text", "source")
    body = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    rows = read.select(
        "doc_id",
        "source",
        (F.octet_length(body) + OVERHEAD).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.xxhash64(F.lit(seed), body).alias("_text"),
        F.xxhash64(F.lit(seed), F.col("doc_id").cast("string")).alias("_row"),
    )
    shuffled = ["_text", "_row", "doc_id", "text_crc32", "size"]
    placed = write(ranked(rows, "_place", F.asc_nulls_first("source"), *shuffled), "shuffled")
    sources = placed.groupBy(F.col("source").alias("_source")).agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    fraction = ((F.col("_place") - F.col("_first")) + 0.5) / F.col("_rows")
    mixed = placed.join(sources, F.expr("source <=> _source")).withColumn("fraction", fraction)
    mixed = mixed.select("doc_id", "source", "size", "text_crc32", "fraction", "_place")
    total = placed.agg(F.count(F.lit(1)).alias("_total"))
    numbered = ranked(mixed, "_at", "fraction", "_place").crossJoin(F.broadcast(total))  # one row
    shard = F.expr(f"(_at * {shards}) div _total")
    begin = F.expr(f"(shard * _total + {shards - 1}) div {shards}")
    return (
        numbered.withColumn("shard", shard.cast("int"))
        .withColumn("slot", F.col("_at") - begin)
        .select("doc_id", "source", "size", "text_crc32", "fraction", "shard", "slot")
    )
