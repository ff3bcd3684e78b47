"""Lines that many documents share, kept in an index that documents can be added to and taken from again.

The index has an exact table (line digest, number of documents) and, per shard of digests, a cuckoo filter of the lines
that reached the threshold. A new count moves fingerprints into or out of the filters, so a deletion undoes an insertion.
Lines that the filters don't know are settled without the table; the few others are confirmed against it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from lossline.llm.common import hidden, parts, pick, slices, write

#: Fixed value: the characters stripped at both ends of a line.
STRIPPED = b" \t\n\v\f\r"
#: Lines in one filter at first; more shards are made beyond.
LINES_PER_SHARD = 500_000
SLOTS, KICKS = 4, 200
MASK = (1 << 64) - 1


def line_key(line: bytes) -> bytes:
    return line.strip(STRIPPED).lower()


def long_enough(key: bytes, least: int) -> bool:
    return len(key) >= least and (least <= 1 or len(key.decode("utf-8", "replace")) >= least)


# --- the filter --------------------------------------------------------------------------


class CuckooFilter:
    """Fingerprints of 16 bits in buckets of four; a line has two buckets. What finds no room goes to a list beside it."""

    def __init__(self, table: np.ndarray, spare: np.ndarray):
        self.table, self.spare = table, spare

    @classmethod
    def sized(cls, lines: int) -> CuckooFilter:
        buckets = 1 << max(4, int(np.ceil(lines / (0.8 * SLOTS))).bit_length())
        return cls(np.zeros((buckets, SLOTS), np.uint16), np.zeros((0, 2), np.int64))

    @classmethod
    def load(cls, data: bytes) -> CuckooFilter:
        buckets = int.from_bytes(data[:8], "little")
        table = np.frombuffer(data, np.uint16, buckets * SLOTS, 8).reshape(buckets, SLOTS).copy()
        return cls(table, np.frombuffer(data, np.int64, offset=8 + table.nbytes).reshape(-1, 2).copy())

    def dump(self) -> bytes:
        return len(self.table).to_bytes(8, "little") + self.table.tobytes() + self.spare.tobytes()

    def places(self, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprint and both buckets of digests."""
        mark = np.maximum(h2 & 0xFFFF, 1)
        first = (h2 >> 16) & (len(self.table) - 1)
        return mark, first, self.other(first, mark)

    def other(self, bucket, mark):
        return (bucket ^ (mark * 0x5BD1E995 >> 7)) & (len(self.table) - 1)

    def contains(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        mark, first, second = self.places(h1, h2)
        found = ((self.table[first] == mark[:, None]) | (self.table[second] == mark[:, None])).any(axis=1)
        if len(self.spare):
            size = len(self.table)
            found |= np.isin(mark * size + first, self.spare[:, 1] * size + self.spare[:, 0])
            found |= np.isin(mark * size + second, self.spare[:, 1] * size + self.spare[:, 0])
        return found

    def _put(self, bucket: int, mark: int) -> bool:
        free = (self.table[bucket] == 0).nonzero()[0]
        if len(free):
            self.table[bucket, free[0]] = mark
        return len(free) > 0

    def insert(self, h1: np.ndarray, h2: np.ndarray) -> None:
        for mark, first, second in zip(*(x.tolist() for x in self.places(h1, h2))):
            if self._put(first, mark) or self._put(second, mark):
                continue
            bucket = second
            for kick in range(KICKS):
                slot = (kick + mark) % SLOTS
                mark, self.table[bucket, slot] = int(self.table[bucket, slot]), mark
                bucket = int(self.other(bucket, mark))
                if self._put(bucket, mark):
                    break
            else:
                self.spare = np.append(self.spare, [[bucket, mark]], axis=0)

    def delete(self, h1: np.ndarray, h2: np.ndarray) -> None:
        """Take out lines that were inserted before, once each."""
        for mark, first, second in zip(*(x.tolist() for x in self.places(h1, h2))):
            for bucket in (first, second):
                found = (self.table[bucket] == mark).nonzero()[0]
                if len(found):
                    self.table[bucket, found[0]] = 0
                    break
            else:
                found = (((self.spare[:, 0] == first) | (self.spare[:, 0] == second)) & (self.spare[:, 1] == mark)).nonzero()[0]
                self.spare = np.delete(self.spare, found[:1], axis=0)


# --- lines of documents ------------------------------------------------------------------


def line_digests(docs: DataFrame, least: int = 1) -> DataFrame:
    """doc_id, h1, h2: the 128-bit digest of each different line key of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for batch in slices(batches, "text"):
            found, counts = [], []
            for text in batch.column(1).to_pylist():
                keys = {line.strip(STRIPPED) for line in text.lower().split(b"\n")}
                some = {digest(key) for key in keys if key and long_enough(key, least)}
                found += some
                counts.append(len(some))
            values = np.frombuffer(b"".join(found), "<i8").reshape(-1, 2)
            ids = batch.column(0).take(pa.array(np.repeat(np.arange(len(counts)), counts)))
            yield pa.RecordBatch.from_arrays([ids, pa.array(values[:, 0]), pa.array(values[:, 1])], names=["doc_id", "h1", "h2"])

    read = pick(docs, "doc_id", "text").select("doc_id", F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))
    return read.mapInArrow(run, f"doc_id {read.schema['doc_id'].dataType.simpleString()}, h1 long, h2 long")


def _changed(filters: DataFrame | None, changes: DataFrame, shards: int) -> DataFrame:
    """Filters (shard, body) after changes (h1, h2, sign: 1 in, -1 out). A shard's rows stream past its one filter."""
    dealt = changes.select(F.pmod("h1", F.lit(shards)).alias("shard"), F.lit(1).alias("kind"), "h1", "h2", "sign")
    counted = dealt.groupBy("shard").agg(F.count(F.lit(1)).alias("h1"))
    # Zeros, not nulls, where a row has no number: numpy would turn the whole column into floats.
    empty, zero, no_sign = F.lit(None).cast("binary").alias("body"), F.lit(0).cast("long"), F.lit(0).alias("sign")
    rows = dealt.select("*", empty).unionByName(
        counted.select("shard", F.lit(-1).alias("kind"), "h1", zero.alias("h2"), no_sign, empty)
    )
    if filters is not None:
        rows = rows.unionByName(filters.select("shard", F.lit(0).alias("kind"), zero.alias("h1"), zero.alias("h2"), no_sign, "body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done():
            return pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([made.dump()], pa.binary())], names=["shard", "body"])

        shard, made = None, None
        for batch in batches:
            of, kind, h1, h2, sign = (batch.column(i).to_numpy() for i in range(5))
            starts = np.flatnonzero(np.r_[True, of[1:] != of[:-1]]) if len(of) else []
            for a, b in zip(starts, [*starts[1:], len(of)]):
                if of[a] != shard:
                    if made is not None:
                        yield done()
                    shard, made = int(of[a]), None
                at = a
                while at < b and kind[at] < 1:  # how many changes there are, then the filter so far
                    if kind[at] == 0:
                        made = CuckooFilter.load(batch.column(5)[at].as_py())
                    elif made is None:
                        made = CuckooFilter.sized(int(h1[at]))
                    at += 1
                some = slice(at, b)
                for way, act in ((1, made.insert), (-1, made.delete)):
                    chosen = sign[some] == way
                    act(h1[some][chosen], h2[some][chosen])
        if made is not None:
            yield done()

    order = rows.repartition(parts(changes), "shard").sortWithinPartitions("shard", "kind")
    return order.select("shard", "kind", "h1", "h2", "sign", "body").mapInArrow(run, "shard long, body binary")


@dataclass
class LineIndex:
    """counts: h1, h2, n (documents that have the line). filters: shard, body (lines of n >= threshold)."""

    counts: DataFrame
    filters: DataFrame
    shards: int
    threshold: int
    least: int

    @classmethod
    def build(cls, docs: DataFrame, threshold: int = 10, least: int = 1) -> LineIndex:
        """Index a table. Each row counts as a document, repeated rows too; null and empty texts have no line key."""
        lines = line_digests(docs, least)
        counts = write(lines.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")), "line-counts")
        hot = counts.filter(F.col("n") >= threshold)
        shards = max(parts(docs), -(-hot.count() // LINES_PER_SHARD))
        filters = write(_changed(None, hot.withColumn("sign", F.lit(1)), shards), "line-filters")
        return cls(counts, filters, shards, threshold, least)

    def _moved(self, docs: DataFrame, way: int) -> LineIndex:
        moved = line_digests(docs, self.least).groupBy("h1", "h2").agg((F.count(F.lit(1)) * way).alias("n"))
        both = self.counts.withColumn("old", F.col("n")).unionByName(moved.withColumn("old", F.lit(0).cast("long")))
        after = write(both.groupBy("h1", "h2").agg(F.sum("n").alias("n"), F.sum("old").alias("old")), "line-counts")
        if after.filter("n < 0").limit(1).count():
            raise ValueError("a document that the index doesn't hold can't be deleted")
        now, before = F.col("n") >= self.threshold, F.col("old") >= self.threshold
        changes = after.filter(now != before).select("h1", "h2", F.when(now, 1).otherwise(-1).alias("sign"))
        filters = write(_changed(self.filters, changes, self.shards), "line-filters")
        return LineIndex(after.filter("n > 0").drop("old"), filters, self.shards, self.threshold, self.least)

    def insert(self, docs: DataFrame) -> LineIndex:
        return self._moved(docs, 1)

    def delete(self, docs: DataFrame) -> LineIndex:
        return self._moved(docs, -1)

    @property
    def hot(self) -> DataFrame:
        return self.counts.filter(F.col("n") >= self.threshold).select("h1", "h2")

    def suspects(self, lines: DataFrame) -> DataFrame:
        """The rows of lines (doc_id, h1, h2) that a filter knows.

        Rows meet the filter of their shard in as many places as the shard's share of all lines asks for, so a line that
        most documents have is dealt out; the table of shares has one row per shard.
        """
        shard = F.pmod("h1", F.lit(self.shards))
        share = self.counts.groupBy(shard.alias("shard")).agg(F.sum("n").alias("rows"))
        total = share.agg(F.sum("rows").alias("total"))
        places = F.ceil(F.col("rows") * parts(lines) / F.col("total")).cast("int")
        dealt = self.filters.join(share, "shard").crossJoin(F.broadcast(total)).withColumn("places", places)
        where = F.broadcast(dealt.select("shard", "places"))  # one row per shard
        none, zero, kind = F.lit(None), F.lit(0).cast("long"), lines.schema["doc_id"].dataType
        rows = (
            lines.withColumn("shard", shard)
            .join(where, "shard")
            .select("shard", F.pmod(F.xxhash64("doc_id"), F.col("places").cast("long")).alias("place"), F.lit(1).alias("kind"), "doc_id", "h1", "h2", none.cast("binary").alias("body"))
            .unionByName(
                dealt.select("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("places").cast("long") - 1)).alias("place"), F.lit(0).alias("kind"), none.cast(kind).alias("doc_id"), zero.alias("h1"), zero.alias("h2"), "body")
            )
        )

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = None
            for batch in batches:
                kinds = batch.column(2).to_numpy()
                h1, h2 = (batch.column(i).to_numpy() for i in (4, 5))
                hit = np.zeros(len(kinds), bool)
                cuts = [0, *np.flatnonzero(kinds == 0).tolist(), len(kinds)]
                for a, b in zip(cuts, cuts[1:]):
                    if a < b and kinds[a] == 0:
                        known, a = CuckooFilter.load(batch.column(6)[a].as_py()), a + 1
                    if a < b:
                        hit[a:b] = known.contains(h1[a:b], h2[a:b])
                yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(hit)) for i in (3, 4, 5)], names=["doc_id", "h1", "h2"])

        order = rows.repartition(parts(lines), "shard", "place").sortWithinPartitions("shard", "place", "kind")
        return order.mapInArrow(run, f"doc_id {kind.simpleString()}, h1 long, h2 long")

    def drop_lines(self, docs: DataFrame) -> DataFrame:
        """Every row and column of docs without the lines that the index calls frequent, and n_lines, n_dropped.

        n_lines counts lines before dropping (a null or empty text is one empty line). Lines are whole and keep their
        order and spelling; a text that loses all lines, or is null, becomes empty. Rows that repeat a doc_id, and rows
        without one, are each treated by their own text. Other columns pass through, whatever their names.
        """
        inner, names, (doc_id, text) = hidden(docs, "doc_id", "text")
        # Rows without doc_id are told apart by their text, so that none meets the lines of all of them.
        own = F.struct(F.col(doc_id).alias("id"), F.when(F.col(doc_id).isNull(), F.xxhash64(text)).alias("k"))
        told = line_digests(inner.select(own.alias("doc_id"), F.col(text).alias("text")), self.least)
        confirmed = self.suspects(told).join(self.hot, ["h1", "h2"], "left_semi")
        found = confirmed.groupBy(F.col("doc_id").alias("_of")).agg(F.collect_set(F.struct("h1", "h2")).alias("_hot"))
        joined = inner.join(found, own.eqNullSafe(F.col("_of")), "left").drop("_of")
        least, digest = self.least, xxhash.xxh3_128_intdigest

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, text):
                at = batch.schema.names.index(text)
                texts, counts, dropped = [], [], []
                for body, hot in zip(batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()):
                    lines = (body or "").split("\n")
                    kept = lines
                    if hot:
                        # xxh3_128_digest is big-endian, read above as two little-endian halves
                        known = {int.from_bytes(p["h1"].to_bytes(8, "little", signed=True) + p["h2"].to_bytes(8, "little", signed=True)) for p in hot}
                        kept = [x for x in lines if not ((k := line_key(x.encode())) and long_enough(k, least) and digest(k) in known)]
                    texts.append("\n".join(kept) if hot else body or "")
                    counts.append(len(lines))
                    dropped.append(len(lines) - len(kept))
                columns = list(batch.columns[:-1])
                columns[at] = pa.array(texts, pa.string())
                columns += [pa.array(counts, pa.int64()), pa.array(dropped, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], "n_lines", "n_dropped"])

        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in inner.schema) + ", n_lines long, n_dropped long"
        return joined.mapInArrow(run, schema).toDF(*names, "n_lines", "n_dropped")


def dedup_lines(docs: DataFrame, threshold: int = 10, least: int = 1) -> DataFrame:
    """Drop from every document the lines that at least `threshold` rows of the table have. A row is a document: rows of
    one doc_id, also equal ones, count one by one."""
    return LineIndex.build(docs, threshold, least).drop_lines(docs)
