"""Token ids in files of independent zstandard frames: a document's frame can be read without the others.

A file is frames, then a table as a skippable zstandard frame, so that any zstandard reader can also read the file from
end to end. Each frame holds the ids (little-endian unsigned 32-bit) of some whole documents, or a part of a long one.

    table      magic 0x184D2A5E, size, frame entries, document entries, footer
    frame      offset u64, compressed bytes u32, ids u32, xxh64 of the compressed bytes u64
    document   doc_id i64 (NO_ID for null), first frame u32, ids before it in that frame u32, ids u64
    footer     frames u32, documents u64, xxh64 of both entry lists u64, version u32, magic 0x8F92EAB1
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window, functions as F

from lossline.llm.bpe import SLICE_BYTES, encoder, vocabulary_source
from lossline.llm.common import parts, pick, slices
from lossline.session import work_path

#: Fixed values of the format.
SKIPPABLE, FOOTER_MAGIC, VERSION = 0x184D2A5E, 0x8F92EAB1, 1
FRAME = np.dtype([("offset", "<u8"), ("size", "<u4"), ("ids", "<u4"), ("check", "<u8")])
DOCUMENT = np.dtype([("doc_id", "<i8"), ("frame", "<u4"), ("skip", "<u4"), ("ids", "<u8")])
FOOTER = np.dtype([("frames", "<u4"), ("documents", "<u8"), ("check", "<u8"), ("version", "<u4"), ("magic", "<u4")])
NO_ID = -(1 << 63)
#: Bytes of ids after which a frame, and frames after which a file, is closed.
FRAME_BYTES, FILE_BYTES = 256 << 10, 256 << 20
LEVEL = 3


class Writer:
    """Frames of one file, to a stream that is written front to back."""

    def __init__(self, stream):
        self.stream, self.at = stream, 0
        self.frames, self.documents, self.pending = [], [], bytearray()
        self.compress = zstandard.ZstdCompressor(level=LEVEL).compress

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.documents.append((NO_ID if doc_id is None else doc_id, len(self.frames), len(self.pending) // 4, len(ids) // 4))
        self.pending += ids
        while len(self.pending) >= FRAME_BYTES:
            self._frame(FRAME_BYTES)

    def _frame(self, size: int) -> None:
        body = self.compress(bytes(self.pending[:size]))
        self.frames.append((self.at, len(body), min(size, len(self.pending)) // 4, xxhash.xxh64_intdigest(body)))
        self.stream.write(body)
        self.at += len(body)
        del self.pending[:size]

    def close(self) -> None:
        if self.pending:
            self._frame(len(self.pending))
        entries = np.array(self.frames, FRAME).tobytes() + np.array(self.documents, DOCUMENT).tobytes()
        footer = np.array([(len(self.frames), len(self.documents), xxhash.xxh64_intdigest(entries), VERSION, FOOTER_MAGIC)], FOOTER)
        body = entries + footer.tobytes()
        self.stream.write(np.array([SKIPPABLE, len(body)], "<u4").tobytes() + body)

    @property
    def ids(self) -> int:
        return sum(d[3] for d in self.documents)


class Reader:
    """Documents of one file by their place in it; reads the table, then only the frames asked for."""

    def __init__(self, file, size: int):
        self.file = file
        footer = np.frombuffer(self._read(size - FOOTER.itemsize, FOOTER.itemsize), FOOTER)[0]
        if footer["magic"] != FOOTER_MAGIC or footer["version"] != VERSION:
            raise ValueError("not a token file of this version")
        frames, documents = int(footer["frames"]), int(footer["documents"])
        length = frames * FRAME.itemsize + documents * DOCUMENT.itemsize
        entries = self._read(size - FOOTER.itemsize - length, length)
        if xxhash.xxh64_intdigest(entries) != int(footer["check"]):
            raise ValueError("the table of a token file is damaged")
        self.frames = np.frombuffer(entries, FRAME, frames)
        self.documents = np.frombuffer(entries, DOCUMENT, documents, frames * FRAME.itemsize)
        self.held: tuple[int, bytes] = (-1, b"")
        self.expand = zstandard.ZstdDecompressor().decompress

    def _read(self, offset: int, size: int) -> bytes:
        self.file.seek(offset)
        return self.file.read(size)

    def frame(self, n: int) -> bytes:
        if self.held[0] != n:
            entry = self.frames[n]
            body = self._read(int(entry["offset"]), int(entry["size"]))
            if xxhash.xxh64_intdigest(body) != int(entry["check"]):
                raise ValueError(f"frame {n} of a token file is damaged")
            self.held = n, self.expand(body, max_output_size=int(entry["ids"]) * 4)
        return self.held[1]

    def ids(self, place: int) -> bytes:
        """Ids of the document at a place."""
        entry = self.documents[place]
        n, skip, left = int(entry["frame"]), int(entry["skip"]) * 4, int(entry["ids"]) * 4
        out = []
        while left:
            part = self.frame(n)[skip : skip + left]
            out.append(part)
            n, skip, left = n + 1, 0, left - len(part)
        return b"".join(out)


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    """A file system for a folder that every executor reaches (a mounted path, hdfs://, s3://, gs://)."""
    return pafs.FileSystem.from_uri(path) if "://" in path else pafs.FileSystem.from_uri(f"file://{path.removeprefix('file:')}")


def write_tokens(docs: DataFrame, vocabulary_path: str, end_id: int = 1, folder: str | None = None) -> DataFrame:
    """Encode whole texts with the tokenizers library, append end_id, and write the files in ascending doc_id order.

    Null and empty texts have the end id alone. Rows that repeat a doc_id follow each other in the order of their texts;
    rows without doc_id come first. Returns one row per file: part (order), path, documents, ids. A task that runs again
    writes new files, and only those of its last run are named. An empty table writes no file.
    """
    spark = docs.sparkSession
    folder = folder or work_path(spark, "tokens")
    shared = spark.sparkContext.broadcast(vocabulary_source(vocabulary_path))
    end = np.array([end_id], "<u4").tobytes()
    read = pick(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text")
    )
    tie = F.xxhash64("text")
    dealt = read.withColumn("tie", tie).repartitionByRange(parts(docs), "doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, system, at = encoder(shared.value, "library"), None, 0
        rows, writer, stream, path = [], None, None, None

        def close():
            writer.close()
            stream.close()
            rows.append((path, len(writer.documents), writer.ids))

        for batch in slices(batches, "text", SLICE_BYTES):
            for doc_id, ids in zip(batch.column(0).to_pylist(), made.encode(batch.column(1).to_pylist())):
                if writer and writer.at > FILE_BYTES:
                    close()
                    writer, at = None, at + 1
                if writer is None:
                    if system is None:
                        system, base = _open(folder)
                        system.create_dir(base, recursive=True)
                    path = f"{uuid.uuid4().hex}-{at}.tok"
                    stream = system.open_output_stream(f"{base}/{path}")
                    writer = Writer(stream)
                writer.add(doc_id, ids + end)
        if writer:
            close()
        yield pa.RecordBatch.from_pydict(
            {
                "at": pa.array(range(len(rows)), pa.int64()),
                "path": pa.array([f"{folder}/{r[0]}" for r in rows], pa.string()),
                "documents": pa.array([r[1] for r in rows], pa.int64()),
                "ids": pa.array([r[2] for r in rows], pa.int64()),
            }
        )

    files = dealt.select("doc_id", "text").mapInArrow(run, "at long, path string, documents long, ids long")
    manifest = files.withColumn("part", F.shiftleft(F.spark_partition_id().cast("long"), 24) + F.col("at")).drop("at")
    target = f"{folder}/manifest"
    manifest.write.parquet(target)
    return spark.read.schema(manifest.schema).parquet(target)


def read_tokens(manifest: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """doc_id, start, n_tokens, ids of the documents in the files, or of the wanted ones (doc_id) only.

    start counts the ids of all documents before it, over all files in order. A file is read by one task, frame by frame.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.select("path", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"), "documents")
    if wanted is not None:
        # Where the documents lie is in the tables; only the files of those found are opened again.
        tables = _scan(placed, table_only=True)
        chosen = tables.join(wanted.select("doc_id").distinct(), "doc_id", "left_semi")
        return _scan(chosen.groupBy("path", "base").agg(F.sort_array(F.collect_list("place")).alias("places")), places=True)
    return _scan(placed.repartition(parts(manifest), "path"))


def _scan(files: DataFrame, table_only: bool = False, places: bool = False) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, path = _open(row["path"])
                with system.open_input_file(path) as file:
                    reader = Reader(file, file.size())
                    sizes = reader.documents["ids"].astype(np.int64)
                    starts = row["base"] + np.cumsum(sizes) - sizes
                    asked = np.array(row["places"]) if places else np.arange(len(sizes))
                    step = max(1, int(len(sizes) * 8_000_000 / max(1, sizes.sum() * 4)))
                    for at in range(0, len(asked), step):
                        some = asked[at : at + step]
                        ids = reader.documents["doc_id"][some]
                        columns = [pa.array(ids, mask=ids == NO_ID), pa.array(starts[some]), pa.array(sizes[some])]
                        if table_only:
                            columns += [pa.array([row["path"]] * len(some)), pa.array([row["base"]] * len(some), pa.int64()), pa.array(some)]
                        else:
                            columns.append(pa.array([reader.ids(int(i)) for i in some], pa.binary()))
                        yield pa.RecordBatch.from_arrays(columns, names=names)

    kinds = "doc_id long, start long, n_tokens long" + (", path string, base long, place long" if table_only else ", ids binary")
    names = [part.strip().split(" ")[0] for part in kinds.split(",")]
    return files.mapInArrow(run, kinds)
