"""Token ids of whole texts in binary files, and back.

Documents are sorted by id over range partitions; each partition writes files of about
``FILE_IDS`` ids, named by partition and number, so names in order are ids in order. A file
appears under its name only when whole (it is written under another and renamed), and a task that
runs again writes the same files, so lost executors leave neither gaps nor doubles. What the tasks
report about their files (one row each) is written as a table, and says where each file's ids
begin among all ids.

A file is little-endian: ``RLT1``; the numbers of documents, words, escapes and blocks as 64-bit;
a byte per document, 1 if its id is null; the documents' ids as 64-bit; their token counts as
64-bit; per block where its ids, words and escapes begin, and a last row of totals; the words; the
escaped ids; the CRC-32 of all that.

Defined results: a null text has the end id only; a null ``doc_id`` sorts first; rows that share an
id follow one another in the order of their texts; an empty table writes no files and reads back
as an empty one.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from riskloom.llm import simple8b, tokens
from riskloom.llm.common import lean, partitions, prefix_sums, whole
from riskloom.session import fresh_path, stage

MAGIC = b"RLT1"
FILE_IDS = 2_000_000
END = 0


def to_bytes(doc_ids: list[int | None], counts: np.ndarray, ids: np.ndarray) -> bytes:
    words, extras, table = simple8b.encode(ids)
    head = struct.pack("<4q", len(doc_ids), len(words), len(extras), len(table) - 1)
    body = b"".join([
        MAGIC, head, bytes(d is None for d in doc_ids), np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
        counts.astype("<i8").tobytes(), table.astype("<i8").tobytes(), words.astype("<u8").tobytes(),
        extras.astype("<u8").tobytes()])
    return body + struct.pack("<I", zlib.crc32(body))


def from_bytes(data: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Document ids, token counts, and all token ids of a file."""
    if data[:4] != MAGIC or struct.unpack("<I", data[-4:])[0] != zlib.crc32(memoryview(data)[:-4]):
        raise ValueError("not a whole token file")
    docs, words, extras, blocks = struct.unpack_from("<4q", data, 4)
    at = 36
    null = data[at:at + docs]
    at += docs

    def numbers(count: int, kind: str) -> np.ndarray:
        nonlocal at
        found = np.frombuffer(data, kind, count, at)
        at += 8 * count
        return found

    doc_ids, counts = numbers(docs, "<i8").tolist(), numbers(docs, "<i8")
    table = numbers(3 * (blocks + 1), "<i8").reshape(-1, 3)
    ids = simple8b.decode(numbers(words, "<u8"), numbers(extras, "<u8"), table)
    return [None if n else d for d, n in zip(doc_ids, null)], counts, ids


def write(docs: DataFrame, folder: str, vocabulary: str, end: int = END, file_ids: int = FILE_IDS) -> DataFrame:
    """Writes the files below ``folder`` (which all executors reach) and returns a row per file:
    ``part, number, n_docs, n_ids, n_bytes``."""

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        from pyspark import TaskContext

        store, base = fs.FileSystem.from_uri(folder)
        part, encoder = TaskContext.get().partitionId(), tokens.encoder(vocabulary)
        doc_ids, counts, held, size, number = [], [], [], 0, 0

        def save() -> pa.RecordBatch:
            data = to_bytes(doc_ids, np.concatenate(counts), np.concatenate(held))
            hidden = f"{base}/_{uuid.uuid4().hex}"
            with store.open_output_stream(hidden) as out:
                out.write(data)
            store.move(hidden, f"{base}/part-{part:06d}-{number:06d}.ids")
            row = {"part": part, "number": number, "n_docs": len(doc_ids), "n_ids": size, "n_bytes": len(data)}
            return pa.RecordBatch.from_pylist([row])

        for batch in batches:
            texts, names = batch.column(1), batch.column(0).to_pylist()
            for piece in tokens.slices(texts):
                ids, edges = encoder.encode(texts[piece], end)
                doc_ids += names[piece]
                counts.append(np.diff(edges))
                held.append(ids)
                size += len(ids)
                if size >= file_ids:
                    yield save()
                    doc_ids, counts, held, size, number = [], [], [], 0, number + 1
        if doc_ids:
            yield save()

    spark = docs.sparkSession
    _make(folder)
    rows = docs.select(F.col("doc_id").cast("long"), whole().alias("text"))
    placed = rows.repartitionByRange(partitions(spark), "doc_id").sortWithinPartitions("doc_id", "text")
    return stage(placed.mapInArrow(lean(convert, tokens=True), "part long, number long, n_docs long, n_ids long, n_bytes long"))


def _make(folder: str) -> None:
    from pyarrow import fs

    store, base = fs.FileSystem.from_uri(folder)
    store.create_dir(base, recursive=True)


def starts(files: DataFrame) -> DataFrame:
    """Adds ``first``: the ids in all files before. Sums run within a partition's files, and over
    one row per partition."""
    per = files.groupBy("part").agg(F.sum("n_ids").alias("_n"))
    base = prefix_sums(per, ["part"], "_n", "_base").drop("_n")
    before = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    within = F.coalesce(F.sum("n_ids").over(before), F.lit(0))
    return files.join(F.broadcast(base), "part").withColumn("first", within + F.col("_base")).drop("_base")


def read(spark: SparkSession, folder: str, files: DataFrame, with_ids: bool = False) -> DataFrame:
    """One row per document from the files: ``doc_id, start, n_tokens, ids_crc32``, and the ids
    themselves if asked for."""

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, data in zip(batch.column(0), batch.column(1)):
                _, part, number = path.as_py().rsplit("/", 1)[1].removesuffix(".ids").split("-")
                doc_ids, counts, ids = from_bytes(data.as_py())
                ends = np.cumsum(counts)
                ids = ids.astype("<u4")
                edges = [0, *ends.tolist()]
                pairs = list(zip(edges, edges[1:]))
                columns = {
                    "part": pa.array([int(part)] * len(counts), pa.int64()),
                    "number": pa.array([int(number)] * len(counts), pa.int64()),
                    "doc_id": pa.array(doc_ids, pa.int64()), "before": pa.array(ends - counts, pa.int64()),
                    "n_tokens": pa.array(counts, pa.int64()),
                    "ids_crc32": pa.array([zlib.crc32(ids[a:b]) for a, b in pairs], pa.int64())}
                if with_ids:
                    columns["ids"] = pa.array([ids[a:b].astype(np.int64) for a, b in pairs], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_pydict(columns)

    schema = "part long, number long, doc_id long, before long, n_tokens long, ids_crc32 long"
    names = ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids
    if with_ids:
        schema += ", ids array<long>"
    loaded = spark.read.format("binaryFile").option("pathGlobFilter", "*.ids").load(folder).select("path", "content")
    rows = loaded.mapInArrow(lean(convert, tokens=True), schema)
    at = starts(files).select("part", "number", "first")
    return rows.join(at, ["part", "number"]).withColumn("start", F.col("first") + F.col("before")).select(*names)


def round_trip(docs: DataFrame, vocabulary: str, end: int = END) -> DataFrame:
    """Writes the files into a new folder and reads them back."""
    folder = fresh_path(docs.sparkSession, "tokens")
    files = write(docs, folder, vocabulary, end)
    return read(docs.sparkSession, folder, files)
