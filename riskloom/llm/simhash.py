"""SimHash near-duplicates with a pigeonring filter.

A fingerprint has 64 bits: each is 1 if set in over half of the hashes of the text's word shingles.
Two fingerprints link when they differ in at most 3 bits. Cut into a ring of 4 segments of 16 bits,
such a pair has a segment from which every chain of l consecutive segments differs in at most
floor(3 l / 4) bits: 0, 1, 2 and 3. The chain of two segments is the join key: the first segment as
it is, the second as it is or with one unset bit set (of a pair that differs there, one side has
the bit unset). What meets under a key must pass the longer chains, the last of which is the full
Hamming check. Only distinct fingerprints are joined; a pair under 32 bits of key meets by chance
once in four billion, so work follows the number of texts, and a group of copies is one fingerprint.

Components are those of the fingerprints; a component's id is the smallest document id in it.

Defined results: upper-case A to Z count as lower case; a null or empty text, or one of white space
only, has fingerprint 0, which links like any other; a text with fewer words than a shingle has one
shingle, all its words; a document with a null id links others and gets their component's id, which
is null where all ids are null; repeated rows give repeated results; an empty table gives an empty
one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from riskloom.llm.common import boxed, lean
from riskloom.llm.components import components
from riskloom.session import stage

SEGMENTS, WIDTH = 4, 16
MOST_BITS = 3
HASH_SEED = 42


def shingle_hashes(text: str | None, size: int) -> np.ndarray:
    """XXH64 of each run of ``size`` words, joined by spaces."""
    import xxhash

    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(joined, HASH_SEED)], np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    begins = (ends - lengths)[: len(words) - size + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return np.array(
        [digest(joined[a:b], HASH_SEED) for a, b in zip(begins, ends[size - 1:].tolist())], np.uint64)


def majority_bits(hashes: np.ndarray) -> int:
    """64 bits as a signed number, each set if it is in over half of the hashes."""
    if not len(hashes):
        return 0
    votes = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 255):  # so many ones fit in a byte
        part = np.unpackbits(hashes[start:start + 255].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += part.sum(axis=0, dtype=np.uint8)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, size: int = 3) -> DataFrame:
    """``doc_id, fp``: each row's fingerprint as a signed 64-bit number."""

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [majority_bits(shingle_hashes(text.as_py(), size)) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(lean(convert), "doc_id long, fp long")


def _segment(fp: Column, i: int) -> Column:
    return F.shiftrightunsigned(fp, WIDTH * (i % SEGMENTS)).bitwiseAND((1 << WIDTH) - 1)


def _chain_key(fp: Column, i: int) -> Column:
    """Position, segment and next segment in one number."""
    return F.lit(i << (2 * WIDTH)) + F.shiftleft(_segment(fp, i), WIDTH) + _segment(fp, i + 1)


def ring_keys(prints: DataFrame, fp: str, near: bool) -> DataFrame:
    """The rows once per chain key; ``near`` adds the keys with one unset bit of the second segment set."""
    at = []
    for i in range(SEGMENTS):
        key = _chain_key(F.col(fp), i)
        at.append(key)
        if near:
            at += [F.when(key.bitwiseAND(1 << b) == 0, key + (1 << b)) for b in range(WIDTH)]
    return prints.withColumn("_key", F.explode(F.array_compact(F.array(*at))))


def within_ring(x: Column, at: Column, most: int = MOST_BITS) -> Column:
    """Do the differing bits ``x`` pass every chain from segment ``at`` on."""
    turned = F.expr("0")
    for i in range(SEGMENTS):
        shift = WIDTH * i
        ring = x if i == 0 else F.shiftrightunsigned(x, shift).bitwiseOR(F.shiftleft(x, 64 - shift))
        turned = ring if i == 0 else F.when(at == i, ring).otherwise(turned)
    passes = F.lit(True)
    for length in range(1, SEGMENTS + 1):
        part = turned if length == SEGMENTS else turned.bitwiseAND((1 << (WIDTH * length)) - 1)
        passes = passes & (F.bit_count(part) <= most * length // SEGMENTS)
    return passes


def links(distinct: DataFrame, fp: str = "fp") -> DataFrame:
    """All pairs ``a, b`` of different fingerprints that differ in at most 3 bits."""
    index = ring_keys(distinct.select(F.col(fp).alias("b")), "b", near=False)
    probe = ring_keys(distinct.select(F.col(fp).alias("a")), "a", near=True)
    x = F.col("a").bitwiseXOR(F.col("b"))
    at = F.shiftrightunsigned("_key", 2 * WIDTH)
    pairs = probe.join(index, "_key").filter((F.col("a") != F.col("b")) & within_ring(x, at))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_groups(docs: DataFrame, size: int = 3) -> DataFrame:
    """``doc_id, fp, component_id`` per row; the component is the smallest id reachable by links."""
    return grouped(stage(fingerprints(docs, size)))


def grouped(printed: DataFrame) -> DataFrame:
    """The same from rows ``doc_id, fp``, which are read several times."""
    classes = stage(printed.groupBy("fp").agg(F.min("doc_id").alias("first")))
    found = components(links(classes).select(F.col("a").alias("u"), F.col("b").alias("v")))
    root = F.coalesce("component", "fp").alias("root")
    rooted = classes.join(found, F.col("fp") == F.col("node"), "left").select("fp", "first", root)
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return printed.join(rooted.join(least, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def deduplicate(docs: DataFrame, size: int = 3) -> DataFrame:
    """One document of each component stays, with all its columns: the one with the smallest id.

    Rows without an id stay; rows that share an id stay if one of them is to stay.
    """
    found = near_groups(docs, size).filter("doc_id is not null")
    stays = found.groupBy("doc_id").agg(F.max(F.col("doc_id") == F.col("component_id")).alias("stays"))
    gone = stays.filter("not stays").select(F.col("doc_id").alias("_id"))
    return boxed(docs).join(gone, F.col("_row.doc_id") == F.col("_id"), "left_anti").select("_row.*")
