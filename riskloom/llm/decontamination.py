"""Benchmark decontamination: where documents hold windows of benchmark items, by a prefix-filtered join.

An item's windows are its runs of ``size`` words; an item of fewer words is one window. A window is
seen as its five-word shingles (a shorter window: one shingle, all its words). A document holds a
window only if it holds all its shingles, so any one of them is a necessary prefix; the rarest in
the documents is taken. Documents meet windows by that shingle only. A meeting gives the place at
which the window would begin, which bounds it to the words at hand; its words are then compared.

One pass over the texts hashes shingles of all places (numpy, whole batches) and keeps those that a
filter of the items' shingles passes. The filter is a bit field of fixed size, so it can be sent to
the tasks whatever the benchmark's size; what it passes wrongly finds no window. Only runs of
places that are long enough for a window are kept, with their words, in pieces of bounded length.
Counting shingles, choosing prefixes, meeting and comparing are Spark aggregates and joins on what
was kept. A shingle that very many documents hold is counted on the map side, and is a prefix only
where a window has no rarer one.

Defined results: a null or empty text has no words and is not hit; a null or empty item has no
windows; items with one id are one item; the windows of an item with a null id hit words, but the
item is neither counted nor listed; repeated documents give repeated results; a window that occurs
several times, also overlapping, hits each word once; without items nothing is hit; an empty table
gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskloom.llm.bytes_of import Words, gathered, shingles_of, words_of
from riskloom.llm.common import lean
from riskloom.llm.tokens import slices
from riskloom.session import pin, stage

WINDOW = 10
SHINGLE = 5
FILTER_BITS = 24  # the filter has 2 ** 24 bits, 2 MB
STEP = 64  # windows that begin in one piece of a document
SLICE = 2_000_000

# Words are runs of digits, letters and everything beyond ASCII, A to Z lower-cased.
_WORD = np.zeros(256, bool)
_WORD[list(b"0123456789abcdefghijklmnopqrstuvwxyz")] = True
_WORD[128:] = True


def _windows(items: DataFrame, size: int) -> DataFrame:
    """``item_id, words, hashes``: each window's words and its shingles' hashes in order."""

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch.column(1), SLICE):
                found = words_of(batch.column(1)[piece], _WORD)
                n = np.diff(found.edges)
                length = np.minimum(n, size)
                of = np.repeat(np.arange(len(n)), np.where(n == 0, 0, n - length + 1))
                begin = found.edges[of] + np.arange(len(of)) - np.searchsorted(of, of)
                length = length[of]
                shingle = np.minimum(length, SHINGLE)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[piece].take(pa.array(of)), found.lists(begin, length),
                     _hash_lists(found, begin, length, shingle)], names=["item_id", "words", "hashes"])

    rows = items.select(F.col("item_id").cast("string"), "text").filter("text is not null")
    return rows.mapInArrow(lean(convert), "item_id string, words array<string>, hashes array<long>")


def _hash_lists(found: Words, begin: np.ndarray, length: np.ndarray, shingle: np.ndarray) -> pa.ListArray:
    """The shingles' hashes of windows, as lists."""
    per = length - shingle + 1
    at = gathered(begin, per)
    size = np.repeat(shingle, per)
    hashes = np.zeros(len(at), np.uint64)
    for s in np.unique(size).tolist():
        hashes[size == s] = shingles_of(found, s)[at[size == s]]
    offsets = np.concatenate([[0], np.cumsum(per)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(hashes.view(np.int64)))


def _filter_of(windows: DataFrame) -> np.ndarray:
    """A bit for every value of the highest bits of the windows' hashes, eight to a byte."""
    top = windows.select(F.explode("hashes").alias("hash")).select(F.shiftrightunsigned("hash", 64 - FILTER_BITS).alias("top"))
    bit = F.expr("shiftleft(1, cast(top & 7 as int))")
    found = top.groupBy(F.shiftright("top", 3).alias("byte")).agg(F.bit_or(bit).alias("bits")).toArrow()
    field = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    field[found["byte"].to_numpy()] = found["bits"].to_numpy()
    return field


def _passing(field: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    top = (hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
    return (field[top >> 3] >> (top & 7).astype(np.uint8)) & 1 > 0


def _pieces(found: Words, field: np.ndarray, shingle: int, least: int, most: int, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Where pieces begin, and how many places they have: runs of places that pass, long enough for
    a window of ``least`` words, cut so that each window of up to ``most`` words that begins within
    a piece's first ``step`` places is whole in it."""
    text_of = np.repeat(np.arange(len(found.edges) - 1), np.diff(found.edges))
    n = len(found.hashes) - shingle + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = text_of[shingle - 1:] == text_of[:n]
    at = np.flatnonzero(inside & _passing(field, shingles_of(found, shingle)[:n]))
    if not len(at):
        return at, at
    new = np.concatenate([[True], (np.diff(at) > 1) | (np.diff(text_of[at]) > 0)])
    begin = at[new]
    places = np.diff(np.concatenate([np.flatnonzero(new), [len(at)]]))
    long = places >= least - shingle + 1
    begin, places = begin[long], places[long]
    count = -(-(places - (least - shingle)) // step)  # windows begin in so many pieces
    number = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    return np.repeat(begin, count) + step * number, np.minimum(np.repeat(places, count) - step * number, step + most - shingle)


def _scanned(docs: DataFrame, field: np.ndarray, kinds: list[tuple[int, int, int]], step: int) -> DataFrame:
    """``doc_id, n_words, pieces``: each row's pieces, a start (in words), words and hashes each.

    ``kinds`` has the shingle sizes in use, with the lengths of the shortest and longest window.
    """
    sent = docs.sparkSession.sparkContext.broadcast(field)

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch.column(1), SLICE):
                found = words_of(batch.column(1)[piece], _WORD)
                begin, places, shingle = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
                for size, least, most in kinds:
                    a, b = _pieces(found, sent.value, size, least, most, step)
                    begin.append(a)
                    places.append(b)
                    shingle.append(np.full(len(a), size))
                begin, places, shingle = (np.concatenate(x) for x in (begin, places, shingle))
                order = np.argsort(begin, kind="stable")
                begin, places, shingle = begin[order], places[order], shingle[order]
                length = places + shingle - 1
                of = np.searchsorted(found.edges, begin, "right") - 1
                fields = [
                    pa.array((begin - found.edges[of]).astype(np.int32)), found.lists(begin, length),
                    _hash_lists(found, begin, length, shingle)]
                per = np.bincount(of, minlength=len(found.edges) - 1)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(per)]).astype(np.int32)),
                    pa.StructArray.from_arrays(fields, names=["start", "words", "hashes"]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[piece], pa.array(np.diff(found.edges)), lists], names=["doc_id", "n_words", "pieces"])

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(
        lean(convert), "doc_id long, n_words long, pieces array<struct<start:int, words:array<string>, hashes:array<long>>>")


def _prefixes(windows: DataFrame, places: DataFrame) -> DataFrame:
    """``hash, window, at, words``: each window's rarest shingle in the documents and its place in it.

    A window with a shingle that no document holds occurs nowhere and goes.
    """
    counts = places.select(F.explode("hashes").alias("hash")).groupBy("hash").agg(F.count("*").alias("n"))
    each = windows.select("window", F.size("hashes").alias("size"), F.posexplode("hashes").alias("at", "hash"))
    rarest = (each.join(pin(counts.join(each.select("hash").distinct(), "hash", "left_semi")), "hash").groupBy("window", "size")
              .agg(F.count("*").alias("met"), F.min(F.struct("n", "hash", "at")).alias("rarest"))
              .filter("met = size").select("window", "rarest.hash", "rarest.at"))
    return rarest.join(windows.select("window", "words"), "window")


def occurrences(pieces: DataFrame, windows: DataFrame, step: int = STEP) -> DataFrame:
    """``_row, window, start, stop``: every place at which a document holds a window."""
    prefixes = pin(_prefixes(windows, pieces))
    held = pieces.select("_row", "start", F.col("words").alias("around"), F.posexplode("hashes").alias("place", "hash"))
    met = held.join(prefixes, "hash")
    begin, length = F.col("place") - F.col("at"), F.size("words")
    bounded = met.filter((begin >= 0) & (begin < step) & (begin + length <= F.size("around")))
    same = bounded.filter(F.slice("around", begin + 1, length) == F.col("words"))
    first = F.col("start") + begin
    return same.select("_row", "window", first.alias("start"), (first + length).alias("stop"))


def _covered(spans: str) -> str:
    """The number of places in any of the spans, which are sorted by their start."""
    return f"""aggregate({spans}, named_struct('n', 0L, 'reach', 0),
      (s, x) -> named_struct('n', s.n + greatest(x.stop - greatest(x.start, s.reach), 0), 'reach', greatest(s.reach, x.stop)),
      s -> s.n)"""


def contamination(docs: DataFrame, items: DataFrame, size: int = WINDOW, step: int = STEP) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` for every document."""
    # The numbers of rows and windows are written with them, so a task that runs again keeps them.
    every = stage(_windows(items, size))
    windows = stage(every.groupBy("words").agg(F.first("hashes").alias("hashes")).withColumn("window", F.monotonically_increasing_id()))
    length = F.size("words")
    kinds = windows.groupBy(F.least(length, F.lit(SHINGLE)).alias("s")).agg(F.min(length), F.max(length)).orderBy("s").collect()
    scanned = stage(_scanned(docs, _filter_of(windows), [tuple(k) for k in kinds], step).withColumn("_row", F.monotonically_increasing_id()))
    pieces = scanned.select("_row", F.explode("pieces").alias("p")).select("_row", "p.*")
    found = occurrences(pieces, windows, step)
    # A document's places are at most its words, so its group is no larger than its text.
    hit = stage(found.groupBy("_row").agg(
        F.sort_array(F.collect_set("window")).alias("held"), F.sort_array(F.collect_set(F.struct("start", "stop"))).alias("spans"))
        .select("_row", "held", F.expr(_covered("spans")).alias("n_hit")))
    # Documents that hold the same windows hold the same items: one list for all of them.
    owners = every.filter("item_id is not null").join(windows.select("words", "window"), "words").select("window", "item_id").distinct()
    held = hit.select("held").distinct()
    listed = held.select("held", F.explode("held").alias("window")).join(owners, "window").groupBy("held").agg(
        F.sort_array(F.collect_set("item_id")).alias("ids"))
    listed = listed.select("held", F.size("ids").cast("long").alias("n_items"), F.array_join("ids", ",").alias("ids"))
    judged = hit.join(listed, "held", "left").select("_row", "n_hit", "n_items", "ids")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return scanned.select("_row", "doc_id", "n_words").join(judged, "_row", "left").select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce("ids", F.lit("")), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))
