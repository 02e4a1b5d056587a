"""Best-fit packing with large-item matching, from the counts of lengths.

A packing depends on the pieces' lengths only, and those are whole numbers up to the capacity. So
the pieces are counted per length (at most ``capacity`` rows, whatever the input), the plan is made
on those counts, and pieces are then dealt to it by their place among the pieces of their length:

* Lengths above a third of the capacity: a sequence holds at most two. From the longest down, each
  is matched with the longest other that still fits beside it.
* The rest, from the longest down: each goes to the sequence with the smallest gap that takes it,
  as many per sequence as fit; a new sequence is begun only if there is no such gap.

All sequences alike are handled at once, so the plan has a few rows per length, and is broadcast
(its size is bounded by the capacity, not by the input). Places are counted within (length, salt)
and the salts' counts added, so a length that very many pieces share is spread over tasks.

Defined results: a null text counts as empty and has one token, the end id; documents that repeat
are packed as often as they come; an empty table gives an empty one.
"""

from __future__ import annotations

import heapq
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from riskloom.llm import tokens
from riskloom.llm.common import lean, partitions, whole
from riskloom.session import local_rows, stage

CAPACITY = 4096
END = 1
MOST_WORDS = 200_000  # remembered per worker; workers keep them while other stages run
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, vocabulary: str, end: int = END, capacity: int = CAPACITY,
           with_ids: bool = False) -> DataFrame:
    """Token pieces of every whole text: ``doc_id, piece, start, length, ids_crc32`` and the ids
    themselves if asked for. Only texts above the capacity are cut."""

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(vocabulary, MOST_WORDS)
        for batch in batches:
            texts = batch.column(1)
            for part in tokens.slices(texts):
                ids, edges = encoder.encode(texts[part], end)
                ids = ids.astype("<u4")
                edges = edges.tolist()
                rows, starts, crcs, numbers, sizes, kept = [], [], [], [], [], []
                for i in range(len(edges) - 1):
                    for number, a in enumerate(range(edges[i], edges[i + 1], capacity)):
                        own = ids[a:min(a + capacity, edges[i + 1])]
                        rows.append(part.start + i)
                        numbers.append(number)
                        starts.append(a - edges[i])
                        sizes.append(len(own))
                        crcs.append(zlib.crc32(own))
                        if with_ids:
                            kept.append(own.astype(np.int32))
                columns = [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(numbers, pa.int32()),
                           *[pa.array(c, pa.int64()) for c in (starts, sizes, crcs)]]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array(kept, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = PIECES + (", ids array<int>" if with_ids else "")
    return docs.select(F.col("doc_id").cast("long"), whole().alias("text")).mapInArrow(lean(convert, tokens=True), schema)


class _Gaps:
    """Sequences that still have room: for each gap, runs of (first sequence, how many)."""

    def __init__(self):
        self.runs: dict[int, list[tuple[int, int]]] = {}
        self.sizes: list[int] = []

    def add(self, gap: int, first: int, count: int) -> None:
        if gap > 0 and count > 0:
            if gap not in self.runs:
                self.runs[gap] = []
                insort(self.sizes, gap)
            heapq.heappush(self.runs[gap], (first, count))

    def take(self, least: int) -> tuple[int, int, int] | None:
        """The smallest gap of at least so much, and one run of it."""
        at = bisect_left(self.sizes, least)
        if at == len(self.sizes):
            return None
        gap = self.sizes[at]
        first, count = heapq.heappop(self.runs[gap])
        if not self.runs[gap]:
            del self.runs[gap], self.sizes[at]
        return gap, first, count


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Rows ``(length, from, to, sequence, each, offset)``: the pieces of that length with places
    from..to-1 go ``each`` to a sequence, from that sequence on, beginning at that offset."""
    out, used, gaps, place = [], 0, _Gaps(), dict.fromkeys(counts, 0)

    def put(length: int, number: int, first: int, each: int, offset: int) -> None:
        out.append((length, place[length], place[length] + number, first, each, offset))
        place[length] += number

    left = {n: c for n, c in counts.items() if 3 * n > capacity and c > 0}
    longest = sorted(left, reverse=True)
    ascending = sorted(left)
    for length in longest:
        while left[length]:
            # The longest that fits beside it: the largest with some left, itself included.
            while ascending and not left[ascending[-1]]:
                ascending.pop()
            at = bisect_left(ascending, capacity - length + 1) - 1
            while at >= 0 and not left[ascending[at]]:
                del ascending[at]
                at -= 1
            other = ascending[at] if at >= 0 else None
            if other == length and left[length] == 1:
                other = next((n for n in reversed(ascending[:at]) if left[n]), None)
            if other is None:
                number = left[length]
                put(length, number, used, 1, 0)
                gaps.add(capacity - length, used, number)
                left[length] = 0
            else:
                number = left[length] // 2 if other == length else min(left[length], left[other])
                put(length, number, used, 1, 0)
                put(other, number, used, 1, length)
                gaps.add(capacity - length - other, used, number)
                left[length] -= number
                left[other] -= number
            used += number
    for length in sorted((n for n in counts if 3 * n <= capacity), reverse=True):
        rest = counts[length]
        while rest:
            found = gaps.take(length)
            if found is None:
                gap, first, many = capacity, used, -(-rest // (capacity // length))
                used += many
            else:
                gap, first, many = found
            each = gap // length
            full = min(many, rest // each)
            if full:
                put(length, full * each, first, each, capacity - gap)
                gaps.add(gap - each * length, first, full)
                rest -= full * each
            if full < many and rest:
                put(length, rest, first + full, rest, capacity - gap)
                gaps.add(gap - rest * length, first + full, 1)
                full += 1
                rest = 0
            gaps.add(gap, first + full, many - full)
    return out


def place(pieces_: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows with ``length``; other columns pass through.

    The rows are read twice, so a caller hands over a written table.
    """
    spark = pieces_.sparkSession
    salts = partitions(spark)
    salted = pieces_.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)).cast("int"))
    per = stage(salted.groupBy("length", "_salt").agg(F.count("*").alias("_n")))
    counts = {int(n): int(c) for n, c in per.groupBy("length").agg(F.sum("_n")).collect()}
    rows = local_rows(spark, plan(counts, capacity),
                      "_length long, _from long, _to long, _first long, _each long, _offset long")
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    base = per.withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    within = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece")
    placed = (
        salted.withColumn("_in", F.row_number().over(within) - 1).join(base, ["length", "_salt"])
        .withColumn("_place", F.col("_base") + F.col("_in"))
    )
    at = (F.col("length") == F.col("_length")) & (F.col("_place") >= F.col("_from")) & (F.col("_place") < F.col("_to"))
    step = F.col("_place") - F.col("_from")
    return placed.join(F.broadcast(rows), at).select(
        *pieces_.columns,
        (F.col("_first") + F.floor(step / F.col("_each"))).cast("long").alias("sequence_id"),
        (F.col("_offset") + step % F.col("_each") * F.col("length")).cast("long").alias("offset"))


def pack(docs: DataFrame, vocabulary: str, end: int = END, capacity: int = CAPACITY) -> DataFrame:
    """Tokenised pieces of all documents with their places in sequences."""
    return place(stage(pieces(docs, vocabulary, end, capacity)), capacity)


def sequences(docs: DataFrame, vocabulary: str, end: int = END, capacity: int = CAPACITY) -> DataFrame:
    """The packed sequences themselves: ``sequence_id, ids``; each has at most ``capacity`` ids."""
    placed = place(stage(pieces(docs, vocabulary, end, capacity, with_ids=True)), capacity)
    gathered = placed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("_parts"))
    return gathered.select("sequence_id", F.flatten(F.col("_parts.ids")).alias("ids"))
