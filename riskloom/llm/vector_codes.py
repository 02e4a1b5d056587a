"""Vector codes: a codebook per part of the vectors, entries found by a GNAT.

Components become whole numbers, so sums and squared distances are exact and results do not depend
on how rows are spread. A vector is cut into equal parts; each part position has a codebook of at
most 64 entries. Rounds of assigning parts and averaging entries go over all rows: each partition
sums by entry, Spark adds the sums up, and the driver gets one row per entry and component. The
codebooks and their trees, which do not grow with the rows, go to the tasks.

Each codebook's tree (a geometric near-neighbour access tree) has up to 8 split points a node, far
from each other; other entries go to the nearest. Every split point keeps, for every child, the range
of its distances to the child's entries. A query's distance to a split point and the best distance
so far rule a child out if even the nearest end of the range lies beyond, strictly; distances are
rounded down or up so that nothing is ruled out that could be as near. What remains is compared in
whole numbers, and of equals the lower entry wins.

Defined results: vectors that are null or hold a null or non-finite component are dropped; so are
those of another length than the smallest id's; a length that no whole parts fill is filled up with
zeros; components beyond 2 ** 19 in size count as that, so that sums of squares stay whole; rows are
ordered by id (null last), then components; fewer than 64 rows give fewer entries; repeated rows
give repeated results; null labels are one label; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from riskloom.llm.common import lean
from riskloom.session import pin, stage

SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2
DEGREE = 8
BOUND = 2.0**19
SLACK = 1e-12  # relative; a root of a whole number below 2 ** 63 is nearer than that
ROWS = 4096


def _squares(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Exact squared distances of queries (rows) to points (columns)."""
    total = np.zeros((len(queries), len(points)), np.int64)
    for i in range(points.shape[1]):
        apart = queries[:, i, None] - points[None, :, i]
        total += apart * apart
    return total


class Gnat:
    """A tree over the rows of ``points``, of those numbered ``own``."""

    def __init__(self, points: np.ndarray, own: np.ndarray | None = None, degree: int = DEGREE):
        own = np.arange(len(points)) if own is None else own
        self.points = points
        self.splits, rest = (own, own[:0]) if len(own) <= degree else self._far_apart(own, degree)
        self.children: list[Gnat | None] = [None] * len(self.splits)
        if not len(rest):
            return
        apart = _squares(points[rest], points[self.splits])
        child = apart.argmin(axis=1)
        root = np.sqrt(apart.astype(float))
        k = len(self.splits)
        # Ranges of distances from split point i to the entries of child j; an empty child is never met.
        self.low, self.high = np.full((k, k), np.inf), np.full((k, k), -np.inf)
        for j in range(k):
            mine = child == j
            if mine.any():
                self.low[:, j] = root[mine].min(axis=0) * (1 - SLACK)
                self.high[:, j] = root[mine].max(axis=0) * (1 + SLACK)
                self.children[j] = Gnat(points, rest[mine], degree)

    def _far_apart(self, own: np.ndarray, degree: int) -> tuple[np.ndarray, np.ndarray]:
        """Split points, each the farthest from those before, and the other entries."""
        points = self.points[own]
        chosen = [0]
        nearest = _squares(points, points[:1])[:, 0]
        while len(chosen) < degree:
            nearest[chosen] = -1
            chosen.append(int(nearest.argmax()))
            nearest = np.minimum(nearest, _squares(points, points[chosen[-1:]])[:, 0])
        return own[chosen], np.delete(own, chosen)

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each query's nearest entry, the lower of equals, and its squared distance."""
        best = np.full(len(queries), np.iinfo(np.int64).max)
        entry = np.full(len(queries), len(self.points))
        self._search(queries, np.arange(len(queries)), best, entry)
        return entry, best

    def _search(self, queries: np.ndarray, rows: np.ndarray, best: np.ndarray, entry: np.ndarray) -> None:
        squares = _squares(queries[rows], self.points[self.splits])
        for i, split in enumerate(self.splits.tolist()):
            square = squares[:, i]
            better = (square < best[rows]) | ((square == best[rows]) & (split < entry[rows]))
            best[rows[better]], entry[rows[better]] = square[better], split
        if not any(self.children):
            return
        root = np.sqrt(squares.astype(float))
        for j, child in enumerate(self.children):
            if child is None:
                continue
            reach = np.sqrt(best[rows].astype(float)) * (1 + SLACK)
            beyond = (self.low[None, :, j] - root * (1 + SLACK) > reach[:, None]) | (
                root * (1 - SLACK) - self.high[None, :, j] > reach[:, None])
            left = rows[~beyond.any(axis=1)]
            if len(left):
                child._search(queries, left, best, entry)


def _whole(vectors: pa.Array, dimension: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Which rows are kept, and their components as whole numbers; of one dimension, if given, else
    as many as the longest has, missing ones 0."""
    length = pc.fill_null(pc.list_value_length(vectors), -1).to_numpy(False)
    rows = np.flatnonzero(length >= 0 if dimension is None else length == dimension)
    some = vectors.take(pa.array(rows))
    size = length[rows]
    flat = some.flatten().cast(pa.float64()).to_numpy(False)
    bad = np.bincount(np.repeat(np.arange(len(rows)), size), weights=~np.isfinite(flat), minlength=len(rows)) > 0
    values = np.floor(np.clip(np.nan_to_num(flat, nan=0.0), -BOUND, BOUND) * SCALE).astype(np.int64)
    width = int(size.max()) if len(size) else 0
    out = np.zeros((len(rows), width), np.int64)
    out[np.repeat(np.arange(len(rows)), size), np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = values
    return rows[~bad], out[~bad]


def _cut(whole: np.ndarray, parts: int) -> np.ndarray:
    """Rows of components as rows of parts, filled up with zeros."""
    width = -(-whole.shape[1] // parts)
    out = np.zeros((len(whole), parts * width), np.int64)
    out[:, : whole.shape[1]] = whole
    return out.reshape(len(whole), parts, width)


def first_entries(vectors: DataFrame, entries: int) -> tuple[int, np.ndarray]:
    """The dimension, and the components of the rows with the smallest ids."""

    def smallest(dimension: int | None) -> list[list[int]]:
        def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, ROWS):
                    part = batch.slice(at, ROWS)
                    rows, whole = _whole(part.column(1), dimension)
                    size = pc.list_value_length(part.column(1)).take(pa.array(rows)).to_numpy(False).tolist()
                    lists = [w[:n] for w, n in zip(whole.tolist(), size)]
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).take(pa.array(rows)), pa.array(lists, pa.list_(pa.int64()))], names=["vec_id", "x"])

        kept = vectors.select("vec_id", "embedding").mapInArrow(lean(convert), "vec_id long, x array<long>")
        return [r.x for r in kept.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).collect()]

    found = smallest(None)
    dimension = len(found[0]) if found else 0
    if any(len(x) != dimension for x in found):
        found = smallest(dimension)
    return dimension, np.array(found, np.int64).reshape(len(found), dimension)


def _sums(vectors: DataFrame, dimension: int, books: np.ndarray) -> np.ndarray:
    """Per part, entry and component the sum over the parts assigned to it; last, their number."""
    parts, entries, width = books.shape

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Gnat(book) for book in books]
        total = np.zeros((parts, entries, width + 1), np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                cut = _cut(_whole(batch.column(0).slice(at, ROWS), dimension)[1], parts)
                for p, tree in enumerate(trees):
                    entry, _ = tree.nearest(cut[:, p])
                    np.add.at(total[p], entry, np.pad(cut[:, p], ((0, 0), (0, 1)), constant_values=1))
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel()], pa.list_(pa.int64()))], names=["sums"])

    rows = vectors.select("embedding").mapInArrow(lean(convert), "sums array<long>")
    added = rows.select(F.posexplode("sums").alias("at", "value")).groupBy("at").agg(F.sum("value").alias("value")).toArrow()
    total = np.zeros(books.size + parts * entries, np.int64)
    total[added["at"].to_numpy()] = added["value"].to_numpy()
    return total.reshape(parts, entries, width + 1)


def fit(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[int, np.ndarray]:
    """The dimension, and the codebooks by part, entry and component."""
    dimension, first = first_entries(vectors, entries)
    books = _cut(first, parts).transpose(1, 0, 2)
    for _ in range(rounds if len(first) else 0):
        total = _sums(vectors, dimension, books)
        n = total[:, :, -1:]
        books = np.where(n > 0, total[:, :, :-1] // np.maximum(n, 1), books)
    return dimension, books


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def encoder(dimension: int, books: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """From batches of id, label and vector to id, label, code and error."""

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Gnat(book) for book in books]
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                rows, whole = _whole(part.column(2), dimension)
                cut = _cut(whole, len(books))
                codes, error = np.zeros((len(rows), len(books)), np.uint8), np.zeros(len(rows), np.int64)
                for p, tree in enumerate(trees):
                    codes[:, p], squares = tree.nearest(cut[:, p])
                    error += squares
                kept = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(kept), part.column(1).take(kept), pa.array([c.tobytes().hex() for c in codes], pa.string()),
                     pa.array(error)], names=["vec_id", "label", "code", "error"])

    return convert


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` for every kept vector."""
    kind = vectors.schema["label"].dataType.simpleString()
    rows = vectors.select(F.col("vec_id").cast("long"), "label", "embedding")
    dimension, books = fit(rows, parts, entries, rounds)
    found = stage(rows.mapInArrow(lean(encoder(dimension, books)), f"vec_id long, label {kind}, code string, error long"))
    labels = pin(found.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error")))
    return found.join(labels, F.col("label").eqNullSafe(F.col("_label"))).select(
        "vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
