"""Correlations of many columns from blocks of co-moments.

The columns are cut into blocks. One pass over the rows gives, per partition and pair of blocks,
matrices of counts, sums and sums of products over the rows where both columns are present (matrix
products of what a task has read). They are added up per pair of blocks, as they arrive; a plan has
a few nodes whatever the number of columns. Values are taken from their column's mean, so that the
differences of sums keep their digits.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskloom.spec import normalise

BLOCK = 64
ROWS = 4096
# A variance below this share of the mean square is what rounding leaves of a constant.
CONSTANT = 1e-14
KINDS = 6


def _products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Counts, sums of either side, of their squares and of products, over rows with both values."""
    a, b = np.isfinite(left), np.isfinite(right)
    x, y = np.where(a, left, 0.0), np.where(b, right, 0.0)
    a, b = a.astype(float), b.astype(float)
    return np.stack([a.T @ b, x.T @ b, a.T @ y, (x * x).T @ b, a.T @ (y * y), x.T @ y])


def _r(total: np.ndarray) -> np.ndarray:
    """Pearson's r from the sums; NaN where a side is constant or fewer than two rows have both."""
    n, x, y, xx, yy, xy = total
    with np.errstate(all="ignore"):
        vx, vy = xx - x * x / n, yy - y * y / n
        r = (xy - x * y / n) / np.sqrt(vx * vy)
        return np.where((n < 2) | (vx <= CONSTANT * xx) | (vy <= CONSTANT * yy), np.nan, np.clip(r, -1.0, 1.0))


def pearson(df: DataFrame, left: Sequence[str], right: Sequence[str], block: int = BLOCK) -> DataFrame:
    """(a, b, r) by places in ``left`` and ``right``; only a <= b where both are the same columns.

    Missing values and infinite ones take no part; r is NULL where it has no value.
    """
    same = list(left) == list(right)
    columns = list(dict.fromkeys([*left, *right]))
    rows = normalise(df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(columns)]))
    finite = [F.when(F.abs(f"c{i}") < float("inf"), F.col(f"c{i}")) for i in range(len(columns))]
    means = np.array([m or 0.0 for m in rows.agg(*[F.avg(c) for c in finite]).first()])
    place = {c: i for i, c in enumerate(columns)}
    sides = [np.array([place[c] for c in side]) for side in (left, right)]
    cuts = [[(i, min(i + block, len(side))) for i in range(0, len(side), block)] for side in sides]
    pairs = [(i, j) for i in range(len(cuts[0])) for j in range(len(cuts[1])) if not same or i <= j]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                some = batch.slice(at, ROWS)
                values = np.column_stack([c.to_numpy(zero_copy_only=False) for c in some.columns]).astype(float) - means
                for i, j in pairs:
                    (a, b), (c, d) = cuts[0][i], cuts[1][j]
                    got = _products(values[:, sides[0][a:b]], values[:, sides[1][c:d]])
                    total[i, j] = total[i, j] + got if (i, j) in total else got
        for (i, j), sums in total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([i], pa.int32()), pa.array([j], pa.int32()), pa.array([sums.ravel()], pa.list_(pa.float64()))],
                names=["i", "j", "sums"])

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for i, j, sums in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                got = sums.values.to_numpy()
                total[i, j] = total[i, j] + got if (i, j) in total else got
        for (i, j), sums in total.items():
            (a, b), (c, d) = cuts[0][i], cuts[1][j]
            r = _r(sums.reshape(KINDS, b - a, d - c))
            x, y = np.meshgrid(np.arange(a, b), np.arange(c, d), indexing="ij")
            keep = (x <= y).ravel() if same else np.ones(r.size, bool)
            r = r.ravel()[keep]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x.ravel()[keep], pa.int32()), pa.array(y.ravel()[keep], pa.int32()), pa.array(r, mask=np.isnan(r))],
                names=["a", "b", "r"])

    parts = rows.mapInArrow(partial, "i int, j int, sums array<double>")
    spread = min(len(pairs), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    found = parts.repartition(max(spread, 1), "i", "j").mapInArrow(merged, "a int, b int, r double")
    # A table without rows has no sums; every pair still has its row.
    width = len(right)
    every = df.sparkSession.range(len(left) * width).select(
        F.expr(f"int(id div {width})").alias("a"), (F.col("id") % width).cast("int").alias("b"))
    if same:
        every = every.filter("a <= b")
    return every.join(found, ["a", "b"], "left")
