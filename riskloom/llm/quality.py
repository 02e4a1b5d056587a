"""Quality classifier: regularised quadratic discriminant analysis over document statistics.

Statistics of the whole text become features (logarithms of sizes, square roots of shares). Each
class has a Gaussian whose covariance is shrunk towards a scaled identity; the score is the
logistic of the difference of the two log densities. Spark sums counts, features and their products
over all labelled rows in one aggregate (a row of 2 * (1 + k + k^2) numbers per partition); the
driver turns them into means and Cholesky factors, and these few numbers go to the tasks, which
solve against the cached factors for a batch of documents at a time.

Defined results: a null text counts as empty and is scored like any other; a row without a label,
or with a label other than 0 and 1, teaches nothing; with one class only, all scores are that
class's label; with none, 0.5; several labels of a document all count; an empty table gives an
empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from riskloom.llm.common import lean, whole

SHRINK = 0.05
FOLDS, HELD_OUT = 3, 1
_KINDS = ("space", "line", "upper", "lower", "digit", "stop", "mark", "symbol", "high")
FEATURES = (
    "log_bytes", "log_words", "word_length", "line_share", "upper_share", "digit_share", "stop_share",
    "mark_share", "symbol_share", "high_share", "run_share", "spread", "fresh_share",
)


def _byte_kinds() -> np.ndarray:
    """The kind of each byte, as a place in ``_KINDS``."""
    kinds = np.full(256, _KINDS.index("symbol"), np.int64)
    for name, members in (("space", b" \t\r\x0b\x0c"), ("line", b"\n"), ("stop", b".,;:?"), ("mark", b"!\"'()-")):
        kinds[list(members)] = _KINDS.index(name)
    for name, first, last in (("upper", 65, 90), ("lower", 97, 122), ("digit", 48, 57), ("high", 128, 255)):
        kinds[first:last + 1] = _KINDS.index(name)
    return kinds


_KIND = _byte_kinds()


def statistics(text: bytes) -> list[float]:
    """The transformed statistics of one whole text, in the order of ``FEATURES``."""
    data = np.frombuffer(text, np.uint8)
    n = len(data)
    if n == 0:
        return [0.0] * len(FEATURES)
    counts = np.bincount(data, minlength=256)
    kind = np.bincount(_KIND, weights=counts, minlength=len(_KINDS))
    space, line, upper, _, digit, stop, mark, symbol, high = kind
    words = text.split()
    letters = max(n - space - line, 1)
    some = counts[counts > 0] / n
    runs = np.count_nonzero(data[1:] == data[:-1])
    many = max(len(words), 1)
    return [
        np.log1p(n), np.log1p(len(words)), np.log1p(letters / many), np.sqrt(line / n), np.sqrt(upper / letters),
        np.sqrt(digit / letters), np.sqrt(stop / letters), np.sqrt(mark / letters), np.sqrt(symbol / letters),
        np.sqrt(high / letters), np.sqrt(runs / n), float(-(some * np.log(some)).sum()), len(set(words)) / many,
    ]


def features(docs: DataFrame, *keep: str) -> DataFrame:
    """The kept columns and ``x``, an array of the statistics."""

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [statistics((t.as_py() or "").encode()) for t in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(x, pa.list_(pa.float64()))], names=[*keep, "x"])

    rows = docs.select(*keep, whole().alias("_text"))
    fields = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    return rows.mapInArrow(lean(convert), f"{fields}{', ' if keep else ''}x array<double>")


@dataclass(frozen=True)
class Discriminant:
    """Per class: log prior minus half the log determinant, mean, and the Cholesky factor."""

    constants: np.ndarray
    means: np.ndarray
    factors: np.ndarray
    only: float | None = None

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.only is not None:
            return np.full(len(x), self.only)
        logs = []
        for constant, mean, factor in zip(self.constants, self.means, self.factors):
            z = np.linalg.solve(factor, (x - mean).T)
            logs.append(constant - 0.5 * (z * z).sum(axis=0))
        return 1.0 / (1.0 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))


def fit(labelled: DataFrame, shrink: float = SHRINK) -> Discriminant:
    """From rows ``x, label``: one pass over all of them."""
    k = len(FEATURES)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 + k + k * k))
        for batch in batches:
            x = np.array(batch.column(0).to_pylist(), float).reshape(-1, k)
            label = np.array(batch.column(1).to_pylist())
            for c in (0, 1):
                own = x[label == c]
                total[c] += np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
        yield pa.RecordBatch.from_pydict({
            "label": pa.array([0, 1], pa.int32()), "sums": pa.array(list(total), pa.list_(pa.float64()))})

    rows = labelled.filter("label in (0, 1)").select("x", F.col("label").cast("int"))
    parts = rows.mapInArrow(lean(sums), "label int, sums array<double>")
    added = parts.select("label", F.posexplode("sums").alias("at", "value")).groupBy("label", "at").agg(
        F.sum("value").alias("value")).collect()
    total = np.zeros((2, 1 + k + k * k))
    for label, at, value in added:
        total[label, at] = value
    return solve(total, k, shrink)


def solve(total: np.ndarray, k: int, shrink: float) -> Discriminant:
    """Means and Cholesky factors from the classes' counts, sums and sums of products."""
    n = total[:, 0]
    none = np.zeros((2, k)), np.zeros((2, k, k))
    if not n.all():
        return Discriminant(np.zeros(2), *none, only=0.5 if not n.any() else float(n[1] > 0))
    means = total[:, 1:1 + k] / n[:, None]
    constants, factors = [], []
    for c in (0, 1):
        cov = total[c, 1 + k:].reshape(k, k) / n[c] - np.outer(means[c], means[c])
        cov = (1 - shrink) * cov + (shrink * np.trace(cov) / k + 1e-9) * np.eye(k)
        factor = np.linalg.cholesky(cov)
        factors.append(factor)
        constants.append(np.log(n[c] / n.sum()) - np.log(np.diag(factor)).sum())
    return Discriminant(np.array(constants), means, np.array(factors))


def scores(docs: DataFrame, model: Discriminant, least: float | None = None) -> DataFrame:
    """The rows with a ``score`` as last column; with ``least``, only those that reach it, and
    without the score. Any other columns pass through, whatever their names."""
    at = docs.columns.index("text")
    names = [*docs.columns, "score"]

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [statistics((t.as_py() or "").encode()) for t in batch.column(at)]
            score = model.score(np.array(x, float).reshape(-1, len(FEATURES)))
            if least is None:
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score, pa.float64())], names=names)
            else:
                yield batch.filter(pa.array(score >= least))

    score = [T.StructField("score", T.DoubleType())] if least is None else []
    return docs.mapInArrow(lean(convert), T.StructType([*docs.schema.fields, *score]))


def fold(folds: int = FOLDS) -> Column:
    """The fold of a document: the CRC-32 of its id as text, modulo the number of folds."""
    return F.crc32(F.col("doc_id").cast("string")) % folds


def teaching(known: DataFrame, labels: DataFrame, held_out: int = HELD_OUT, folds: int = FOLDS) -> DataFrame:
    """From rows ``doc_id, x`` the labelled ones outside the held-out fold, ``x, label``."""
    own = labels.filter(fold(folds) != held_out).select(F.col("doc_id").alias("_id"), F.col("quality").alias("label"))
    return known.join(own, F.col("doc_id") == F.col("_id")).select("x", "label")


def trained(docs: DataFrame, labels: DataFrame, shrink: float = SHRINK) -> Discriminant:
    """Features are made before the join with the labels, so no text is shuffled."""
    return fit(teaching(features(docs, "doc_id"), labels), shrink)


def classify(docs: DataFrame, labels: DataFrame, shrink: float = SHRINK) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every document; a null id is not held out."""
    known = docs.select("doc_id", whole().alias("text"))
    held = F.coalesce(fold() == HELD_OUT, F.lit(False))
    return scores(known, trained(docs, labels, shrink)).select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, least: float = 0.5, shrink: float = SHRINK) -> DataFrame:
    """The documents that score at least so much, with all their columns."""
    return scores(docs, trained(docs, labels, shrink), least)
