"""Evaluation of scored rows (model, label, prediction, score) as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from riskloom.functions.columns import half_even, label_of, ratio
from riskloom.operators.ranking import ranked_scores
from riskloom.session import local_rows

# Metric names in report order, and class names.
METRICS = ("Acurácia", "Precisão", "Recall", "F1-Score", "ROC-AUC")
CLASS_NAMES = {0: "Não Evadiu", 1: "Evadiu"}
RANDOM = "Aleatório"


def confusion(scored: DataFrame) -> DataFrame:
    """(model, tn, fp, fn, tp), counted in one pass; an empty cell is 0."""
    actual, said = F.col("label") == 1, F.col("prediction") == 1
    return scored.groupBy("model").agg(
        F.count_if(~actual & ~said).alias("tn"), F.count_if(~actual & said).alias("fp"),
        F.count_if(actual & ~said).alias("fn"), F.count_if(actual & said).alias("tp"),
    )


def confusion_cells(scored: DataFrame, names: dict = CLASS_NAMES) -> DataFrame:
    """(model, actual, predicted, n): always four rows per model."""
    cells = F.array(*[
        F.struct(F.lit(names[a]).alias("actual"), F.lit(names[p]).alias("predicted"), F.col(c).alias("n"))
        for c, a, p in (("tn", 0, 0), ("fp", 0, 1), ("fn", 1, 0), ("tp", 1, 1))
    ])
    return confusion(scored).select("model", F.inline(cells))


def roc_auc(scored: DataFrame, ranked: DataFrame | None = None) -> DataFrame:
    """(model, auc): chance that a positive outranks a negative, ties count one half; NULL when
    only one class occurs."""
    ranked = ranked_scores(scored) if ranked is None else ranked
    pos, neg, above = (F.col(c).cast("double") for c in ("pos", "neg", "cum_neg"))
    wins = F.sum(pos) * F.sum(neg) - F.sum(pos * above) + F.sum(pos * neg) / 2.0
    return ranked.groupBy("model").agg(ratio(wins, F.sum(pos) * F.sum(neg), None).alias("auc"))



def metrics(scored: DataFrame, decimals: int | None = 4, ranked: DataFrame | None = None) -> DataFrame:
    """(model, metric, value): accuracy, precision, recall, F1 and ROC-AUC."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    values = (
        ratio(tn + tp, tn + fp + fn + tp), ratio(tp, tp + fp), ratio(tp, tp + fn),
        ratio(tp * 2, tp * 2 + fp + fn), F.col("auc"),
    )
    if decimals is not None:
        values = tuple(half_even(v, decimals) for v in values)
    rows = F.array(*[F.struct(F.lit(n).alias("metric"), v.alias("value")) for n, v in zip(METRICS, values)])
    return confusion(scored).join(roc_auc(scored, ranked), "model", "left").select("model", F.inline(rows))


def class_report(scored: DataFrame, names: dict = CLASS_NAMES) -> DataFrame:
    """(model, row, precision, recall, f1, support): one row per class, accuracy, and the macro and
    support-weighted averages."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    n0, n1 = tn + fp, fn + tp
    c0 = (ratio(tn, tn + fn), ratio(tn, n0), ratio(tn * 2, tn * 2 + fn + fp))
    c1 = (ratio(tp, tp + fp), ratio(tp, n1), ratio(tp * 2, tp * 2 + fp + fn))
    n = n0 + n1
    none = F.lit(None).cast("double")
    rows = [
        (names[0], *c0, n0),
        (names[1], *c1, n1),
        ("accuracy", none, none, ratio(tn + tp, n), n),
        ("macro avg", *[(a + b) / 2.0 for a, b in zip(c0, c1)], n),
        ("weighted avg", *[ratio(a * n0 + b * n1, n) for a, b in zip(c0, c1)], n),
    ]
    fields = ("row", "precision", "recall", "f1", "support")
    cells = [F.struct(F.lit(r[0]).alias("row"), *[v.alias(f) for v, f in zip(r[1:], fields[1:])]) for r in rows]
    return confusion(scored).select("model", F.inline(F.array(*cells)))


def roc_points(
    scored: DataFrame, drop_intermediate: bool = True, ranked: DataFrame | None = None, max_points: int | None = None
) -> DataFrame:
    """(model, threshold, fpr, tpr) from (0, 0), whose threshold is infinite, to (1, 1).

    ``max_points`` bounds the points of a model. The way along the curve, fpr + tpr, rises from 0 to
    2 and is cut into max_points - 3 cells; the last point of each stays, and the first of all. All
    points between two that stay are in the cell of the second, so the area under the curve changes
    by at most ``area_bound(max_points)``. Points that stay are points of the full curve.

    ``drop_intermediate`` leaves out points on a straight line between their neighbours: those
    whose next score carries the same counts. The first and last scores always stay. Everything is
    row-wise: totals come with the ranked scores, and the start goes with each model's first score.
    """
    ranked = ranked_scores(scored) if ranked is None else ranked
    first = F.col("cum_pos") + F.col("cum_neg") == F.col("pos") + F.col("neg")
    if drop_intermediate:
        last = F.col("next_pos").isNull()
        bend = (F.col("next_pos") != F.col("pos")) | (F.col("next_neg") != F.col("neg"))
        ranked = ranked.filter(first | last | bend)
    if max_points is not None:
        cells = _cells(max_points)
        step = lambda pos, neg: F.floor((F.coalesce(ratio(neg, F.col("all_neg"), None), F.lit(0.0)) + F.coalesce(
            ratio(pos, F.col("all_pos"), None), F.lit(0.0))) * cells / 2.0)
        here = step(F.col("cum_pos"), F.col("cum_neg"))
        after = step(F.col("cum_pos") + F.col("next_pos"), F.col("cum_neg") + F.col("next_neg"))
        ranked = ranked.filter(first | F.col("next_pos").isNull() | (after > here))
    fields = ("threshold", "fpr", "tpr")
    here = (
        F.col("score"), ratio(F.col("cum_neg"), F.col("all_neg"), None), ratio(F.col("cum_pos"), F.col("all_pos"), None)
    )
    start = F.struct(*[F.lit(v).alias(f) for v, f in zip((float("inf"), 0.0, 0.0), fields)])
    point = F.struct(*[v.alias(f) for v, f in zip(here, fields)])
    return ranked.select("model", F.inline(F.when(first, F.array(start, point)).otherwise(F.array(point))))


def _cells(max_points: int) -> int:
    if max_points < 4:
        raise ValueError("a curve has at least four points")
    return max_points - 3


def area_bound(max_points: int) -> float:
    """How far the area under a curve of so many points may be from the full curve's.

    With cells of length d = 2 / cells, left-out points lie behind a step of length s into a cell.
    The triangle of that step and the way on within the cell is at most s * d / 2, what the curve
    does within the cell at most d * d / 8; the steps add up to 2, the cells to 2.
    """
    return 2.5 / _cells(max_points)


def with_diagonal(points: DataFrame) -> DataFrame:
    """The curve plus the two end points of a random classifier."""
    ends = local_rows(
        points.sparkSession, [(RANDOM, None, 0.0, 0.0), (RANDOM, None, 1.0, 1.0)],
        "model string, threshold double, fpr double, tpr double",
    )
    return points.unionByName(ends)


def compare(measured: DataFrame) -> DataFrame:
    """(model, metric, value, best): marks the best value of each metric, all of them on a tie."""
    top = F.max("value").over(Window.partitionBy("metric"))
    return measured.withColumn("best", F.coalesce(F.col("value") == top, F.lit(False)))


def compare_wide(measured: DataFrame) -> DataFrame:
    """One row per model, one column per metric."""
    return measured.groupBy("model").pivot("metric", list(METRICS)).agg(F.first("value"))


def best_model(measured: DataFrame, priority: list[str], metric: str = "ROC-AUC") -> DataFrame:
    """(model, value) of the winner; equal values go to the model listed first in ``priority``."""
    rank = {name: i for i, name in enumerate(priority)}
    place = F.coalesce(label_of(F.col("model"), rank), F.lit(len(priority)))
    return (
        measured.filter(F.col("metric") == metric)
        .orderBy(F.desc_nulls_last("value"), place, "model").limit(1).select("model", "value")
    )
