import random
import re

import pytest

from helpers import rows
from riskloom.operators import evaluate as ev
from riskloom.operators.ranking import ranked_scores

SCHEMA = "model string, label int, prediction int, score double"


def scored(spark, data, model="m"):
    return spark.createDataFrame([(model, y, int(s >= 0.5), s) for y, s in data], SCHEMA)


def brute_auc(data):
    pos, neg = [s for y, s in data if y], [s for y, s in data if not y]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def brute_curve(data):
    out, p, n = [], sum(y for y, _ in data), sum(1 - y for y, _ in data)
    for t in sorted({s for _, s in data}, reverse=True):
        out.append((t, sum(1 - y for y, s in data if s >= t) / n, sum(y for y, s in data if s >= t) / p))
    return out


@pytest.mark.parametrize("per_bucket", [1 << 20, 7, 1])
def test_auc_and_curve_against_brute_force(spark, per_bucket):
    draw = random.Random(5)
    data = [(int(draw.random() < 0.4), round(draw.random(), 2)) for _ in range(300)]
    data += [(1, 0.5)] * 50 + [(0, 0.5)] * 60
    df = scored(spark, data).repartition(4)
    ranked = ranked_scores(df, per_bucket=per_bucket)
    assert ev.roc_auc(df, ranked).first()["auc"] == pytest.approx(brute_auc(data), abs=1e-12)
    curve = ev.roc_points(df, drop_intermediate=False, ranked=ranked).collect()
    got = sorted(((r["threshold"], r["fpr"], r["tpr"]) for r in curve), reverse=True)
    assert got[0] == (float("inf"), 0.0, 0.0)
    want = brute_curve(data)
    assert len(got) == len(want) + 1
    assert all(a == pytest.approx(b) for a, b in zip(got[1:], want))
    kept = ev.roc_points(df, ranked=ranked).collect()
    rest = {(r["threshold"], r["fpr"], r["tpr"]) for r in kept}
    assert rest <= set(got)
    # what was left out lies on a straight line between its neighbours
    for prev, here, after in zip(got[1:], got[2:], got[3:]):
        if here not in rest:
            assert (here[1] - prev[1], here[2] - prev[2]) == pytest.approx((after[1] - here[1], after[2] - here[2]))


def test_ties_and_one_class(spark):
    tied = scored(spark, [(1, 0.5), (0, 0.5), (0, 0.5)])
    assert ev.roc_auc(tied).first()["auc"] == 0.5
    assert rows(ev.roc_points(tied), "fpr", "tpr") == [(0.0, 0.0), (1.0, 1.0)]
    one = scored(spark, [(0, 0.2), (0, 0.3)])
    got = {r["metric"]: r["value"] for r in ev.metrics(one).collect()}
    assert got == {"Acurácia": 1.0, "Precisão": 0.0, "Recall": 0.0, "F1-Score": 0.0, "ROC-AUC": None}


def test_confusion_cells_are_complete(spark):
    df = scored(spark, [(1, 0.9), (1, 0.8)])
    assert rows(ev.confusion_cells(df), "actual", "predicted", "n") == [
        ("Evadiu", "Evadiu", 2), ("Evadiu", "Não Evadiu", 0),
        ("Não Evadiu", "Evadiu", 0), ("Não Evadiu", "Não Evadiu", 0)]


def test_report(spark):
    df = scored(spark, [(1, 0.9), (1, 0.1), (0, 0.2), (0, 0.7), (0, 0.1)])
    got = {r["row"]: r for r in ev.class_report(df).collect()}
    assert got["Evadiu"]["precision"] == 0.5 and got["Evadiu"]["recall"] == 0.5 and got["Evadiu"]["support"] == 2
    assert got["Não Evadiu"]["recall"] == pytest.approx(2 / 3)
    assert got["accuracy"]["f1"] == 0.6
    assert got["macro avg"]["recall"] == pytest.approx((0.5 + 2 / 3) / 2)
    assert got["weighted avg"]["recall"] == pytest.approx(0.6)


def test_winner_follows_the_priority_on_a_tie(spark):
    m = spark.createDataFrame([("a", "ROC-AUC", 0.9), ("b", "ROC-AUC", 0.9), ("c", "ROC-AUC", None)],
                              "model string, metric string, value double")
    assert ev.best_model(m, ["b", "a"]).first()["model"] == "b"
    assert ev.best_model(m, ["a", "b"]).first()["model"] == "a"
    assert rows(ev.compare(m), "model", "best") == [("a", True), ("b", True), ("c", False)]
    assert ev.with_diagonal(ev.roc_points(scored(spark, [(1, 0.9), (0, 0.1)]))).filter("model = 'Aleatório'").count() == 2


def test_rows_without_score_or_label_are_left_out(spark):
    df = spark.createDataFrame([("m", 1, 1, 0.9), ("m", 0, 0, 0.1), ("m", None, 1, 0.4), ("m", 1, None, None),
                                ("m", 0, 1, float("nan"))], SCHEMA)
    assert ev.roc_auc(df).first()["auc"] == 1.0


def test_curve_does_not_shuffle_scores_by_model(spark):
    draw = random.Random(6)
    df = scored(spark, [(int(draw.random() < 0.5), draw.random()) for _ in range(500)])
    points = ev.roc_points(df, ranked=ranked_scores(df, per_bucket=50))
    plan = points._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" in plan
    assert not re.search(r"hashpartitioning\(model#\d+, \d+\)", plan)
    assert points.filter("fpr = 0 and tpr = 0 and threshold > 1").count() == 1
