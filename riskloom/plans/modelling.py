"""Prepare, fit both models, evaluate and compare them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from riskloom.operators import evaluate, models
from riskloom.operators.models import FOREST, LOGISTIC
from riskloom.operators.prepare import LABEL, Prepared, prepare, stratified_split
from riskloom.operators.ranking import ranked_scores
from riskloom.session import stage
from riskloom.sources.tables import cached
from riskloom.spec import RoleSpec, normalise

# On equal ROC-AUC the trainer prefers the forest, the dashboard the first listed.
TRAINER_PRIORITY = [FOREST, LOGISTIC]
DASHBOARD_PRIORITY = [LOGISTIC, FOREST]


@dataclass(frozen=True)
class Compared:
    """Fitted scorers by name and every evaluation table over the test rows."""

    prepared: Prepared
    scorers: dict[str, PipelineModel]
    scored: DataFrame
    metrics: DataFrame
    confusion: DataFrame
    report: DataFrame
    roc: DataFrame
    importances: DataFrame
    coefficients: DataFrame
    best: DataFrame


def spread(df: DataFrame) -> DataFrame:
    """At least one partition per core for the iterative fits; a large table already has more."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def train(df: DataFrame, spec: RoleSpec, priority=TRAINER_PRIORITY, seed: int = 42, **forest) -> Compared:
    ready = prepare(df, spec, seed=seed)
    train_rows = cached(spread(ready.train.select("features", LABEL)))
    logistic = models.fit_logistic(train_rows)
    forest_model = models.fit_forest(train_rows, seed=seed, **forest)
    train_rows.unpersist()
    scored = stage(
        models.predict(logistic, ready.test, LOGISTIC, [spec.id])
        .unionByName(models.predict(forest_model, ready.test, FOREST, [spec.id]))
    )
    ranked = stage(ranked_scores(scored))
    measured = evaluate.metrics(scored, ranked=ranked)
    return Compared(
        prepared=ready,
        scorers={
            LOGISTIC: models.with_model(ready.model, logistic),
            FOREST: models.with_model(ready.model, forest_model),
        },
        scored=scored,
        metrics=evaluate.compare(measured),
        confusion=evaluate.confusion_cells(scored),
        report=evaluate.class_report(scored),
        roc=evaluate.with_diagonal(evaluate.roc_points(scored, ranked=ranked)),
        importances=models.importances(df, forest_model, ready.names),
        coefficients=models.coefficients(df, logistic, ready.names),
        best=evaluate.best_model(measured, list(priority)),
    )


def scorers(df, spec: RoleSpec, folder: str, **kw) -> dict[str, PipelineModel]:
    """Both scorers from ``folder``; trained and saved there first when absent. ``df`` is a table,
    or a function that makes it, which is only called when training is needed."""
    made: dict[str, PipelineModel] = {}

    def fit(name: str) -> PipelineModel:
        if not made:
            made.update(train(df() if callable(df) else df, spec, **kw).scorers)
        return made[name]

    return {
        name: models.load_or_fit(f"{folder}/{slug}", lambda name=name: fit(name))
        for name, slug in ((LOGISTIC, "logistic"), (FOREST, "forest"))
    }


@dataclass(frozen=True)
class Legacy:
    model: PipelineModel
    report: DataFrame
    confusion: DataFrame
    scored: DataFrame  # the held-out rows


def train_legacy(raw: DataFrame, spec: RoleSpec, seed: int = 42, **forest) -> Legacy:
    """The older flow: integer codes, raw table, one forest."""
    split = stage(stratified_split(normalise(raw), spec, seed=seed).withColumn(LABEL, F.col(spec.target).cast("double")))
    model = models.fit_legacy(split.filter("not is_test"), spec, seed=seed, **forest)
    scored = stage(models.predict(model, split.filter("is_test"), FOREST, [spec.id]))
    return Legacy(model, evaluate.class_report(scored), evaluate.confusion_cells(scored), scored)
