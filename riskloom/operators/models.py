"""Logistic regression and random forest, their explanations, and persistence."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from riskloom.functions.columns import effect, fixed_text, signed_text, text_bar
from riskloom.operators.clean import fill_values
from riskloom.operators.forest import TableForest, fit_table_forest
from riskloom.operators.prepare import FEATURES, LABEL
from riskloom.session import fresh_path, local_rows, pin, store_of
from riskloom.spec import RoleSpec, normalise

# Display names of the two models, in the order the dashboard lists them.
LOGISTIC, FOREST = "Regressão Logística", "Random Forest"

BINS = 256


def fit_logistic(train: DataFrame, c: float = 1.0, max_iter: int = 1000):
    """L2 logistic regression on the summed loss: the penalty per row is 1 / (n * C)."""
    return LogisticRegression(
        featuresCol=FEATURES, labelCol=LABEL, regParam=1.0 / (train.count() * c), elasticNetParam=0.0,
        standardization=False, maxIter=max_iter, tol=1e-10,
    ).fit(train)


def fit_forest(
    train: DataFrame, trees: int = 100, depth: int = 30, bins: int = BINS, seed: int = 42, memory_mb: int = 512
):
    """Gini forest on sqrt(features) per split, grown as deep as Spark grows trees. ``bins`` bounds
    the split candidates per feature and must not be below the number of categories.

    Two classes give a forest that stays a table (see ``forest``); ``memory_mb`` bounds what a task
    takes for the rows of the part of a tree it grows. More classes give Spark's own forest, where it
    bounds the statistics of the nodes that are split in one pass.
    """
    labels = train.agg(F.count("*").alias("n"), F.count_if(F.col(LABEL).isin(0, 1)).alias("binary")).first()
    if labels["n"] and labels["n"] == labels["binary"]:
        return fit_table_forest(train, FEATURES, LABEL, trees, depth, bins, seed, memory_mb)
    return RandomForestClassifier(
        featuresCol=FEATURES, labelCol=LABEL, numTrees=trees, maxDepth=depth, maxBins=bins, impurity="gini",
        featureSubsetStrategy="sqrt", seed=seed, maxMemoryInMB=memory_mb, cacheNodeIds=True, checkpointInterval=10,
    ).fit(train)


def fit_legacy(df: DataFrame, spec: RoleSpec, **kw) -> PipelineModel:
    """Integer-encoded forest on the raw table.

    Missing numerics, NULL or NaN, are filled with the median first, because Spark's trees take
    none; a missing category counts as the empty text. Categories not seen in training share one
    further code.
    """
    df = normalise(df)
    fills = {c: v for c, v in fill_values(df, spec).items() if c in spec.numeric}
    none = "CAST(NULL AS DOUBLE)"
    parts = [f"coalesce(nanvl(CAST(`{c}` AS DOUBLE), {none}), {fills.get(c, 0.0)!r}D) AS `__f_{c}`" for c in spec.numeric]
    parts += [f"coalesce(CAST(`{c}` AS STRING), '') AS `__c_{c}`" for c in spec.categorical]
    texts, index = [f"__c_{c}" for c in spec.categorical], [f"__e_{c}" for c in spec.categorical]
    features = [f"__f_{c}" for c in spec.numeric] + index
    helpers = ", ".join(f"`{c}`" for c in features + texts)
    prepared = Pipeline(stages=[
        SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__"),
        StringIndexer(inputCols=texts, outputCols=index, stringOrderType="alphabetAsc", handleInvalid="keep"),
        VectorAssembler(inputCols=features, outputCol=FEATURES),
        SQLTransformer(statement=f"SELECT * EXCEPT ({helpers}) FROM __THIS__"),
    ]).fit(df)
    most = max((len(labels) + 1 for labels in prepared.stages[1].labelsArray), default=0)
    return PipelineModel(stages=[*prepared.stages, fit_forest(prepared.transform(df), **{"bins": max(BINS, most)} | kw)])


def with_model(preparation: PipelineModel, model) -> PipelineModel:
    """Preparation and model as one object, so that they are saved and loaded together."""
    return PipelineModel(stages=[*preparation.stages, model])


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_or_fit(path: str, fit: Callable[[], PipelineModel]) -> PipelineModel:
    """The saved model, or a newly fitted and saved one when the folder holds none."""
    spark = SparkSession.active()
    store, place = store_of(spark, f"{path}/metadata")
    if store.exists(place):
        return PipelineModel.load(path)
    model = fit()
    save_model(model, path)
    return model


def predict(model, df: DataFrame, name: str, keep=()) -> DataFrame:
    """(keep..., model, label, prediction, score): hard class and probability of the positive one."""
    return model.transform(df).select(
        *keep, F.lit(name).alias("model"), F.col(LABEL).cast("int").alias("label"),
        F.col("prediction").cast("int").alias("prediction"),
        vector_to_array("probability")[1].alias("score"),
    )


def _by_slot(df: DataFrame, names: list[str], values, column: str) -> DataFrame:
    rows = [(i, n, float(v)) for i, (n, v) in enumerate(zip(names, values, strict=True))]
    return local_rows(df.sparkSession, rows, f"slot int, feature string, {column} double")


def importances(df: DataFrame, forest, names: list[str]) -> DataFrame:
    """(slot, feature, importance), sum 1. ``df`` only lends its session."""
    return _by_slot(df, names, forest.featureImportances.toArray(), "importance")


def tree_nodes(forest) -> DataFrame:
    """(tree, node, feature, threshold, left, right, counts): the grown trees, a row per node, as
    Spark saves them. ``counts`` holds the training rows of each class, by bootstrap weight; a leaf
    has NULL for the split, and a split by categories for the threshold."""
    spark = SparkSession.active()
    if isinstance(forest, TableForest):
        table = forest.nodes()
    else:
        path = fresh_path(spark, "forest")
        forest.write().save(path)
        table = spark.read.parquet(f"{path}/data")
    node, split = F.col("nodeData"), F.col("nodeData.split")
    inner = node["leftChild"] >= 0
    threshold = F.when(split["numCategories"] < 0, split["leftCategoriesOrThreshold"][0])
    return table.select(
        F.col("treeID").alias("tree"), node["id"].alias("node"), F.when(inner, split["featureIndex"]).alias("feature"),
        F.when(inner, threshold).alias("threshold"), F.when(inner, node["leftChild"]).alias("left"),
        F.when(inner, node["rightChild"]).alias("right"), node["impurityStats"].alias("counts"))


def gains(nodes: DataFrame) -> DataFrame:
    """(slot, gain): each feature's share of what the splits take from the rows' Gini impurity, every
    tree counting the same, from the class counts of the nodes alone. A feature that no tree splits
    by has no row, nor has a tree that is one leaf."""
    total = F.aggregate("counts", F.lit(0.0), lambda a, x: a + x)
    mixed = nodes.select("*", (total - F.aggregate("counts", F.lit(0.0), lambda a, x: a + x * x) / F.greatest(total, F.lit(1.0))).alias("impure"))
    # A node is there as a child with what it leaves over, and a split for either child with half of
    # what it had. Both of a child's rows come from one scan and mostly from one task.
    own = F.struct(F.col("node").alias("child"), F.lit(None).cast("int").alias("slot"), (-F.col("impure")).alias("taken"))
    half = lambda c: F.struct(F.col(c).alias("child"), F.col("feature").alias("slot"), (F.col("impure") / 2.0).alias("taken"))
    sides = mixed.select("tree", F.inline(F.when(F.col("feature").isNull(), F.array(own)).otherwise(F.array(own, half("left"), half("right")))))
    taken = sides.groupBy("tree", "child").agg(F.max("slot").alias("slot"), F.sum("taken").alias("taken"), F.count("*").alias("n")).filter(
        "n = 2 and slot is not null").groupBy("tree", "slot").agg(F.sum("taken").alias("taken"))
    whole = F.sum("taken").over(Window.partitionBy("tree"))
    shares = pin(taken.withColumn("all_taken", whole).filter("all_taken > 0").groupBy("slot").agg(F.sum(F.col("taken") / F.col("all_taken")).alias("share")))
    return shares.select("slot", (F.col("share") / shares.agg(F.sum("share")).scalar()).alias("gain"))


def coefficients(df: DataFrame, logistic, names: list[str]) -> DataFrame:
    """(slot, feature, coefficient) in log-odds, signed text and direction, smallest first."""
    c = F.col("coefficient")
    return (
        _by_slot(df, names, logistic.coefficients.toArray(), "coefficient")
        .withColumns({"text": signed_text(c, 3), "effect": effect(c)}).orderBy("coefficient", "feature")
    )


def top_importances(table: DataFrame, k: int = 10) -> DataFrame:
    """(place, feature, importance, text, bar): the k largest."""
    top = table.orderBy(F.desc("importance"), "feature").limit(k)
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("importance"), "feature"))
    v = F.col("importance")
    return top.select(
        place.alias("place"), "feature", "importance",
        fixed_text(v, 4).alias("text"), text_bar(v, 50, "#").alias("bar"),
    )


def flag_importances(table: DataFrame) -> DataFrame:
    """Every feature with the mean line and whether it reaches the 75th percentile. One row per
    feature, so the built-in percentile is exact and bounded here."""
    upper = table.agg(F.percentile("importance", 0.75).alias("p75")).scalar()
    mean = table.agg(F.avg("importance").alias("mean")).scalar()
    return table.withColumn("mean", mean).withColumn("strong", F.col("importance") >= upper)
