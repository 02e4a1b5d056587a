import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from helpers import rows
from riskloom.operators import models
from riskloom.operators.forest import ARRAYS, NODE, Cells, Grid, TableForest, _node_batch
from riskloom.plans import modelling
from riskloom.session import arrow_schema, local_rows
from riskloom.spec import RoleSpec

SPEC = RoleSpec(id="id", target="y", numeric=("a", "b"), categorical=("k",))


def noisy(spark, n, seed=3):
    """Rows whose class depends on a number and on an unordered category, with noise."""
    rng = np.random.default_rng(seed)
    a, b, k = rng.normal(0, 1, n), rng.integers(0, 9, n), rng.integers(0, 7, n)
    y = (a + np.isin(k, (1, 4, 6)) * 1.5 + rng.normal(0, 0.8, n) > 0.6).astype(int)
    data = [(i, float(a[i]), float(b[i]), f"k{k[i]}", int(y[i])) for i in range(n)]
    return spark.createDataFrame(data, "id long, a double, b double, k string, y int").withColumn("label", F.col("y").cast("double"))


@pytest.fixture(scope="module")
def legacy(spark):
    """A forest whose tops have several levels: a task may take 2048 rows."""
    df = noisy(spark, 9000)
    return df, models.fit_legacy(df, SPEC, trees=6, memory_mb=1)


def scored(model, df):
    return rows(model.transform(df).select("id", F.round(vector_to_array("probability")[1], 9), "prediction"))


def test_a_legacy_forest_is_kept_as_parts_and_not_in_the_driver(legacy):
    df, model = legacy
    forest = model.stages[-1]
    assert isinstance(forest, TableForest)
    assert forest.parts().filter("part > 0").count() > 12
    assert forest.parts().filter("part > 0").agg(F.max("n_nodes")).first()[0] < forest.totalNumNodes / 10
    assert model.transform(df).filter("prediction = y").count() > 8000


def test_parts_score_like_sparks_model_of_the_same_trees(spark, legacy):
    df, model = legacy
    assert scored(PipelineModel(stages=[*model.stages[:-1], model.stages[-1].to_spark()]), df) == scored(model, df)
    unseen = df.limit(5).withColumn("k", F.lit("zzz"))
    assert scored(PipelineModel(stages=[*model.stages[:-1], model.stages[-1].to_spark()]), unseen) == scored(model, unseen)


def test_nodes_of_parts_make_whole_trees(legacy):
    forest = legacy[1].stages[-1]
    nodes = models.tree_nodes(forest)
    assert nodes.count() == forest.totalNumNodes
    for r in nodes.groupBy("tree").agg(F.min("node"), F.max("node"), F.count("*"), F.count_distinct("node")).collect():
        assert (r[1], r[2] + 1, r[4]) == (0, r[3], r[3])
    sides = nodes.select("tree", "counts", F.explode(F.array("left", "right")).alias("child"), "node").filter("child is not null")
    child = nodes.select("tree", F.col("node").alias("child"), F.col("counts").alias("own"))
    split = sides.join(child, ["tree", "child"]).groupBy("tree", "node").agg(
        F.first("counts").alias("counts"), F.sum(F.col("own")[0]).alias("c0"), F.sum(F.col("own")[1]).alias("c1"), F.min("child").alias("low"))
    assert split.count() == nodes.filter("feature is not null").count()
    assert split.filter("c0 != counts[0] or c1 != counts[1] or low <= node").count() == 0


def test_importances_of_parts_are_the_gains_of_their_splits(legacy):
    forest = legacy[1].stages[-1]
    got = dict(rows(models.gains(models.tree_nodes(forest))))
    assert [got.get(i, 0.0) for i in range(3)] == pytest.approx(forest.featureImportances.toArray(), abs=1e-9)
    assert forest.featureImportances.toArray() == pytest.approx(forest.to_spark().featureImportances.toArray(), abs=1e-9)


def test_parts_survive_saving(legacy, tmp_path):
    df, model = legacy
    models.save_model(model, str(tmp_path / "m"))
    models.save_model(model, str(tmp_path / "m"))
    loaded = PipelineModel.load(str(tmp_path / "m"))
    assert isinstance(loaded.stages[-1], TableForest) and scored(loaded, df) == scored(model, df)


def test_a_tree_that_draws_no_rows_does_not_vote(spark):
    df = spark.createDataFrame([(Vectors.dense([1.0]), 1.0)], ["features", "label"])
    forest = models.fit_forest(df, trees=20)
    assert models.tree_nodes(forest).count() == 20 and models.gains(models.tree_nodes(forest)).count() == 0
    assert rows(forest.transform(df).select(vector_to_array("probability")[1], "prediction")) == [(1.0, 1.0)]


def test_a_deep_forest_takes_few_jobs(spark):
    """Spark's own forest takes two jobs and more for each level: over 40 here."""
    rng = np.random.default_rng(5)
    df = spark.createDataFrame([(Vectors.dense(v), float(t)) for v, t in zip(rng.normal(0, 1, (2000, 3)), rng.integers(0, 2, 2000))], ["features", "label"])
    spark.sparkContext.setJobGroup("deep", "deep")
    forest = models.fit_forest(df, trees=10)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("deep"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < jobs < 30
    assert forest.transform(df).filter("prediction = label").count() > 1900


def test_the_largest_importances_of_a_forest_in_parts(spark):
    """More rows than a task may take, so the first splits come from summed counts."""
    rng = np.random.default_rng(6)
    x = rng.normal(0, 1, (5000, 4))
    df = spark.createDataFrame([(Vectors.dense(v), float(v[2] + 0.5 * v[0] > 0)) for v in x], ["features", "label"])
    forest = models.fit_forest(df, trees=4, memory_mb=1)
    assert forest.parts().filter("part > 0").count() > 4
    top = models.top_importances(models.importances(df, forest, list("abcd")), 2).orderBy("place").collect()
    assert [r["feature"] for r in top] == ["c", "a"]


def test_the_compared_forest_scores_from_its_parts(spark):
    done = modelling.train(noisy(spark, 4000).drop("label"), SPEC, trees=8, memory_mb=1)
    model = done.scorers[models.FOREST]
    assert isinstance(model.stages[-1], TableForest)
    got = done.scored.filter(F.col("model") == models.FOREST).select("id", F.round("score", 9))
    other = models.predict(model.stages[-1].to_spark(), done.prepared.test, "x", ["id"])
    assert rows(got) == rows(other.select("id", F.round("score", 9)))


def test_more_than_two_classes_are_still_grown(spark):
    df = spark.createDataFrame([(Vectors.dense([float(i % 9)]), float(i % 3)) for i in range(90)], ["features", "label"])
    assert models.fit_forest(df, trees=3).numClasses == 3


def test_gains_read_each_node_once(spark):
    """They were read for the nodes as parents, again as children, and that for the sum of all shares too."""
    data = [(0, 0, 0, 1, 2, [6.0, 4.0]), (0, 1, None, None, None, [5.0, 0.0]), (0, 2, 1, 3, 4, [1.0, 4.0]),
            (0, 3, None, None, None, [1.0, 0.0]), (0, 4, None, None, None, [0.0, 4.0]), (1, 0, None, None, None, [3.0, 3.0])]
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    nodes = spark.createDataFrame(data, "tree int, node int, feature int, left int, right int, counts array<double>")
    got = dict(rows(models.gains(nodes.mapInArrow(count, nodes.schema))))
    assert got == pytest.approx({0: (4.8 - 1.6) / 4.8, 1: 1.6 / 4.8})
    assert read.value == len(data)


def test_tables_of_fitted_values_need_no_job(spark):
    """Python workers were started on every core to tell the types of an empty table."""
    spark.sparkContext.setJobGroup("types", "types")
    table = local_rows(spark, [(1, None, [2.0], b"a", "x"), (2, 3.0, None, None, None)], "a int, b double, c array<double>, d binary, e string")
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("types")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not jobs
    assert rows(table.select("a", "b", "c", "e")) == [(1, None, [2.0], "x"), (2, 3.0, None, None)]


def test_nodes_say_what_goes_left(spark):
    """A number's threshold, two categories by the bin, more than two by a set; a leaf says nothing."""
    grid = Grid([0, 2, 3], [[1.5, 2.5], [], []])
    part = {c: np.zeros(7, t) for c, t in ARRAYS.items()}
    part["feature"][:], part["mask"][:] = (0, 1, 2, -1, -1, -1, -1), (-1, -1, 0, -1, -1, -1, -1)
    part["cut"][0], part["left"][:3], part["right"][:3] = 1, (1, 3, 5), (2, 4, 6)
    part["n0"][:], part["n1"][:] = (6, 4, 2, 3, 1, 2, 0), (6, 1, 5, 0, 1, 1, 4)
    part["masks"] = np.array([[0b101]], np.uint8)
    ids = np.array([9, 20, 21, 22, 23, 24, 25])
    got = [r["nodeData"] for r in _node_batch(3, part, ids, np.array([0, 1, 2, 5]), grid, arrow_schema(NODE)).to_pylist()]
    assert [(r["id"], r["leftChild"], r["rightChild"], r["rawCount"], r["impurityStats"]) for r in got] == [
        (9, 20, 21, 12, [6, 6]), (20, 22, 23, 5, [4, 1]), (21, 24, 25, 7, [2, 5]), (24, -1, -1, 3, [2, 1])]
    assert [tuple(r["split"].values()) for r in got] == [(0, [2.5], -1), (1, [0.0], 2), (2, [0.0, 2.0], 3), (-1, [], -1)]
    assert got[0]["gain"] == pytest.approx(0.5 - (5 * 0.32 + 7 * 20 / 49) / 12) and got[3]["gain"] == -1.0


@pytest.mark.parametrize("nodes", [3, 900])
def test_cells_are_counted_alike_in_place_and_by_sorting(nodes):
    """Few nodes are counted in place, many by sorting; both as a plain count does."""
    rng = np.random.default_rng(8)
    n, wide = 5000, 40
    at, b, weight, y = rng.integers(0, nodes, n), rng.integers(0, wide, n).astype(np.uint8), rng.integers(1, 32, n), rng.integers(0, 2, n)
    cells = Cells(at, weight * 2 + y, nodes, wide)
    want = {}
    for key in zip(at.tolist(), b.tolist(), weight.tolist(), y.tolist()):
        want.setdefault(key[:2], [0, 0])[key[3]] += key[2]
    assert cells.sort == (nodes > 3)
    assert [v.tolist() for v in cells.count(b)] == [list(v) for v in zip(*[(*k, *want[k]) for k in sorted(want)])]
