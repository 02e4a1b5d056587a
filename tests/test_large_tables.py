"""Operators whose plan does not depend on how many values, columns, strata or points there are."""

import math
import os

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from helpers import rows
from riskloom.operators import clean, dictionary, evaluate, explore, sketches
from riskloom.operators.comoments import pearson
from riskloom.operators.prepare import stratified_split
from riskloom.operators.ranking import placed, ranked_scores
from riskloom.session import fresh_path
from riskloom.sources.inferred import read_csv_inferred
from riskloom.spec import RoleSpec


# --- dictionaries ----------------------------------------------------------------------------

def test_codes_are_places_in_sorted_order(spark):
    """A third of the rows share a value and some have none; the value 'r5' looks like a spread key."""
    values = [f"v{i % 2500}" for i in range(5000)] + ["hot"] * 3000 + [None] * 2000 + ["", "r5", "é", "Z"]
    df = spark.createDataFrame(list(enumerate(values)), "id long, k string").repartition(7)
    known = dictionary.fit_dictionary(df, "k")
    order = sorted({v for v in values if v is not None}, key=lambda v: v.encode())
    assert known.size == len(order)
    assert [r.value for r in known.table.orderBy("code").collect()] == order
    assert [r.value for r in known.table.filter("hot").collect()] == ["hot"]
    want = {v: i for i, v in enumerate(order)}
    got = dictionary.with_code(df, known, "code").collect()
    assert sorted((r.id, r.code) for r in got if r.code is not None) == [(i, want[v]) for i, v in enumerate(values) if v is not None]
    assert len(got) == len(values)


def test_unknown_values(spark):
    train = spark.createDataFrame([("a",), ("b",)], "k string")
    fitted = dictionary.fit_labels(train, ["k"])
    seen = spark.createDataFrame([("b",), ("c",), (None,)], "k string")
    assert rows(fitted.transform(seen, "null"), "k", "k_enc") == [("b", 1), ("c", None), (None, None)]
    with pytest.raises(PySparkException, match="unknown value c"):
        fitted.transform(seen).collect()


def test_slots_of_several_columns(spark):
    df = spark.createDataFrame([(1, "a", 5), (2, "b", 7), (3, None, 5), (4, "a", None)], "id int, k string, n int")
    known = [dictionary.fit_dictionary(df, c) for c in ("k", "n")]
    got = {r.id: r.slots for r in dictionary.with_slots(df, known).collect()}
    assert got == {1: [0, 2], 2: [1, 3], 3: [2], 4: [0]}
    assert rows(dictionary.slots(known)) == [(0, "k", "a"), (1, "k", "b"), (2, "n", "5"), (3, "n", "7")]
    vectors = dictionary.with_slots(df, known).select("id", dictionary.as_vector(F.col("slots"), 4).alias("v")).collect()
    assert {r.id: r.v.toArray().tolist() for r in vectors}[2] == [0, 1, 0, 1]


def test_dictionary_of_nothing_and_from_storage(spark):
    df = spark.createDataFrame([(1, None)], "id int, k string")
    known = dictionary.fit_dictionary(df, "k")
    assert known.size == 0 and dictionary.with_code(df, known, "code").first().code is None
    path = fresh_path(spark, "dictionary")
    some = dictionary.fit_dictionary(spark.createDataFrame([("x",), ("y",)], "k string"), "k")
    some.save(path)
    loaded = dictionary.Dictionary.load(spark, "k", path)
    assert loaded.size == 2 and rows(loaded.table, "value", "code") == [("x", 0), ("y", 1)]


def test_places(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("x")).repartition(9)
    assert rows(placed(df, F.desc("x")), "x", "place") == [(i, 999 - i) for i in range(1000)]
    assert placed(df.limit(0), "x").count() == 0


# --- correlations ----------------------------------------------------------------------------

@pytest.mark.parametrize("columns, block", [(5, 2), (130, 64)])
def test_correlations_against_numpy(spark, columns, block):
    """Missing values, a constant, a far offset, an infinite value, a column without values."""
    rng = np.random.default_rng(3)
    x = rng.normal(0, 1, (400, columns)) @ rng.normal(0, 1, (columns, columns))
    x[:, 1] += 1e9
    x[rng.random(x.shape) < 0.1] = np.nan
    x[:, 2] = 0.1
    x[:, 3] = np.nan
    x[5, 4] = np.inf
    names = [f"c.{i}" for i in range(columns)]
    df = spark.createDataFrame([tuple(None if np.isnan(v) and i % 2 else float(v) for v in r) for i, r in enumerate(x)],
                               ", ".join(f"`{n}` double" for n in names)).repartition(5)
    got = {(r.a, r.b): r.r for r in pearson(df, names, names, block).collect()}
    assert len(got) == columns * (columns + 1) // 2
    for (a, b), r in got.items():
        both = np.isfinite(x[:, a]) & np.isfinite(x[:, b])
        p, q = x[both, a], x[both, b]
        if 2 in (a, b) or 3 in (a, b):
            assert r is None
        else:
            assert r == pytest.approx(np.corrcoef(p, q)[0, 1] if a != b else 1.0, abs=1e-6)


def test_correlation_plan_does_not_grow(spark):
    """Five hundred columns go through one pass over the rows."""
    names = [f"c{i}" for i in range(500)]
    df = spark.range(300).select(*[F.rand(i).alias(n) for i, n in enumerate(names)])
    found = explore.correlation_matrix(df, names)
    assert found.count() == 250_000
    assert found.filter("a = b and abs(r - 1) < 1e-9").count() == 500


def test_correlations_without_rows(spark):
    df = spark.createDataFrame([], "x double, y double")
    assert rows(explore.correlation_matrix(df, ["x", "y"]), "a", "b", "r") == [("x", "x", None), ("x", "y", None), ("y", "x", None), ("y", "y", None)]


# --- strata, samples, survivors --------------------------------------------------------------

def test_split_of_more_strata_than_test_rows(spark):
    df = spark.range(3000).select("id", (F.col("id") % 1700).alias("y")).repartition(6)
    spec = RoleSpec(id="id", target="y", numeric=("x",), categorical=())
    marked = stratified_split(df, spec)
    assert marked.filter("is_test").count() == 600
    per = {r.y: (r.n, r.k) for r in marked.groupBy("y").agg(F.count("*").alias("n"), F.count_if("is_test").alias("k")).collect()}
    assert all(math.floor(n * 0.2) <= k <= math.ceil(n * 0.2) for n, k in per.values())
    assert rows(stratified_split(df.repartition(2), spec).filter("is_test"), "id") == rows(marked.filter("is_test"), "id")


def test_scatter_sample(spark):
    df = spark.range(900).select(
        "id", F.when(F.col("id") % 10 > 0, F.col("id") * 1.0).alias("x"), F.lit(1.0).alias("y"), (F.col("id") % 3).cast("int").alias("c"))
    df = df.withColumn("c", F.when(F.col("id") < 5, 9).otherwise(F.col("c")))
    got = [explore.scatter_sample(df.repartition(n), "id", "x", "y", "c", {0: "a", 1: "b", 2: "c", 9: "z"}, 7, ["id"]) for n in (1, 8)]
    assert rows(got[0]) == rows(got[1])
    assert rows(got[0].groupBy("label").count()) == [("a", 7), ("b", 7), ("c", 7), ("z", 4)]
    assert got[0].filter("x is null").count() == 0


def test_first_of_equal_keys_stays(spark):
    data = [(1, "a", 3, None), (1, "b", 2, 1.0), (None, "c", 1, 1.0), (None, "d", 0, 1.0), (2, "e", 5, 1.0), (2, "e", 5, None), (2, "d", 5, 2.0)]
    df = spark.createDataFrame(data, "k int, v string, o int, __first double").repartition(4)
    assert rows(clean.drop_duplicates(df, ["k"], order=["o"])) == [(1, "b", 2, 1.0), (2, "d", 5, 2.0), (None, "d", 0, 1.0)]
    assert rows(clean.drop_duplicates(df, ["k"])) == rows(clean.drop_duplicates(df.coalesce(1), ["k"]))
    assert clean.drop_duplicates(df.limit(0), ["k"]).count() == 0


# --- bounded curves --------------------------------------------------------------------------

def area(points):
    points = sorted((r.fpr, r.tpr) for r in points)
    return sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(points, points[1:]))


@pytest.mark.parametrize("most", [4, 10, 60])
def test_bounded_curve(spark, most):
    """Many scores; few scores with large jumps; one class only."""
    rng = np.random.default_rng(2)
    data = [("many", int(rng.random() < s), 0, float(s)) for s in rng.random(4000)]
    data += [("few", int(i % 3 == 0), 0, float(i % 5)) for i in range(200)] + [("one", 1, 0, float(i)) for i in range(50)]
    scored = spark.createDataFrame(data, "model string, label int, prediction int, score double")
    ranked = ranked_scores(scored)
    full = evaluate.roc_points(scored, drop_intermediate=False, ranked=ranked).collect()
    few = evaluate.roc_points(scored, drop_intermediate=False, ranked=ranked, max_points=most).collect()
    for model in ("many", "few", "one"):
        a, b = [r for r in full if r.model == model], [r for r in few if r.model == model]
        assert len(b) <= most and set(b) <= set(a)
        assert max(a, key=lambda r: r.threshold) in b and min(a, key=lambda r: r.threshold) in b
        if model != "one":
            assert abs(area(a) - area(b)) <= evaluate.area_bound(most)
    with pytest.raises(ValueError):
        evaluate.roc_points(scored, ranked=ranked, max_points=3)


# --- sketches --------------------------------------------------------------------------------

def test_merged_sketches_keep_their_rank_error(spark):
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.lognormal(0, 3, 30_000), np.full(10_000, 5.0)])
    df = spark.createDataFrame([(float(v), None if i % 4 else float(i)) for i, v in enumerate(x)], "x double, y double")
    path = fresh_path(spark, "sketches")
    half = df.withColumn("part", F.pmod(F.hash("x"), F.lit(2)))
    assert sketches.add_batch(path, "0", half.filter("part = 0"), ["x", "y"])
    assert sketches.add_batch(path, "1", half.filter("part = 1"), ["x", "y"])
    assert not sketches.add_batch(path, "1", half.filter("part = 1"), ["x", "y"])
    for r in sketches.quantiles(sketches.stored(spark, path), [0.0, 0.1, 0.5, 0.9, 1.0]).collect():
        values = x if r.column == "x" else np.arange(0, 40_000, 4)
        assert r.n == len(values)
        slack = sketches.rank_error() * len(values) + 1
        assert (values < r.value).sum() - slack <= r.prob * len(values) <= (values <= r.value).sum() + slack


def test_approximate_medians(spark):
    df = spark.range(1001).select(F.col("id").cast("double").alias("x"), F.lit(None).cast("double").alias("none"))
    exact, near = clean.medians(df, ["x", "none"]).collect(), clean.medians(df, ["x", "none"], approx=True).collect()
    assert [r.column for r in exact] == [r.column for r in near] == ["x"]
    assert abs(exact[0].value - near[0].value) <= sketches.rank_error() * 1001 + 1


# --- inferred CSV ----------------------------------------------------------------------------

def test_inferred_types_and_rejected_rows(spark):
    path = fresh_path(spark, "csv")
    os.makedirs(path)
    with open(f"{path}/a.csv", "w") as file:
        file.write("id,whole,gap,real,day,at,text,none,mixed\n"
                   "1,5,3,1.5,2024-01-31,2024-01-31 10:00:00,a,,7\n"
                   "2,-6,,2,2024-02-29,2024-02-29T11:30:00,\"b, c\",NaN,x\n"
                   "3,7,4,1e3,2024-03-01,2024-03-01,007,,8\n")
    with open(f"{path}/b.csv", "w") as file:
        file.write("id,whole,gap,real,day,at,text,none,mixed\n"
                   "4,8\n5,9,9,.5,2024-04-01,2024-04-01,z,,9,too,many\n6,10,NA,-3,2024-05-01,2024-05-01,,,9\n")
    found = read_csv_inferred(spark, path)
    assert found.types == {"id": "bigint", "whole": "bigint", "gap": "double", "real": "double", "day": "date", "at": "timestamp",
                           "text": "string", "none": "double", "mixed": "string"}
    assert dict(found.table.dtypes) == found.types
    assert rows(found.table, "id", "whole", "gap", "real", "text", "mixed") == [
        (1, 5, 3.0, 1.5, "a", "7"), (2, -6, None, 2.0, "b, c", "x"), (3, 7, 4.0, 1000.0, "007", "8"), (6, 10, None, -3.0, None, "9")]
    assert rows(found.rejected) == [("4,8",), ("5,9,9,.5,2024-04-01,2024-04-01,z,,9,too,many",)]


def test_impossible_dates_are_text(spark):
    path = fresh_path(spark, "csv")
    spark.createDataFrame([("2024-02-30",), ("2024-01-01",)], "d string").coalesce(1).write.option("header", True).csv(path)
    assert read_csv_inferred(spark, path).types == {"d": "string"}
