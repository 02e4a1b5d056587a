import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import rows
from riskloom.operators import explore as e


@pytest.fixture(scope="module")
def students(spark):
    data = [("a", 1, 4.0, 10.0), ("a", 0, 6.0, 2.0), ("b", 1, 5.0, None), ("b", 1, None, 30.0), (None, 0, 9.0, 1.0)]
    return spark.createDataFrame(data, "curso string, evadiu int, cr double, faltas double")


def test_kpis(students):
    assert rows(e.kpis(students, "evadiu", {"cr": 2, "faltas": 1})) == [(5, 3, 60.0, 6.0, 10.8)]
    assert rows(e.kpis(students.limit(0), "evadiu", {"cr": 2})) == [(0, 0, 0.0, None)]


def test_kpis_of_all_choices_equal_the_filtered_ones(students):
    every = {r["choice"]: r for r in e.kpis_by_choice(students, "curso", "evadiu", {"cr": 2}).collect()}
    assert set(every) == {"a", "b", "Todos"}
    for choice, row in every.items():
        one = e.kpis(e.only(students, "curso", choice), "evadiu", {"cr": 2}).first()
        assert tuple(one) == (row["total"], row["positives"], row["rate"], row["mean_cr"])
    assert every["Todos"]["delta"] is None
    assert every["a"]["delta"] == pytest.approx(-10.0)


def test_filter_choices(students):
    assert e.only(students, "curso", None).count() == e.only(students, "curso", e.ALL).count() == 5
    for r in e.distinct_values(students, "curso").collect():
        assert e.only(students, "curso", r["curso"]).count() > 0


def test_rates_and_shares_drop_null_keys(students):
    assert [tuple(r) for r in e.ranked_rates(students, "curso", "evadiu").collect()] == [
        ("b", 2, 2, 100.0), ("a", 2, 1, 50.0)]
    assert rows(e.share_by(students, "curso")) == [("a", 2, 50.0), ("b", 2, 50.0)]


def test_fixed_order_keeps_missing_keys(students):
    got = e.in_order(e.rate_by(students, "curso", "evadiu"), "curso", ["b", "zzz", "a"])
    assert [(r["curso"], r["rate"]) for r in got.collect()] == [("b", 100.0), ("zzz", None), ("a", 50.0)]


def test_correlation_is_pairwise_and_safe(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0, 1.0), (2.0, 1.0, 1.0), (3.0, None, 1.0), (4.0, 5.0, 1.0)], "x double, y double, const double")
    got = {(r["a"], r["b"]): r["r"] for r in e.correlation_matrix(df, ["x", "y", "const"]).collect()}
    assert got["x", "y"] == got["y", "x"] == pytest.approx(np.corrcoef([1, 2, 4], [2, 1, 5])[0, 1])
    assert got["x", "x"] == pytest.approx(1.0)
    assert got["x", "const"] is None and got["const", "const"] is None
    top = e.strongest_correlations(df, ["const", "x"], "y", 2).collect()
    assert [(r["place"], r["column"]) for r in top] == [(1, "x"), (2, "const")]


def test_bar_and_sign(spark):
    df = spark.createDataFrame([(1.0, -1.0, 0), (2.0, -2.0, 1)], "x double, z double, y int")
    got = {r["column"]: r for r in e.correlation_bars(df, ["x", "z"], "y").collect()}
    assert got["x"]["bar"] == "+" + "█" * 30 and got["x"]["effect"] == "raises"
    assert got["z"]["text"] == "-1.0000" and got["z"]["bar"][0] == "-"


def test_histogram(spark):
    df = spark.createDataFrame([(float(i),) for i in range(11)] + [(None,)], "x double")
    got = e.histogram(df, "x", 30).orderBy("bin").collect()
    assert len(got) == 30 and sum(r["n"] for r in got) == 11 and got[-1]["n"] == 1
    assert [r["n"] for r in got] == list(np.histogram(range(11), 30)[0])
    const = e.histogram(spark.createDataFrame([(2.0,)] * 4, "x double"), "x", 30).collect()
    assert sorted(r["n"] for r in const) == [0] * 29 + [4]
    assert e.histogram(df.limit(0), "x").count() == 0


def test_box(spark):
    data = [("g", float(v)) for v in (1, 2, 3, 4, 5, 50)] + [("h", 1.0), (None, 9.0), ("h", None)]
    df = spark.createDataFrame(data, "k string, x double")
    got = {r["k"]: r for r in e.box_stats(df, ["x"], "k").collect()}
    assert set(got) == {"g", "h"}
    g = got["g"]
    assert (g["n"], g["q1"], g["median"], g["q3"]) == (6, 2.25, 3.5, 4.75)
    assert (g["low_whisker"], g["high_whisker"], g["outliers"]) == (1.0, 5.0, 1)
    assert rows(e.box_outliers(df, "x", "k")) == [("g", 50.0)]


def test_density_counts_every_point(spark):
    df = spark.range(1000).select(F.sin("id").alias("x"), F.cos("id").alias("y"), (F.col("id") % 2).alias("k"))
    got = e.density(df, "x", "y", "k", 10)
    assert got.agg(F.sum("n")).first()[0] == 1000
    assert got.agg(F.max("x_bin")).first()[0] == 10 and got.count() <= 200
    assert e.density(df.limit(0), "x", "y", "k").count() == 0


def test_labels_and_projection(students):
    named = e.with_label(students, "evadiu", {0: "Não Evadiu"}, "label")
    assert named.filter("evadiu = 1 and label is not null").count() == 0
    assert e.positives(students, "evadiu", {"cr": "CR"}).columns == ["CR"]
    assert [r["cr"] for r in e.first_rows(students, "cr", 2).collect()] == [None, 4.0]


def test_nan_counts_as_missing(spark):
    nan = float("nan")
    df = spark.createDataFrame([("a", 1.0, 2.0, 1), ("a", nan, 3.0, 0), ("a", 3.0, 5.0, 1), ("a", 4.0, nan, 0)],
                               "k string, x double, y double, t int")
    as_null = df.select("k", F.nanvl("x", F.lit(None)).alias("x"), F.nanvl("y", F.lit(None)).alias("y"), "t")
    for make in (
        lambda d: e.kpis(d, "t", {"x": 2}), lambda d: e.correlation_matrix(d, ["x", "y"]),
        lambda d: e.histogram(d, "x", 4), lambda d: e.density(d, "x", "y", "t", 3),
        lambda d: e.box_stats(d, ["x", "y"], "k"), lambda d: e.kpis_by_choice(d, "k", "t", {"y": 1}),
    ):
        assert rows(make(df)) == rows(make(as_null))


def test_infinite_values_have_no_place_on_an_axis(spark):
    df = spark.createDataFrame([(1.0,), (float("inf"),)], "x double")
    with pytest.raises(ValueError):
        e.histogram(df, "x")
