import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import rows
from riskloom.operators.quantiles import exact_quantiles

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]


def check(spark, values, **kw):
    df = spark.createDataFrame([(float(v),) for v in values], "x double").repartition(3)
    got = {r["prob"]: r["value"] for r in exact_quantiles(df, ["x"], PROBS, **kw).collect()}
    for p in PROBS:
        assert got[p] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-12), p


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("max_rows,splits", [(1 << 20, 4096), (3, 4), (1, 2)])
def test_any_distribution(spark, seed, max_rows, splits):
    draw = random.Random(seed)
    values = [draw.choice([
        draw.gauss(0, 1), draw.uniform(-1e6, 1e6), draw.expovariate(1e-9), float(draw.randint(0, 5)), 7.0,
    ]) for _ in range(400)]
    check(spark, values, max_rows=max_rows, splits=splits)


def test_hot_value_and_extremes(spark):
    values = [3.25] * 400 + [1e300, -1e300, 1e-300, -0.0, 0.0] + [i / 7 for i in range(200)]
    check(spark, values)
    check(spark, values, max_rows=2, splits=2)


def test_infinities_are_values(spark):
    df = spark.createDataFrame([(v,) for v in (-math.inf, 1.0, 2.0, 3.0, math.inf)], "x double")
    got = {r["prob"]: r["value"] for r in exact_quantiles(df, ["x"], [0.0, 0.5, 1.0]).collect()}
    assert got == {0.0: -math.inf, 0.5: 2.0, 1.0: math.inf}


def test_small_cases(spark):
    df = spark.createDataFrame(
        [(1.0, 1.0), (2.0, 2.0), (math.nan, 3.0), (4.0, 4.0), (None, None)], "odd double, even double")
    got = rows(exact_quantiles(df, ["odd", "even"], [0.25, 0.5, 0.75]), "column", "prob", "n", "value")
    assert got == [("even", 0.25, 4, 1.75), ("even", 0.5, 4, 2.5), ("even", 0.75, 4, 3.25),
                   ("odd", 0.25, 3, 1.5), ("odd", 0.5, 3, 2.0), ("odd", 0.75, 3, 3.0)]


def test_groups_with_a_hot_one(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 50)).alias("g"),
        F.sin("id").alias("x"))
    df = df.unionByName(spark.createDataFrame([(None, 5.0)], "g string, x double"))
    pdf = df.toPandas()
    want = pdf.groupby("g")["x"].quantile(0.3).to_dict()
    got = {r["g"]: r["value"] for r in exact_quantiles(df, ["x"], [0.3], ["g"], max_rows=10, splits=8).collect()}
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], abs=1e-12) for k in want)


def test_more_groups_than_fit_locally(spark):
    """Beyond the size for a local relation the brackets go through a written table."""
    df = spark.range(40000).select((F.col("id") % 11000).alias("g"), F.sin("id").alias("x"))
    got = {r["g"]: r["value"] for r in exact_quantiles(df, ["x"], [0.5], ["g"]).collect()}
    want = df.toPandas().groupby("g")["x"].median().to_dict()
    assert len(got) == 11000 and all(got[k] == pytest.approx(want[k], abs=1e-12) for k in want)


def test_empty(spark):
    df = spark.createDataFrame([], "x double")
    assert exact_quantiles(df, ["x"], [0.5]).collect() == []
