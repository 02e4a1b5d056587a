import math

from pyspark.sql import functions as F

from helpers import rows
from riskloom.functions.columns import half_even
from riskloom.operators import clean as c
from riskloom.operators.profile import data_dictionary, describe, null_profile, profile
from riskloom.spec import InvalidTable, RoleSpec, normalise, validate

import pytest

SPEC = RoleSpec(id="id", target="y", numeric=("a", "b"), categorical=("k",), outlier=("a",),
                integer=("b",), decimals={"a": 1})


def table(spark, data):
    return spark.createDataFrame(data, "id bigint, k string, a double, b double, y int")


def test_missing_values(spark):
    df = normalise(table(spark, [(1, "x", math.nan, 1.0, 0), (2, None, 2.0, None, 1), (3, "x", None, 3.0, 0)]))
    assert rows(null_profile(df), "column", "nulls") == [("a", 2), ("b", 1), ("id", 0), ("k", 1), ("y", 0)]


def test_mode_takes_the_smallest_on_a_tie(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("b",), (None,)], "k string")
    assert rows(c.modes(df, ["k"])) == [("k", "a")]


def test_all_null_column_stays_null(spark):
    df = table(spark, [(1, None, None, 1.0, 0), (2, None, None, 2.0, 1)])
    fills = c.fill_values(df, SPEC)
    assert fills == {"b": 1.5}
    assert c.impute(df, fills).filter("a is null and k is null").count() == 2
    assert c.clean(df, SPEC).table.count() == 2


def test_half_even(spark):
    df = spark.createDataFrame([(2.5,), (26.5,), (27.5,), (-2.5,), (None,)], "x double")
    got = [r[0] for r in df.select(half_even(F.col("x"))).collect()]
    assert got == [2.0, 26.0, 28.0, -2.0, None]


def test_duplicates_only_after_imputation(spark):
    data = [(1, "x", 1.0, 5.0, 0), (1, "x", 1.0, None, 0), (2, "x", 1.0, 5.0, 1), (2, "x", 1.0, 5.0, 1),
            (3, "y", 9.0, 5.0, 1)]
    done = c.clean(table(spark, data), SPEC)
    assert done.table.count() == 3
    removed = done.report().filter("step = 'duplicates'").first()["value"]
    assert removed == 2.0


def test_key_shortcut_equals_distinct(spark):
    df = spark.range(300).select((F.col("id") % 100).alias("id"), (F.col("id") % 200).alias("v"))
    df = df.unionByName(spark.createDataFrame([(None, 1), (None, 1), (None, 2)], "id bigint, v bigint"))
    assert rows(c.drop_duplicates(df, key="id")) == rows(df.distinct())
    unique = spark.range(10)
    assert rows(c.drop_duplicates(unique, key="id")) == rows(unique)


def test_many_repeated_keys(spark):
    df = spark.range(44000).select((F.col("id") % 11000).alias("id"), (F.col("id") % 22000).alias("v"))
    assert c.drop_duplicates(df, key="id").count() == 22000


def test_duplicate_count(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a")], "a int, b string")
    assert rows(c.duplicate_count(df)) == [(3, 2, 1)]
    assert rows(c.duplicate_count(df.limit(0))) == [(0, 0, 0)]


def test_winsorise_keeps_the_limit(spark):
    df = spark.createDataFrame([(v,) for v in (1.0, 2.0, 3.0, 4.0, 100.0, None)], "a double")
    limits = c.limits_of(df, ["a"])
    assert limits == {"a": (-1.0, 7.0)}
    assert rows(c.outlier_counts(df, ["a"]), "column", "outliers") == [("a", 1)]
    assert rows(c.winsorise(df, limits)) == [(1.0,), (2.0,), (3.0,), (4.0,), (7.0,), (None,)]
    on_limit = spark.createDataFrame([(7.0,), (-1.0,)], "a double")
    assert c.outlier_counts(on_limit, ["a"], limits).first()["outliers"] == 0


def test_clean_types_and_range(spark):
    data = [(i, "x" if i % 2 else None, float(i) + 0.25, float(i % 5) + 0.5, i % 2) for i in range(50)]
    data.append((50, "x", 1e6, 2.5, 1))
    done = c.clean(table(spark, data), SPEC)
    assert dict(done.table.dtypes)["b"] == "int"
    low, high = done.limits["a"]
    top = done.table.agg(F.max("a")).first()[0]
    assert top == round(high, 1) < 1e6
    assert done.table.filter("a is null or b is null or k is null").count() == 0


def test_describe_and_profile(spark):
    df = spark.createDataFrame([(1.0, "a"), (2.0, None), (3.0, "b"), (4.0, "b")], "x double, k string")
    got = describe(df, ["x"]).first()
    assert (got["count"], got["mean"], got["min"], got["p25"], got["p50"], got["p75"], got["max"]) == (
        4, 2.5, 1.0, 1.75, 2.5, 3.25, 4.0)
    assert got["std"] == pytest.approx(1.2909944487)
    p = {r["column"]: r for r in profile(df).collect()}
    assert (p["x"]["dtype"], p["k"]["dtype"], p["k"]["nulls"], p["k"]["min"]) == ("float64", "object", 1, None)
    empty = profile(df.limit(0)).collect()
    assert [r["pct_null"] for r in empty] == [0.0, 0.0]


def test_dictionary_defaults(spark):
    raw = spark.createDataFrame([(1, 2.0, "a"), (2, None, "b")], "id_aluno int, cr double, extra string")
    done = {r["coluna"]: r for r in data_dictionary(raw, raw.select("id_aluno", "cr").na.fill(2.0)).collect()}
    assert done["id_aluno"]["valores_possiveis"] == "1 a 2"
    assert done["cr"]["valores_possiveis"] == "min=2.0 | max=2.0"
    assert (done["cr"]["pct_ausentes_antes"], done["cr"]["pct_ausentes_depois"]) == (50.0, 0.0)
    assert (done["extra"]["descricao"], done["extra"]["pct_ausentes_depois"]) == ("—", 0.0)


def test_validate(spark):
    df = table(spark, [(1, "x", 1.0, 1.0, 0), (1, "x", 2.0, 1.0, 0)])
    assert validate(df, SPEC) is df
    for bad, kw in ((df.drop("y"), {}), (df.limit(0), {}), (df, {"unique_id": True})):
        with pytest.raises(InvalidTable):
            validate(bad, SPEC, **kw)
