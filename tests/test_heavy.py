"""Modes of columns with very many values, against a plain count."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from helpers import rows
from riskloom.operators import clean, heavy
from riskloom.spec import RoleSpec


def by_hand(values):
    n = Counter(v for v in values if v is not None)
    value = min(n, key=lambda v: (-n[v], v))
    return n[value], value


MIXED = [None] * 50 + ["hot"] * 30 + [f"v{i}" for i in range(2000)] + [f"w{i % 40}" for i in range(800)] + [""] * 5
UNIQUE = [f"id{i}" for i in range(1500)]
TIED = [f"t{i % 300}" for i in range(1500)]


@pytest.mark.parametrize("values", [MIXED, UNIQUE, TIED, ["", None, ""], ["é", "z", "é", "z"]])
@pytest.mark.parametrize("buckets, fullest", [(1, 1), (7, 2), (256, 3), (heavy.BUCKETS, heavy.FULLEST)])
def test_modes_against_a_plain_count(spark, values, buckets, fullest):
    df = spark.createDataFrame([(v,) for v in values], "k string").repartition(5)
    assert rows(heavy.modes(df, ["k"], buckets=buckets, fullest=fullest)) == [("k", *by_hand(values))]


def test_several_columns_nulls_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "a", None), (2, "b", None)], "`x.y` int, bucket string, n string")
    assert rows(heavy.modes(df, ["x.y", "bucket", "n"])) == [("bucket", 2, "a"), ("x.y", 2, "2")]
    assert rows(heavy.modes(df.filter("false"), ["bucket"])) == []
    assert rows(heavy.modes(df.withColumn("value", F.lit(1)).withColumn("column", F.lit("c")), ["value", "column"])) == [
        ("column", 3, "c"), ("value", 3, "1")]


def test_merged_summaries_are_the_summary_of_the_whole(spark):
    df = spark.createDataFrame(list(enumerate(MIXED)), "i long, k string")
    parts = [heavy.summary(df.filter(F.col("i") % 3 == r), ["k"]) for r in range(3)]
    assert rows(heavy.merge(*parts)) == rows(heavy.summary(df, ["k"]))
    assert rows(heavy.modes(df, ["k"], heavy.merge(*parts))) == [("k", *by_hand(MIXED))]


def test_a_frequent_value_leaves_most_values_uncounted(spark, monkeypatch):
    """All but the fullest buckets are ruled out by their counts; with unique values none is."""
    counted = []
    plain = heavy._counts
    monkeypatch.setattr(heavy, "_counts", lambda cells, wanted: counted.append(out := plain(cells, wanted)) or out)
    for values in (["hot"] * 500 + UNIQUE, UNIQUE):
        counted.clear()
        df = spark.createDataFrame([(v,) for v in values], "k string")
        assert rows(heavy.modes(df, ["k"])) == [("k", *by_hand(values))]
        seen = sum(c.count() for c in counted)
        assert (len(counted), seen) == (2, 1500) if values is UNIQUE else (len(counted) == 1 and seen < 150)


def test_fill_values_with_many(spark):
    df = spark.createDataFrame([(1, 0, "b"), (2, 1, "a"), (3, 1, "b"), (4, 0, "a"), (5, 0, None)], "id int, y int, k string")
    spec = RoleSpec(id="id", target="y", numeric=(), categorical=("k",))
    assert clean.fill_values(df, spec, many=True) == clean.fill_values(df, spec) == {"k": "a"}
