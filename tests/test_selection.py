import hashlib

import pytest
from pyspark.sql import functions as F

from helpers import rows
from riskloom.operators.prepare import hash_split, stratified_split
from riskloom.operators.selection import UnusableKey, mark_selected, proportional_quota, share_quota
from riskloom.spec import RoleSpec

SPEC = RoleSpec(id="id", target="y", numeric=("x",), categorical=())


def first_k(ids, k, seed):
    return set(sorted(ids, key=lambda i: (hashlib.md5(f"{i}:{seed}".encode()).hexdigest(), i))[:k])


@pytest.mark.parametrize("max_rows,digits", [(1 << 20, 3), (5, 1), (1, 1)])
def test_exact_and_independent_of_partitions(spark, max_rows, digits):
    df = spark.range(1000).select("id", (F.col("id") % 3 == 0).cast("int").alias("y"))
    want = {0: first_k([i for i in range(1000) if i % 3], int(666 * 0.1), 7),
            1: first_k(range(0, 1000, 3), int(334 * 0.1), 7)}
    for parts in (1, 7):
        marked = mark_selected(df.repartition(parts), "id", ["y"], share_quota(0.1), 7, max_rows=max_rows, digits=digits)
        got = {(r["y"], r["id"]) for r in marked.filter("selected").collect()}
        assert got == {(y, i) for y, ids in want.items() for i in ids}
        assert marked.count() == 1000


def test_zero_and_all(spark):
    df = spark.range(20).select("id")
    assert mark_selected(df, "id", [], share_quota(0.0), 1).filter("selected").count() == 0
    assert mark_selected(df, "id", [], share_quota(1.0), 1).filter("selected").count() == 20


def test_null_stratum_is_a_stratum(spark):
    df = spark.range(20).select("id", F.when(F.col("id") < 10, 1).alias("y"))
    got = mark_selected(df, "id", ["y"], share_quota(0.5), 1).filter("selected").groupBy("y").count()
    assert rows(got) == [(1, 5), (None, 5)]


@pytest.mark.parametrize("sizes,want", [
    ([450, 1050], [90, 210]),       # both exact
    ([1, 1, 1], [0, 0, 1]),         # one row of three, spread by remainder
    ([7, 5], [2, 1]),
    ([399], [80]),
])
def test_allocation(spark, sizes, want):
    counts = spark.createDataFrame(list(enumerate(sizes)), "y int, n bigint")
    got = [r["k"] for r in proportional_quota(0.2, ["y"])(counts).orderBy("y").collect()]
    assert sum(got) == -(-sum(sizes) * 2 // 10)
    assert got == want


def test_large_counts_do_not_overflow(spark):
    counts = spark.createDataFrame([(0, 10**13), (1, 3 * 10**13)], "y int, n bigint")
    got = rows(proportional_quota(0.2, ["y"])(counts), "y", "k")
    assert got == [(0, 2 * 10**12), (1, 6 * 10**12)]


def test_split_is_a_partition_of_the_rows(spark):
    df = spark.range(1500).select("id", (F.col("id") < 450).cast("int").alias("y"), F.rand(1).alias("x"))
    split = stratified_split(df, SPEC)
    train, test = split.filter("not is_test"), split.filter("is_test")
    assert train.join(test, "id", "left_semi").count() == 0
    assert train.count() + test.count() == 1500
    assert rows(test.groupBy("y").count()) == [(0, 210), (1, 90)]
    again = stratified_split(df.repartition(7), SPEC).filter("is_test")
    assert rows(again, "id") == rows(test, "id")


def test_hash_split_is_close(spark):
    n = hash_split(spark.range(20000).withColumn("y", F.lit(1)), SPEC).filter("is_test").count()
    assert abs(n / 20000 - 0.2) < 0.02


def test_repeated_or_missing_keys_at_the_cut_are_errors(spark):
    same = spark.range(100).select(F.lit(5).alias("id"))
    for df in (same, spark.range(10).select(F.lit(None).cast("long").alias("id"))):
        with pytest.raises(UnusableKey):
            mark_selected(df, "id", [], share_quota(0.5), 1)
    with pytest.raises(UnusableKey):
        mark_selected(same, "id", [], share_quota(0.5), 1, max_rows=10, digits=16)


def test_no_exact_split_without_a_key(spark):
    spec = RoleSpec(id=None, target="y", numeric=(), categorical=())
    with pytest.raises(ValueError):
        stratified_split(spark.range(5).withColumn("y", F.lit(1)), spec)
    assert spec.columns == ("y",)
