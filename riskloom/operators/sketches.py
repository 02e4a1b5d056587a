"""Quantile sketches that are stored and merged as rows arrive.

A sketch (KLL) of a column takes a few kilobytes whatever the number of rows, is made per batch of
rows in one aggregate, and merges with others, so a table that grows is never read again: the new
batch is sketched, and the stored sketches are merged. A quantile read from a sketch of ``k`` has a
rank that is off by at most ``rank_error(k)`` of the rows, with 99 % confidence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom.operators.quantiles import long_values
from riskloom.session import store_of
from riskloom.spec import normalise

K = 400


def rank_error(k: int = K) -> float:
    """The published bound on the normalised rank error of a KLL sketch of size k."""
    return 2.446 / k**0.9433


def sketch(df: DataFrame, columns, by=(), k: int = K) -> DataFrame:
    """(by..., column, n, sketch), missing values ignored; a column without values has no row."""
    long = long_values(normalise(df), columns, by)
    return long.groupBy(*by, "column").agg(F.count("*").alias("n"), F.kll_sketch_agg_double("x", F.lit(k)).alias("sketch"))


def merge(sketched: DataFrame, by=()) -> DataFrame:
    """Sketches of parts as sketches of the whole."""
    return sketched.groupBy(*by, "column").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))


def quantiles(sketched: DataFrame, probs, by=()) -> DataFrame:
    """(by..., column, prob, n, value)."""
    read = [F.struct(F.lit(float(p)).alias("prob"), "n", F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias("value")) for p in probs]
    return sketched.select(*by, "column", F.inline(F.array(*read)))


def add_batch(path: str, name: str, df: DataFrame, columns, by=(), k: int = K) -> bool:
    """Stores the sketches of a batch of rows below ``path``; a batch of that name counts once.

    The batch is written beside the stored ones and gets its name when it is whole, so a reader
    meets none or all of it, and of two writers of one name the second leaves no trace.
    """
    spark = df.sparkSession
    store, place = store_of(spark, f"{path}/batch={name}")
    if store.exists(place):
        return False
    hidden = f"{path}/_{name}-{spark.range(1).select(F.uuid()).first()[0]}"
    sketch(df, columns, by, k).coalesce(1).write.parquet(hidden)
    _, from_ = store_of(spark, hidden)
    # Renaming onto a folder that exists would move this one into it.
    return not store.exists(place) and store.rename(from_, place)


def stored(spark: SparkSession, path: str, by=()) -> DataFrame:
    """The merged sketches of all batches."""
    return merge(spark.read.parquet(path).drop("batch"), by)
