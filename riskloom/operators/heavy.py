"""Most frequent values of columns with very many values, without shuffling all of them.

The summary of a column counts its rows per bucket of a hash of the value. It has at most
``BUCKETS`` rows per column and task, summaries of parts add up to that of the whole, and a bucket's
count is at least that of every value in it. So the values of the fullest buckets are counted
first; the largest of these counts is one that the mode must reach, and only buckets that reach it
too can hold another mode. These are counted next, none is left out: a column without any frequent
value ends in a full count, and the result is exact always.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskloom.session import any_row, pin, stage

BUCKETS = 1 << 16
FULLEST = 64


def _cells(df: DataFrame, columns, buckets: int) -> DataFrame:
    """(column, value, bucket) of the values as text, without NULL."""
    text = [F.col(f"`{c}`").cast("string") for c in columns]
    cells = F.array(*[F.struct(F.lit(c).alias("column"), v.alias("value")) for c, v in zip(columns, text, strict=True)])
    bucket = F.pmod(F.xxhash64("value"), F.lit(buckets)).cast("int")
    return df.select(F.inline(cells)).filter("value is not null").withColumn("bucket", bucket)


def summary(df: DataFrame, columns, buckets: int = BUCKETS) -> DataFrame:
    """(column, bucket, n)."""
    return _cells(df, columns, buckets).groupBy("column", "bucket").agg(F.count("*").alias("n"))


def merge(*summaries: DataFrame) -> DataFrame:
    """Summaries of parts, made with the same number of buckets, as the summary of the whole."""
    every = summaries[0]
    for more in summaries[1:]:
        every = every.unionByName(more)
    return every.groupBy("column", "bucket").agg(F.sum("n").alias("n"))


def _fullest(known: DataFrame, fullest: int) -> DataFrame:
    """(column, bucket) of each column's fullest buckets; a task hands on so many per column."""
    ranked = F.slice(F.sort_array(F.collect_list(F.struct("n", "bucket")), asc=False), 1, fullest)
    part = known.withColumn("part", F.pmod(F.hash("bucket"), F.lit(FULLEST)))
    for by in (("column", "part"), ("column",)):
        part = part.groupBy(*by).agg(ranked.alias("top")).select(*by, F.inline("top"))
    return part.select("column", "bucket")


def _counts(cells: DataFrame, wanted: DataFrame) -> DataFrame:
    """(column, value, n) of the values in the wanted buckets."""
    return cells.join(wanted, ["column", "bucket"], "left_semi").groupBy("column", "value").agg(F.count("*").alias("n"))


def _best(counts: DataFrame) -> DataFrame:
    """(column, n, value): the largest count, the smallest value on a tie."""
    first = F.min(F.struct((-F.col("n")).alias("rank"), "value"))
    return counts.groupBy("column").agg(first.alias("first")).select(
        "column", (-F.col("first.rank")).alias("n"), F.col("first.value").alias("value"))


def modes(df: DataFrame, columns, known: DataFrame | None = None, buckets: int = BUCKETS, fullest: int = FULLEST) -> DataFrame:
    """(column, n, value): most frequent value as text and its rows, the smallest value on a tie.

    NULL is no value, the empty text is one; a column without values has no row. ``known`` is the
    summary of ``df``'s rows, where it has been kept; else it is made first. It must be of the same
    rows: a bucket whose count is too low could hide a mode.
    """
    columns = list(columns)
    cells = _cells(df, columns, buckets)
    known = stage(summary(df, columns, buckets) if known is None else known)
    first = pin(_fullest(known, fullest))
    found = stage(_best(_counts(cells, first)))
    left = known.join(first, ["column", "bucket"], "left_anti").alias("k").join(
        F.broadcast(found.select("column", F.col("n").alias("reached"))), "column").filter("n >= reached")
    open_ = pin(left.select("column", "bucket"))
    if not any_row(open_, "true"):
        return found
    return _best(found.unionByName(_counts(cells, open_).select("column", "n", "value")))
