"""Exact, interpolated quantiles of many columns, per group, at any size.

The built-in exact percentile sends a value-to-count map of a whole group to one task. Here every
pass is a plain counting aggregate, combined on the map side, whose result is a small histogram:

1. Values fall into buckets that are order-preserving and logarithmic, so one pass narrows any
   distribution. Each bucket knows its row count and its smallest and largest value, so the bucket
   that holds a wanted rank gives an exact bracket. A bracket of one value is already the answer;
   this ends the search for integer-like columns and for heavy ties.
2. While some bracket holds more than ``max_rows`` rows, it is cut into ``splits`` parts.
3. The few rows left in the brackets are counted by value and the rank is read off.

Rows are only shuffled as histogram counts; a hot value or hot group is one count per map task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskloom.session import any_row, pin

MAX_ROWS = 1 << 20
SPLITS = 4096
PER_E_FOLD = 256


def long_values(df: DataFrame, columns, by=()) -> DataFrame:
    """(by..., column, x) with one row per non-missing value; rows with a NULL key are dropped."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in columns])
    kept = reduce(lambda d, k: d.filter(F.col(k).isNotNull()), by, df)
    return (
        kept.select(*by, F.inline(cells))
        .filter(F.col("x").isNotNull() & ~F.isnan("x"))
    )


def exact_quantiles(
    df: DataFrame, columns, probs, by=(), max_rows: int = MAX_ROWS, splits: int = SPLITS
) -> DataFrame:
    """(by..., column, prob, n, value) with linear interpolation between neighbouring ranks."""
    by = list(by)
    keys = [*by, "column"]
    long = long_values(df, columns, by)
    targets = pin(_first_brackets(long, keys, probs))
    while any_row(targets, f"lo < hi and inside > {max_rows}"):
        targets = pin(_narrow(long, targets, keys, max_rows, splits))

    found = targets.filter("lo = hi").select(*keys, "n", "prob", "side", "frac", F.col("lo").alias("x"))
    if any_row(targets, "lo < hi"):
        found = found.unionByName(_read_off(long, targets.filter("lo < hi"), keys))
    low = F.max(F.when(F.col("side") == 0, F.col("x")))
    high = F.max(F.when(F.col("side") == 1, F.col("x")))
    value = F.when(low == high, low).otherwise(low + (high - low) * F.first("frac"))
    return found.groupBy(*keys, "prob", "n").agg(value.alias("value"))


def quantile_table(df: DataFrame, columns, probs, names, by=(), **kw) -> DataFrame:
    """The quantiles side by side: one row per (by..., column), one column per name."""
    q = exact_quantiles(df, columns, probs, by, **kw)
    wide = [F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n) for p, n in zip(probs, names)]
    return q.groupBy(*by, "column").agg(F.first("n").alias("n"), *wide)


def _log_bucket(x: Column) -> Column:
    """Monotone bucket number; infinities get the outermost buckets."""
    return F.floor(F.signum(x) * F.least(F.log1p(F.abs(x)) * PER_E_FOLD, F.lit(1e6))).cast("long")


def _histogram(rows: DataFrame, keys: list[str], bucket: Column) -> DataFrame:
    """Counts and true value range per bucket, with the rank before and after each bucket."""
    hist = rows.groupBy(*keys, bucket.alias("bucket")).agg(
        F.count("*").alias("inside"), F.min("x").alias("lo"), F.max("x").alias("hi")
    )
    running = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    return hist.withColumn("upto", F.sum("inside").over(running))


def _first_brackets(long: DataFrame, keys: list[str], probs) -> DataFrame:
    hist = _histogram(long, keys, _log_bucket(F.col("x")))
    hist = hist.withColumn("n", F.sum("inside").over(Window.partitionBy(*keys)))
    wanted = F.array(*[
        F.struct(F.lit(float(p)).alias("prob"), F.lit(side).alias("side")) for p in probs for side in (0, 1)
    ])
    position = F.col("prob") * (F.col("n") - 1)
    rank = F.when(F.col("side") == 0, F.floor(position)).otherwise(F.ceil(position)).cast("long")
    return (
        hist.select("*", F.inline(wanted))
        .withColumn("rank", rank)
        .withColumn("frac", position - F.floor(position))
        .withColumn("below", F.col("upto") - F.col("inside"))
        .filter("below <= rank and rank < upto")
        .select(*keys, "n", "prob", "side", "rank", "frac", "lo", "hi", "below", "inside")
    )


def _narrow(long: DataFrame, targets: DataFrame, keys: list[str], max_rows: int, splits: int) -> DataFrame:
    wide = f"lo < hi and inside > {max_rows}"
    brackets = targets.filter(wide).select(*keys, F.col("lo").alias("from"), F.col("hi").alias("to"), "below").distinct()
    rows = long.join(brackets, keys).filter("x >= from and x <= to")
    part = F.floor((F.col("x") - F.col("from")) / (F.col("to") - F.col("from")) * splits).cast("long")
    hist = _histogram(rows, [*keys, "from", "to", "below"], part)
    narrowed = (
        targets.filter(wide)
        .select(*keys, "n", "prob", "side", "rank", "frac", F.col("lo").alias("from"), F.col("hi").alias("to"))
        .join(hist.withColumn("below", F.col("below") + F.col("upto") - F.col("inside")), [*keys, "from", "to"])
        .filter("below <= rank and rank < below + inside")
        .select(*targets.columns)
    )
    return targets.filter(f"not ({wide})").unionByName(narrowed)


def _read_off(long: DataFrame, targets: DataFrame, keys: list[str]) -> DataFrame:
    """Count the values inside the brackets and pick the wanted ranks."""
    wanted = F.collect_list(F.struct("n", "prob", "side", "rank", "frac"))
    brackets = pin(targets.groupBy(*keys, "lo", "hi", "below").agg(wanted.alias("wanted")))
    counts = (
        long.join(brackets, keys).filter("x >= lo and x <= hi")
        .groupBy(*keys, "lo", "hi", "below", "x").agg(F.count("*").alias("c"), F.first("wanted").alias("wanted"))
    )
    running = Window.partitionBy(*keys, "lo", "hi", "below").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    return (
        counts.withColumn("end", F.col("below") + F.sum("c").over(running))
        .select(*keys, "x", "c", "end", F.inline("wanted"))
        .filter("end - c <= rank and rank < end")
        .select(*keys, "n", "prob", "side", "frac", "x")
    )
