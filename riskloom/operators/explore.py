"""Indicators, rates, shares, correlations and the data behind each chart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskloom.functions.columns import (
    clip, effect, half_even, label_of, ratio, sign_mark, signed_text, text_bar,
)
from riskloom.operators.clean import iqr_limits
from riskloom.operators.comoments import pearson
from riskloom.operators.quantiles import quantile_table
from riskloom.operators.selection import at_most_quota, mark_selected
from riskloom.session import local_rows, pin, stage
from riskloom.spec import normalise

ALL = "Todos"


# --- filters and projections -----------------------------------------------------------------

def only(df: DataFrame, column: str, value) -> DataFrame:
    """Rows with ``column == value``; None or the sentinel keeps the whole table."""
    return df if value is None or value == ALL else df.filter(F.col(column) == value)


def positives(df: DataFrame, target: str, names: dict) -> DataFrame:
    """Rows of the positive class, projected and renamed for display."""
    return df.filter(F.col(target) == 1).select(*[F.col(c).alias(n) for c, n in names.items()])


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull()).select(column).distinct().orderBy(column)


def with_label(df: DataFrame, column: str, names: dict, name: str) -> DataFrame:
    return df.withColumn(name, label_of(F.col(column), names))


def first_rows(df: DataFrame, order: str, n: int) -> DataFrame:
    return df.orderBy(order).limit(n)


# --- indicators ------------------------------------------------------------------------------

def _totals(target: str, means) -> list[Column]:
    aggs = [F.count("*").alias("total"), F.coalesce(F.sum(F.col(target).cast("long")), F.lit(0)).alias("positives")]
    for c in means:
        x = F.col(c).cast("double")
        aggs += [F.sum(x).alias(f"sum_{c}"), F.count(x).alias(f"n_{c}")]
    return aggs


def _indicators(means: dict) -> list[Column]:
    rate = half_even(ratio(F.col("positives") * 100.0, F.col("total")), 1)
    return [F.col("total"), F.col("positives"), rate.alias("rate")] + [
        half_even(ratio(F.col(f"sum_{c}"), F.col(f"n_{c}"), None), d).alias(f"mean_{c}") for c, d in means.items()
    ]


def kpis(df: DataFrame, target: str, means: dict) -> DataFrame:
    """One row: total, positives, rate in percent, and the rounded mean of each given column."""
    return normalise(df).agg(*_totals(target, means)).select(*_indicators(means))


def kpis_by_choice(df: DataFrame, by: str, target: str, means: dict) -> DataFrame:
    """The indicators for the whole table and for every value of ``by`` from a single scan.

    The table is aggregated per value first, and that summary is written; the roll-up and the
    overall rate then only see one row per value. Rows with a NULL value count in the total only. ``delta`` is the rounded rate minus the overall one.
    """
    per_value = stage(normalise(df).groupBy(by).agg(*_totals(target, means)))
    sums = [F.sum(c).alias(c) for c in per_value.columns if c != by]
    rolled = per_value.rollup(by).agg(F.grouping_id().alias("level"), *sums)
    rolled = rolled.filter(F.col(by).isNotNull() | (F.col("level") == 1))
    overall = per_value.agg(ratio(F.sum("positives") * 100.0, F.sum("total")).alias("overall")).scalar()
    delta = F.when(F.col("level") == 0, F.col("rate") - overall)
    name = F.when(F.col("level") == 1, F.lit(ALL)).otherwise(F.col(by).cast("string"))
    return rolled.select(name.alias("choice"), "level", *_indicators(means)).withColumn("delta", delta).drop("level")


def rate_by(df: DataFrame, by: str, target: str, decimals: int | None = 1) -> DataFrame:
    """(by, n, positives, rate): percent positive per value."""
    counts = df.filter(F.col(by).isNotNull()).groupBy(by).agg(
        F.count(target).alias("n"), F.sum(F.col(target).cast("long")).alias("positives")
    )
    rate = ratio(F.col("positives") * 100.0, F.col("n"), None)
    return counts.withColumn("rate", rate if decimals is None else half_even(rate, decimals))


def ranked_rates(df: DataFrame, by: str, target: str) -> DataFrame:
    return rate_by(df, by, target).orderBy(F.desc("rate"), by)


def share_by(df: DataFrame, by: str, decimals: int = 1) -> DataFrame:
    """(by, n, pct): counts and their share of all non-NULL rows."""
    counts = df.filter(F.col(by).isNotNull()).groupBy(by).agg(F.count("*").alias("n"))
    whole = counts.agg(F.sum("n").alias("whole")).scalar()
    return counts.withColumn("pct", half_even(ratio(F.col("n") * 100.0, whole), decimals))


def in_order(df: DataFrame, column: str, order: list) -> DataFrame:
    """Rows aligned to a fixed key order; keys without a row stay, with NULLs."""
    keys = local_rows(df.sparkSession, list(enumerate(order, 1)), f"position int, {column} string")
    return keys.join(df, column, "left").orderBy("position")


# --- correlations ----------------------------------------------------------------------------

def correlation_matrix(df: DataFrame, columns) -> DataFrame:
    """(a, b, r) for all ordered pairs of columns, each over the rows where both are present; NULL
    where a side is constant there."""
    columns = list(columns)
    names = local_rows(df.sparkSession, list(enumerate(columns)), "place int, name string")
    half = pearson(df, columns, columns)
    both = half.unionByName(half.filter("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"), "r"))
    a = names.select(F.col("place").alias("a"), F.col("name").alias("first"))
    b = names.select(F.col("place").alias("b"), F.col("name").alias("second"))
    return both.join(F.broadcast(a), "a").join(F.broadcast(b), "b").select(F.col("first").alias("a"), F.col("second").alias("b"), "r")


def correlation_wide(df: DataFrame, columns) -> DataFrame:
    """The matrix with one column per variable."""
    long = correlation_matrix(df, columns)
    return long.groupBy("a").pivot("b", list(columns)).agg(F.first("r"))


def target_correlations(df: DataFrame, columns, target: str) -> DataFrame:
    """(column, r): only the pairs with the target."""
    columns = list(columns)
    names = local_rows(df.sparkSession, list(enumerate(columns)), "a int, column string")
    return pearson(df, columns, [target]).join(F.broadcast(names), "a").select("column", "r")


def strongest_correlations(df: DataFrame, columns, target: str, k: int = 3) -> DataFrame:
    """(place, column, r, text): the k largest by magnitude."""
    top = target_correlations(df, columns, target).orderBy(F.desc(F.abs("r")), "column").limit(k)
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc(F.abs("r")), "column"))
    return top.withColumn("place", place).select("place", "column", "r", signed_text(F.col("r"), 2).alias("text"))


def correlation_bars(df: DataFrame, columns, target: str) -> DataFrame:
    """(column, r, text, bar, effect), smallest first."""
    r = F.col("r")
    return (
        target_correlations(df, columns, target)
        .withColumns({
            "text": signed_text(r, 4),
            "bar": F.concat(sign_mark(r), text_bar(r, 30, "█")),
            "effect": effect(r),
        })
        .orderBy("r", "column")
    )


# --- distributions ---------------------------------------------------------------------------

def box_stats(df: DataFrame, columns, by: str) -> DataFrame:
    """(by, column, n, q1, median, q3, low_whisker, high_whisker, outliers) per group.

    Whiskers are the furthest values within 1.5 IQR of the box.
    """
    columns, df = list(columns), normalise(df)
    q = pin(quantile_table(df, columns, [0.25, 0.5, 0.75], ["q1", "median", "q3"], [by]))
    fences = q.withColumn("__step", (F.col("q3") - F.col("q1")) * 1.5)
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in columns])
    x = F.col("x")
    inside = (x >= F.col("q1") - F.col("__step")) & (x <= F.col("q3") + F.col("__step"))
    reach = (
        df.filter(F.col(by).isNotNull()).select(by, F.inline(cells)).filter(x.isNotNull())
        .join(fences, [by, "column"])
        .groupBy(by, "column")
        .agg(
            F.min(F.when(inside, x)).alias("low_whisker"),
            F.max(F.when(inside, x)).alias("high_whisker"),
            F.count_if(~inside).alias("outliers"),
        )
    )
    return q.join(reach, [by, "column"])


def box_outliers(df: DataFrame, column: str, by: str, keep=()) -> DataFrame:
    """(by, keep..., value): every row outside the fences of its group."""
    df = normalise(df)
    fences = pin(iqr_limits(df, [column], [by])).select(by, "lower", "upper")
    x = F.col(column).cast("double")
    return (
        df.select(by, *keep, x.alias("value")).join(fences, by)
        .filter((F.col("value") < F.col("lower")) | (F.col("value") > F.col("upper")))
        .drop("lower", "upper")
    )


def _bin(x: Column, lo: float, hi: float, bins: int) -> Column:
    """1-based equal-width bin; the maximum belongs to the last bin, a constant column to one."""
    if lo == hi:
        return F.when(x.isNotNull(), F.lit(bins // 2 + 1))
    return clip(F.floor((x - lo) / (hi - lo) * bins).cast("int") + 1, 1, bins)


def _range(df: DataFrame, columns) -> dict:
    """Smallest and largest value; an infinite one has no place on an axis and is an error."""
    row = df.agg(*[f(F.col(c).cast("double")).alias(f"{n}_{c}") for c in columns for n, f in
                   (("lo", F.min), ("hi", F.max))]).first()
    for c in columns:
        if float("inf") in (row[f"hi_{c}"], -(row[f"lo_{c}"] or 0.0)):
            raise ValueError(f"{c} holds an infinite value")
    return {c: (row[f"lo_{c}"], row[f"hi_{c}"]) for c in columns}


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """(bin, low, high, n) for all bins, empty ones included."""
    spark, df = df.sparkSession, normalise(df)
    lo, hi = _range(df, [column])[column]
    if lo is None:
        return spark.createDataFrame([], "bin int, low double, high double, n bigint")
    if lo == hi:
        left, step = lo - 0.5, 1.0 / bins
    else:
        left, step = lo, (hi - lo) / bins
    x = F.col(column).cast("double")
    counts = df.filter(x.isNotNull()).groupBy(_bin(x, lo, hi, bins).alias("bin")).agg(F.count("*").alias("n"))
    every = spark.range(1, bins + 1, numPartitions=1).select(F.col("id").cast("int").alias("bin"))
    return every.join(counts, "bin", "left").select(
        "bin",
        (F.lit(left) + (F.col("bin") - 1) * F.lit(step)).alias("low"),
        (F.lit(left) + F.col("bin") * F.lit(step)).alias("high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def scatter_points(df: DataFrame, x: str, y: str, target: str, names: dict, hover=()) -> DataFrame:
    """All points of a scatter chart with their class label."""
    return df.select(x, y, label_of(F.col(target), names).alias("label"), *hover)


def scatter_sample(df: DataFrame, key, x: str, y: str, target: str, names: dict, k: int, hover=(), seed: int = 42) -> DataFrame:
    """The same for at most ``k`` rows of each class that have both values: those whose hash of the
    key is smallest, so that the sample is exact in size and the same under any partitioning. Only
    counts per hash prefix are shuffled; rows stay where they are until the few are known."""
    present = normalise(df).filter(F.col(x).isNotNull() & F.col(y).isNotNull() & F.col(target).isNotNull())
    chosen = mark_selected(present, key, [target], at_most_quota(k), seed).filter("selected")
    return scatter_points(chosen, x, y, target, names, hover)


def density(df: DataFrame, x: str, y: str, by: str, bins: int = 20) -> DataFrame:
    """(by, x_bin, y_bin, n): the scatter as counts on a grid, bounded at any table size."""
    df = normalise(df)
    span = _range(df, [x, y])
    if span[x][0] is None or span[y][0] is None:
        return df.select(by, F.lit(0).alias("x_bin"), F.lit(0).alias("y_bin"), F.lit(0).cast("long").alias("n")).limit(0)
    cx, cy = F.col(x).cast("double"), F.col(y).cast("double")
    return (
        df.filter(cx.isNotNull() & cy.isNotNull())
        .groupBy(by, _bin(cx, *span[x], bins).alias("x_bin"), _bin(cy, *span[y], bins).alias("y_bin"))
        .agg(F.count("*").alias("n"))
    )
