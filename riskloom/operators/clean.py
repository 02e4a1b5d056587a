"""Cleaning, in this order: impute, drop duplicates, winsorise by IQR limits, round and cast."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.functions.columns import clip, half_even, outside, rows_of
from riskloom.operators import heavy, sketches
from riskloom.operators.profile import null_profile
from riskloom.operators.quantiles import quantile_table
from riskloom.session import local_rows, pin, stage
from riskloom.spec import RoleSpec, normalise

FENCE = 1.5


def medians(df: DataFrame, columns, approx: bool = False) -> DataFrame:
    """(column, value): exact median, missing values ignored; or one from a mergeable sketch, whose
    rank is off by at most ``sketches.rank_error`` of the rows."""
    if approx:
        return sketches.quantiles(sketches.sketch(df, columns), [0.5]).select("column", "value")
    return quantile_table(df, columns, [0.5], ["value"]).select("column", "value")


def modes(df: DataFrame, columns, many: bool = False) -> DataFrame:
    """(column, value): most frequent value, the smallest on a tie. With ``many`` by two or three
    passes that shuffle only values that can be the mode, for columns of very many values."""
    if many:
        return heavy.modes(df, columns).select("column", "value")
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    counts = (
        df.select(F.inline(cells)).filter(F.col("value").isNotNull())
        .groupBy("column", "value").agg(F.count("*").alias("n"))
    )
    best = F.min(F.struct((-F.col("n")).alias("rank"), "value"))
    return counts.groupBy("column").agg(best["value"].alias("value"))


def fill_values(df: DataFrame, spec: RoleSpec, many: bool = False) -> dict:
    """Median or mode per column, one value each; a column without any value has none. ``many`` as
    in ``modes``."""
    found = {}
    if spec.numeric:
        found |= {r["column"]: r["value"] for r in medians(df, spec.numeric).collect()}
    if spec.categorical:
        found |= {r["column"]: r["value"] for r in modes(df, spec.categorical, many).collect()}
    return {c: v for c, v in found.items() if v is not None}


def impute(df: DataFrame, fills: dict) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in fills.items()}) if fills else df


def first_per_key(df: DataFrame, subset, order=()) -> DataFrame:
    """Of the rows that agree on ``subset`` the first in the given order, rows of equal rank by all
    their columns, so that the same row stays under any partitioning. NULL keys agree. Each task
    hands on one row per key, so a hot key reaches no task with more rows than there are tasks."""
    rank = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))
    return df.groupBy(*[F.col(f"`{c}`").alias(f"__key{i}") for i, c in enumerate(subset)]).agg(F.min(rank).alias("__first")).select("__first.row.*")


def drop_duplicates(df: DataFrame, subset=None, key: str | None = None, order=()) -> DataFrame:
    """Keep one of equal rows; copies are combined before the shuffle, so a hot row costs nothing.

    With ``subset`` rows are equal that agree on these columns, and the first in ``order`` stays.

    With ``key`` only key values are shuffled first: equal rows share their key, so rows whose key
    occurs once are left as they are, and only the others are compared in full.
    """
    if subset:
        return first_per_key(df, subset, order)
    if key is None:
        return df.distinct()
    repeated = pin(df.groupBy(F.col(key).alias("__key")).count().filter("count > 1").select("__key"))
    same = F.col(key).eqNullSafe(F.col("__key"))
    return df.join(repeated, same, "left_anti").unionByName(df.join(repeated, same, "left_semi").distinct())


def duplicate_count(df: DataFrame, subset=None) -> DataFrame:
    """(rows, kept, duplicates) from counts per distinct row."""
    keys = list(subset or df.columns)
    groups = df.groupBy(*keys).agg(F.count("*").alias("__n"))
    return groups.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("rows"),
        F.count("*").alias("kept"),
        F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("duplicates"),
    )


def iqr_limits(df: DataFrame, columns, by=(), fence: float = FENCE) -> DataFrame:
    """(by..., column, n, q1, q3, iqr, lower, upper)."""
    q = quantile_table(df, columns, [0.25, 0.75], ["q1", "q3"], by)
    iqr = F.col("q3") - F.col("q1")
    return q.select(
        *by, "column", "n", "q1", "q3", iqr.alias("iqr"),
        (F.col("q1") - iqr * fence).alias("lower"),
        (F.col("q3") + iqr * fence).alias("upper"),
    )


def limits_of(df: DataFrame, columns, fence: float = FENCE) -> dict:
    """{column: (lower, upper)}; one row per column comes to the driver."""
    return {r["column"]: (r["lower"], r["upper"]) for r in iqr_limits(df, columns, (), fence).collect()}


def outlier_flag(column: str, limits: dict) -> Column:
    return outside(F.col(column), *limits[column])


def outlier_counts(df: DataFrame, columns, limits: dict | None = None) -> DataFrame:
    """(column, outliers, lower, upper).

    Limits come from the same table unless given: pass the raw table for the count over present
    values, the imputed one for the count that cleaning treats.
    """
    limits = limits_of(df, columns) if limits is None else limits
    columns = [c for c in columns if c in limits]
    if not columns:
        return df.sparkSession.createDataFrame([], "column string, outliers bigint, lower double, upper double")
    wide = df.agg(*[F.count_if(outlier_flag(c, limits)).alias(f"n_{c}") for c in columns])
    return rows_of(
        wide, ["column", "outliers", "lower", "upper"],
        [[F.lit(c), F.col(f"n_{c}"), F.lit(limits[c][0]), F.lit(limits[c][1])] for c in columns],
    )


def winsorise(df: DataFrame, limits: dict) -> DataFrame:
    return df.withColumns({c: clip(F.col(c), lo, hi) for c, (lo, hi) in limits.items()}) if limits else df


def fix_types(df: DataFrame, spec: RoleSpec) -> DataFrame:
    """Half-even rounding and the final types."""
    out = {c: half_even(F.col(c)).cast("int") for c in spec.integer}
    out |= {c: half_even(F.col(c), d) for c, d in spec.decimals.items()}
    return df.withColumns(out) if out else df


@dataclass(frozen=True)
class Cleaned:
    """The clean table and what was fitted on the way to it."""

    table: DataFrame
    raw: DataFrame
    distinct: DataFrame
    spec: RoleSpec
    fills: dict
    limits: dict

    def report(self) -> DataFrame:
        """(step, column, metric, value) in place of printed text; scans the table when called."""
        spec, limits = self.spec, self.limits
        nulls = null_profile(self.raw).collect()
        after = self.distinct.agg(F.count("*").alias("rows"), *[
            F.count_if(outlier_flag(c, limits)).alias(f"n_{c}") for c in limits
        ]).first()
        before = nulls[0]["rows"]
        rows = [("load", None, "rows", before)]
        rows += [("missing", r["column"], "nulls", r["nulls"]) for r in nulls]
        rows += [("missing", None, "nulls", sum(r["nulls"] for r in nulls))]
        rows += [("missing", c, "fill", v) for c, v in self.fills.items() if c in spec.numeric]
        rows += [("duplicates", None, "removed", before - after["rows"])]
        for c, (lower, upper) in limits.items():
            rows += [("outliers", c, "treated", after[f"n_{c}"]),
                     ("outliers", c, "lower", lower), ("outliers", c, "upper", upper)]
        rows += [("outliers", None, "treated", sum(after[f"n_{c}"] for c in limits)),
                 ("result", None, "rows", after["rows"])]
        return local_rows(
            self.raw.sparkSession, [(s, c, m, float(v)) for s, c, m, v in rows],
            "step string, column string, metric string, value double",
        )


def clean(df: DataFrame, spec: RoleSpec) -> Cleaned:
    """Run every step.

    Everything but the comparison of rows with a repeated id is row-wise around a few fitted
    constants. The rows left are written once, since both the limits and the result read them.
    ``df`` is read a few times, so stage it first when it is more than a scan.
    """
    raw = normalise(df)
    fills = fill_values(raw, spec)
    filled = impute(raw, fills)
    distinct = stage(drop_duplicates(filled, key=spec.id))
    limits = limits_of(distinct, spec.outlier)
    table = fix_types(winsorise(distinct, limits), spec)
    return Cleaned(table, raw, distinct, spec, fills, limits)


def clean_table(df: DataFrame, spec: RoleSpec) -> DataFrame:
    return clean(df, spec).table
