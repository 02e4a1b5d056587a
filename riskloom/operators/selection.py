"""Exact k-of-n selection per stratum, independent of partitioning, without sorting a stratum.

Rows are ordered by the MD5 of (key, seed). A histogram of hash prefixes per stratum tells in which
prefix the k-th row lies; the prefix is lengthened until it holds few rows, only those are ranked,
and the result is one cut (hash, key) per stratum. Selecting is then a row-wise comparison with a
cut table of one row per stratum, so a hot stratum is never gathered. The key must be unique and
not null; a cut that falls on a missing or repeated key is an error.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskloom.operators.ranking import placed
from riskloom.session import any_row, pin, stage

MAX_ROWS = 1 << 20
DIGITS = 3
HASH_DIGITS = 32


class UnusableKey(ValueError):
    """The k-th row of a stratum is not determined by its key."""


def row_hash(key, seed: int) -> Column:
    parts = [key] if isinstance(key, str) else list(key)
    return F.md5(F.concat_ws(":", *[F.col(c).cast("string") for c in parts], F.lit(str(seed))))


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Equi-join where NULL keys match each other; keeps the left key columns."""
    renamed = right.withColumnsRenamed({k: f"__{k}" for k in keys})
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    return left.join(renamed, on, how).drop(*[f"__{k}" for k in keys])


def attach(left: DataFrame, right: DataFrame, strata: list[str], how: str) -> DataFrame:
    """The columns of a per-stratum table next to each row; without strata ``right`` has at most
    one row, whose values are scalars."""
    if strata:
        return join_null_safe(left, right, strata, how)
    return left.withColumns({c: right.select(c).scalar() for c in right.columns})


def _per_stratum(strata: list[str]):
    return Window.partitionBy(*(strata or [F.lit(0)]))


def hash_cuts(
    df: DataFrame, key, strata: list[str], quota, seed: int,
    max_rows: int = MAX_ROWS, digits: int = DIGITS,
) -> DataFrame:
    """(strata..., k, cut_hash, cut_key): the k-th smallest row of each stratum with k > 0.

    ``quota`` maps the stratum counts (strata..., n) to (strata..., n, k).
    """
    parts = [key] if isinstance(key, str) else list(key)
    rows = df.select(
        *strata, F.struct(*parts).alias("key"), row_hash(parts, seed).alias("h")
    )
    length = digits
    hist = stage(rows.groupBy(*strata, F.substring("h", 1, length).alias("prefix")).agg(F.count("*").alias("inside")))
    counts = quota(hist.groupBy(*strata).agg(F.sum("inside").alias("n")))
    wanted = counts.filter("k > 0").select(*strata, "k", F.col("k").alias("left"))
    cuts = pin(_locate(hist, wanted, strata))
    while any_row(cuts, f"inside > {max_rows}"):
        if length >= HASH_DIGITS:
            raise UnusableKey(f"{parts} repeats more than {max_rows} times")
        inside = attach(rows, cuts.select(*strata, F.col("prefix").alias("found")), strata, "inner")
        inside = inside.filter(F.col("h").startswith(F.col("found")))
        length += digits
        hist = inside.groupBy(*strata, F.substring("h", 1, length).alias("prefix")).agg(
            F.count("*").alias("inside")
        )
        cuts = pin(_locate(hist, cuts.select(*strata, "k", "left"), strata))

    last = attach(rows, cuts.drop("inside"), strata, "inner")
    last = last.filter(F.col("h").startswith(F.col("prefix")))
    order = _per_stratum(strata).orderBy("h", "key")
    missing = reduce(lambda a, b: a | b, [F.col(f"key.{p}").isNull() for p in parts])
    found = pin(
        last.withColumn("place", F.row_number().over(order))
        .withColumn("same", F.count("*").over(Window.partitionBy(*strata, "h", "key")))
        .filter("place = left")
        .select(*strata, "k", F.col("h").alias("cut_hash"), F.col("key").alias("cut_key"),
                ((F.col("same") > 1) | missing).alias("unusable"))
    )
    if any_row(found, "unusable"):
        raise UnusableKey(f"{parts} is missing or repeated")
    return found.drop("unusable")


def _locate(hist: DataFrame, wanted: DataFrame, strata: list[str]) -> DataFrame:
    """The prefix of each stratum in which its k-th row lies, and the rank left inside it."""
    running = _per_stratum(strata).orderBy("prefix").rowsBetween(Window.unboundedPreceding, 0)
    ranked = hist.withColumn("upto", F.sum("inside").over(running))
    return (
        attach(ranked, wanted, strata, "inner")
        .filter("upto - inside < left and left <= upto")
        .select(*strata, "k", (F.col("left") - F.col("upto") + F.col("inside")).alias("left"), "prefix", "inside")
    )


def mark_selected(
    df: DataFrame, key, strata: list[str], quota, seed: int, name: str = "selected", **kw
) -> DataFrame:
    """``df`` with a boolean column: is this row among the first k of its stratum in hash order."""
    parts = [key] if isinstance(key, str) else list(key)
    cuts = hash_cuts(df, parts, strata, quota, seed, **kw).drop("k")
    joined = attach(df, cuts, strata, "left")
    here = F.struct(row_hash(parts, seed).alias("h"), F.struct(*parts).alias("key"))
    cut = F.struct(F.col("cut_hash").alias("h"), F.col("cut_key").alias("key"))
    flag = F.coalesce(F.col("cut_hash").isNotNull() & (here <= cut), F.lit(False))
    return joined.withColumn(name, flag).drop("cut_hash", "cut_key")


def share_quota(share: float):
    """k = int(n * share) of every stratum."""
    return lambda counts: counts.withColumn("k", F.floor(F.col("n") * F.lit(float(share))).cast("long"))


def proportional_quota(share: float, strata: list[str]):
    """Test rows per stratum for a stratified split.

    ceil(share * n) rows are taken in total; the rest is spread over the strata by largest
    remainder, the smaller stratum value first on a tie. Works on the per-stratum counts only, which
    a range sort by remainder puts in order, so any number of strata will do.
    """

    def quota(counts: DataFrame) -> DataFrame:
        exact = "decimal(38,0)"
        counts = stage(counts)
        total = counts.agg(F.sum("n")).first()[0] or 0
        train = total - math.ceil(total * float(share))
        product = F.col("n").cast(exact) * F.lit(train).cast("decimal(19,0)")
        whole = F.lit(max(total, 1)).cast("decimal(19,0)")
        sized = counts.withColumn("over", (product % whole).cast("decimal(19,0)")).withColumn(
            "base", ((product - F.col("over")) / whole).cast("long"))
        ranked = placed(sized, F.desc("over"), *strata)
        spare = train - (ranked.agg(F.sum("base")).first()[0] or 0)
        k = F.col("n") - F.col("base") - (F.col("place") < spare).cast("long")
        return ranked.select(*strata, "n", k.alias("k"))

    return quota


def at_most_quota(k: int):
    """k rows of every stratum, or all of them."""
    return lambda counts: counts.withColumn("k", F.least(F.col("n"), F.lit(k)).cast("long"))
