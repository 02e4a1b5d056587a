"""Codes for the values of a column, however many there are: a sorted dictionary as a table.

Distinct values are ranked by a range sort: every value's code is its place within its partition
plus the number of values in the partitions before (one row per partition). Rows get their code by a
join; nothing but counts and sizes comes to the driver.

A value that many rows hold would be one task's in that join. Values above ``HOT_SHARE`` of the rows
number at most 1 / ``HOT_SHARE``, so they are broadcast and matched first; rows they match, and rows
without a value, then go through the join under keys of their own that match nothing, spread evenly.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskloom.operators.ranking import placed
from riskloom.session import stage

HOT_SHARE = 1e-3
SPREAD = 1 << 16


@dataclass(frozen=True)
class Dictionary:
    """The sorted values of one column: ``value, code, hot``; and how many there are."""

    column: str
    table: DataFrame
    size: int

    def save(self, path: str) -> None:
        self.table.write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, column: str, path: str) -> Dictionary:
        table = spark.read.parquet(path)
        return Dictionary(column, table, table.count())


def fit_dictionary(train: DataFrame, column: str) -> Dictionary:
    """The distinct values as text, without NULL, in code-point order; codes from 0."""
    counts = (
        train.select(F.col(column).cast("string").alias("value")).filter("value is not null")
        .groupBy("value").agg(F.count("*").alias("n"))
    )
    table = placed(counts, "value", name="code")
    rows, size = table.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    hot = F.col("n") > HOT_SHARE * rows
    return Dictionary(column, stage(table.select("value", "code", hot.alias("hot"))), size)


def with_code(df: DataFrame, known: Dictionary, name: str) -> DataFrame:
    """``df`` with the code of the dictionary's column; NULL for a value it does not hold."""
    value = F.col(f"`{known.column}`").cast("string")
    hot = known.table.filter("hot").select(F.col("value").alias("__hot"), F.col("code").alias("__hot_code"))
    rest = known.table.filter("not hot").select(F.concat(F.lit("v"), "value").alias("__key"), F.col("code").alias("__code"))
    first = df.withColumn("__value", value).join(F.broadcast(hot), F.col("__value") == F.col("__hot"), "left")
    needed = F.col("__hot").isNull() & F.col("__value").isNotNull()
    apart = F.concat(F.lit("r"), F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(SPREAD)).cast("string"))
    keyed = first.withColumn("__key", F.when(needed, F.concat(F.lit("v"), "__value")).otherwise(apart))
    coded = keyed.join(rest, "__key", "left").withColumn(name, F.coalesce("__hot_code", "__code"))
    return coded.drop("__value", "__hot", "__hot_code", "__key", "__code")


@dataclass(frozen=True)
class LabelEncoder:
    """Dictionaries of several columns, applied one after the other."""

    known: tuple[Dictionary, ...]

    def transform(self, df: DataFrame, unknown: str = "error") -> DataFrame:
        """Adds <column>_enc. A value that was not in the training rows ends the job, or is NULL
        with ``unknown="null"``; NULL stays NULL."""
        for d in self.known:
            code = f"{d.column}_enc"
            df = with_code(df, d, code)
            if unknown == "error":
                text = F.concat(F.lit(f"{d.column}: unknown value "), F.col(f"`{d.column}`").cast("string"))
                lost = F.col(code).isNull() & F.col(f"`{d.column}`").isNotNull()
                df = df.withColumn(code, F.when(lost, F.raise_error(text).cast("long")).otherwise(F.col(code)))
        return df


def fit_labels(train: DataFrame, columns: Sequence[str]) -> LabelEncoder:
    return LabelEncoder(tuple(fit_dictionary(train, c) for c in columns))


def slots(known: Sequence[Dictionary]) -> DataFrame:
    """(slot, column, value) of the vector whose slots ``with_slots`` gives."""
    first, parts = 0, []
    for d in known:
        parts.append(d.table.select((F.col("code") + first).alias("slot"), F.lit(d.column).alias("column"), "value"))
        first += d.size
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    return every


def with_slots(df: DataFrame, known: Sequence[Dictionary], name: str = "slots") -> DataFrame:
    """Adds the slots that each row sets in a sparse 0/1 vector with one slot per value of each
    column, the columns' slots one after the other; a value that is NULL or not in its dictionary
    sets none. The vector has as many slots as the dictionaries have values."""
    first, codes = 0, []
    for i, d in enumerate(known):
        df = with_code(df, d, f"__slot{i}")
        codes.append(F.col(f"__slot{i}") + first)
        first += d.size
    return df.withColumn(name, F.array_compact(F.array(*codes))).drop(*[f"__slot{i}" for i in range(len(known))])


def as_vector(slots_of: Column, size: int) -> Column:
    """The slots as a sparse vector for Spark ML, whose vectors only Python or Scala can build."""
    return F.udf(lambda at: Vectors.sparse(size, at, [1.0] * len(at)), VectorUDT())(slots_of)
