"""CSV without a schema: types found over all rows, and the rows that do not parse beside the others.

Every column climbs a lattice of types as far as its values make it: whole number, decimal number,
date, time, text. One aggregate over all rows counts, per column, the values that each type can
take; whole numbers with gaps become decimal ones, which is where a missing value can stand. Rows
with more or fewer fields than the header, or with a quote that never ends, are not forced into the
table: they come back as the text they were.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from riskloom.session import stage
from riskloom.spec import normalise

BROKEN = "__broken"
# What counts as no value, apart from the empty field.
MISSING = ("NaN", "nan", "NULL", "null", "NA", "N/A", "None")


@dataclass(frozen=True)
class Inferred:
    """The rows that parse, with types; the text of those that do not; and types by column."""

    table: DataFrame
    rejected: DataFrame
    types: dict[str, str]


def _present(column: str) -> Column:
    """The field, or NULL for an empty one or a mark of a missing value."""
    text = F.trim(f"`{column}`")
    return F.when(~text.isin("", *MISSING), F.col(f"`{column}`"))


def _whole(text: Column) -> Column:
    return F.trim(text).rlike(r"^[+-]?[0-9]{1,18}$")


def _decimal(text: Column) -> Column:
    return F.trim(text).rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$|^[+-]?(inf|Infinity)$")


def _date(text: Column) -> Column:
    return text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & F.try_to_date(text).isNotNull()


def _time(text: Column) -> Column:
    return text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}") & F.try_to_timestamp(text).isNotNull()


def _type_of(rows: int, present: int, whole: int, decimal: int, date: int, time: int) -> str:
    if present == 0:
        return "double"
    if whole == present:
        return "bigint" if present == rows else "double"
    if decimal == present:
        return "double"
    if date == present:
        return "date"
    return "timestamp" if date + time == present else "string"


def read_csv_inferred(spark: SparkSession, path: str) -> Inferred:
    """A CSV file or folder with headers. The text is read once and written as columns; counting and
    the result read those."""
    header = spark.read.option("header", True).option("inferSchema", False).csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header] + [T.StructField(BROKEN, T.StringType())])
    read = spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("mode", "PERMISSIVE")
    rows = stage(read.option("columnNameOfCorruptRecord", BROKEN).csv(path))
    good = rows.filter(F.col(BROKEN).isNull())
    counted = [F.count("*")]
    for c in header:
        text = _present(c)
        counted += [F.count(text), *[F.count_if(kind(text)) for kind in (_whole, _decimal, _date, _time)]]
    found = good.agg(*[x.alias(f"n{i}") for i, x in enumerate(counted)]).first()
    types = {c: _type_of(found[0], *found[1 + 5 * i:6 + 5 * i]) for i, c in enumerate(header)}
    typed = [
        (F.col(f"`{c}`") if t == "string" else F.trim(_present(c)).try_cast(t)).alias(c) for c, t in types.items()]
    return Inferred(normalise(good.select(*typed)), rows.filter(F.col(BROKEN).isNotNull()).select(F.col(BROKEN).alias("line")), types)
