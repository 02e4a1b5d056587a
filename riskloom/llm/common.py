"""What the operators share: tables, white space, words, and global order without a single task."""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from riskloom.session import stage

SPACE = r"[\x20\x09-\x0D]+"
TRIM = " \t\n\x0b\f\r"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def whole(column: str = "text") -> Column:
    """The text, a missing one as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def squeezed(text: Column) -> Column:
    """Each run of white space as one space. A single space is left alone, so most text is only
    scanned."""
    return F.regexp_replace(text, r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")


def words(text: Column) -> Column:
    """The runs of other characters, in order; an empty array if there are none."""
    trimmed = F.btrim(text, F.lit(TRIM))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE))


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def uniform(seed: int, *columns: str) -> Column:
    """A number in [0, 1) that depends on the columns' values and the seed only."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 11) * F.lit(2.0**-53)


def boxed(docs: DataFrame) -> DataFrame:
    """The table as one column ``_row``, so that no name of its can clash with an operator's own."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def prefix_sums(parts: DataFrame, order: list[str], value: str, name: str) -> DataFrame:
    """Adds the sum of ``value`` over all rows before, in the given order.

    For tables of at most one row per partition or file bucket, whose number the caller bounds.
    """
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumn(name, F.coalesce(F.sum(value).over(before), F.lit(0)).cast("long"))


def numbered(df: DataFrame, *order: Column, name: str = "place") -> DataFrame:
    """Adds the row's place in the given order, from 0.

    A range sort spreads the rows over tasks; each row gets its place within its partition, and
    the partitions' sizes (one row per partition, hence the broadcast) give the rest.
    """
    placed = stage(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    base = prefix_sums(sizes, ["_part"], "_n", "_base").drop("_n")
    return (
        placed.withColumn("_part", part).join(F.broadcast(base), "_part")
        .withColumn(name, F.col("_base") + F.col("_at").bitwiseAND((1 << 33) - 1))
        .drop("_at", "_part", "_base")
    )


def _return_memory() -> None:
    """Gives the system what this worker has freed; an allocator would keep it for later."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform.startswith("linux"):
        ctypes.CDLL(None).malloc_trim(0)


def lean(convert: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], tokens: bool = False):
    """The same function for workers that outlive tasks: it begins without what other stages keep
    (the tokenizers' tables, unless it uses them itself) and gives back what it has freed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = sys.modules.get("riskloom.llm.tokens")
        if kept and not tokens:
            kept.encoder.cache_clear()
        _return_memory()
        try:
            yield from convert(batches)
        finally:
            _return_memory()

    return run
