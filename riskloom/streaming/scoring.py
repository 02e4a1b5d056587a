"""Scoring a stream of rows. Scoring keeps no state, so the batch function is the stream function."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import StreamingQuery


def read_stream(spark: SparkSession, folder: str, schema: T.StructType, pattern: str | None = None) -> DataFrame:
    """A stream over the Parquet files that are in, or arrive in, ``folder``."""
    reader = spark.readStream.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.parquet(folder)


def score_stream(
    rows: DataFrame, transform: Callable[[DataFrame], DataFrame], out: str, checkpoint: str
) -> StreamingQuery:
    """Score all rows available now and append them to a Parquet table.

    The checkpoint and the file sink's log make each input file count exactly once across restarts.
    """
    return (
        transform(rows).writeStream.format("parquet").outputMode("append")
        .option("path", out).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
