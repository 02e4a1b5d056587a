"""Files in and out, with explicit schemas."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, types as T

from riskloom.spec import STUDENT_SCHEMA, normalise


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str = STUDENT_SCHEMA) -> DataFrame:
    """CSV with a header; no inference pass. Empty fields are NULL."""
    return normalise(spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return normalise(spark.read.parquet(path))


def write_csv(df: DataFrame, path: str) -> None:
    """A folder of CSV parts with headers, one per partition."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def cached(df: DataFrame) -> DataFrame:
    """Keep a table for several reports of one session; the caller unpersists it."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)
