"""Flat labelled tables built from the normalised sample tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskloom.functions.columns import half_even
from riskloom.spec import RoleSpec

CUTOFF = "2000-09-01"

CUSTOMERS = RoleSpec(
    id="c_custkey",
    target="churned",
    numeric=("c_acctbal", "n_orders", "avg_price", "recency_days"),
    categorical=("c_mktsegment", "region"),
    drop=("c_name",),
    outlier=("n_orders", "avg_price", "recency_days"),
    integer=("n_orders", "recency_days"),
    decimals={"c_acctbal": 1, "avg_price": 1},
)
LINES = RoleSpec(
    id=None,
    target="returned",
    numeric=("l_quantity", "l_extendedprice", "l_discount", "l_tax"),
    categorical=("l_linestatus", "ship_year"),
    outlier=("l_quantity", "l_extendedprice", "l_tax"),
)
DOCUMENTS = RoleSpec(
    id="doc_id",
    target="poor",
    numeric=("n_chars", "n_words", "n_lines"),
    categorical=("lang", "source"),
    outlier=("n_chars", "n_words", "n_lines"),
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _undisclosed(column: str) -> Column:
    """True for about one row in 32: the value was never reported."""
    return F.md5(F.concat_ws(":", F.col("c_custkey").cast("string"), F.lit(column), F.lit("gap"))) < "08"


def customers(spark: SparkSession, folder: str) -> DataFrame:
    """One row per customer: order history before the cutoff, region, and whether the customer
    never ordered again. Orders are reduced to one row per customer before any join, so a customer
    with very many orders is combined on the map side."""
    day = F.lit(CUTOFF).cast("timestamp_ntz")
    before = F.col("o_orderdate") < day
    history = table(spark, folder, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count_if(before).alias("orders_before"),
        F.sum(F.when(before, F.col("o_totalprice"))).alias("price_before"),
        F.max(F.when(before, F.col("o_orderdate"))).alias("last_order"),
        F.count_if(~before).alias("orders_after"),
    )
    region = (
        table(spark, folder, "nation")
        .join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("n_nationkey").alias("c_nationkey"), F.col("r_name").alias("region"))
    )
    flat = (
        table(spark, folder, "customer").join(history, "c_custkey", "left").join(region, "c_nationkey", "left")
        .select(
            "c_custkey", "c_name", "c_mktsegment", "region", "c_acctbal",
            F.coalesce("orders_before", F.lit(0)).cast("double").alias("n_orders"),
            half_even(F.try_divide("price_before", "orders_before"), 2).alias("avg_price"),
            F.datediff(F.lit(CUTOFF).cast("date"), F.col("last_order").cast("date")).cast("double").alias("recency_days"),
            (F.coalesce("orders_after", F.lit(0)) == 0).cast("int").alias("churned"),
        )
    )
    return flat


def customers_with_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """The customers with values missing here and there, for the operators that treat missing
    values: about one row in 32 of each numeric column and of the region was never reported."""
    gaps = (*CUSTOMERS.numeric, "region")
    return customers(spark, folder).withColumns({c: F.when(~_undisclosed(c), F.col(c)) for c in gaps})


def lines(spark: SparkSession, folder: str) -> DataFrame:
    """One row per line item; positive when returned."""
    return table(spark, folder, "lineitem").select(
        "l_orderkey", *LINES.numeric, "l_linestatus",
        F.year("l_shipdate").cast("string").alias("ship_year"),
        (F.col("l_returnflag") == "R").cast("int").alias("returned"),
    )


def document_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document with sizes of its whole text; the text itself is never shuffled."""
    text = F.col("text")
    return table(spark, folder, "documents").select(
        "doc_id", "lang", "source", F.col("n_chars").cast("double").alias("n_chars"),
        (F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit(""))) + 1).cast("double").alias("n_words"),
        (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("double").alias("n_lines"),
    )


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """The labelled documents with their sizes; positive when of low quality. Sizes are computed
    before the join."""
    labels = table(spark, folder, "labels").select("doc_id", (1 - F.col("quality")).cast("int").alias("poor"))
    return document_sizes(spark, folder).join(labels, "doc_id")
