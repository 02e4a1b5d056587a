"""Exact deduplication by skew-safe combining.

Texts are equal when they are identical after each run of white space became one space. A group of
copies is reduced in three steps, each of which compares whole texts and not only digests: within
a partition before anything is shuffled, then within (digest, salt), then over the salts. The salt
comes from the partition a row was read in, so the first step always shrinks a group to one row per
partition, and a group of any size reaches no task with more rows than there are salts.

Defined results: a null text counts as empty; a null ``doc_id`` loses to any other; rows that share
both id and text are one document (``deduplicate`` returns it once, ``groups`` flags each of its
rows); an empty table gives an empty table; other columns pass through untouched.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.llm.common import boxed, squeezed, whole
from riskloom.session import stage

SALTS = 16


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def _keyed(docs: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    normal = squeezed(whole())
    return docs.select("doc_id", normal.alias("_text")).withColumn("_digest", digest(F.col("_text")))


def winners(keyed: DataFrame, salts: int = SALTS) -> DataFrame:
    """One row per distinct text: ``_digest, _text, keep_id, group_size``."""
    salted = (
        keyed.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
        .groupBy("_digest", "_salt", "_text")
        .agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    )
    return salted.groupBy("_digest", "_text").agg(
        F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))


def groups(docs: DataFrame, digest: Callable[[Column], Column] = sha256, salts: int = SALTS) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, digest``.

    The combining above has compared whole texts, so a digest that it left with one text identifies
    that text, and the members need only be joined by digest. Digests that it left with several
    texts are joined by digest and text.
    """
    keyed = _keyed(docs, digest)
    found = stage(winners(keyed, salts).drop("_text"))
    clashing = stage(found.groupBy("_digest").count().filter("count > 1").select("_digest"))
    members = keyed.drop("_text").join(found, "_digest")
    if not clashing.isEmpty():
        clear = keyed.drop("_text").join(clashing, "_digest", "left_anti").join(found, "_digest")
        rest = keyed.join(clashing, "_digest", "left_semi")
        members = clear.unionByName(rest.join(winners(rest, salts), ["_digest", "_text"]).drop("_text"))
    return members.select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("_digest").alias("digest"))


def deduplicate(docs: DataFrame, digest: Callable[[Column], Column] = sha256, salts: int = SALTS) -> DataFrame:
    """The documents that stay, with all their columns: the smallest ``doc_id`` of each text."""
    kept = groups(docs, digest, salts).filter("kept").select(F.col("doc_id").alias("_id"), F.col("digest").alias("_key"))
    once = stage(kept.groupBy("_id", "_key").agg(F.count("*").alias("_copies")))
    rows = boxed(docs).withColumn("_digest", digest(squeezed(F.coalesce("_row.text", F.lit("")))))
    same = F.col("_row.doc_id").eqNullSafe(F.col("_id")) & (F.col("_digest") == F.col("_key"))
    rows = rows.join(once, same)
    if not once.filter("_copies > 1").isEmpty():
        again = rows.filter("_copies > 1").withColumn("_id", F.col("_row.doc_id"))
        rows = rows.filter("_copies = 1").unionByName(again.dropDuplicates(["_id", "_digest"]))
    return rows.select("_row.*")
