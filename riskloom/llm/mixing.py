"""Mixing sources to target weights.

Sizes are summed per source, targets follow from the weights, and a source's repetition rate is its
target over its size. Each document is emitted floor(rate) times, plus once more with probability
equal to the fraction. That copy is drawn along the source's documents in the order of their size
(equals by a hash of the id): with a start that a hash of the source and the seed gives, a document
is drawn where the sum of the fractions passes a whole number. So each draw has the probability it
should have, reruns agree, and a source's words miss its target by no more than its largest
document's, as the draws before any place sum up to what they should within one.

The order comes from a range sort of ids and sizes; no source is ever one task's.

Defined results: a null text has size 0; a null source is a source of its own, last in order; a
source without words has target and rate 0; rows that share id, source and size share the draw;
rows without an id are told apart by their text; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from riskloom.llm.common import boxed, numbered, uniform, word_count
from riskloom.operators.selection import join_null_safe
from riskloom.session import pin, stage

WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3.0
SEED = 20


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST) -> DataFrame:
    """From ``source, size`` rows to ``source, source_size, target, rate``, one row per source.

    The sources weigh ``weights``, repeating, in code-point order with null last, and share the sum
    of all sizes; what a source would get above ``most`` times its size is shared again by weight.
    That ends at target = min(cap, level * weight) for one level, found from two sums per round;
    each round caps at least one more source or is the last.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = numbered(totals, F.col("source").asc_nulls_last(), name="_place")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = stage(
        ranked.withColumn("_weight", F.element_at(cycle, (F.col("_place") % len(weights) + 1).cast("int")))
        .withColumn("_cap", F.col("source_size") * most).drop("_place"))
    level, capped = 0.0, -1
    while True:
        full = F.col("_cap") <= F.col("_weight") * level
        total, held, free, now = ranked.agg(
            F.sum("source_size"), F.sum(F.when(full, F.col("_cap"))), F.sum(F.when(~full, F.col("_weight"))),
            F.count_if(full)).first()
        if now == capped or not free:
            break
        level, capped = ((total or 0) - (held or 0.0)) / free, now
    target = F.least(F.col("_cap"), F.col("_weight") * level)
    rate = F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(0.0)
    return ranked.select("source", "source_size", target.alias("target"), rate.alias("rate"))


def _sized(docs: DataFrame) -> DataFrame:
    """The rows as one column ``_row``, and what identifies a draw: ``_source, _size, _key``."""
    text = F.coalesce("_row.text", F.lit(""))
    return boxed(docs).select(
        "_row", F.col("_row.source").alias("_source"), word_count(text).alias("_size"),
        F.coalesce(F.col("_row.doc_id").cast("long"), F.xxhash64(text)).alias("_key"))


def draws(units: DataFrame, targets: DataFrame, seed: int) -> DataFrame:
    """``source, size, key, source_size, target, copies`` per draw; ``units`` has a row per document."""
    n = units.groupBy("source", "size", "key").agg(F.count("*").alias("_n"))
    order = [F.col("source").asc_nulls_last(), F.col("size") * F.col("_n"), F.xxhash64(F.lit(seed), "key"), F.col("key"), F.col("size")]
    placed = numbered(n, *order, name="_place")
    first = placed.groupBy("source").agg(F.min("_place").alias("_first"))
    per = pin(targets.join(first, targets["source"].eqNullSafe(first["source"])).select(
        targets["source"].alias("_source"), "_first", "source_size", "target", "rate"))
    joined = placed.join(per, F.col("source").eqNullSafe(F.col("_source")))
    fraction = F.col("rate") - F.floor("rate")
    before = uniform(seed, "source") + fraction * (F.col("_place") - F.col("_first"))
    extra = F.floor(before + fraction) - F.floor(before)
    return joined.select("source", "size", "key", "source_size", "target", (F.floor("rate") + extra).cast("int").alias("copies"))


def _drawn(docs: DataFrame, weights: Sequence[float], most: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """Each document's source, size and key; and the draws."""
    sized = _sized(docs)
    units = stage(sized.select(
        F.col("_row.doc_id").alias("doc_id"), F.col("_source").alias("source"), F.col("_size").alias("size"), F.col("_key").alias("key")))
    return units, draws(units, stage(source_targets(units, weights, most)), seed)


def copies(docs: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST, seed: int = SEED) -> DataFrame:
    """Per document ``doc_id, source, size, source_size, target, copies``; no text moves."""
    units, drawn = _drawn(docs, weights, most, seed)
    return join_null_safe(units, drawn, ["source", "size", "key"], "inner").drop("key")


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST, seed: int = SEED) -> DataFrame:
    """The documents, each as often as the mix takes it, with the columns they came with."""
    _, drawn = _drawn(docs, weights, most, seed)
    drawn = drawn.filter("copies > 0").select(
        F.col("source").alias("_source"), F.col("size").alias("_size"), F.col("key").alias("_key"), F.col("copies").alias("_copies"))
    joined = join_null_safe(_sized(docs), drawn, ["_source", "_size", "_key"], "inner")
    return joined.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), F.col("_copies")))).select("_row.*")
