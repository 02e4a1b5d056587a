"""Document fingerprints: bottom-k sketches of word-shingle hashes, in SQL functions only.

A sketch is the k smallest distinct 64-bit hashes of a text's shingles of five words (fewer if it
has fewer; a text of fewer words has one shingle, all its words; one without words has an empty
sketch), in order. The sketch of two parts together is the k smallest of both sketches, so parts
can be sketched anywhere and merged in any order. From two sketches follow the resemblance (the
share of the k smallest of both that is in each) and the containment, from one the number of
distinct shingles.

Defined results: a null text counts as empty; two empty sketches are alike (1), an empty and
another are not (0); equal texts have equal sketches; in ``with_next`` a null id sorts first, rows
that share an id are ordered by text, and a single row is its own next; an empty table gives an
empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskloom.llm.common import partitions, whole, words
from riskloom.session import stage

K = 128
WORDS = 5
BITS = 64
# Buckets of ids that a range of them is cut into.
PER_PART = 8


def shingle_hashes(text: Column, size: int = WORDS) -> Column:
    """The hash of each run of ``size`` words."""
    found = words(text)

    def at(w: Column) -> Column:
        several = F.transform(
            F.sequence(F.lit(0), F.size(w) - size), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(size)]))
        return F.when(F.size(w) >= size, several).when(F.size(w) > 0, F.array(F.xxhash64(w))).otherwise(
            F.array().cast("array<long>"))

    # The words are made once: a lambda's variable stands for them.
    return F.transform(F.array(found), at)[0]


def smallest(hashes: Column, k: int = K) -> Column:
    """The k smallest distinct numbers, in order."""
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def sketch(text: Column, k: int = K, size: int = WORDS) -> Column:
    return smallest(shingle_hashes(text, size), k)


def merged(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of both parts together."""
    return smallest(F.concat(a, b), k)


def merge_parts(parts: DataFrame, key: str, column: str, k: int = K) -> DataFrame:
    """One sketch per key from the sketches of its parts, combined on the map side: distinct
    hashes, then the k smallest by their place. Salted, so a key of very many parts is spread."""
    salts = partitions(parts.sparkSession)
    each = parts.select(key, F.explode(column).alias("_h")).distinct()
    salted = each.withColumn("_salt", F.pmod("_h", F.lit(salts)))
    within = Window.partitionBy(key, "_salt").orderBy("_h")
    few = salted.withColumn("_n", F.row_number().over(within)).filter(F.col("_n") <= k)
    return few.groupBy(key).agg(smallest(F.collect_list("_h"), k).alias(column))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """The estimated Jaccard similarity of the two shingle sets."""
    union = merged(a, b, k)
    both = F.size(F.array_intersect(F.array_intersect(union, a), b))
    return F.when(F.size(union) == 0, 1.0).otherwise(both / F.size(union)).cast("double")


def distinct_shingles(a: Column, k: int = K) -> Column:
    """The estimated number of distinct shingles; exact below k."""
    largest = F.element_at(a, -1).cast("double") + F.lit(2.0 ** (BITS - 1))
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) * F.lit(2.0**BITS) / largest)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """The estimated share of a's shingles that b has too."""
    union = merged(a, b, k)
    common = resemblance(a, b, k) * distinct_shingles(union, k)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), common / distinct_shingles(a, k)))


def text_of(a: Column) -> Column:
    """The sketch as text: 16 hexadecimal digits for each hash."""
    return F.concat_ws("", F.transform(a, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")))


def _cuts(docs: DataFrame, buckets: int) -> DataFrame:
    """One row: the ids, ascending, at which about so many buckets of equal numbers of rows begin.

    Ids are range-partitioned, each partition names a few of its own, so no task sees all of them;
    what is put together is a number per bucket.
    """
    each = min(PER_PART, buckets)
    ids = docs.select("doc_id").filter("doc_id is not null").repartitionByRange(-(-buckets // each), "doc_id")
    shares = F.array(*[F.lit(i / each) for i in range(each)])
    named = ids.groupBy(F.spark_partition_id().alias("_part")).agg(F.percentile_approx("doc_id", shares, 100 * each).alias("_ids"))
    return stage(named.agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("_ids")))).alias("cuts")))


def _with_bucket(rows: DataFrame, cuts: Column, most: int) -> DataFrame:
    """Adds ``_bucket``, the number of cuts (at most ``most``) that are not above the id, by halving."""
    rows = rows.withColumn("_bucket", F.lit(0))
    for jump in (1 << i for i in reversed(range(most.bit_length()))):
        ahead = F.get(cuts, F.col("_bucket") + (jump - 1)) <= F.col("doc_id")
        rows = rows.withColumn("_bucket", F.when(ahead, F.col("_bucket") + jump).otherwise(F.col("_bucket")))
    return rows


def with_next(docs: DataFrame, own: dict[str, Column], buckets: int | None = None) -> DataFrame:
    """Each row's ``doc_id`` and ``text`` (not null), the columns of ``own``, and all of these of
    the next row by ascending id as a struct ``next``; the first follows the last.

    Ids are cut into buckets of about equal numbers of rows, at ids that occur (their number
    follows the number of partitions, the plan's size its logarithm). The rows a bucket begins
    with also go, as guests, to the end of the bucket before, so after one shuffle by bucket the
    next row is a window function away. ``own`` is computed after the shuffle, once.
    """
    count = buckets or PER_PART * partitions(docs.sparkSession)
    low, nulls = docs.agg(F.min("doc_id"), F.count_if(F.col("doc_id").isNull())).first()
    # The least id begins the first bucket, unless rows without an id come before it.
    cuts = _cuts(docs, count).select(F.filter("cuts", lambda c: F.lit(nulls > 0) | (c != F.lit(low)))).scalar()
    begins = F.coalesce(F.get(cuts, F.col("_bucket") - 1) == F.col("doc_id"), F.lit(False))
    very_first = F.col("doc_id").isNull() if nulls else F.col("doc_id") == low
    at = F.filter(F.array(
        F.struct(F.col("_bucket").alias("b"), F.lit(False).alias("guest")),
        F.when(F.col("_begins"), F.struct((F.col("_bucket") - 1).alias("b"), F.lit(True).alias("guest"))),
        F.when(very_first, F.struct(F.col("_last").alias("b"), F.lit(True).alias("guest"))),
    ), lambda x: x.isNotNull())
    dealt = (
        _with_bucket(docs.select("doc_id", whole().alias("text")), cuts, count + PER_PART)
        .withColumns({"_begins": begins, "_last": F.size(cuts)})
        .select("doc_id", "text", F.inline(at)).repartition("b").withColumns(own)
    )
    order = Window.partitionBy("b").orderBy("guest", F.col("doc_id").asc_nulls_first(), "text")
    after = F.lead(F.struct("doc_id", "text", *own)).over(order)
    return dealt.withColumn("next", after).filter(~F.col("guest")).drop("b", "guest")
