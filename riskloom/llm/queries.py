"""One query per operator over its whole table, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom.llm import (
    chat, decontamination, exact_dedup, fingerprint, link_trust, mixing, packing, quality, simhash, spelling, token_files,
    token_rollup, vector_codes,
)
from riskloom.llm.common import table, whole
from riskloom.session import fresh_path, stage

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
# Marks that only noise holds; documents of low quality are counted again without them.
NOISE = r"[!#$%&*]+"


def op1_token_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """Loads all documents under one tokenizer, adds a second, folds both into a snapshot, then
    deletes the toxic documents and revises the counts of those of low quality, whose noise goes;
    the last two batches are delivered twice."""
    labels = table(spark, folder, "labels").filter("doc_id is not null").groupBy("doc_id").agg(
        F.bool_or(F.col("toxic") == 1).alias("_toxic"), F.bool_or((F.col("quality") == 0) & (F.col("toxic") != 1)).alias("_low"))
    docs = table(spark, folder, "documents").select("doc_id", "source", "lang", whole().alias("now"))
    # Texts stay where they are read; labels meet the counts. A text without noise keeps its count.
    plain = F.regexp_replace("now", NOISE, "")
    texts = docs.withColumn("later", F.when(plain != F.col("now"), plain))
    toxic, low = F.coalesce("_toxic", F.lit(False)), F.coalesce("_low", F.lit(False))
    state = fresh_path(spark, "rollup")
    rows = token_rollup.counted
    loads, cleaning = [], []
    for vocabulary in (WORD_BPE, BYTE_BPE):
        name = token_rollup.version_of(vocabulary)
        counts = stage(token_rollup.with_counts(texts, ["now", "later"], vocabulary))
        known = stage(counts.join(labels, "doc_id", "left").select(
            "source", "lang", "now", F.coalesce("later", "now").alias("later"), toxic.alias("toxic"), (low & ~toxic).alias("low")))
        poor = known.filter("low")
        loads.append(token_rollup.inserted(rows(known, "now", name)))
        cleaning += [
            token_rollup.deleted(rows(known.filter("toxic"), "now", name)),
            token_rollup.revised(rows(poor, "now", name), rows(poor, "later", name))]
    changes = reduce(DataFrame.unionByName, cleaning)
    token_rollup.commit(state, 1, loads[0])
    token_rollup.commit(state, 2, loads[1])
    token_rollup.fold(spark, state)
    for number, batch in ((3, changes), (2, loads[1]), (3, changes)):
        token_rollup.commit(state, number, batch)
    return token_rollup.totals(spark, state)


def op2_chat_repair(spark: SparkSession, folder: str) -> DataFrame:
    return chat.repair(table(spark, folder, "conversations"))


def op3_link_trust(spark: SparkSession, folder: str) -> DataFrame:
    return link_trust.judge(table(spark, folder, "pages"))


def op4_simhash_links(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_groups(table(spark, folder, "documents"))
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op5_large_item_packing(spark: SparkSession, folder: str) -> DataFrame:
    packed = packing.pack(table(spark, folder, "documents"), WORD_BPE)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op6_simple8b_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.round_trip(table(spark, folder, "documents"), BYTE_BPE)


def op7_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = exact_dedup.groups(table(spark, folder, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def op8_bottom_k(spark: SparkSession, folder: str) -> DataFrame:
    """The edited text is the document with its last quarter replaced by the next one's beginning."""
    rows = fingerprint.with_next(
        table(spark, folder, "documents"), {"own": fingerprint.sketch(F.col("text")), "n_chars": F.length("text").cast("long")})
    cut = F.floor(F.col("n_chars") / 4).cast("int")
    edited = F.concat(F.left(F.col("text"), (F.col("n_chars") - cut).cast("int")), F.left(F.col("next.text"), cut))
    rows = rows.select("doc_id", "n_chars", "own", F.col("next.own").alias("after"), edited.alias("edited"))
    rows = rows.withColumn("changed", fingerprint.sketch(F.col("edited")))
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint.text_of(F.col("own")).alias("fingerprint"),
        fingerprint.text_of(F.col("changed")).alias("edited_fingerprint"),
        fingerprint.resemblance(F.col("own"), F.col("changed")).alias("near_edited"),
        fingerprint.resemblance(F.col("own"), F.col("after")).alias("near_next"))


def op9_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    found = mixing.copies(table(spark, folder, "documents"))
    return found.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op10_quality_qda(spark: SparkSession, folder: str) -> DataFrame:
    return quality.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op11_prefix_join(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op12_spelling_forms(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(table(spark, folder, "documents"))


def op13_gnat_codes(spark: SparkSession, folder: str) -> DataFrame:
    return vector_codes.compress(table(spark, folder, "embeddings"))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_token_rollup, op2_chat_repair, op3_link_trust, op4_simhash_links, op5_large_item_packing,
        op6_simple8b_files, op7_exact_dedup, op8_bottom_k, op9_source_mix, op10_quality_qda,
        op11_prefix_join, op12_spelling_forms, op13_gnat_codes, pipeline)
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _item_words(text: str) -> str:
    return rf"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _assigned(books: str) -> str:
    """Each part's entry ``e`` and squared distance ``d``; a distance and a place in one number decide ties."""
    far = "list_dot_product(q, q) - 2 * list_dot_product(q, c) + list_dot_product(c, c)"
    return f"""SELECT vec_id, p, q, (m % 64)::BIGINT AS e, m // 64 AS d FROM (
  SELECT vec_id, p, any_value(q) AS q, min(({far})::BIGINT * 64 + e) AS m FROM parts JOIN {books} USING (p) GROUP BY vec_id, p)"""


def _averaged(books: str, assigned: str) -> str:
    return f"""SELECT p, e, coalesce(s.c, b.c) AS c FROM {books} b LEFT JOIN (
  SELECT p, e, list(((t - ((t % n) + n) % n) // n)::DOUBLE ORDER BY i) AS c FROM (
    SELECT p, e, i, sum(q[i]::BIGINT) AS t, count(*) AS n FROM {assigned}, (SELECT unnest(range(1, (SELECT max(len(q)) FROM parts) + 1)) AS i)
    GROUP BY p, e, i) GROUP BY p, e) s USING (p, e)"""


ORACLES = {
    "op7_exact_dedup": r"""
WITH norm AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
groups AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM norm GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM norm JOIN groups USING (t)""",
    "op11_prefix_join": rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_item_words('text')} AS ws FROM documents),
items AS (SELECT item_id, {_item_words('text')} AS ws FROM benchmark),
wins AS (
  SELECT DISTINCT item_id, k, array_to_string(ws[i:i + k - 1], ' ') AS g FROM (
    SELECT item_id, ws, least(len(ws), 10) AS k, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS i FROM items WHERE len(ws) > 0)),
places AS (
  SELECT r, i, k, array_to_string(ws[i:i + k - 1], ' ') AS g FROM (
    SELECT r, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM wins))),
met AS (SELECT DISTINCT r, i, k, item_id FROM places JOIN wins USING (g, k)),
hits AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + k)) AS p FROM met) GROUP BY r),
held AS (
  SELECT r, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS id FROM met WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(hits.n, 0)::BIGINT AS n_hit, coalesce(held.n, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(hits.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (r) LEFT JOIN held USING (r)""",
    "op13_gnat_codes": f"""
WITH kept AS (
  SELECT vec_id, label, [floor(256 * x)::DOUBLE FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
parts AS (
  SELECT vec_id, p, v[p * w + 1:(p + 1) * w] AS q
  FROM (SELECT vec_id, v, len(v) // 16 AS w, unnest(range(16)) AS p FROM kept)),
b0 AS (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, q AS c FROM parts
  WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT 64)),
a0 AS ({_assigned('b0')}),
b1 AS ({_averaged('b0', 'a0')}),
a1 AS ({_assigned('b1')}),
b2 AS ({_averaged('b1', 'a1')}),
a2 AS ({_assigned('b2')}),
coded AS (SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a2 GROUP BY vec_id)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(array_to_string([x::BIGINT FOR x IN c], ','), ',' ORDER BY p, e)) FROM b2) AS codebooks_sha256
FROM coded JOIN kept USING (vec_id)""",
}
