"""Exact dedup, source mixing and token rollups against plain Python."""

import hashlib
import re
from collections import Counter, defaultdict
from functools import lru_cache

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskloom.llm import exact_dedup, mixing, queries, token_rollup
from riskloom.session import fresh_path
from samples import SCHEMA, WORD, awkward, docs, squeezed, whole


def expected_groups(rows):
    by = defaultdict(list)
    for r in rows:
        by[squeezed(r[1])].append(r[0])
    out = []
    for r in rows:
        ids = by[squeezed(r[1])]
        keep = min((i for i in ids if i is not None), default=None)
        out.append((r[0], keep, len(ids), r[0] == keep, hashlib.sha256(squeezed(r[1]).encode()).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("digest", [exact_dedup.sha256, lambda t: F.substring(F.sha2(t, 256), 1, 1)])
def test_groups(spark, digest):
    """A digest of one letter clashes all the time; whole texts must still decide."""
    found = exact_dedup.groups(docs(spark), digest).withColumn("t", F.length("digest")).collect()
    want = expected_groups(awkward())
    assert Counter(tuple(r)[:4] for r in found) == Counter({k[:4]: 0 for k in want}) + sum(
        (Counter({k[:4]: n}) for k, n in want.items()), Counter())
    if digest is exact_dedup.sha256:
        assert Counter(tuple(r)[:5] for r in found) == want


@pytest.mark.parametrize("digest", [exact_dedup.sha256, lambda t: F.substring(F.sha2(t, 256), 1, 1)])
def test_deduplicate_keeps_one_row_per_text(spark, digest):
    kept = exact_dedup.deduplicate(docs(spark, clashing=True), digest).collect()
    texts = [squeezed(r.text) for r in kept]
    assert sorted(texts) == sorted({squeezed(r[1]) for r in awkward()})
    assert {r.doc_id for r in kept} == {r[1] for r in expected_groups(awkward()) if r[3]}
    assert kept[0].size == 7


def test_one_group_of_all_rows(spark):
    rows = [(i, "same text", "en", "a", 1) for i in range(500)]
    found = exact_dedup.groups(docs(spark, rows, parts=20)).select("keep_id", "group_size").distinct().collect()
    assert [tuple(r) for r in found] == [(0, 500)]


def expected_targets(rows, weights=(5, 2, 1), most=3):
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(WORD.findall(whole(r[1])))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    capped, total = set(), sum(sizes.values())
    while True:
        free = [s for s in order if s not in capped]
        rest = total - sum(most * sizes[s] for s in capped)
        level = rest / sum(weight[s] for s in free) if free else 0
        over = {s for s in free if level * weight[s] > most * sizes[s]}
        if not over:
            return sizes, {s: most * sizes[s] if s in capped else level * weight[s] for s in order}
        capped |= over


def test_targets(spark):
    sizes, want = expected_targets(awkward())
    found = mixing.copies(docs(spark)).collect()
    assert len(found) == len(awkward())
    for r in found:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
        assert 0 <= r.copies <= 3
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))


def test_capped_target_and_mean_of_draws(spark):
    """One small source of great weight is capped at three times its size; the rest share by weight."""
    rows = [(i, "w " * 10, "en", "a" if i < 5 else "b" if i < 1000 else "c", 1) for i in range(2000)]
    got = mixing.copies(docs(spark, rows)).groupBy("source").agg(
        F.first("target").alias("t"), F.sum(F.col("copies") * F.col("size")).alias("taken")).collect()
    got = {r.source: (r.t, r.taken) for r in got}
    assert got["a"] == (150, 150)
    assert got["b"][0] == pytest.approx(2 * got["c"][0])
    for target, taken in got.values():
        assert abs(taken - target) <= 10


def test_each_document_is_drawn_with_its_fraction(spark):
    """Over many seeds every document gets the copy about as often as the fraction says, and every
    source's words come within its largest document of the target."""
    rows = [(i, "w " * (1 + i % 7), "en", "ab"[i % 2], 1) for i in range(60)]
    table, extra, seeds = docs(spark, rows).coalesce(1).cache(), Counter(), 12
    for seed in range(seeds):
        found = mixing.copies(table, seed=seed).collect()
        for source in "ab":
            own = [r for r in found if r.source == source]
            assert abs(sum(r.copies * r["size"] for r in own) - own[0].target) <= 7
        extra.update({r.doc_id: r.copies for r in found})
    for r in found:
        assert abs(extra[r.doc_id] / seeds - r.target / r.source_size) < 0.5
    assert abs(sum(extra.values()) / seeds - sum(r.target / r.source_size for r in found)) < 1


def test_mix_emits_the_copies(spark):
    table = docs(spark, clashing=True)
    want = Counter()
    for r in mixing.copies(table).collect():
        want[r.doc_id] += r.copies
    got = Counter(r.doc_id for r in mixing.mix(table).collect())
    assert got == +want
    assert mixing.mix(table).columns == table.columns


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert exact_dedup.groups(none).collect() == []
    assert exact_dedup.deduplicate(none).collect() == []
    assert mixing.copies(none).collect() == []
    assert mixing.mix(none).collect() == []


KEYED = "source string, lang string, tokenizer string, tokens long"


def made(spark, *rows):
    return spark.createDataFrame(list(rows), KEYED)


def sums(spark, state):
    return {tuple(r) for r in token_rollup.totals(spark, state).collect()}


def test_rollup_of_signed_batches(spark):
    state = fresh_path(spark, "rollup-test")
    assert sums(spark, state) == set() and token_rollup.fold(spark, state) == 0
    first = token_rollup.inserted(made(
        spark, ("a", "en", "v1", 5), ("a", "en", "v1", 7), (None, None, "v1", 1), ("z", "en", "v1", 4)))
    assert token_rollup.commit(state, 1, first)
    changes = token_rollup.deleted(made(spark, ("z", "en", "v1", 4))).unionByName(
        token_rollup.revised(made(spark, ("a", "en", "v1", 5)), made(spark, ("a", "en", "v1", 9))))
    want = {("a", "en", "v1", 2, 16), (None, None, "v1", 1, 1)}
    assert token_rollup.commit(state, 2, changes)
    assert not token_rollup.commit(state, 2, changes)
    assert token_rollup.commit(state, 3, token_rollup.inserted(made(spark)))
    assert sums(spark, state) == want
    assert token_rollup.fold(spark, state) == 3 and token_rollup.fold(spark, state) == 3
    assert sums(spark, state) == want
    assert not token_rollup.commit(state, 1, first)
    with pytest.raises(ValueError):
        token_rollup.commit(state, 0, first)
    assert token_rollup.vacuum(spark, state) == 3
    assert not token_rollup.commit(state, 2, changes)
    assert sums(spark, state) == want


def test_interleaved_batches_and_snapshots(spark):
    """A batch that comes after a later one, one that two writers publish, and one that is
    published once more when a snapshot holds it."""
    state = fresh_path(spark, "rollup-test")
    batch = {n: token_rollup.inserted(made(spark, ("a", "en", "v1", 10**n))) for n in (1, 2, 3, 4)}
    token_rollup.commit(state, 1, batch[1])
    token_rollup.commit(state, 3, batch[3])
    assert token_rollup.fold(spark, state) == 1
    assert sums(spark, state) == {("a", "en", "v1", 2, 1010)}
    for _ in range(2):  # both writers looked before either had published
        token_rollup._publish(state, "batch-2", batch[2])
    assert sums(spark, state) == {("a", "en", "v1", 3, 1110)}
    assert token_rollup.fold(spark, state) == 3
    token_rollup._publish(state, "batch-2", batch[2])
    token_rollup._publish(state, "snapshot-1", batch[1])
    assert token_rollup.commit(state, 4, batch[4])
    assert sums(spark, state) == {("a", "en", "v1", 4, 11110)}
    token_rollup.vacuum(spark, state)
    assert sums(spark, state) == {("a", "en", "v1", 4, 11110)}


def test_rollup_ignores_what_a_failed_commit_left(spark):
    state = fresh_path(spark, "rollup-test")
    rows = token_rollup.inserted(made(spark, ("a", "en", "v1", 5)))
    rows.write.parquet(f"{state}/_attempt-{'0' * 32}")
    assert sums(spark, state) == set()
    assert token_rollup.commit(state, 1, rows)
    assert sums(spark, state) == {("a", "en", "v1", 1, 5)}


tokenizer = lru_cache(Tokenizer.from_file)


def ids_of(vocabulary, text):
    return len(tokenizer(vocabulary).encode(text, add_special_tokens=False).ids)


@pytest.mark.parametrize("vocabulary", [queries.WORD_BPE, queries.BYTE_BPE])
def test_counts_are_the_tokenizers_own(spark, vocabulary):
    rows = docs(spark, clashing=True).select("doc_id", F.col("text").alias("now"), "x", F.lit(None).cast("string").alias("later"))
    got = token_rollup.with_counts(rows, ["now", "later"], vocabulary).collect()
    count = Counter((r.doc_id, r.now) for r in got)
    assert count == Counter((r[0], None if r[1] is None else ids_of(vocabulary, r[1])) for r in awkward())
    assert {(r.x, r.later) for r in got} == {(7, None)}


def test_rollup_query_on_awkward_documents(spark):
    """Against plain Python: toxic documents are gone, those of low quality count without noise."""
    folder = fresh_path(spark, "rollup-query")
    rows = awkward() + [(90, "!!! noise $$ here %", "en", "a", 1), (91, "gone", "xx", "only", 1)]
    docs(spark, rows, clashing=True).write.parquet(f"{folder}/documents.parquet")
    marks = [(1, 1, 0), (7, 0, 0), (8, 0, 1), (None, 1, 1), (13, None, None), (90, 0, 0), (90, 0, 0), (91, 1, 1), (12, 0, None)]
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    toxic, low = {8, 91}, {7, 90}
    want = Counter()
    for vocabulary in (queries.WORD_BPE, queries.BYTE_BPE):
        for doc_id, text, lang, source, _ in rows:
            if doc_id in toxic:
                continue
            plain = re.sub(queries.NOISE, "", whole(text)) if doc_id in low else whole(text)
            key = source, lang, token_rollup.version_of(vocabulary)
            want[*key, "documents"] += 1
            want[*key, "tokens"] += ids_of(vocabulary, plain)
    got = Counter()
    for r in queries.op1_token_rollup(spark, folder).collect():
        got[r.source, r.lang, r.tokenizer, "documents"] += r.documents
        got[r.source, r.lang, r.tokenizer, "tokens"] += r.tokens
    assert got == want
