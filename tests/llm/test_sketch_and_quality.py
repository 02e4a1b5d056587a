"""Bottom-k sketches and the quality classifier."""

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.llm import fingerprint, quality, queries
from samples import SCHEMA, WORD, awkward, docs, prose, whole


def shingle_set(text):
    w = WORD.findall(whole(text))
    return {tuple(w[i:i + 5]) for i in range(max(len(w) - 4, min(len(w), 1)))}


def test_sketch_is_the_smallest_distinct_hashes(spark):
    text = F.coalesce("text", F.lit(""))
    rows = docs(spark).select("text", fingerprint.shingle_hashes(text).alias("all"), fingerprint.sketch(text, 16).alias("few")).collect()
    for r in rows:
        assert len(set(r["all"])) == len(shingle_set(r.text))
        assert r.few == sorted(set(r["all"]))[:16]


def test_merging_parts_is_the_sketch_of_the_whole(spark):
    rows = [("a", list(range(i, 3000, 7))) for i in range(7)] + [("b", [5]), ("c", [])]
    parts = spark.createDataFrame(rows, "key string, s array<long>")
    got = {r.key: r.s for r in fingerprint.merge_parts(parts, "key", "s", 32).collect()}
    assert got == {"a": list(range(32)), "b": [5]}


def test_estimates(spark):
    base = prose(1, 4000, 9000).split()
    a, b = " ".join(base), " ".join(base[:3000] + prose(2, 1000, 9000).split())
    row = spark.createDataFrame([(a, b)], "a string, b string").select(
        fingerprint.sketch(F.col("a"), 1024).alias("a"), fingerprint.sketch(F.col("b"), 1024).alias("b"),
        fingerprint.sketch(F.lit(""), 1024).alias("e"))
    near = lambda x, y: fingerprint.resemblance(F.col(x), F.col(y), 1024)
    got = row.select(
        near("a", "b"), near("a", "a"), near("a", "e"), near("e", "e"), fingerprint.distinct_shingles(F.col("a"), 1024),
        fingerprint.containment(F.col("a"), F.col("b"), 1024), fingerprint.distinct_shingles(F.col("e"), 1024)).first()
    x, y = shingle_set(a), shingle_set(b)
    assert got[0] == pytest.approx(len(x & y) / len(x | y), abs=0.05)
    assert got[1:4] == (1, 0, 1)
    assert got[4] == pytest.approx(len(x), rel=0.1) and got[6] == 0
    assert got[5] == pytest.approx(len(x & y) / len(x), abs=0.08)


@pytest.mark.parametrize("buckets", [1, 3, 50])
def test_next_row(spark, buckets):
    rows = sorted(awkward(), key=lambda r: (r[0] is not None, r[0] or 0, whole(r[1])))
    found = fingerprint.with_next(docs(spark, clashing=True), {"n": F.length("text")}, buckets).collect()
    want = [(r[0], whole(r[1]), s[0], whole(s[1]), len(whole(s[1]))) for r, s in zip(rows, rows[1:] + rows[:1])]
    key = lambda t: tuple((v is None, str(v)) for v in t)
    assert sorted(((r.doc_id, r.text, r.next.doc_id, r.next.text, r.next.n) for r in found), key=key) == sorted(want, key=key)


def test_plan_grows_with_the_logarithm_of_the_buckets_only(spark):
    made = [fingerprint.with_next(docs(spark), {}, n)._jdf.queryExecution().analyzed().toString() for n in (16, 4096)]
    assert len(made[1]) < 3 * len(made[0])


def test_cuts_are_even(spark):
    ids = spark.range(10_000).select((F.col("id") * F.col("id")).alias("doc_id")).repartition(7)
    cuts = fingerprint._cuts(ids, 80).first()[0]
    edges = [round(c**0.5) for c in cuts] + [10_000]
    assert cuts[0] == 0 and cuts == sorted(set(cuts)) and 70 <= len(cuts) <= 80
    assert max(b - a for a, b in zip(edges, edges[1:])) < 400


def test_bottom_k_query(spark, folder):
    """The edited texts, by plain Python, and the estimates against exact similarity."""
    rows = sorted(queries.table(spark, folder, "documents").select("doc_id", "text").collect())
    got = {r.doc_id: r for r in queries.op8_bottom_k(spark, folder).collect()}
    off = []
    for (i, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        cut = len(text) // 4
        edited = text[:len(text) - cut] + after[:cut]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        x, y, z = shingle_set(text), shingle_set(edited), shingle_set(after)
        off += [abs(r.near_edited - len(x & y) / len(x | y)), abs(r.near_next - len(x & z) / len(x | z))]
    assert len(got) == len(rows) and np.mean(off) < 0.02 and max(off) < 0.2


def test_one_row_and_none(spark):
    one = docs(spark, awkward()[:1])
    assert [r.next.doc_id for r in fingerprint.with_next(one, {}).collect()] == [1]
    assert fingerprint.with_next(spark.createDataFrame([], SCHEMA), {}).collect() == []


def test_scores_are_the_densities_difference():
    rng = np.random.default_rng(2)
    k = len(quality.FEATURES)
    x = np.concatenate([rng.normal(0, 1, (300, k)), rng.normal(0.8, 1.6, (200, k))])
    label = np.repeat([0, 1], [300, 200])
    total = np.stack([np.concatenate([[len(v)], v.sum(0), (v.T @ v).ravel()]) for v in (x[label == 0], x[label == 1])])
    model = quality.solve(total, k, 0.1)
    logs = []
    for c in (0, 1):
        own = x[label == c]
        cov = np.cov(own.T, bias=True)
        cov = 0.9 * cov + (0.1 * np.trace(cov) / k + 1e-9) * np.eye(k)
        d = x - own.mean(0)
        logs.append(np.log(len(own) / 500) - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d))
    assert np.allclose(model.score(x), 1 / (1 + np.exp(logs[0] - logs[1])))


def test_fit_over_partitions_equals_numpy(spark):
    rng = np.random.default_rng(3)
    k = len(quality.FEATURES)
    x, label = rng.normal(0, 1, (400, k)), rng.integers(0, 2, 400)
    rows = [(v.tolist(), int(c)) for v, c in zip(x, label)] + [(x[0].tolist(), None), (x[1].tolist(), 5)]
    model = quality.fit(spark.createDataFrame(rows, "x array<double>, label int").repartition(7))
    total = np.stack([np.concatenate([[len(v)], v.sum(0), (v.T @ v).ravel()]) for v in (x[label == 0], x[label == 1])])
    assert np.allclose(model.means, quality.solve(total, k, quality.SHRINK).means)
    assert np.allclose(model.factors, quality.solve(total, k, quality.SHRINK).factors)


def test_quality_on_held_out_documents(spark, folder):
    found = {r.doc_id: r for r in queries.op10_quality_qda(spark, folder.replace("sf0.001", "sf0.01")).collect()}
    labels = queries.table(spark, folder.replace("sf0.001", "sf0.01"), "labels").collect()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in found.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found.values())
    held = [(found[r.doc_id].score, r.quality) for r in labels if found[r.doc_id].held_out]
    good, bad = [s for s, q in held if q == 1], [s for s, q in held if q == 0]
    assert np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad]) > 0.95


def test_held_out_labels_teach_nothing(spark, folder):
    table = queries.table(spark, folder, "documents")
    labels = queries.table(spark, folder, "labels")
    flipped = labels.withColumn("quality", F.when(quality.fold() == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    a = quality.trained(table, labels)
    b = quality.trained(table, flipped)
    assert np.allclose(a.factors, b.factors) and np.allclose(a.means, b.means)


@pytest.mark.parametrize("labels, score", [([], 0.5), ([(1, 1)], 1.0), ([(1, 0)], 0.0)])
def test_too_few_labels(spark, labels, score):
    known = spark.createDataFrame(labels, "doc_id long, quality int")
    found = quality.classify(docs(spark, clashing=True), known).collect()
    assert len(found) == len(awkward()) and {r.score for r in found} == {score}


def test_accepted_keeps_columns(spark):
    table = docs(spark, clashing=True)
    known = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    kept = quality.accepted(table, known)
    assert kept.columns == table.columns and kept.count() == len(awkward())
    assert quality.accepted(spark.createDataFrame([], SCHEMA), known).collect() == []
