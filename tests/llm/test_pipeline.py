"""The pipeline on a small table against the stages in plain Python, and every query on whole tables."""

import os
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from riskloom.llm import mixing, quality, queries
from riskloom.session import fresh_path
from samples import awkward, docs, squeezed, whole
from test_dedup_and_mix import expected_targets
from test_simhash import fingerprint, linked, near_copies, roots
from test_tokens import check_packing


@pytest.fixture(scope="module")
def made(spark):
    """A folder with documents and labels; noise is of low quality."""
    folder = fresh_path(spark, "pipeline-test")
    rows = [r for r in near_copies() if r[0] is not None]
    rows += [(5000 + i, f"{'!!! $$$ %%% ### ' * (5 + i)}{i}", "en", "a", 1) for i in range(30)]
    docs(spark, rows).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{folder}/documents.parquet")
    labels = [(r[0], int(r[0] < 5000), 0) for r in rows]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, rows


def test_stages(spark, made):
    from tokenizers import Tokenizer

    folder, rows = made
    table, labels = queries.table(spark, folder, "documents"), queries.table(spark, folder, "labels")
    model = quality.trained(table, labels)
    score = lambda t: model.score(np.array([quality.statistics(whole(t).encode())]))[0]
    good = [r for r in rows if score(r[1]) >= 0.5]
    assert 0 < len(good) < len(rows) and all(r[0] < 5000 for r in good)
    first = {}
    for r in sorted(good, key=lambda r: r[0]):
        first.setdefault(squeezed(r[1]), r)
    prints = {r[0]: fingerprint(r[1]) for r in first.values()}
    near = linked(prints)
    assert near
    stay = set(roots(prints, near).values())
    kept = [r for r in first.values() if r[0] in stay]
    sizes, targets = expected_targets(kept)
    draws = {r.doc_id: r for r in mixing.copies(docs(spark, kept)).collect()}
    library, want = Tokenizer.from_file(queries.WORD_BPE), Counter()
    for r in kept:
        rate = targets[r[3]] / sizes[r[3]] if sizes[r[3]] else 0
        times = draws[r[0]].copies
        assert int(rate + 1e-9) <= times <= int(rate) + 1
        ids = [*library.encode(whole(r[1]), add_special_tokens=False).ids, 1]
        for number, a in enumerate(range(0, len(ids), 4096)):
            want[r[0], number, zlib.crc32(np.array(ids[a:a + 4096], "<u4").tobytes())] += times
    found = corpus_pipeline.run(spark, folder).collect()
    assert Counter((r.doc_id, r.piece, r.ids_crc32) for r in found) == +want
    check_packing([(r.length, r.sequence_id, r.offset) for r in found], 4096)


def test_middle_stages_return_the_columns_of_documents(spark, made):
    folder, _ = made
    table = queries.table(spark, folder, "documents")
    for _, apply in corpus_pipeline.STAGES[:-1]:
        assert apply(spark, table, folder).schema == table.schema


def test_empty_documents(spark, made):
    folder = fresh_path(spark, "pipeline-test")
    queries.table(spark, made[0], "documents").limit(0).write.parquet(f"{folder}/documents.parquet")
    queries.table(spark, made[0], "labels").limit(0).write.parquet(f"{folder}/labels.parquet")
    assert corpus_pipeline.run(spark, folder).collect() == []


def test_rows_without_or_with_repeated_ids_and_clashing_columns(spark):
    """Nothing but noise, exact and near copies goes; other columns pass through to the packing."""
    folder = fresh_path(spark, "pipeline-test")
    docs(spark, awkward() + [(None, None, None, None, None)] * 2, clashing=True).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, 0) for i in range(20, 60)] + [(5, 0, 0), (6, 0, 0), (None, 1, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    found = corpus_pipeline.run(spark, folder).collect()
    check_packing([(r.length, r.sequence_id, r.offset) for r in found], 4096)
    good = {r.doc_id for r in quality.accepted(docs(spark), queries.table(spark, folder, "labels")).collect()}
    assert {r.doc_id for r in found} <= good
    assert len({r.doc_id for r in found}) > 20


def test_queries_on_awkward_documents(spark):
    folder = fresh_path(spark, "queries-test")
    docs(spark, clashing=True).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (7, 0, 0), (8, 0, 1), (None, 1, 1), (13, None, None)], "doc_id long, quality int, toxic int").write.parquet(
        f"{folder}/labels.parquet")
    count = len(awkward())
    for name in ("op4_simhash_links", "op6_simple8b_files", "op7_exact_dedup", "op8_bottom_k", "op9_source_mix", "op10_quality_qda"):
        assert queries.QUERIES[name](spark, folder).count() == count, name
    assert queries.op5_large_item_packing(spark, folder).count() >= count
    assert queries.op1_token_rollup(spark, folder).count() > 0


def test_taken_words_come_near_targets(spark, folder):
    by = defaultdict(lambda: [0, 0])
    for r in queries.op9_source_mix(spark, folder.replace("sf0.001", "sf0.01")).collect():
        assert r.taken <= 3 * r["size"]
        by[r.target, r.source_size][0] += r.taken
        by[r.target, r.source_size][1] = max(r["size"], by[r.target, r.source_size][1])
    for (target, _), (taken, largest) in by.items():
        assert abs(taken - target) <= largest
    assert os.path.isdir(folder)
