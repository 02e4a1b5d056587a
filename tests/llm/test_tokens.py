"""Token ids, Simple-8b, token files and packing: round trips and the library's own ids."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from riskloom.llm import packing, simple8b, token_files, tokens
from riskloom.llm.queries import BYTE_BPE, WORD_BPE
from riskloom.session import fresh_path
from samples import SCHEMA, awkward, docs, whole

ODD = [
    "", " ", "\n", "\n\n a", "  x\n\ny  ", "a'll don't,, 'x", "x\t y\r\n  z", "a <|endoftext|> b", "é,è!! ñ́. á!",
    "Hello,world foo.bar(baz) 3.14, x2!", "a  b  c d　 e", "a\x1cb \x85 c", "İstanbul! ΑΣ, ΑΣ ß.", "１２３,① ²! x²!",
    "' s 's", "x ='s y'll,", "﻿a ‘q’ “z”,", "ﬁne Å, K!", "日本語、テスト。 漢字!!", "a \n b", "\x00 \x07",
]


@pytest.fixture(scope="module", params=[BYTE_BPE, WORD_BPE])
def encoder(request):
    return tokens.Encoder(request.param, most_words=30)


def ids_of(encoder, texts, end=None):
    ids, edges = encoder.encode(pa.array(texts, pa.string()), end)
    return [ids[a:b].tolist() for a, b in zip(edges, edges[1:])]


def test_ids_are_the_tokenizers_own(encoder):
    texts = ODD + [whole(r[1]) for r in awkward()] + ["".join(ODD)]
    want = [e.ids for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert ids_of(encoder, texts) == want
    assert ids_of(encoder, texts, 1) == [[*w, 1] for w in want]
    assert ids_of(encoder, []) == []


@settings(max_examples=200, deadline=None)
@given(text=st.text(alphabet=st.sampled_from(" \n\t\r\x0b\x0c\x1c\x85\xa0abZ9é̈ßΣİ日'.,!<|>$_😀") | st.characters(exclude_categories=["Cs"])))
def test_ids_of_any_text(encoder, text):
    assert ids_of(encoder, [text])[0] == encoder.tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1) | st.integers(0, 300) | st.integers(0, 60_000), max_size=900))
def test_simple8b_round_trip(values):
    words, extras, table = simple8b.encode(np.array(values, np.uint64))
    assert simple8b.decode(words, extras, table).tolist() == values


def test_simple8b_blocks_and_density():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 32_768, 50_000).astype(np.uint64)
    words, extras, table = simple8b.encode(values)
    assert len(table) == 5 and len(extras) < 16 and len(words) <= 50_000 / 4 + 16
    assert simple8b.decode(words, extras, table, 1, 3).tolist() == values[simple8b.BLOCK:3 * simple8b.BLOCK].tolist()
    zeros = simple8b.encode(np.zeros(2400, np.uint64))[0]
    assert len(zeros) == 10


def test_file_bytes():
    ids = np.array([5, 0, 70_000, 2**62, 0], np.uint64)
    data = token_files.to_bytes([None, 7], np.array([2, 3]), ids)
    doc_ids, counts, back = token_files.from_bytes(data)
    assert (doc_ids, counts.tolist(), back.tolist()) == ([None, 7], [2, 3], ids.tolist())
    with pytest.raises(ValueError):
        token_files.from_bytes(data[:-5] + b"x" + data[-4:])


def test_files_hold_every_document_in_order(spark):
    from tokenizers import Tokenizer

    folder, library = fresh_path(spark, "ids"), Tokenizer.from_file(BYTE_BPE)
    table = docs(spark, clashing=True)
    files = token_files.write(table, folder, BYTE_BPE, file_ids=5_000)
    assert files.count() > 3
    found = sorted(token_files.read(spark, folder, files, with_ids=True).collect(), key=lambda r: r.start)
    rows = sorted(awkward(), key=lambda r: (r[0] is not None, r[0] or 0, whole(r[1])))
    start = 0
    for got, row in zip(found, rows, strict=True):
        ids = [*library.encode(whole(row[1]), add_special_tokens=False).ids, 0]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert (got.doc_id, got.start, got.n_tokens, got.ids_crc32, got.ids) == (row[0], start, len(ids), crc, ids)
        start += len(ids)


def check_packing(rows, capacity):
    """Every sequence is gapless from 0 and within the capacity."""
    by = defaultdict(list)
    for length, sequence, offset in rows:
        by[sequence].append((offset, length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def deal(counts, capacity):
    rows = []
    for length, a, b, first, each, offset in packing.plan(counts, capacity):
        rows += [(length, first + (i - a) // each, offset + (i - a) % each * length) for i in range(a, b)]
    assert Counter(r[0] for r in rows) == +Counter(counts)
    return rows


@settings(max_examples=300, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(0, 40), max_size=25))
def test_plans(counts):
    used = check_packing(deal(counts, 60), 60)
    assert used >= -(-sum(n * c for n, c in counts.items()) // 60)


def test_plan_is_near_the_bound():
    rng = random.Random(3)
    counts = Counter(min(4096, int(rng.lognormvariate(6.5, 1)) + 1) for _ in range(20_000))
    used = check_packing(deal(counts, 4096), 4096)
    assert used <= 1.003 * sum(n * c for n, c in counts.items()) / 4096 + 1


def test_large_items_pair_as_well_as_any_matching():
    """Against the best number of pairs, by trying all for a few lengths."""
    from functools import lru_cache

    rng = random.Random(4)
    for _ in range(60):
        sizes = tuple(sorted(rng.randrange(34, 100) for _ in range(9)))

        @lru_cache(None)
        def best(left):
            if not left:
                return 0
            first, rest = left[-1], left[:-1]
            return 1 + min([best(rest)] + [best(rest[:i] + rest[i + 1:]) for i, s in enumerate(rest) if s + first <= 100])

        assert check_packing(deal(Counter(sizes), 100), 100) == best(sizes)


def test_pack_documents(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORD_BPE)
    want = Counter()
    for r in awkward():
        ids = [*library.encode(whole(r[1]), add_special_tokens=False).ids, 1]
        for number, a in enumerate(range(0, len(ids), 4096)):
            own = ids[a:a + 4096]
            want[r[0], number, a, len(own), zlib.crc32(np.array(own, "<u4").tobytes())] += 1
    found = packing.pack(docs(spark, clashing=True), WORD_BPE).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == want
    total = sum(k[3] * n for k, n in want.items())
    assert check_packing([(r.length, r.sequence_id, r.offset) for r in found], 4096) == -(-total // 4096)


def test_sequences_hold_the_ids(spark):
    made = packing.sequences(docs(spark), WORD_BPE, capacity=512).collect()
    assert max(len(r.ids) for r in made) <= 512
    assert sum(r.ids.count(1) for r in made) >= len(awkward())


def test_many_equal_lengths(spark):
    rows = [(i, "word", "en", "a", 1) for i in range(3000)]
    found = packing.pack(docs(spark, rows, parts=9), WORD_BPE, capacity=10).collect()
    assert check_packing([(r.length, r.sequence_id, r.offset) for r in found], 10) == 600


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert packing.pack(none, WORD_BPE).collect() == []
    assert token_files.round_trip(none, BYTE_BPE).collect() == []
    assert none.select(F.col("doc_id")).collect() == []
