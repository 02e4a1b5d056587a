"""Decontamination, spelling variants and vector codes against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from riskloom.llm import bytes_of, decontamination, spelling, vector_codes
from samples import awkward, docs, prose, whole

ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
RUN = re.compile("[A-Za-zÀ-ÿ]+")
ITEMS = "item_id long, text string, words string, window long, hash long"


def lowered(text):
    return re.sub("[A-Z]+", lambda m: m.group().lower(), whole(text))


def items_table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 1) for r in rows], ITEMS)


def expected_hits(rows, items, size=10):
    windows = defaultdict(set)
    for item_id, text in items:
        words = ITEM_WORD.findall(lowered(text))
        k = min(len(words), size)
        for i in range(len(words) - k + 1 if words else 0):
            windows[tuple(words[i:i + k])].add(item_id)
    out = Counter()
    for r in rows:
        words = ITEM_WORD.findall(lowered(r[1]))
        hit, held = set(), set()
        for k in {len(w) for w in windows}:
            for i in range(len(words) - k + 1):
                if (own := tuple(words[i:i + k])) in windows:
                    hit |= set(range(i, i + k))
                    held |= windows[own]
        ids = sorted(str(i) for i in held if i is not None)
        out[r[0], len(words), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)] += 1
    return out


def contaminated():
    """Documents with items inside, cut short, overlapping, twice, in other case and punctuation."""
    a, b = prose(50, 40), prose(51, 25)
    nine = " ".join(a.split()[:9])
    rows = awkward() + [
        (100, f"{prose(60, 50)} {a} {prose(61, 30)}", "en", "a", 1), (101, f"{a}. {a.upper()}!", "en", "a", 1),
        (102, f"{nine} {prose(62, 20)}", "en", "a", 1), (103, ", ".join(a.split()[3:16]), "en", "a", 1),
        (104, f"{a} {b} {nine}", "en", "a", 1), (104, f"{a} {b} {nine}", "en", "a", 1), (105, "la la la la la la la la la la la la", "en", "a", 1),
        (106, f"{prose(63, 5000)} {b} {prose(64, 5000)} {a}", "en", "a", 1), (107, "only three words", "fr", "a", 1),
        (None, f"x {b}", None, None, None), (108, prose(70, 700), "en", "a", 1), (109, "é" + a, "en", "a", 1),
    ]
    items = [
        (1, a), (2, b), (3, a), (3, "only three words"), (4, None), (5, ""), (6, " ".join(["la"] * 10)), (7, "one two"),
        (None, " ".join(prose(60, 50).split()[5:20])), (8, "été 日本語 \U0001f600"), (9, prose(70, 700)), (10, "x"), (11, "!? -"),
        (12, " ".join(a.split()[:7])),
    ]
    return rows, items


@pytest.mark.parametrize("step", [decontamination.STEP, 3])
def test_contamination(spark, step):
    rows, items = contaminated()
    found = decontamination.contamination(docs(spark, rows, clashing=True), items_table(spark, items), step=step)
    assert Counter(tuple(r) for r in found.collect()) == expected_hits(rows, items)


@pytest.mark.parametrize("size", [1, 4, 6])
def test_contamination_by_other_windows(spark, size):
    rows, items = contaminated()
    found = decontamination.contamination(docs(spark, rows), items_table(spark, items), size)
    assert Counter(tuple(r) for r in found.collect()) == expected_hits(rows, items, size)


def test_contamination_without_rows(spark):
    none = spark.createDataFrame([], ITEMS)
    found = decontamination.contamination(docs(spark), none).collect()
    assert len(found) == len(awkward()) and not any(r.contaminated for r in found)
    assert decontamination.contamination(docs(spark).limit(0), items_table(spark, [(1, "a b")])).collect() == []


def test_words_of_a_batch_and_a_word_longer_than_a_stretch():
    texts = ["ab, Cd", "", "é9", None, "x" * 600_000 + " y", "ab"]
    found = bytes_of.words_of(pa.array(texts, pa.string()), decontamination._WORD)
    assert found.strings(np.arange(len(found.starts))).to_pylist() == ["ab", "cd", "é9", "x" * 600_000, "y", "ab"]
    assert found.edges.tolist() == [0, 2, 2, 3, 3, 5, 6]
    alone = bytes_of.words_of(pa.array(["y", "ab"]), decontamination._WORD)
    assert found.hashes[[4, 5]].tolist() == alone.hashes.tolist()
    assert len(set(found.hashes.tolist())) == 5


def expected_vocabulary(rows, letters=7, times=2):
    n = Counter()
    for r in rows:
        for run in RUN.findall(whole(r[1])):
            run = lowered(run)
            h = zlib.crc32(f"{'' if r[0] is None else r[0]}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= letters:
                n[run] += 1
    return {w: k for w, k in n.items() if k >= times}


def near(a, b):
    if len(a) < len(b):
        a, b = b, a
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(b))
    if len(a) == len(b):
        return i < len(a) and a[i + 1:] == b[i + 1:]
    return len(a) == len(b) + 1 and a[i + 1:] == b[i:]


def expected_variants(n):
    out, form = {}, {}
    around = {w: [v for v in n if abs(len(v) - len(w)) < 2 and near(w, v)] for w in n}
    for w in n:
        best = min(around[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n[w], len(around[w]), n[form[w]] if form[w] else None)
    return out


def spelled(seed, rows=60):
    """Texts of few stems with slips, accents and long words; some stems far more frequent."""
    rng = random.Random(seed)
    stems = ["calendar", "separate", "aaaaaaaa", "abababab", "élégamment", "tomorrow", "garçonnet", "misspelling" * 9, "z" * 90]
    made = []
    for i in range(rows):
        words = []
        for _ in range(60):
            w = rng.choice(stems[: 3 + i % 7])
            for _ in range(rng.choice((0, 0, 0, 0, 0, 0, 1, 1, 2))):
                k = rng.randrange(len(w) + 1)
                w = rng.choice((w[:k] + w[k + 1:], w[:k] + rng.choice("abzé÷") + w[k:], w[:k] + rng.choice("abzéÿ") + w[k + 1:]))
            words.append(rng.choice((w, w.capitalize(), w.replace("a", "A"))))
        made.append((i, rng.choice((" ", ", ", "1", "ł")).join(words), "en", "a", 1))
    return made + [(None, "calendar Calendar calendaR", None, None, None), (0, None, None, None, None), (3, "", "en", "a", 0)]


def test_vocabulary(spark):
    rows = spelled(1) + awkward()
    got = {r.word: r.n for r in spelling.vocabulary(docs(spark, rows, clashing=True)).collect()}
    assert got == expected_vocabulary(rows)


@pytest.mark.parametrize("seed", [2, 3])
def test_variants(spark, seed):
    rows = spelled(seed)
    got = spelling.variants(docs(spark, rows, clashing=True)).collect()
    want = expected_variants(expected_vocabulary(rows))
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got} == want
    assert len(got) == len(want) > 100
    assert any(f for f, *_ in want.values())


@pytest.mark.parametrize("most", [3, 40])
def test_near_pairs_of_blocks_that_are_cut_again(spark, most):
    rng = random.Random(4)
    words = {"".join(rng.choice("ab") for _ in range(rng.randrange(7, 10))) for _ in range(300)} | {"aaaaaaa" + c for c in "abcdé"}
    table = spark.createDataFrame([(w, i + 2) for i, w in enumerate(sorted(words))], "word string, n long").repartition(3)
    got = Counter((r.word, r.near) for r in spelling.near_pairs(table, most).collect())
    want = Counter((a, b) for a in words for b in words if a != b and abs(len(a) - len(b)) < 2 and near(a, b))
    assert got == want


def test_forms_lead_to_the_last_word(spark):
    forms = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(9)] + [("x", "w3")], "word string, form string")
    assert {tuple(r) for r in spelling.roots(forms).collect()} == {(f"w{i}", "w9") for i in range(9)} | {("x", "w9")}


def test_variants_without_words(spark):
    assert spelling.variants(docs(spark).limit(0)).collect() == []
    assert spelling.variants(docs(spark, [(1, "short words only", "en", "a", 1), (2, None, None, None, None)])).collect() == []


def floors(vector):
    return [int(np.floor(np.float64(x) * 256)) for x in vector]


def expected_codes(rows, parts=16, entries=64, rounds=2):
    kept = [(i, label, floors(v)) for i, label, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    kept = [r for r in kept if len(r[2]) == len(kept[0][2])]
    width = -(-len(kept[0][2]) // parts)
    cut = [[(v + [0] * (parts * width))[p * width:(p + 1) * width] for p in range(parts)] for _, _, v in kept]
    books = [[cut[e][p] for e in range(min(entries, len(cut)))] for p in range(parts)]

    def nearest(q, book):
        return min((sum((a - b) ** 2 for a, b in zip(q, c)), e) for e, c in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            own = defaultdict(list)
            for v in cut:
                own[nearest(v[p], books[p])[1]].append(v[p])
            books[p] = [[sum(x) // len(own[e]) for x in zip(*own[e])] if e in own else c for e, c in enumerate(books[p])]
    found = [[nearest(v[p], books[p]) for p in range(parts)] for v in cut]
    errors = [sum(d for d, _ in f) for f in found]
    per = Counter()
    for (_, label, _), error in zip(kept, errors):
        per[label] += error
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    return Counter((i, "".join(f"{e:02x}" for _, e in f), error, per[label], digest)
                   for (i, label, _), f, error in zip(kept, found, errors))


VECTORS = "vec_id long, label int, embedding array<float>, error long, code string"


def vectors(spark, rows, parts=3):
    return spark.createDataFrame([(*r, 5, "x") for r in rows], VECTORS).repartition(parts)


def some_vectors(n, dimension, seed=0, coarse=False):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 0.2, (n, dimension))
    x = (np.round(x * 4) / 4 if coarse else x).astype(np.float32)
    return [(i, None if i % 7 == 0 else i % 3, x[i].tolist()) for i in range(n)]


AWKWARD = [
    (500, 1, None), (501, 1, [float("nan")] * 32), (502, None, [float("inf")] + [0.0] * 31), (503, 2, [None] + [1.0] * 31),
    (504, 1, [1.0, 2.0]), (505, 1, []), (None, 1, [0.5] * 32), (3, 2, [0.25] * 32), (3, 2, [0.25] * 32), (-1, 1, [-0.001] * 32),
]


@pytest.mark.parametrize("coarse", [False, True])
def test_codes(spark, coarse):
    """Coarse components make many ties and repeated entries."""
    rows = some_vectors(300, 32, 1, coarse) + AWKWARD
    found = vector_codes.compress(vectors(spark, rows)).collect()
    assert Counter(tuple(r) for r in found) == expected_codes(rows)


@pytest.mark.parametrize("n, dimension", [(5, 32), (90, 20), (40, 3), (3, 0)])
def test_codes_of_few_rows_and_uneven_lengths(spark, n, dimension):
    rows = some_vectors(n, dimension, 2)
    found = vector_codes.compress(vectors(spark, rows)).collect()
    assert Counter(tuple(r) for r in found) == expected_codes(rows)


def test_codes_without_vectors(spark):
    assert vector_codes.compress(vectors(spark, [(1, 1, None), (2, 2, [None])])).collect() == []
    assert vector_codes.compress(vectors(spark, [(1, 1, None)]).limit(0)).collect() == []


def test_huge_components_count_as_the_bound(spark):
    rows = [(-1, 1, [3e38] * 16), (-2, 1, [-3e38] * 16)] + some_vectors(70, 16, 3)
    found = {r.vec_id: r for r in vector_codes.compress(vectors(spark, rows)).collect()}
    bounded = [(i, label, np.clip(v, -2.0**19, 2.0**19).tolist()) for i, label, v in rows]
    assert {tuple(r) for r in found.values()} == set(expected_codes(bounded))


@pytest.mark.parametrize("degree", [2, 3, 8])
@pytest.mark.parametrize("spread", [2, 30, 10**6])
def test_tree_finds_the_lowest_nearest_entry(degree, spread):
    rng = np.random.default_rng(spread + degree)
    points, queries = rng.integers(-spread, spread, (64, 4)), rng.integers(-2 * spread, 2 * spread, (500, 4))
    entry, square = vector_codes.Gnat(points, degree=degree).nearest(queries)
    every = ((queries[:, None] - points[None]) ** 2).sum(axis=2)
    assert entry.tolist() == every.argmin(axis=1).tolist()
    assert square.tolist() == every.min(axis=1).tolist()


def test_tree_rules_out_subtrees(monkeypatch):
    """Far groups of entries are never compared with queries near one of them."""
    rng = np.random.default_rng(5)
    centres = rng.integers(-10**6, 10**6, (8, 4))
    points = np.concatenate([c + rng.integers(-20, 20, (8, 4)) for c in centres])
    queries = np.concatenate([c + rng.integers(-20, 20, (50, 4)) for c in centres])
    compared = []
    exact = vector_codes._squares
    tree = vector_codes.Gnat(points)
    monkeypatch.setattr(vector_codes, "_squares", lambda q, p: compared.append(len(q) * len(p)) or exact(q, p))
    entry, _ = tree.nearest(queries)
    assert entry.tolist() == ((queries[:, None] - points[None]) ** 2).sum(axis=2).argmin(axis=1).tolist()
    assert sum(compared) < 0.4 * len(queries) * len(points)
