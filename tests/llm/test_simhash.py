"""SimHash links, groups and near copies against all pairs."""

from itertools import combinations

import xxhash
from hypothesis import given, settings, strategies as st

from riskloom.llm import simhash
from riskloom.llm.components import components
from samples import SCHEMA, WORD, awkward, docs, prose, whole


def shingles(text, size):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in whole(text))
    w = WORD.findall(low)
    return [" ".join(w[i:i + size]) for i in range(max(len(w) - size + 1, min(len(w), 1)))]


def fingerprint(text, size=3):
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles(text, size)]
    bits = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    return bits - (1 << 64) if bits >> 63 else bits


def roots(nodes, edges):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_fingerprints(spark):
    got = sorted((r.doc_id or -1, r.fp) for r in simhash.fingerprints(docs(spark)).collect())
    assert got == sorted((r[0] or -1, fingerprint(r[1])) for r in awkward())


def test_groups_on_awkward_texts(spark):
    rows = [r for r in awkward() if r[0] is not None]
    prints = {r[0]: fingerprint(r[1]) for r in rows}
    edges = [(a, b) for a, b in combinations(prints, 2) if ((prints[a] ^ prints[b]) % 2**64).bit_count() <= 3]
    want = roots(prints, edges)
    found = simhash.near_groups(docs(spark, rows, clashing=True)).collect()
    assert len(found) == len(rows)
    assert {r.doc_id: r.component_id for r in found} == want
    assert want[2] == 1 and want[14] == 1 and want[6] == 4


def test_links_find_every_close_pair(spark):
    """Clusters of fingerprints at distances 0 to 5, some across the ring's ends."""
    import random

    rng, prints = random.Random(5), set()
    for _ in range(60):
        base = rng.getrandbits(64)
        prints.add(base)
        for k in (1, 2, 3, 3, 3, 4, 5):
            flipped = base
            for b in rng.sample(range(64), k):
                flipped ^= 1 << b
            prints.add(flipped)
    prints |= {0, 7, 2**64 - 1, 2**63, 2**63 | 3}
    signed = [p - 2**64 if p >> 63 else p for p in prints]
    want = {(min(a, b), max(a, b)) for a, b in combinations(signed, 2) if ((a ^ b) % 2**64).bit_count() <= 3}
    got = simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long")).collect()
    assert len(got) == len(set(map(tuple, got)))
    assert {tuple(r) for r in got} == want


@settings(max_examples=300, deadline=None)
@given(st.sets(st.integers(0, 63), max_size=3))
def test_some_chain_fits_whatever_differs(bits):
    parts = [sum(1 << (b - 16 * i) for b in bits if b // 16 == i) for i in range(4)]
    ok = [all(sum(parts[(i + j) % 4].bit_count() for j in range(n)) <= 3 * n // 4 for n in range(1, 5)) for i in range(4)]
    assert any(ok)


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(60, 61), (61, 62), (62, 60), (7, 7)]
    want = roots({n for e in edges for n in e}, edges)
    got = components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {r.node: r.component for r in got} == want
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


def near_copies():
    """Groups of copies with a few words changed, and texts that share half of their words."""
    rows = [r for r in awkward() if r[0] is not None and r[0] < 40]
    for g in range(12):
        words = prose(900 + g, 250, 5000).split()
        for c in range(4):
            new = list(words)
            for k in range(c):
                new[(37 * k + 11 * c) % 250] = f"new{g}{c}{k}"
            rows.append((1000 + 10 * g + c, " ".join(new), "en", "a", 1))
        rows.append((1000 + 10 * g + 9, " ".join(words[:125] + prose(700 + g, 125, 5000).split()), "en", "a", 1))
    return rows


def linked(prints):
    """Pairs of ids whose fingerprints differ in 3 bits at most."""
    return [(a, b) for a, b in combinations(sorted(prints), 2) if ((prints[a] ^ prints[b]) % 2**64).bit_count() <= 3]


def test_one_of_each_component_stays(spark):
    rows = near_copies() + [(2000, "the same again", "en", "a", 1), (2001, "the  same AGAIN", "en", "b", 1)]
    prints = {r[0]: fingerprint(r[1]) for r in rows}
    groups = roots(prints, linked(prints))
    table = docs(spark, rows, clashing=True)
    kept = simhash.deduplicate(table)
    assert kept.columns == table.columns
    kept = {r.doc_id for r in kept.collect()}
    assert kept == set(groups.values())
    assert 2001 not in kept and len(kept) < len(rows) - 10


def test_links_through_rows_without_an_id(spark):
    """A chain of three fingerprints whose middle one only null ids carry, and one of null ids only."""
    rows = [(1, 0), (None, 0b111), (2, 0b111111), (None, 0xFF << 40), (None, (0xFF << 40) + 1), (9, -1), (9, -2), (9, 1 << 60)]
    found = simhash.grouped(spark.createDataFrame(rows, "doc_id long, fp long")).collect()
    assert sorted((str(r.doc_id), r.fp, r.component_id) for r in found) == sorted(
        (str(i), p, 1 if p in (0, 0b111, 0b111111) else None if i is None else 1 if p == 1 << 60 else 9) for i, p in rows)


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert simhash.near_groups(none).collect() == []
    assert simhash.deduplicate(none).collect() == []


def test_null_ids_stay(spark):
    rows = [(None, "a b c d e f", None, None, None), (None, "a b c d e f", None, None, None), (3, "a b c d e f", None, None, None)]
    assert simhash.deduplicate(docs(spark, rows)).count() == 3
    assert {r.component_id for r in simhash.near_groups(docs(spark, rows)).collect()} == {3}
