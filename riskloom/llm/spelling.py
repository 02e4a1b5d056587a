"""Spelling variants: words one letter apart, by bit-sliced indexes of letters at positions.

Words are counted over whole texts first. Two words of at least seven letters that differ by one
inserted, deleted or replaced letter agree outside one half of the longer one, so words meet in
blocks: the longer word's length M, a range of positions left out, and what stands outside it
(the shorter word has one letter less in the range). A pair belongs to the range that its first
difference falls in, and to no other block. A block of more than ``MOST`` words is cut again: its
range is halved and each half's letters join the key, down to a range of one position, in which at
most an alphabet of words is left. So no block grows with the vocabulary.

Within a block there is a bit set over its words per position and letter: those that have the
letter there. A query word goes through the range position by position, for all words of the block
at once, 64 a machine word: the zero-error set keeps the words with the same letter; the words that
leave it begin a one-error set, either in step (a replaced letter, for words of the same length) or
one position behind (an inserted letter, for words one shorter), which keep the words that have the
query's letter at the same or at the position before. What is left at the range's end is near.

Defined results: a null or empty text has no words; a null ``doc_id`` is written as the empty text
in the hash; repeated rows count again; ties of a form go to the smallest word in code-point order;
forms lead to words at least ``FACTOR`` times as frequent, so following them ends; an empty table
gives an empty one.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskloom.llm.bytes_of import Words, bytes_and_offsets, runs
from riskloom.llm.common import lean, partitions
from riskloom.llm.tokens import slices
from riskloom.session import pin, stage

LETTERS_AT_LEAST = 7
TIMES_AT_LEAST = 2
FACTOR = 10
DROP_EVERY = 31
MOST = 16_384
CHUNK = 4096  # words that are indexed together, if their blocks are small
QUERIES = 256
SLICE = 2_000_000

# Letters: a to z, and the code points C0 to FF, which UTF-8 writes as C3 and one more byte.
_LEAD = 0xC3
_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
_CODE = np.zeros(256, np.uint8)  # of a letter in Latin-1; 0 is no letter
_CODE[97:123] = np.arange(1, 27)
_CODE[0xC0:] = np.arange(27, 91)
_CODES = 91


def _zero_byte_table() -> np.ndarray:
    """What a CRC-32 register's low byte becomes when one more byte, a zero, goes in."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> np.uint32(1)) ^ np.where(table & np.uint32(1), np.uint32(0xEDB88320), np.uint32(0))
    return table


_ZERO = _zero_byte_table()
_FAR = 64


def _crc_after(prefix: np.ndarray, of: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The CRC-32 of each run's document prefix moved on by the run's length in bytes."""
    out = np.zeros(len(of), np.uint32)
    order = np.argsort(lengths, kind="stable")
    length, now, at = 0, prefix, 0
    top = int(lengths.max()) if len(lengths) else 0
    ends = np.searchsorted(lengths[order], np.arange(top + 1), "right")
    while length < top:
        now = _ZERO[now & np.uint32(255)] ^ (now >> np.uint32(8))
        length += 1
        if ends[length] > at:
            own = order[at:ends[length]]
            out[own] = now[of[own]]
            at = ends[length]
    return out


def _counted(texts: pa.Array, ids: list[int | None], least: int, drop_every: int) -> tuple[pa.Array, np.ndarray, Counter]:
    """The distinct runs of a batch and how often each stays as it is; and the changed ones."""
    data, offsets = bytes_and_offsets(texts)
    lead = data == _LEAD
    member = _LETTER[data] | lead
    member[1:] |= lead[:-1]
    starts, ends = runs(member, offsets)
    before = np.concatenate([[0], np.cumsum(lead, dtype=np.int32)])
    points = ends - starts - (before[ends] - before[starts])
    long = points >= least
    found = Words(data, starts[long], ends[long], offsets)
    points = points[long]
    coded = found.strings(np.arange(len(points))).dictionary_encode()
    slot = coded.indices.to_numpy()
    names = coded.dictionary
    spelled = names.cast(pa.binary()).to_pylist()
    crc = np.fromiter(map(zlib.crc32, spelled), np.uint32, len(spelled))[slot]
    length = found.ends - found.starts
    prefix = ["" if i is None else str(i) for i in ids]
    of = np.searchsorted(offsets, found.starts, "right") - 1
    start = np.fromiter((zlib.crc32(f"{i}:".encode()) for i in prefix), np.uint32, len(prefix))
    h = np.zeros(len(slot), np.uint32)
    near = length <= _FAR
    h[near] = _crc_after(start, of[near], length[near]) ^ crc[near]
    for i in np.flatnonzero(~near).tolist():
        h[i] = zlib.crc32(spelled[slot[i]], int(start[of[i]]))
    hit = h % np.uint32(drop_every) == 0
    changed: Counter = Counter()
    words = {}
    for s, k, n in zip(slot[hit].tolist(), (h[hit] % points[hit].astype(np.uint32)).tolist(), points[hit].tolist()):
        if n > least:
            if s not in words:
                words[s] = spelled[s].decode()
            changed[words[s][:k] + words[s][k + 1:]] += 1
    return names, np.bincount(slot[~hit], minlength=len(names)), changed


def vocabulary(docs: DataFrame, letters: int = LETTERS_AT_LEAST, times: int = TIMES_AT_LEAST, drop_every: int = DROP_EVERY) -> DataFrame:
    """``word, n``: the words of enough letters that occur often enough over all texts."""

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch.column(1), SLICE):
                names, n, changed = _counted(batch.column(1)[piece], batch.column(0)[piece].to_pylist(), letters, drop_every)
                some = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.concat_arrays([names.take(pa.array(some)), pa.array(list(changed), pa.string())]),
                     pa.array(np.concatenate([n[some], np.fromiter(changed.values(), np.int64, len(changed))]))],
                    names=["word", "n"])

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(lean(convert), "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= times)


def _keyed(ranged: DataFrame) -> DataFrame:
    """Adds the block key to rows ``word, n, m, lo, hi``: what stands outside the range."""
    after = F.col("hi") - (F.col("m") - F.length("word")) + 1
    rest = F.concat(F.substr("word", F.lit(1), F.col("lo")), F.lit("\t"), F.substr("word", after))
    return ranged.withColumn("key", rest)


def _halves(words: DataFrame) -> DataFrame:
    """Each word four times: as the longer or equal one and as the shorter one of a pair, without
    either half."""
    m = F.explode(F.array(F.length("word"), F.length("word") + 1))
    both = F.expr("inline(array(named_struct('lo', 0, 'hi', m div 2), named_struct('lo', m div 2, 'hi', m)))")
    ranged = words.withColumn("m", m).select("*", both)
    return _keyed(ranged.select("word", "n", "m", F.col("lo").cast("int"), F.col("hi").cast("int")))


def _finer(rows: DataFrame) -> DataFrame:
    """The rows of large blocks once for each half of their range."""
    cut = "(lo + hi) div 2"
    both = F.expr(f"inline(array(named_struct('lo', lo, 'hi', {cut}), named_struct('lo', {cut}, 'hi', hi)))")
    halves = rows.select("word", "n", "m", both)
    return _keyed(halves.select("word", "n", "m", F.col("lo").cast("int"), F.col("hi").cast("int")))


BLOCK = ["m", "lo", "hi", "key"]


def blocks(words: DataFrame, most: int = MOST) -> DataFrame:
    """``word, n, m, lo, hi, key``: words by the blocks in which they meet, none above ``most`` words
    unless its range is one position."""
    done, rows = [], _halves(words)
    while True:
        large = pin(rows.groupBy(*BLOCK).agg(F.count("*").alias("size")).filter((F.col("size") > most) & (F.col("hi") - F.col("lo") > 1)))
        if not large.limit(1).collect():
            break
        done.append(rows.join(large, BLOCK, "left_anti"))
        rows = stage(_finer(rows.join(large, BLOCK, "left_semi")))
    for part in done:
        rows = rows.unionByName(part)
    return rows


def _bit_rows(flags: np.ndarray) -> np.ndarray:
    """Rows of truth values as rows of 64-bit words."""
    width = -(-flags.shape[-1] // 64) * 64
    full = np.zeros((*flags.shape[:-1], width), bool)
    full[..., : flags.shape[-1]] = flags
    return np.packbits(full, axis=-1, bitorder="little").view(np.uint64)


def _set_bits(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and places of the set bits."""
    row, word = np.nonzero(bits)
    flags = np.unpackbits(bits[row, word].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    which, bit = np.nonzero(flags)
    return row[which], 64 * word[which] + bit


def near_in(words: list[str], m: int, lo: int, hi: int, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of places in ``words``, query and near word, the query the longer or of equal length,
    that are in one block and first differ within positions lo..hi-1.

    ``block`` numbers the words' blocks, in order. All words have m or m - 1 letters.
    """
    length = np.fromiter(map(len, words), np.int64, len(words))
    letters = np.array([w.encode("latin-1") for w in words], f"S{m}").view(np.uint8).reshape(len(words), m)
    code = _CODE[letters[:, lo:hi]]
    full = np.arange(_CODES)[:, None]
    index = np.stack([_bit_rows(code[:, i] == full) for i in range(hi - lo)])
    equal, shorter = _bit_rows(length == m), _bit_rows(length == m - 1)
    members = _bit_rows(block == np.arange(block[-1] + 1)[:, None])
    queries = np.flatnonzero(length == m)
    rows, places = [], []
    for at in range(0, len(queries), QUERIES):
        own = queries[at:at + QUERIES]
        none = members[block[own]]
        replaced, inserted = np.zeros_like(none), np.zeros_like(none)
        for i in range(hi - lo):
            same = index[i][code[own, i]]
            left = none & ~same
            replaced = (replaced & same) | (left & equal)
            if i:
                inserted &= index[i - 1][code[own, i]]
            inserted |= left & shorter
            none &= same
        row, place = _set_bits(replaced | inserted)
        rows.append(own[row])
        places.append(place)
    empty = [np.zeros(0, np.int64)]
    return np.concatenate(rows or empty), np.concatenate(places or empty)


def near_pairs(words: DataFrame, most: int = MOST) -> DataFrame:
    """``word, near, near_n``: both directions of every near pair of ``word, n``."""

    def found(rows: pa.Table) -> pa.RecordBatch:
        names, n = rows["word"].to_pylist(), rows["n"].to_numpy()
        keys = list(zip(*(rows[c].to_pylist() for c in BLOCK)))
        block = np.cumsum([a != b for a, b in zip(keys, [None, *keys])]) - 1
        first, second = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        ranges = [k[:3] for k in keys]
        edges = [i for i, (a, b) in enumerate(zip(ranges, [None, *ranges])) if a != b] + [len(keys)]
        for a, b in zip(edges, edges[1:]):
            x, y = near_in(names[a:b], *ranges[a], block[a:b] - block[a])
            longer = np.fromiter((len(names[a + i]) for i in x.tolist()), np.int64, len(x))
            other = np.fromiter((len(names[a + i]) for i in y.tolist()), np.int64, len(y))
            back = longer > other  # words of equal length find each other
            first += [a + x, a + y[back]]
            second += [a + y, a + x[back]]
        one, two = np.concatenate(first), np.concatenate(second)
        column = pa.array(names, pa.string())
        return pa.RecordBatch.from_arrays(
            [column.take(pa.array(one)), column.take(pa.array(two)), pa.array(n[two])], names=["word", "near", "near_n"])

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            while held.num_rows >= CHUNK:
                # Up to the last change of block within a chunk, or else the first one after it.
                keys = list(zip(*(held[c].to_pylist() for c in BLOCK)))
                changes = [i for i in range(1, len(keys)) if keys[i] != keys[i - 1]]
                cut = max((i for i in changes if i <= CHUNK), default=next(iter(changes), 0))
                if not cut:
                    break
                yield found(held.slice(0, cut))
                held = held.slice(cut)
        if held is not None and held.num_rows:
            yield found(held)

    placed = blocks(words, most).select(*BLOCK, "word", "n").repartition(partitions(words.sparkSession), *BLOCK).sortWithinPartitions(*BLOCK)
    return placed.mapInArrow(lean(convert), "word string, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` from ``word, form``: the last word that forms lead to.

    Each round doubles the steps taken, so rounds follow the logarithm of the longest chain, which
    has at most one word per power of ``FACTOR`` in the counts.
    """
    now = stage(forms.select("word", F.col("form").alias("root")))
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("far"))
        moved = stage(now.join(on, "root", "left").select("word", "root", "far"))
        if not moved.filter("far is not null").limit(1).collect():
            return now
        now = stage(moved.select("word", F.coalesce("far", "root").alias("root")))


def variants(docs: DataFrame, factor: int = FACTOR) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word."""
    words = stage(vocabulary(docs))
    # The most frequent near word, of equals the smallest; a word has at most an alphabet per letter.
    best = near_pairs(words).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    known = words.join(best, "word", "left")
    leads = -F.col("best.less") >= factor * F.col("n")
    known = stage(known.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(leads, F.col("best.near")).alias("form"), F.when(leads, -F.col("best.less")).alias("form_n")))
    found = roots(known.filter("form is not null"))
    return known.join(found, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
