"""Simple-8b: as many whole numbers per 64-bit word as their widths allow, in numpy.

A word's top four bits select how many numbers it holds and of how many bits each. Selector 15 is
an escape: its low bits are a place in the block's list of numbers too wide for any other. A block
is encoded by itself and holds ``BLOCK`` numbers (the last may hold fewer), so decoding can start
at any block; all words of a call are decoded at once, selector by selector.

Defined results: numbers are unsigned and of up to 64 bits; no numbers make no words and no blocks;
a number too wide for any selector, or one of too few left at a block's end, is escaped.
"""

from __future__ import annotations

import numpy as np

from riskloom.llm.bytes_of import gathered

BLOCK = 16_384
ESCAPE = 15

# Numbers per word and bits of each, by selector; a run of zeros takes no bits.
COUNTS = (240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2)
BITS = (0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30)
_LIMITS = np.array(sorted({1 << b for b in BITS}), np.uint64)  # a width is a number of limits reached
_ORDER = [int(np.searchsorted(_LIMITS, (1 << b) - 1, "right")) for b in BITS]
_STEPS = np.array([*COUNTS, 1], np.int64)


def _selectors(values: np.ndarray) -> np.ndarray:
    """For each place, the selector of the word that would begin there: the one holding most."""
    n = len(values)
    chosen = np.full(n, ESCAPE, np.int8)
    width = np.searchsorted(_LIMITS, values, "right").astype(np.uint8)
    for selector in range(len(COUNTS) - 1, -1, -1):
        count = COUNTS[selector]
        fits = np.flatnonzero(width <= _ORDER[selector])
        if len(fits) < count:
            continue
        # In a run of numbers that fit, words begin where enough of the run is left.
        breaks = np.flatnonzero(np.diff(fits) != 1) + 1
        begin = np.concatenate([[0], breaks])
        room = np.concatenate([breaks, [len(fits)]]) - begin - count + 1
        own = room > 0
        if own.any():
            chosen[gathered(fits[begin[own]], room[own])] = selector
    # Near the end fewer numbers are left than any word holds: they go one per word.
    return chosen


def _words_of(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of one block begin, and their selectors."""
    chosen = _selectors(values)
    # From each place the place of the next word; with each round twice as many words are known.
    n = len(values)
    jump = np.append(np.arange(n) + _STEPS[chosen], n)
    first = np.zeros(1, np.int64)
    while (new := jump[first])[-1] < n:
        first, jump = np.concatenate([first, new]), jump[jump]
    first = np.concatenate([first, new[new < n]])
    return first, chosen[first]


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, escaped numbers, and per block where its numbers, words and escapes begin.

    Words are found block by block and filled for all blocks at once, selector by selector.
    """
    values = values.astype(np.uint64)
    blocks = range(0, len(values), BLOCK)
    found = [_words_of(values[at:at + BLOCK]) for at in blocks]
    none = np.zeros(0, np.int64)
    first = np.concatenate([none, *[f + at for (f, _), at in zip(found, blocks)]])
    selector = np.concatenate([none.astype(np.int8), *[s for _, s in found]])
    words = selector.astype(np.uint64) << np.uint64(60)
    escaped = np.flatnonzero(selector == ESCAPE)
    many = np.array([len(f) for f, _ in found], np.int64)
    extras = np.array([np.count_nonzero(s == ESCAPE) for _, s in found], np.int64)
    words[escaped] |= (np.arange(len(escaped)) - np.repeat(np.cumsum(extras) - extras, extras)).astype(np.uint64)
    for s in np.unique(selector).tolist():
        if s == ESCAPE or BITS[s] == 0:
            continue
        own = np.flatnonzero(selector == s)
        at, filled = first[own], words[own]
        for i in range(COUNTS[s]):
            filled |= values[at + i] << np.uint64(BITS[s] * i)
        words[own] = filled
    sums = [np.concatenate([[0], np.cumsum(x)]) for x in (many, extras)]
    table = np.stack([np.array([*blocks, len(values)], np.int64), *sums], axis=1)
    return words, values[first[escaped]], table


def decode(words: np.ndarray, extras: np.ndarray, table: np.ndarray, first: int = 0, last: int | None = None) -> np.ndarray:
    """The numbers of blocks first..last-1, of all blocks by default."""
    last = len(table) - 1 if last is None else last
    words = words[table[first, 1]:table[last, 1]]
    block_of = np.repeat(np.arange(first, last), np.diff(table[first:last + 1, 1]))
    selector = (words >> np.uint64(60)).astype(np.int64)
    counts = np.array([*COUNTS, 1])[selector]
    at = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), np.uint64)
    for s in np.unique(selector).tolist():
        own = np.flatnonzero(selector == s)
        if s == ESCAPE:
            place = (words[own] & np.uint64((1 << 60) - 1)).astype(np.int64)
            out[at[own]] = extras[table[block_of[own], 2] + place]
        elif BITS[s]:
            mask = np.uint64((1 << BITS[s]) - 1)
            for i in range(COUNTS[s]):
                out[at[own] + i] = (words[own] >> np.uint64(BITS[s] * i)) & mask
    return out
