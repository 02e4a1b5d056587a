"""Words of a batch of texts as places in its bytes, and hashes of words and shingles, in numpy.

Everything works on whole batches: a byte table says which bytes belong to words, sums of powers
give every word's hash, and sums of words' hashes every shingle's. Memory follows the batch's
bytes; hashing goes by stretches of words, so one very long text needs no more than its bytes a few
times over.

Defined results: a null text counts as empty and has no words; hashes depend on the words only,
not on the batch they come in.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_STRETCH = 1 << 18
_BASE, _MIX, _NEXT = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xFF51AFD7ED558CCD, 0xC2B2AE3D27D4EB4F))
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(29))


_BYTE = _mixed((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _NEXT)
_powers: dict[np.uint64, np.ndarray] = {}


def _power(base: np.uint64, n: int) -> np.ndarray:
    """The first ``n`` powers of an odd number modulo 2 ** 64."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        steps = np.full(max(n, _STRETCH), base, np.uint64)
        steps[0] = 1
        known = np.cumprod(steps)
        if n <= 4 * _STRETCH:  # a longer list serves one very long word
            _powers[base] = known
    return known[:n]


def gathered(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of each range, one range after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


@dataclass
class Words:
    """``data``: lower-cased bytes; words lie at ``starts``..``ends``; text i has the words
    ``edges[i]``..``edges[i + 1]``."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    edges: np.ndarray
    _hashes: np.ndarray | None = None

    @property
    def hashes(self) -> np.ndarray:
        if self._hashes is None:
            self._hashes = _word_hashes(self.data, self.starts, self.ends)
        return self._hashes

    def strings(self, which: np.ndarray) -> pa.StringArray:
        """Some of the words, as text."""
        length = self.ends[which] - self.starts[which]
        body = self.data[gathered(self.starts[which], length)]
        offsets = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
        return pa.StringArray.from_buffers(len(which), pa.py_buffer(offsets), pa.py_buffer(body))

    def lists(self, begin: np.ndarray, length: np.ndarray) -> pa.ListArray:
        """Runs of so many words from these on, as lists of text."""
        offsets = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), self.strings(gathered(begin, length)))


def bytes_and_offsets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts' bytes, A to Z lower-cased, and where each text begins (one entry more than texts)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    _, offsets, body = texts.buffers()
    at = np.frombuffer(offsets, np.int64, len(texts) + 1, 8 * texts.offset) if len(texts) else np.zeros(1, np.int64)
    raw = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    return _LOWER[raw[at[0]:at[-1]]], at - at[0]


def runs(member: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of marked bytes, none of which crosses from one text into another."""
    n = len(member)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    cut[0] = cut[n] = True
    first, last = member.copy(), member.copy()
    first[1:] &= ~member[:-1] | cut[1:n]
    last[:-1] &= ~member[1:] | cut[1:n]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def words_of(texts: pa.Array, member: np.ndarray) -> Words:
    """The runs of the bytes that ``member`` (a table of 256) marks."""
    data, offsets = bytes_and_offsets(texts)
    starts, ends = runs(member[data], offsets)
    return Words(data, starts, ends, np.searchsorted(starts, offsets))


def _word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    out = np.zeros(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        base = starts[at]
        to = max(at + 1, int(np.searchsorted(ends, base + _STRETCH, "right")))
        stretch = data[base:ends[to - 1]]
        sums = np.zeros(len(stretch) + 1, np.uint64)
        np.cumsum(_BYTE[stretch] * _power(_BASE, len(stretch)), out=sums[1:])
        begin = starts[at:to] - base
        out[at:to] = (sums[ends[at:to] - base] - sums[begin]) * _power(_INVERSE, int(begin[-1]) + 1)[begin]
        at = to
    return _mixed(out)


def shingles_of(found: Words, size: int) -> np.ndarray:
    """The hash of the ``size`` words from each word on; the last ``size - 1`` have none of their own."""
    words = found.hashes
    n = len(words) - size + 1
    out = np.full(len(words), size, np.uint64)
    if n > 0:
        factor = np.uint64(1)
        with np.errstate(over="ignore"):
            for i in range(size):
                out[:n] += words[i:i + n] * factor
                factor = factor * _NEXT
    return _mixed(out)
