"""Token ids of whole texts with a public tokenizer file, a batch of documents at a time.

The merges are the slow part and most words come again, so each Python worker remembers the ids of
the words it has met, up to a fixed number, and asks the tokenizer for the others. A text is cut
where the tokenizer's own splitting pattern always cuts: at white space, and between letters and
the punctuation after them. So the ids are those of the whole text. Arrow cuts the batch and finds
its distinct pieces; ids are put together by numpy. Texts that hold ``<|``, which may begin a special
token, or unusual white space go to the tokenizer as they are.

Defined results: an empty text has no ids but the end; a null one must be filled in before; a text
has the same ids in any batch, whatever the worker has met before.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from riskloom.llm.bytes_of import gathered

MOST_WORDS = 500_000

# Punctuation that joins no letter before it; the apostrophe may begin a contraction.
_ENDS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'")
_ODD = r"[\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_SEPARATORS = r"[\x1c-\x1f]"
_CHUNK = re.compile(r" ?[^ \t-\r]+|[ \t-\r]+(?![^ \t-\r])|[ \t-\r]+")


def _byte_letters() -> dict[int, str]:
    """The letter by which byte-level vocabularies write a byte: itself if printable, else the
    next letter from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def _ends(texts: pa.Array, lengths: np.ndarray) -> pa.Array:
    """The last bytes of each text, so many as given."""
    _, offsets, body = texts.buffers()
    stops = np.frombuffer(offsets, np.int32, len(texts) + 1, 4 * texts.offset)[1:].astype(np.int64)
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    at = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.StringArray.from_buffers(len(texts), pa.py_buffer(at), pa.py_buffer(data[gathered(stops - lengths, lengths)]))


class Encoder:
    """``Tokenizer.encode(text, add_special_tokens=False).ids`` for many texts."""

    def __init__(self, path: str, most_words: int = MOST_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            splitting = json.load(file)["pre_tokenizer"]
        # One kind lets a space go with the word after it; the other drops white space and case.
        self.keeps_space = splitting["type"] == "ByteLevel"
        self.model = self.tokenizer.model
        self.most_words = most_words
        self.letters = _byte_letters()
        self.space = self.letters[32]
        self.slots: dict[str, int] = {}
        self.starts, self.lengths = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)
        self.kept = 0, 0

    def _direct(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _spelled(self, piece: str) -> str | None:
        """A run of letters as the vocabulary writes it; None where that might not be one piece."""
        bare = piece[1:] if piece[:1] == " " else piece
        if not bare.isalpha():
            return None
        if self.keeps_space:
            if bare.isascii():
                return piece if bare is piece else self.space + bare
            return piece.encode().decode("latin-1").translate(self.letters)
        if not piece.isascii():
            piece = unicodedata.normalize("NFC", piece)
            if "Σ" in piece:
                return None
        piece = piece.lower()
        if not piece.isalpha():
            return None
        return piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.letters)

    def _learn(self, pieces: list[str]) -> list[list[int]]:
        """Ids of new pieces; words straight from the model, anything else from the tokenizer."""
        tokenize = self.model.tokenize
        spelled = [self._spelled(p) for p in pieces]
        got = [None if w is None else [t.id for t in tokenize(w)] for w in spelled]
        ask = [i for i, ids in enumerate(got) if ids is None]
        for i, ids in zip(ask, self._direct([pieces[i] for i in ask]) if ask else ()):
            got[i] = ids
        return got

    def _slots_of(self, chunks: list[str]) -> np.ndarray:
        """A place in ``lengths`` and ``starts`` for each of these chunks."""
        known = self.slots
        slots = np.fromiter(map(known.get, chunks, repeat(-1)), np.int64, len(chunks))
        missing = np.flatnonzero(slots < 0)
        if missing.size:
            names = [chunks[i] for i in missing.tolist()]
            new = {name: len(self.starts) + i for i, name in enumerate(dict.fromkeys(names))}
            got = self._learn(list(new))
            more = np.fromiter(map(len, got), np.int64, len(got))
            self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(more) - more])
            self.lengths = np.concatenate([self.lengths, more])
            self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(got), np.uint32, int(more.sum()))])
            slots[missing] = np.fromiter(map(new.__getitem__, names), np.int64, len(names))
            if len(known) < self.most_words:
                known.update(new)
                self.kept = len(self.starts), len(self.ids)
        return slots

    def _forget(self) -> None:
        """Drops the ids of chunks met in this call only."""
        chunks, ids = self.kept
        self.starts, self.lengths, self.ids = self.starts[:chunks], self.lengths[:chunks], self.ids[:ids]

    def _gathered(self, slots: np.ndarray, per: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts with so many chunks each, and where each text begins."""
        size = self.lengths[slots]
        ends = np.cumsum(size)
        body = self.ids[gathered(self.starts[slots], size)]
        return body, np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(per)])]

    def _cut(self, chunks: pa.Array, line: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The slots of the pieces of distinct chunks, and where each chunk's begin and how many it
        has. A word and the marks after it are two pieces; ``line`` says which chunks come after a
        line's end, which is a piece of its own before them."""
        core = pc.utf8_rtrim(chunks, _ENDS)
        word = pc.match_substring_regex(core, r"^ ?\p{L}+$").to_numpy(False)
        marks = pc.binary_length(chunks).to_numpy() - pc.binary_length(core).to_numpy()
        two = word & (marks > 0)
        first = pc.if_else(pa.array(word), core, chunks).dictionary_encode()
        after = _ends(chunks, np.where(two, marks, 0)).filter(pa.array(two)).dictionary_encode()
        count = 1 + line.astype(np.int64) + two
        begin = np.cumsum(count) - count
        slots = np.empty(int(count.sum()), np.int64)
        slots[begin[line]] = self._slots_of(["\n"])[0] if line.any() else 0
        slots[begin + line] = self._slots_of(first.dictionary.to_pylist())[first.indices.to_numpy()]
        slots[(begin + count - 1)[two]] = self._slots_of(after.dictionary.to_pylist())[after.indices.to_numpy()]
        return slots, begin, count

    def _by_words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Texts cut by Arrow; each distinct chunk is looked up once."""
        if self.keeps_space:
            cut = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        else:
            cut = pc.ascii_split_whitespace(texts)
        edges = cut.offsets.to_numpy().astype(np.int64)
        edges = edges - edges[0]
        coded = cut.flatten().dictionary_encode()
        chunks, place = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        line = np.zeros(len(chunks), bool)
        if self.keeps_space:
            # A space goes with the chunk after it, but a text's first and those after a line's end have none.
            line = pc.starts_with(chunks, "\n").to_numpy(False)
            spaced = pc.binary_join_element_wise(pc.if_else(pa.array(line), "", " "), pc.utf8_ltrim(chunks, "\n"), "")
            first, which = np.unique(place[edges[:-1]], return_inverse=True)
            place[edges[:-1]] = len(chunks) + which
            chunks = pa.concat_arrays([spaced, chunks.take(pa.array(first))])
            line = np.concatenate([line, np.zeros(len(first), bool)])
        slots, begin, count = self._cut(chunks, line)
        per = count[place]
        upto = np.concatenate([[0], np.cumsum(per)])[edges]
        return self._gathered(slots[gathered(begin[place], per)], np.diff(upto))

    def _by_pattern(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Texts with runs of white space, cut as the tokenizer's own pattern does."""
        chunks = [_CHUNK.findall(t) for t in texts]
        slots = self._slots_of(list(chain.from_iterable(chunks)))
        return self._gathered(slots, np.fromiter(map(len, chunks), np.int64, len(chunks)))

    def encode(self, texts: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All ids of all texts, and where each text's ids begin (one entry more than texts).

        ``end`` is appended to each text's ids.
        """
        odd = pc.or_(pc.match_substring(texts, "<|"), pc.match_substring_regex(texts, _ODD if self.keeps_space else _SEPARATORS))
        runs = pc.match_substring_regex(texts, r"[ \n][ \n]|[\t\v\f\r]") if self.keeps_space else pa.array([False] * len(texts))
        kind = np.where(odd.to_numpy(False), 2, np.where(runs.to_numpy(False), 1, 0))
        tail = np.array([] if end is None else [end], np.uint32)
        if not kind.any():
            body, edges = self._by_words(texts)
            self._forget()
            if end is None:
                return body, edges
            return np.insert(body, edges[1:], end), edges + np.arange(len(edges))
        parts: list[np.ndarray] = [tail] * len(texts)
        for number in np.unique(kind).tolist():
            own = np.flatnonzero(kind == number)
            some = texts.take(pa.array(own))
            if number == 2:
                for i, ids in zip(own.tolist(), self._direct(some.to_pylist())):
                    parts[i] = np.array([*ids, *tail], np.uint32)
                continue
            body, edges = self._by_words(some) if number == 0 else self._by_pattern(some.to_pylist())
            for i, a, b in zip(own.tolist(), edges[:-1].tolist(), edges[1:].tolist()):
                parts[i] = np.concatenate([body[a:b], tail])
        self._forget()
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(x) for x in parts])])


@lru_cache(maxsize=1)
def encoder(path: str, most_words: int = MOST_WORDS) -> Encoder:
    """The worker's encoder for a vocabulary file, the last one asked for; workers live longer than
    tasks."""
    return Encoder(path, most_words)


def slices(texts: pa.Array, size: int = 3_000_000) -> Iterator[slice]:
    """Consecutive slices of about so many bytes, so that memory does not follow the batch."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(False)) if len(texts) else np.zeros(0)
    start = 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + size)))
        yield slice(start, stop)
        start = stop
