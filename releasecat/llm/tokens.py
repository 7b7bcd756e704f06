"""Token ids of whole batches of text, equal to the tokenizer's own, with sentence ends.

Most text is a sequence of words seen before.  Words are found and hashed as arrays, and only words that a worker has
not met yet go to the tokenizer.  Texts with characters beyond Latin-1 go to it whole.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import regex
from tokenizers import Tokenizer

from .text import prefix_hashes, span_hashes

_LETTER, _NUMBER, _SPACE, _SYMBOL = 0, 1, 2, 3
_SLOT_BITS = 21
# Words a worker keeps; it starts anew beyond them, so that its memory stays bounded.
MOST_WORDS = 1 << 20
# White space as the tokenizer knows it: U+001C to U+001F are symbols.
_SENTENCE = regex.compile(r"(?<=[.!?])\p{White_Space}+|\p{White_Space}*\n\p{White_Space}*")


def _class(c: str) -> int:
    for kind, pattern in ((_LETTER, r"\p{L}"), (_NUMBER, r"\p{N}"), (_SPACE, r"\p{White_Space}")):
        if regex.match(pattern, c):
            return kind
    return _SYMBOL


_CLASS = np.array([_class(chr(c)) for c in range(256)], np.uint8)
_LOWER = np.array([ord(chr(c).lower()) for c in range(256)], np.uint8)
_STOP = np.isin(np.arange(256), [ord(c) for c in ".!?"])


class Tokens(NamedTuple):
    """Ids of some texts one after another, the ids of each text, and where sentences end among all ids."""

    ids: np.ndarray
    counts: np.ndarray
    ends: np.ndarray


class WordTokenizer:
    """The vocabulary file's ids for texts, each followed by an end id."""

    def __init__(self, path: str, end_id: int | None):
        self.tokenizer = Tokenizer.from_file(path)
        self.end_id = end_id
        vocabulary = self.tokenizer.get_vocab()
        self.is_end = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, number in vocabulary.items():
            self.is_end[number] = token.endswith("</w>")
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(1 << _SLOT_BITS, np.uint64)
        self.rows = np.zeros(1 << _SLOT_BITS, np.int32)
        self.overflow: dict[int, int] = {}
        self.flat = np.zeros(1 << 16, np.uint32)
        self.place = np.zeros(1 << 16, np.int64)
        self.size = np.zeros(1 << 16, np.int32)
        self.used = self.words = 0
        # Row 0 stands for the end of a text.
        self._add([[]] if self.end_id is None else [[self.end_id]])

    def _add(self, lists: list) -> None:
        count, total = len(lists), sum(map(len, lists))
        while self.words + count > len(self.size):
            self.place, self.size = np.resize(self.place, 2 * len(self.place)), np.resize(self.size, 2 * len(self.size))
        while self.used + total > len(self.flat):
            self.flat = np.resize(self.flat, 2 * len(self.flat))
        sizes = np.fromiter(map(len, lists), np.int32, count)
        self.size[self.words : self.words + count] = sizes
        self.place[self.words : self.words + count] = self.used + np.cumsum(sizes) - sizes
        self.flat[self.used : self.used + total] = np.concatenate([np.asarray(x, np.uint32) for x in lists])
        self.used += total
        self.words += count

    def _encode(self, words: list[bytes]) -> list:
        ids = np.array(self.tokenizer.encode(b" ".join(words).decode("latin-1"), add_special_tokens=False).ids, np.uint32)
        cuts = np.flatnonzero(self.is_end[ids]) + 1
        if len(cuts) == len(words) and (not len(cuts) or cuts[-1] == len(ids)):
            return np.split(ids, cuts[:-1])
        return [self.tokenizer.encode(w.decode("latin-1"), add_special_tokens=False).ids for w in words]

    def _lookup(self, hashes: np.ndarray, start: np.ndarray, end: np.ndarray, lowered: bytes) -> np.ndarray:
        slot = (hashes >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)
        rows = self.rows[slot]
        missed = np.flatnonzero(self.keys[slot] != hashes)
        if len(missed):
            values, first, inverse = np.unique(hashes[missed], return_index=True, return_inverse=True)
            found = np.fromiter((self.overflow.get(v, -1) for v in values.tolist()), np.int64, len(values))
            new = np.flatnonzero(found < 0)
            if len(new):
                at = missed[first[new]]
                before = self.words
                self._add(self._encode([lowered[a:b] for a, b in zip(start[at].tolist(), end[at].tolist())]))
                found[new] = np.arange(before, self.words)
                free = self.keys[slot[at]] == 0
                # Of new words in one free slot the last one written has it; the others overflow.
                self.keys[slot[at[free]]] = hashes[at[free]]
                self.rows[slot[at[free]]] = found[new[free]]
                kept = self.keys[slot[at]] == hashes[at]
                for i in new[~kept].tolist():
                    self.overflow[int(values[i])] = int(found[i])
            rows[missed] = found[inverse]
        return rows

    def encode(self, texts: list[str | None]) -> Tokens:
        """Ids of each text, which for a null is the end id alone."""
        if self.words > MOST_WORDS:
            self.clear()
        parts: list[Tokens] = []
        plain: list[bytes] = []
        for text in texts:
            try:
                data = (text or "").encode("latin-1")
                if b"<|" in data:
                    data = None  # may hold the name of a special token
            except UnicodeEncodeError:
                data = None
            if data is not None:
                plain.append(data)
                continue
            if plain:
                parts.append(self._encode_plain(plain))
                plain = []
            parts.append(self._encode_other(text))
        if plain:
            parts.append(self._encode_plain(plain))
        if not parts:
            return Tokens(np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64))
        before = np.cumsum([0] + [len(p.ids) for p in parts])
        return Tokens(
            np.concatenate([p.ids for p in parts]),
            np.concatenate([p.counts for p in parts]),
            np.concatenate([p.ends + b for p, b in zip(parts, before)]),
        )

    def _encode_other(self, text: str) -> Tokens:
        # Cutting at white space changes no id, as the tokenizer drops it.
        lists = [e.ids for e in self.tokenizer.encode_batch(_SENTENCE.split(text), add_special_tokens=False)]
        if self.end_id is not None:
            lists.append([self.end_id])
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        return Tokens(np.concatenate([np.asarray(x, np.uint32) for x in lists]), sizes.sum()[None], np.cumsum(sizes)[:-1])

    def _encode_plain(self, texts: list[bytes]) -> Tokens:
        data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        kind = _CLASS[data]
        lowered = _LOWER[data]
        starts = kind != _SPACE
        starts[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == _NUMBER)
        self._contractions(lowered, kind, starts)
        start = np.flatnonzero(starts)
        inside = kind != _SPACE
        last = inside.copy()
        last[:-1] &= ~inside[1:] | starts[1:]
        end = np.flatnonzero(last) + 1
        hashes = span_hashes(prefix_hashes(lowered), start, end)
        hashes[hashes == 0] = 1
        rows = self._lookup(hashes, start, end, lowered.tobytes())
        follows = data[end]
        sentence = (kind[end] == _SPACE) & ((follows == 10) | _STOP[data[end - 1]])

        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        closing = np.cumsum(lengths + 1)
        word_ends = np.searchsorted(start, closing)
        rows = np.insert(rows, word_ends, 0)
        sentence = np.insert(sentence, word_ends, False)
        sizes = self.size[rows].astype(np.int64)
        after = np.cumsum(sizes)
        ids = self.flat[np.repeat(self.place[rows] - after + sizes, sizes) + np.arange(after[-1])]
        text_ends = after[word_ends + np.arange(len(texts))]
        return Tokens(ids, np.diff(text_ends, prepend=0), after[sentence])

    @staticmethod
    def _contractions(lowered: np.ndarray, kind: np.ndarray, starts: np.ndarray) -> None:
        # An apostrophe that begins a run of symbols takes s, t, m, d, re, ve or ll with it.
        at = np.flatnonzero((lowered[:-1] == 39) & starts[:-1])
        if not len(at):
            return
        padded = np.concatenate([lowered, np.zeros(3, np.uint8)])
        kinds = np.concatenate([kind, np.full(3, _SPACE, np.uint8)])
        one, two = padded[at + 1], padded[at + 2]
        single = np.isin(one, [ord(c) for c in "stmd"])
        double = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        for chosen, length in ((at[single], 2), (at[double], 3)):
            starts[chosen + 1] = False
            following = chosen + length
            letters = following[kinds[following] == _LETTER]
            starts[letters] = True


_loaded: dict[tuple[str, int | None], WordTokenizer] = {}


def tokenizer(path: str, end_id: int | None) -> WordTokenizer:
    """The worker's tokenizer for a vocabulary file, loaded once."""
    if (path, end_id) not in _loaded:
        _loaded[path, end_id] = WordTokenizer(path, end_id)
    return _loaded[path, end_id]
