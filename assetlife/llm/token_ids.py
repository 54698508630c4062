"""Token ids of many texts at once, each distinct stretch encoded once.

Texts are cut where no token of a byte-level BPE vocabulary can lie across: before
ASCII white space that follows something else, and where ASCII letters end before
another ASCII character.  Stretches of up to 16 bytes are kept in a table with
their ids, addressed by a hash and compared as a whole; the tokenizer is asked for
the others and for those it has not seen.  All steps but the asking are array
operations over a few megabytes of text.
"""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
from tokenizers import Tokenizer

#: Slots of a table (half of them used at most), ids it may hold, bytes of one
#: text that are cut at a time.
SLOTS, TABLE_IDS, SPAN_BYTES = 1 << 20, 1 << 22, 1 << 20
_SHORT = 16
_SPACE = np.zeros(256, bool)
_SPACE[list(b"\t\n\x0b\x0c\r ")] = True
_LETTER = np.zeros(256, bool)
_LETTER[list(range(65, 91)) + list(range(97, 123))] = True
_ASCII_OTHER = (np.arange(256) < 128) & ~_LETTER
# Stretches that are one run of letters, which the vocabulary's merges turn into ids directly.
_WORD = re.compile(" ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+")
_BORDER = re.compile(rb"(?<=[A-Za-z])[\t-\r ]")


def _byte_letters() -> dict[int, int]:
    """The character by which byte-level vocabularies write each byte: itself if
    it is visible in Latin-1, else the next one from 256 on."""
    seen = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    return dict(zip([*seen, *(b for b in range(256) if b not in seen)], [*seen, *range(256, 512 - len(seen))]))


_LETTERS = _byte_letters()


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each range, end to end."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


def _wide_space(b: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether white space beyond ASCII ends before ``at``: it joins what follows."""
    last, second, third = b[at - 1], b[np.maximum(at - 2, 0)], b[np.maximum(at - 3, 0)]
    two = (second == 0xC2) & ((last == 0x85) | (last == 0xA0))
    ogham = (third == 0xE1) & (second == 0x9A) & (last == 0x80)
    general = (third == 0xE2) & (second == 0x80) & ((last <= 0x8A) | (last == 0xA8) | (last == 0xA9) | (last == 0xAF))
    others = ((third == 0xE2) & (second == 0x81) & (last == 0x9F)) | ((third == 0xE3) & (second == 0x80) & (last == 0x80))
    return two | ogham | general | others


class _Table:
    """Stretches of up to 16 bytes (as two words) and their ids."""

    def __init__(self):
        self.slot = np.full(SLOTS, -1, np.int32)
        self.words = np.zeros((0, 2), np.uint64)
        self.flat, self.ends = np.zeros(0, np.int32), np.zeros(1, np.int64)

    @staticmethod
    def _home(words: np.ndarray) -> np.ndarray:
        h = words[:, 0] * np.uint64(0x9E3779B97F4A7C15) ^ words[:, 1] * np.uint64(0xC2B2AE3D27D4EB4F)
        h ^= h >> np.uint64(29)
        return ((h * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - (SLOTS.bit_length() - 1))).astype(np.int64)

    def find(self, words: np.ndarray) -> np.ndarray:
        """The entry of each stretch, or -1."""
        out = np.full(len(words), -1, np.int64)
        todo, at = np.arange(len(words)), self._home(words)
        while len(todo):
            entry = self.slot[at]
            same = entry >= 0
            same[same] = (self.words[entry[same]] == words[todo[same]]).all(axis=1)
            out[todo[same]] = entry[same]
            go = (entry >= 0) & ~same
            todo, at = todo[go], (at[go] + 1) % SLOTS
        return out

    def add(self, words: np.ndarray, ids: list[list[int]]) -> None:
        """New distinct stretches with their ids."""
        todo, at = np.arange(len(words)), self._home(words)
        while len(todo):
            free = np.flatnonzero(self.slot[at] < 0)
            _, first = np.unique(at[free], return_index=True)
            won = free[first]
            self.slot[at[won]] = todo[won] + len(self.words)
            lost = np.ones(len(todo), bool)
            lost[won] = False
            todo, at = todo[lost], (at[lost] + 1) % SLOTS
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        self.words = np.concatenate([self.words, words])
        self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(ids), np.int32, int(sizes.sum()))])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])

    def full(self) -> bool:
        return 2 * len(self.words) >= SLOTS or len(self.flat) >= TABLE_IDS


class Encoder:
    """Ids of UTF-8 texts by ``tokenizer`` (byte-level BPE, no normalizer),
    without special tokens of its own."""

    def __init__(self, tokenizer: Tokenizer):
        self.tokenizer = tokenizer
        self.marks = [t.content.encode() for t in tokenizer.get_added_tokens_decoder().values()]
        self.table = _Table()

    def _asked(self, stretches: list[bytes]) -> list[list[int]]:
        """The tokenizer's ids of each stretch."""
        merges = self.tokenizer.model.tokenize
        texts = [s.decode() for s in stretches]
        known = [[t.id for t in merges(s.decode("latin-1").translate(_LETTERS))] if _WORD.fullmatch(t) else None for s, t in zip(stretches, texts)]
        others = iter(self.tokenizer.encode_batch_fast([t for t, k in zip(texts, known) if k is None], add_special_tokens=False))
        return [next(others).ids if k is None else k for k in known]

    def _cut(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all ``texts`` end to end, and how many each has."""
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        data = b"".join(texts) + bytes(2 * _SHORT)
        n = int(sizes.sum())
        if not n:
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        b = np.frombuffer(data, np.uint8)[:n]
        border = np.zeros(n, bool)
        border[1:] = (_SPACE[b[1:]] & ~_SPACE[b[:-1]]) | (_ASCII_OTHER[b[1:]] & _LETTER[b[:-1]])
        wide = np.flatnonzero(border[1:] & (b[:-1] >= 128)) + 1
        border[wide[_wide_space(b, wide)]] = False
        first = np.cumsum(sizes) - sizes
        border[first[first < n]] = True
        starts = np.flatnonzero(border)
        lengths = np.diff(np.append(starts, n))

        # two words of bytes, zero beyond the stretch
        at_byte = np.ndarray((n + _SHORT,), "<u8", data, strides=(1,))
        words = np.stack([at_byte[starts], at_byte[starts + 8]], axis=1)
        keep = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
        words[:, 0] &= keep[np.minimum(lengths, 8)]
        words[:, 1] &= keep[np.clip(lengths - 8, 0, 8)]

        if self.table.full():
            self.table = _Table()
        entry = np.full(len(starts), -1, np.int64)
        kept = lengths <= _SHORT
        kept[np.searchsorted(starts, np.flatnonzero(b == 0), side="right") - 1] = False  # zero bytes pad the words
        short = np.flatnonzero(kept)
        entry[short] = self.table.find(words[short])
        missing = short[entry[short] < 0]
        if len(missing):
            order = missing[np.lexsort((words[missing, 1], words[missing, 0]))]
            new = order[np.append(True, (words[order[1:]] != words[order[:-1]]).any(axis=1))]
            self.table.add(words[new], self._asked([data[s:s + k] for s, k in zip(starts[new].tolist(), lengths[new].tolist())]))
            entry[missing] = self.table.find(words[missing])
        long = np.flatnonzero(~kept)
        ids, ends = self.table.flat, self.table.ends
        if len(long):  # behind the table's, for this call
            known = self._asked([data[s:s + k] for s, k in zip(starts[long].tolist(), lengths[long].tolist())])
            entry[long] = len(ends) - 1 + np.arange(len(long))
            counts = np.fromiter(map(len, known), np.int64, len(known))
            ids = np.concatenate([ids, np.fromiter(chain.from_iterable(known), np.int32, int(counts.sum()))])
            ends = np.concatenate([ends, ends[-1] + np.cumsum(counts)])
        many = ends[entry + 1] - ends[entry]
        done = np.concatenate(([0], np.cumsum(many)))
        last = np.searchsorted(starts, first + sizes)  # stretches before each text's end
        return ids[_ranges(ends[entry], many)], done[last] - done[np.searchsorted(starts, first)]

    def _marked(self, text: bytes) -> bool:
        """Whether a special token of the tokenizer stands in the text."""
        return any(m in text for m in self.marks)

    def _one(self, text: bytes) -> np.ndarray:
        if self._marked(text):
            return np.array(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids, np.int32)
        parts, at = [], 0
        while len(text) - at > SPAN_BYTES and (border := _BORDER.search(text, at + SPAN_BYTES)):
            parts.append(self._cut([text[at:border.start()]])[0])
            at = border.start()
        return np.concatenate([*parts, self._cut([text[at:] if at else text])[0]])

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all ``texts`` end to end, and how many each has."""
        alone = [len(t) > SPAN_BYTES or self._marked(t) for t in texts]
        if not any(alone):
            return self._cut(texts)
        own = [self._one(t) if a else self._cut([t])[0] for t, a in zip(texts, alone)]
        return np.concatenate(own), np.fromiter(map(len, own), np.int64, len(own))
