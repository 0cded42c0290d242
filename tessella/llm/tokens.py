"""Exact, cached encoding of whole texts with the ``tokenizers`` library.

Both vocabularies never let a token span a space that stands before a visible
character: the byte-level one begins a new piece at such a space, the word-level
one drops white space. A text cut there therefore has the ids of its pieces, one
after the other, and a piece that was seen before needs no second encoding.
Pieces are looked up by 64-bit hashes of their bytes, in arrays, and then their
bytes are compared, so that two pieces with one hash never share their ids.
"""

from __future__ import annotations

import os
from itertools import chain

import numpy as np
import pyarrow as pa

from tessella.llm.words import BLOCK, eights, hash_stretches, piece, text_buffers

#: Pieces kept, bytes over which a piece is not kept, and pieces encoded in one call.
CACHE, LONGEST, TOGETHER = 1_000_000, 64, 500

#: First bytes of characters that surely are visible: not of white space outside ASCII (after 0xC2, 0xE1, 0xE2, 0xE3).
_VISIBLE = np.zeros(256, dtype=bool)
_VISIBLE[0x21:0x7F] = _VISIBLE[0xC3:0xE1] = _VISIBLE[0xE4:0xF5] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True


def gathered(data: np.ndarray, begin: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the stretches one after the other, and their lengths."""
    end = np.cumsum(length)
    return data[np.repeat(begin - end + length, length) + np.arange(end[-1] if len(end) else 0)], length


def equal_stretches(a: np.ndarray, begin: np.ndarray, b: np.ndarray, other: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether the bytes of ``a`` from ``begin`` on are those of ``b`` from ``other`` on, eight at a time."""
    equal, eight_a, eight_b = np.ones(len(begin), dtype=bool), eights(a), eights(b)
    left, nth = np.flatnonzero((begin != other) | (a is not b)), 0
    left = left[length[left] > 0]
    while len(left):
        if nth == LONGEST // 8:  # a few long ones
            for i in left.tolist():
                equal[i] = np.array_equal(a[begin[i] : begin[i] + length[i]], b[other[i] : other[i] + length[i]])
            break
        equal[left] = piece(eight_a, begin[left], length[left], nth) == piece(eight_b, other[left], length[left], nth)
        nth += 1
        left = left[equal[left] & (length[left] > 8 * nth)]
    return equal


class ChunkEncoder:
    """Ids of texts under a ``tokenizers`` file, as ``encode(text, add_special_tokens=False)`` gives them.

    A special string inside a text gets its special id, as in the library's plain
    call, unless ``special_as_text`` makes it ordinary text. No special string of
    the vocabulary may hold a space, else a cut could run through it.
    """

    def __init__(self, path: str, special_as_text: bool = False):
        from tokenizers import Tokenizer

        # a task has one core: threads of the library would only wait for each other
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        if any(" " in t.content or t.lstrip or t.rstrip for t in self.tokenizer.get_added_tokens_decoder().values()):
            raise ValueError("a special string of the vocabulary takes in spaces")
        words = self.tokenizer.get_vocab()
        #: In a row of plain words, a token with this mark ends a word (word level) or begins one (byte level).
        self.ends = any(w.endswith("</w>") for w in list(words)[:1000])
        self.mark = np.zeros(max(words.values()) + 1, dtype=bool)
        self.mark[[i for w, i in words.items() if (w.endswith("</w>") if self.ends else w.startswith("Ġ"))]] = True
        self.clear()

    def clear(self) -> None:
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []  # sorted hashes and numbers; sizes grow towards the front
        self.ids = np.zeros(1 << 20, dtype=np.uint32)
        self.first = np.zeros(1 << 18, dtype=np.int64)
        self.count = np.zeros(1 << 18, dtype=np.int32)
        self.pool = np.zeros(1 << 20, dtype=np.uint8)  # bytes of the pieces kept
        self.place = np.zeros(1 << 18, dtype=np.int64)
        self.length = np.zeros(1 << 18, dtype=np.int64)
        self.used = self.known = self.pooled = 0

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of the sorted hashes, -1 for unknown ones."""
        numbers = np.full(len(hashes), -1, dtype=np.int64)
        left = np.arange(len(hashes))
        for keys, values in self.levels:
            at = np.minimum(np.searchsorted(keys, hashes[left]), len(keys) - 1)
            hit = keys[at] == hashes[left]
            numbers[left[hit]] = values[at[hit]]
            left = left[~hit]
        return numbers

    def keep(self, hashes: np.ndarray, numbers: np.ndarray, data: np.ndarray, begins: np.ndarray, length: np.ndarray) -> None:
        text, length = gathered(data, begins, length)
        while self.pooled + len(text) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[self.pooled : self.pooled + len(text)] = text
        self.place[numbers], self.length[numbers] = self.pooled + np.cumsum(length) - length, length
        self.pooled += len(text)
        self.levels.append((hashes, numbers))
        while len(self.levels) > 1 and len(self.levels[-2][0]) < 4 * len(self.levels[-1][0]):
            (a, x), (b, y) = self.levels.pop(), self.levels.pop()
            keys, values = np.concatenate([b, a]), np.concatenate([y, x])
            order = np.argsort(keys, kind="stable")
            self.levels.append((keys[order], values[order]))

    def store(self, numbers: np.ndarray, flat: np.ndarray, count: np.ndarray) -> None:
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used : self.used + len(flat)] = flat
        self.first[numbers] = self.used + np.cumsum(count) - count
        self.count[numbers] = count
        self.used += len(flat)

    def learn(self, data: np.ndarray, begins: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Encode new pieces and return their numbers. Spaces with words of ASCII letters are encoded many in one call."""
        start, self.known = self.known, self.known + len(begins)
        while self.known > len(self.first):
            for name in ("first", "count", "place", "length"):
                setattr(self, name, np.concatenate([getattr(self, name), np.zeros_like(getattr(self, name))]))
        marks = np.concatenate([[0], np.cumsum(~_LETTER[data], dtype=np.int32)])
        plain = (length > 1) & (data[begins] == 0x20) & (marks[begins + length] - marks[begins] == 1)
        words, others = np.flatnonzero(plain), np.flatnonzero(~plain)
        for at in range(0, len(words), 20_000):
            some = words[at : at + 20_000]
            text, size = gathered(data, begins[some], length[some])
            text, edge = text.tobytes().decode(), np.concatenate([np.cumsum(size) - size, [len(text)]])[[*range(0, len(some), TOGETHER), len(some)]].tolist()
            found = self.tokenizer.encode_batch_fast([text[i:j] for i, j in zip(edge[:-1], edge[1:], strict=True)], add_special_tokens=False)
            flat = np.concatenate([np.array(e.ids, dtype=np.uint32) for e in found])
            edge = np.flatnonzero(self.mark[flat])
            count = np.diff(edge, prepend=-1) if self.ends else np.diff(edge, append=len(flat))
            if len(count) != len(some):
                raise ValueError("the vocabulary does not mark the borders of words")
            self.store(start + some, flat, count)
        raw = data.tobytes() if len(others) else b""
        for at in range(0, len(others), 20_000):
            some = others[at : at + 20_000]
            pieces = [raw[i : i + k].decode() for i, k in zip(begins[some].tolist(), length[some].tolist(), strict=True)]
            found = [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
            count = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
            self.store(start + some, np.fromiter(chain.from_iterable(found), dtype=np.uint32, count=int(count.sum())), count)
        return np.arange(start, self.known)

    def numbers(self, data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The number of each piece of ``data``."""
        hashes, length = hash_stretches(data, begins, ends), ends - begins
        unique, sample, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        a, n = begins[sample], length[sample]
        number = self.find(unique)
        old = np.flatnonzero(number >= 0)
        same = self.length[number[old]] == n[old]
        old = old[same][equal_stretches(data, a[old[same]], self.pool, self.place[number[old[same]]], n[old[same]])]
        taken, fresh = number >= 0, np.ones(len(unique), dtype=bool)
        fresh[old] = False
        new = np.flatnonzero(fresh)

        if len(new):
            number[new] = self.learn(data, a[new], n[new])
            kept = new[(n[new] <= LONGEST) & ~taken[new]]  # not those whose hash another piece has
            if len(kept):
                self.keep(unique[kept], number[kept], data, a[kept], n[kept])
        number = number[inverse]
        other = (length != n[inverse]) | ~equal_stretches(data, begins, data, a[inverse], np.minimum(length, n[inverse]))
        if other.any():  # pieces with the hash of a different one
            number[other] = self.learn(data, begins[other], length[other])
        return number

    def encode(self, texts) -> list[np.ndarray]:
        """An array of ids for each text of a list or an Arrow column; null is empty."""
        if self.known > CACHE or self.used > 8 * CACHE:
            self.clear()
        data, offsets = text_buffers(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()))
        if not len(data):
            return [np.zeros(0, dtype=np.uint32) for _ in range(len(offsets) - 1)]
        cut = np.zeros(len(data) + 1, dtype=bool)
        cut[:-2] = (data[:-1] == 0x20) & _VISIBLE[data[1:]]
        cut[offsets] = True
        edges = np.flatnonzero(cut)
        numbers, at = [], 0
        while at < len(edges) - 1:  # blocks of whole pieces
            stop = max(at + 1, int(np.searchsorted(edges, edges[at] + BLOCK, side="right")) - 1)
            low = edges[at]
            numbers.append(self.numbers(data[low : edges[stop]], edges[at:stop] - low, edges[at + 1 : stop + 1] - low))
            at = stop
        at = np.concatenate(numbers)
        count = self.count[at].astype(np.int64)
        total = np.concatenate([[0], np.cumsum(count)])
        flat = self.ids[np.repeat(self.first[at] - total[:-1], count) + np.arange(total[-1])]
        bounds = total[np.searchsorted(edges, offsets)]
        return [flat[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]


_ENCODERS: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    """One encoder for each Python worker and file; its cache is bounded."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path)
    return _ENCODERS[path]
