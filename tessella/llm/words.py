"""Words of whole texts as 64-bit hashes, computed on the bytes of Arrow columns.

A word is a run of bytes outside 0x20 and 0x09-0x0D; these bytes never occur
inside a UTF-8 sequence, so bytes and characters give the same words. A-Z are
lower-cased. A word is hashed eight bytes at a time, all words at once, so that
no loop over words runs in Python: each step is a bijection of the next eight
bytes, so words of up to eight bytes and of one length never share a hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are hashed at a time (some ten bytes of memory each).
BLOCK = 1 << 19

_rng = np.random.default_rng(20250101)
SALT = _rng.integers(1, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
#: Masks of the first 0 to 8 bytes; bytes over which a stretch is hashed by itself.
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)
_LONG = 64
#: Classes of bytes: 0 stands between tokens, and a token ends where the class changes.
SPACED = np.ones(256, dtype=np.uint8)
SPACED[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 0
LETTERS = np.zeros(256, dtype=np.uint8)  # letters, and all that is not ASCII
LETTERS[65:91] = LETTERS[97:123] = LETTERS[128:] = 1
WORDS_AND_MARKS = SPACED * 2  # letters and digits, or runs of other visible bytes
WORDS_AND_MARKS[48:58] = WORDS_AND_MARKS[65:91] = WORDS_AND_MARKS[97:123] = WORDS_AND_MARKS[128:] = 1


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position of ``data`` on (zeros after its end) as a little-endian number."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))


def piece(eight: np.ndarray, begin: np.ndarray, length: np.ndarray, nth: int) -> np.ndarray:
    """The ``nth`` eight bytes of stretches longer than 8 * nth; what lies behind a stretch is zero."""
    return eight[begin + 8 * nth] & _FIRST[np.minimum(length - 8 * nth, 8)]


def hash_stretches(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each stretch of ``data``."""
    import xxhash

    eight, length = eights(data), end - begin
    h = mix(piece(eight, begin, length, 0) + length.astype(np.uint64) * SALT[15])
    nth, rest = 1, np.flatnonzero((length > 8) & (length <= _LONG))
    while len(rest):
        h[rest] = mix(h[rest] * SALT[13] + mix(piece(eight, begin[rest], length[rest], nth) + SALT[12]))
        nth += 1
        rest = rest[length[rest] > 8 * nth]
    for i in np.flatnonzero(length > _LONG).tolist():
        h[i] = xxhash.xxh3_64_intdigest(data[begin[i] : end[i]].tobytes())
    return h


def _hash_block(data: np.ndarray, starts: np.ndarray, classes: np.ndarray, fold: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, first bytes and ends of the tokens of a block; a text begins at each of ``starts``."""
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind = classes[data]
    inside = kind > 0
    new = np.zeros(n + 1, dtype=bool)
    new[starts[starts < n]] = True
    new[0] = new[n] = True
    new[1:-1] |= kind[1:] != kind[:-1]
    begin = np.flatnonzero(inside & new[:-1])
    end = np.flatnonzero(inside & new[1:]) + 1
    return hash_stretches(_FOLD[data] if fold else data, begin, end), begin, end


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (from 0) of a string column; null is empty."""
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def word_hashes(column: pa.Array, positions: bool = False, classes: np.ndarray = SPACED, fold: bool = True):
    """Token hashes of all texts one after the other, and where each text's begin (one more entry at the end).

    ``classes`` says what a token is, ``fold`` whether A-Z are lower-cased. With
    ``positions`` also the first byte and the end of each token, counted from the
    start of the column.
    """
    data, offsets = text_buffers(column)
    hashes, firsts, ends, at = [], [], [], 0
    while at < len(data):
        stop = min(at + BLOCK, len(data))
        while stop < len(data) and SPACED[data[stop]]:  # to the end of a word
            step = np.flatnonzero(SPACED[data[stop : stop + BLOCK]] == 0)
            stop = stop + int(step[0]) if len(step) else min(stop + BLOCK, len(data))
        h, b, e = _hash_block(data[at:stop], offsets[np.searchsorted(offsets, at) : np.searchsorted(offsets, stop)] - at, classes, fold)
        hashes.append(h)
        firsts.append(b + at)
        ends.append(e + at)
        at = stop
    h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    first = np.concatenate(firsts) if firsts else np.zeros(0, np.int64)
    bounds = np.searchsorted(first, offsets)
    if positions:
        return h, bounds, first, np.concatenate(ends) if ends else np.zeros(0, np.int64)
    return h, bounds


def letter_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of letters, lower-cased in any script, and where each text's begin."""
    return word_hashes(pc.utf8_lower(column), classes=LETTERS)


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of ``n`` words, by their first word."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    value = np.full(len(h) - n + 1, n, dtype=np.uint64) * SALT[14]
    for i in range(n):
        value = value + h[i : len(h) - n + 1 + i] * SALT[i]
    return mix(value)


def shingle_sets(column: pa.Array, n: int = 5) -> Iterator[np.ndarray]:
    """The sorted set of ``n``-word shingles of each text; of fewer words, their sequence as one."""
    h, bounds = word_hashes(column)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        yield np.unique(grams(h[a:b], min(n, b - a))) if b > a else np.zeros(0, np.uint64)
