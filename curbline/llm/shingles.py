"""Sets of word shingles of many texts at once, as sorted 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WORDS = 5
CHUNK_BYTES = 1 << 20

_rng = np.random.default_rng(7_001)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_BYTE[ord("A") : ord("Z") + 1] = _BYTE[ord("a") : ord("z") + 1]  # A-Z are read as a-z
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_PLACE = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
_POWERS: dict[int, np.ndarray] = {}


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """Spread 64-bit values over the whole range."""
    x = x + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 ... base**(n-1) modulo 2**64; kept for chunks of the usual size."""
    if n <= CHUNK_BYTES and base in _POWERS:
        return _POWERS[base][:n]
    size = max(n, CHUNK_BYTES)
    out = np.empty(size, np.uint64)
    out[0] = 1
    done, step = 1, base
    while done < size:
        more = min(done, size - done)
        out[done : done + more] = out[:more] * np.uint64(step)
        done, step = done + more, step * step & (2**64 - 1)
    if size == CHUNK_BYTES:
        _POWERS[base] = out
    return out[:n]


def _word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, and the position of each text's first word (one more entry for the end)."""
    space = _SPACE[data]
    first, last = ~space, ~space
    first[1:] &= space[:-1]
    last[:-1] &= space[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]  # words do not run from one text into the next
    first[inner] |= ~space[inner]
    last[inner - 1] |= ~space[inner - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _powers(_BASE, len(data)), out=sums[1:])
    words = (sums[ends] - sums[starts]) * _powers(_INVERSE, len(data) + 1)[starts]
    return mixed(words), np.searchsorted(starts, offsets)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each text; ``offsets`` are the texts' bounds in ``data``.

    A text of fewer words than a shingle has its whole sequence as one; one without words has none.
    """
    if not len(data):
        yield from (np.zeros(0, np.uint64) for _ in offsets[1:])
        return
    hashed, bounds = _word_hashes(data, offsets)
    count = len(hashed) - words + 1
    if count > 0:
        joined = hashed[:count] * _PLACE[0]
        for k in range(1, words):
            joined += hashed[k : k + count] * _PLACE[k]
        joined = mixed(joined, 1)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= words:
            part = np.sort(joined[a : b - words + 1])
            yield part[np.r_[True, part[1:] != part[:-1]]]
        elif b > a:
            whole = (hashed[a:b] * _PLACE[: b - a]).sum(dtype=np.uint64, keepdims=True)
            yield mixed(whole, 1 + words + b - a)
        else:
            yield np.zeros(0, np.uint64)


def column_sets(texts: pa.Array, words: int = WORDS) -> Iterator[np.ndarray]:
    """``shingle_sets`` of a column of texts (null: empty), a bounded number of bytes at a time."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    at = 0
    while at < len(texts):
        to = int(np.searchsorted(offsets, offsets[at] + CHUNK_BYTES, "right")) - 1
        to = min(max(to, at + 1), len(texts))
        yield from shingle_sets(data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at], words)
        at = to
