"""Vectorised 64-bit hashes of words and word shingles.

A word's hash is a polynomial of its bytes modulo 2**64, taken from prefix sums over the
whole text, so no word becomes a Python object. The same words give the same hashes on
every executor.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

from murmur.llm.common import SPACES

_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_IN_WORD = np.ones(256, dtype=bool)
_IN_WORD[list(SPACES)] = False
#: Texts beyond this size are hashed in parts that end between words.
_PART = 1 << 21
_TOGETHER = 1 << 17
_powers: dict[str, np.ndarray] = {}


def _power_table(base: int, length: int) -> np.ndarray:
    key = f"{base}"
    known = _powers.get(key)
    if known is None or len(known) < length:
        size = 1 << max(12, (length - 1).bit_length())
        known = np.full(size, base, dtype=np.uint64)
        known[0] = 1
        known = np.multiply.accumulate(known)
        _powers[key] = known
    return known


def mixed(values: np.ndarray) -> np.ndarray:
    """Spreads each value over all 64 bits (the finaliser of splitmix)."""
    x = values + _STEP
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def word_bounds(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of every word."""
    if not text:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    inside = _IN_WORD[np.frombuffer(text, np.uint8)]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        edges = np.concatenate(([0], edges))
    if inside[-1]:
        edges = np.concatenate((edges, [len(text)]))
    return edges[0::2], edges[1::2]


def word_hashes(text: bytes) -> np.ndarray:
    """One hash per word, in order."""
    if len(text) > _PART:
        return np.concatenate([_hashes(part)[0] for part in split_text(text, _PART)])
    return _hashes(text)[0]


def each_word_hashes(texts: Iterable[bytes]) -> Iterator[np.ndarray]:
    """``word_hashes`` of each text; short texts are hashed together, which is faster."""
    held: list[bytes] = []
    size = 0
    for text in texts:
        if len(text) > _TOGETHER:
            yield from _together(held)
            yield word_hashes(text)
            held, size = [], 0
            continue
        held.append(text)
        size += len(text)
        if size > _TOGETHER:
            yield from _together(held)
            held, size = [], 0
    yield from _together(held)


def _together(texts: list[bytes]) -> Iterator[np.ndarray]:
    if not texts:
        return
    hashes, first = _hashes(b"\n".join(texts))
    ends = np.cumsum([len(text) + 1 for text in texts])
    low = 0
    for high in np.searchsorted(first, ends):
        yield hashes[low:high]
        low = high


def split_text(text: bytes, size: int) -> Iterator[bytes]:
    """Parts of at least ``size`` bytes, the last one shorter, that end between words."""
    start = 0
    while start < len(text):
        end = start + size
        while end < len(text) and text[end] not in SPACES:
            end += 1
        yield text[start:end]
        start = end


def _hashes(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    first, end = word_bounds(text)
    if not len(first):
        return np.empty(0, np.uint64), first
    raw = np.frombuffer(text, np.uint8)
    values = raw.astype(np.uint64)
    values += np.uint64(1)
    values *= _power_table(_BASE, len(raw))[: len(raw)]
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(values, out=sums[1:])
    whole = (sums[end] - sums[first]) * _power_table(_INVERSE, len(raw))[first]
    return mixed(whole), first


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """One hash per run of ``size`` words; a shorter text is one shingle, an empty one none."""
    if not len(words):
        return words
    width = min(size, len(words))
    count = len(words) - width + 1
    total = np.full(count, width, dtype=np.uint64)
    for offset in range(width):
        total = total * _STEP + words[offset : offset + count]
    return mixed(total)
