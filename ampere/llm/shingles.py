"""Distinct word-shingle hashes of texts, whole Arrow arrays at a time (helper of operator 8).

A word's hash is a polynomial over its bytes (modulo 2^64, a random 64-bit value
a byte, A-Z as a-z), a shingle's a mix of its words' hashes by place.  64-bit
hashes stand for shingles throughout."""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa

from ampere.llm.wordbpe import blocks

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_rng = np.random.default_rng(20240)
_VALUE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_VALUE[65:91] = _VALUE[97:123]
_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14)]] = True
_VALUE[_BLANK] = 0
_PLACE = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BLOCK = 1 << 20


@functools.lru_cache(maxsize=8)
def _powers(base: int, bits: int) -> np.ndarray:
    p = np.full(1 << bits, base, np.uint64)
    p[0] = 1
    return np.cumprod(p)


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def word_hashes(texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, in order, and where each text's words start (n + 1 offsets)."""
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    size = int(at[-1] - at[0])
    if not size:
        return np.empty(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(raw, np.uint8)[at[0]:at[-1]]
    at = at - at[0]
    ink = ~_BLANK[data]
    first = ink.copy()
    first[1:] &= ~ink[:-1]
    edges = at[at < size]
    first[edges] = ink[edges]                     # a text's first byte never continues a word
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.empty(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    bits = max(20, size.bit_length())
    sums = np.add.reduceat(_VALUE[data] * _powers(_BASE, bits)[:size], starts)
    return mix(sums * _powers(_INVERSE, bits)[starts]), np.searchsorted(starts, at)


def shingle_sets(texts: pa.Array, width: int):
    """Per text, in order: the sorted distinct hashes of its ``width``-word shingles (uint64).

    A text of fewer words has one shingle, its whole sequence; without words, none."""
    for part in blocks(texts, BLOCK):
        words, at = word_hashes(part)
        if len(words) >= width:
            n = len(words) - width + 1
            grams = np.zeros(n, np.uint64)
            for k in range(width):
                grams += words[k:n + k] * _PLACE[k]
            grams = mix(grams)
        for lo, hi in zip(at[:-1].tolist(), at[1:].tolist()):
            if hi - lo >= width:
                yield np.unique(grams[lo:hi - width + 1])
            elif hi > lo:
                one = (words[lo:hi] * _PLACE[:hi - lo]).sum(dtype=np.uint64) + np.uint64(hi - lo)
                yield mix(np.array([one], np.uint64))
            else:
                yield np.empty(0, np.uint64)
