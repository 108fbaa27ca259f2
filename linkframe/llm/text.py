"""Words and n-grams of a text as numpy arrays, without a Python object per word."""

from __future__ import annotations

import functools
import sys

import numpy as np

U = np.uint64
STEP = U(0x9E3779B97F4A7C15)  # odd, so that multiplying by it loses nothing modulo 2^64
MIX = U(0xBF58476D1CE4E5B9)


@functools.cache
def _is_word() -> np.ndarray:
    """For every code point: is it a letter or a digit?"""
    return np.fromiter((chr(i).isalnum() for i in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


@functools.cache
def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.full(n, STEP, U), dtype=U)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly; a bijection."""
    x = (x ^ (x >> U(30))) * MIX
    return x ^ (x >> U(27)) * STEP


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def word_hashes(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A 64-bit hash, the first and the end character of every word (run of letters and digits, case ignored).

    Where lower-casing changes a text's length, positions are those in the lower-cased text.
    """
    chars = code_points(text.lower()) if text else np.empty(0, np.uint32)
    inside = np.zeros(len(chars) + 2, np.int8)
    inside[1:-1] = _is_word()[chars]
    edges = np.flatnonzero(np.diff(inside))
    start, end = edges[::2], edges[1::2]
    if not len(start):
        return np.empty(0, U), start, end
    flat = np.flatnonzero(inside[1:-1])  # characters in words
    length = end - start
    first = np.concatenate([[0], np.cumsum(length)[:-1]])
    place = np.arange(len(flat)) - np.repeat(first, length)
    longest = int(length.max())
    powers = _powers(1 << max(6, (longest - 1).bit_length()))
    sums = np.add.reduceat((chars[flat].astype(U) + U(1)) * powers[place], first)
    return mix(sums + length.astype(U)), start, end


def ngrams(hashes: np.ndarray, n: int) -> np.ndarray:
    """The hash of every run of ``n`` words, in order."""
    if len(hashes) < n:
        return np.empty(0, U)
    out = hashes[: len(hashes) - n + 1].copy()
    for k in range(1, n):
        out = mix(out) + hashes[k : len(hashes) - n + 1 + k]
    return mix(out)


def shingles(text: str | None, n: int) -> np.ndarray:
    """The sorted set of word n-grams; a text of fewer words has one shingle of all its words, an empty one none."""
    words, _, _ = word_hashes(text)
    if not len(words):
        return np.empty(0, U)
    return np.unique(ngrams(words, min(n, len(words))))
