"""Hashed byte n-grams and word shapes of many texts at once."""

from __future__ import annotations

import numpy as np

_MIX = np.uint64(0x9E3779B97F4A7C15)


def bucket(x: np.ndarray, bits: int) -> np.ndarray:
    """The top ``bits`` bits of a multiplicative hash."""
    return ((x.astype(np.uint64) * _MIX) >> np.uint64(64 - bits)).astype(np.int64)


def byte_grams(data: np.ndarray, ends: np.ndarray, n: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of every n-byte string inside a text (n at most 7)."""
    m = len(data) - n + 1
    if m <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = np.zeros(m, np.uint64)
    for i in range(n):
        code <<= np.uint64(8)
        code |= data[i:i + m]
    code |= np.uint64(n << 56)
    text = np.repeat(np.arange(len(ends)), np.diff(np.concatenate(([0], ends))))[:m]
    inside = np.arange(m) + n <= ends[text]
    return text[inside], bucket(code[inside], bits)


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes end to end, and where each text ends."""
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))


def distinct(text: np.ndarray, feature: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Each (text, feature) once, sorted."""
    pairs = np.sort((text << bits) | feature)
    pairs = pairs[np.concatenate(([True], pairs[1:] != pairs[:-1]))] if len(pairs) else pairs
    return pairs >> bits, pairs & ((1 << bits) - 1)
