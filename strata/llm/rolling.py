"""Hashes of all q-grams of an array, and sliding minima and maxima, by doubling."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from strata.llm.shingles import mixed

_BASE = 0x9E3779B97F4A7C15


def grams(codes: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit hash of each q consecutive codes; equal grams have equal hashes."""
    n = len(codes) - q + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    power, have = np.full(1, _BASE, dtype=np.uint64), 1  # an array, whose products wrap silently
    held = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    out, size, left = None, 0, q
    while left:
        if left & 1:
            out = held[:n].copy() if out is None else out * power + held[size:size + n]
            size += have
        left >>= 1
        if left:
            held = held[:-have] * power + held[have:]
            power, have = power * power, have * 2
    return mixed(out)


def sliding(values: np.ndarray, width: int, pick: Callable) -> np.ndarray:
    """``pick`` (np.minimum or np.maximum) of each ``width`` consecutive values."""
    have, held = 1, values
    while have * 2 <= width:
        held = pick(held[:-have], held[have:])
        have *= 2
    n = len(values) - width + 1
    return held[:max(n, 0)] if have == width else pick(held[:max(n, 0)], held[width - have:width - have + max(n, 0)])
