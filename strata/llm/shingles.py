"""Word shingles of a text as sorted 64-bit numbers."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_PIECE = 1 << 20
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_powers: dict[str, np.ndarray] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads each bit over all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if len(_powers.get("up", ())) < size:
        n = 1 << max(12, size.bit_length())
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(n, base, dtype=np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def word_hashes(text: str | None) -> np.ndarray:
    """One number for each word, in order: words are runs without ASCII white space, with A-Z lower-cased."""
    raw = (text or "").encode("utf-8", "replace").lower()
    out, at = [], 0
    while at < len(raw):
        end = min(at + _PIECE, len(raw))
        while end < len(raw) and not _SPACE[raw[end]]:  # a piece ends before a space
            end += 1
        codes = np.frombuffer(raw, dtype=np.uint8, count=end - at, offset=at)
        inside = np.concatenate(([False], ~_SPACE[codes], [False]))
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        if len(edges):
            up, down = _power(len(codes))
            sums = np.concatenate(([np.uint64(0)], np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * up[:len(codes)])))
            starts, ends = edges[::2], edges[1::2]
            out.append(mixed((sums[ends] - sums[starts]) * down[starts]))
        at = end
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Distinct shingles of ``words`` words; fewer words are one shingle, none give an empty set."""
    hashes = word_hashes(text)
    if not len(hashes):
        return hashes
    n = min(words, len(hashes))
    size = len(hashes) - n + 1
    sums = np.full(size, n, dtype=np.uint64)
    for i in range(n):
        sums = mixed(sums + hashes[i:i + size])
    return np.unique(sums)
