"""Word hashes of many texts at once, without a Python step per word."""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes so that all bits depend on all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word (A-Z in lower case, between ASCII white space), and where each text's words begin (one more at the end)."""
    joined = b"\n".join(texts).lower() + b"\n"
    data = np.frombuffer(joined, dtype=np.uint8)
    space = SPACE[data]
    starts = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
    ends = np.cumsum(np.array([len(t) + 1 for t in texts], dtype=np.int64))
    edges = np.concatenate([[0], np.searchsorted(starts, ends)]) if texts else np.zeros(1, np.int64)
    if not len(starts):
        return np.zeros(0, np.uint64), edges
    inside = np.arange(len(data)) - np.repeat(np.concatenate([[0], starts]), np.diff(np.concatenate([[0], starts, [len(data)]])))
    power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(int(inside.max()), _BASE)]), dtype=np.uint64)
    value = np.where(space, np.uint64(0), (data.astype(np.uint64) + np.uint64(1)) * power[inside])
    return mix(np.add.reduceat(value, starts)), edges


def shingles(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every ``n`` words in a row; of the whole sequence where it has fewer words; none without words."""
    if not len(hashes):
        return hashes
    n = min(n, len(hashes))
    out = np.full(len(hashes) - n + 1, n, dtype=np.uint64)
    for i in range(n):
        out = mix(out * _BASE + hashes[i:len(hashes) - n + 1 + i])
    return out


def table_marks(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(word, bit) of a table of ``2 ** bits`` bits for each distinct place that the hashes fall on."""
    return marks_at(mix(hashes) >> np.uint64(64 - bits))


def marks_at(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.unique(places)
    return (at >> np.uint64(6)).astype(np.int64), (np.uint64(1) << (at & np.uint64(63))).view(np.int64)


def may_hold(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each hash may have been marked in the table."""
    at = mix(hashes) >> np.uint64(64 - (len(table).bit_length() + 5))
    return (table[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1
