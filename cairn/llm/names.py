"""Names of strings of bytes: 64-bit hashes of content and length, from sums over prefixes."""

from __future__ import annotations

from functools import lru_cache

import numpy as np


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


@lru_cache(4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    base = 0x9E3779B97F4A7C15
    inverse = pow(base, -1, 1 << 64)
    up, down = np.full(n, base, np.uint64), np.full(n, inverse, np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down), np.random.default_rng(5).integers(1, 1 << 63, 256, np.uint64)


class Names:
    """Names of the strings within one stretch of bytes."""

    def __init__(self, data: np.ndarray, most: int) -> None:
        up, self.down, value = _powers(most)
        self.prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value[data] * up[: len(data)])])

    def names(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self.prefix[end] - self.prefix[start]) * self.down[start] + (end - start).astype(np.uint64))


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of a mask."""
    held = np.zeros(len(mask) + 2, bool)
    held[1:-1] = mask
    edge = np.flatnonzero(held[1:] != held[:-1])
    return edge[::2], edge[1::2]
