"""Hashes of all spans of a text, in numpy."""

from __future__ import annotations

import numpy as np

_ODD = 0x9E3779B97F4A7C15
_BYTE = np.random.default_rng(58).integers(1, 2**63, 256, dtype=np.uint64)
_powers: dict[str, np.ndarray] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n and more of an odd number and of its inverse, modulo 2**64; kept for later texts."""
    if len(_powers.get("up", ())) <= n:
        size = max(1 << 16, 2 * n)
        for name, base in (("up", _ODD), ("down", pow(_ODD, -1, 2**64))):
            _powers[name] = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, np.uint64(base))]))
    return _powers["up"], _powers["down"]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, the same wherever they stand."""
    up, down = powers(len(data))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * up[: len(data)])])
    return mixed((sums[ends] - sums[starts]) * down[starts])


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of the ``size`` bytes from each position on."""
    up, down = powers(len(data))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * up[: len(data)])])
    return mixed((sums[size:] - sums[: len(sums) - size]) * down[: len(data) - size + 1])
