"""Number-theoretic transforms of many short rows at once: exact convolutions of integers."""

from __future__ import annotations

import numpy as np

# A prime 15 * 2^27 + 1 and a generator of its units.
PRIME = 2013265921
GENERATOR = 31
P = np.uint64(PRIME)


def powers(base: int, count: int) -> np.ndarray:
    """base^0 ... base^(count - 1) modulo the prime, by doubling; count is a power of two."""
    out = np.ones(1, np.uint64)
    while len(out) < count:
        step = np.uint64(pow(base, len(out), PRIME))
        out = np.concatenate([out, out * step % P])
    return out


def _root(size: int, inverse: bool) -> int:
    root = pow(GENERATOR, (PRIME - 1) // size, PRIME)
    return pow(root, PRIME - 2, PRIME) if inverse else root


def forward(rows: np.ndarray) -> np.ndarray:
    """Transforms of the rows, in bit-reversed order. The width is a power of two."""
    count, size = rows.shape
    half = size // 2
    while half:
        pairs = rows.reshape(count, -1, 2, half)
        low, high = pairs[:, :, 0], pairs[:, :, 1]
        turned = (low + P - high) % P * powers(_root(2 * half, False), half) % P
        rows = np.stack([(low + high) % P, turned], axis=2)
        half //= 2
    return rows.reshape(count, size)


def backward(rows: np.ndarray) -> np.ndarray:
    """The rows whose transforms, in bit-reversed order, are given."""
    count, size = rows.shape
    half = 1
    while half < size:
        pairs = rows.reshape(count, -1, 2, half)
        low, high = pairs[:, :, 0], pairs[:, :, 1] * powers(_root(2 * half, True), half) % P
        rows = np.stack([(low + high) % P, (low + P - high) % P], axis=2)
        half *= 2
    return rows.reshape(count, size) * np.uint64(pow(size, PRIME - 2, PRIME)) % P


def squared_differences(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """For each row and t: the sum over i of (block[i] - window[i + t])^2, modulo the prime.

    Windows are twice as long as blocks, of a power of two of values below the prime; t runs
    over the length of a block. Equal stretches always give 0; so may, by chance, others.
    """
    size = blocks.shape[1]
    blocks, windows = blocks.astype(np.uint64), windows.astype(np.uint64)
    turned = np.zeros_like(windows)
    turned[:, 0] = blocks[:, 0]
    turned[:, : size : -1] = blocks[:, 1:]
    product = backward(forward(turned) * forward(windows) % P)[:, :size]
    squares = np.cumsum(windows * windows % P, axis=1)
    ends = squares[:, size - 1 : -1]
    before = np.concatenate([np.zeros((len(blocks), 1), np.uint64), squares[:, : size - 1]], axis=1)
    own = (blocks * blocks % P).sum(axis=1, keepdims=True) % P
    return (own + (ends - before) + np.uint64(2) * (P - product)) % P
