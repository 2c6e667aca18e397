"""Sorting suffixes in memory: multikey quicksort over 8-byte tokens, for one bucket at a time."""

from __future__ import annotations

import numpy as np


def as_tokens(rows: np.ndarray) -> np.ndarray:
    """Byte rows (n, width) as big-endian 8-byte tokens, whose order is the order of the bytes."""
    n, width = rows.shape
    out = np.zeros((n, -(-width // 8) * 8), dtype=np.uint8)
    out[:, :width] = rows
    return out.view(">u8").astype(np.uint64)


def multikey_sort(tokens: np.ndarray) -> np.ndarray:
    """The order of the token rows. Multikey quicksort, all open segments at once: a segment is split
    by a pivot token into smaller, equal and larger rows, and the equal ones go on with their next
    token. Segments of one row and segments out of tokens are closed."""
    n, width = tokens.shape
    order = np.arange(n)
    at, label, depth = order.copy(), np.zeros(n, dtype=np.int64), np.zeros(1, dtype=np.int64)
    if n < 2 or not width:
        return order
    while len(at):
        rows = order[at]
        token = tokens[rows, depth[label]]
        size = np.bincount(label, minlength=len(depth))
        start = np.cumsum(size) - size
        pivot = token[start + size // 2][label]
        part = label * 3 + (token >= pivot) + (token > pivot)
        order[at] = rows[np.argsort(part, kind="stable")]
        size = np.bincount(part, minlength=3 * len(depth))
        depth = np.repeat(depth, 3)
        depth[1::3] += 1
        still = (size > 1) & (depth < width)
        at = at[np.repeat(still, size)]
        label = np.repeat(np.arange(int(still.sum())), size[still])
        depth = depth[still]
    return order


def common_prefix(rows: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Bytes that each row shares with the one before it in ``order`` (0 for the first)."""
    out = np.zeros(len(order), dtype=np.int64)
    for k in range(1, len(order), 1 << 14):
        own = order[k - 1:k + (1 << 14)]
        differ = rows[own[1:]] != rows[own[:-1]]
        out[k:k + len(own) - 1] = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    return out
