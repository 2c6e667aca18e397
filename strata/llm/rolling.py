"""Hashes over byte and word sequences, for whole arrays at a time.

Words and windows of words are hashed in steps that mix. Byte runs use polynomials modulo 2**64, whose
linear structure lets some sequences of over a thousand bytes collide whatever the base (Thue-Morse), so
they serve runs of at most some hundred bytes."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Odd multipliers of two independent hash functions, and the seeds of their byte values.
BASES = (0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (in place)."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@lru_cache(maxsize=2)
def _byte_values(which: int) -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASES[which]) + np.uint64(which))


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base ** 0 .. base ** (n - 1)``; each process keeps one growing table per base."""
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        known = np.full(max(n + n // 8, 1 << 16), base, dtype=np.uint64)
        known[0] = 1
        _POWERS[base] = np.cumprod(known, dtype=np.uint64, out=known)
    return _POWERS[base][:n]


def release() -> None:
    """Give the tables of powers back."""
    _POWERS.clear()
    pa.default_memory_pool().release_unused()


def spans(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Hash of ``values[start:end]`` for each span: equal spans have equal hashes wherever they lie."""
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * powers(base, len(values)), out=total[1:])
    inverse = pow(base, -1, 1 << 64)
    return (total[ends] - total[starts]) * powers(inverse, len(values) + 1)[starts]


def byte_values(body: np.ndarray, which: int = 0) -> np.ndarray:
    return _byte_values(which)[body]


def words(body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first): byte spans of all words, and the index of each document's first word
    (one more entry than documents). A word ends at white space or at its document's end."""
    letter = ~_SPACE[body]
    begins, finishes = letter.copy(), letter.copy()
    begins[1:] &= ~letter[:-1]
    finishes[:-1] &= ~letter[1:]
    cuts = np.unique(offsets[(offsets > 0) & (offsets < len(body))])
    begins[cuts] = letter[cuts]
    finishes[cuts - 1] = letter[cuts - 1]
    start = np.flatnonzero(begins)
    return start, np.flatnonzero(finishes) + 1, np.searchsorted(start, offsets)


_LANES = 8  # words of up to 8 * _LANES bytes are hashed together, longer ones one by one


def word_hashes(body: np.ndarray, start: np.ndarray, end: np.ndarray, which: int = 0) -> np.ndarray:
    """64-bit hash of every word, eight bytes at a time; each step mixes before it adds, so no sum of
    byte values decides (long words: XXH64)."""
    padded = np.concatenate((body, np.zeros(8, dtype=np.uint8)))
    at8 = np.ndarray(len(body) + 1, dtype="<u8", buffer=padded, strides=(1,))  # the eight bytes from each place on
    size = end - start
    h = size.astype(np.uint64) * np.uint64(BASES[which]) + np.uint64(BASES[1 - which])
    live = np.arange(len(start))
    for lane in range(_LANES):
        left = size[live] - 8 * lane
        live = live[left > 0]
        left = left[left > 0]
        if not len(live):
            break
        value = at8[start[live] + 8 * lane]
        value &= _KEEP[np.minimum(left, 8)]
        value ^= h[live]
        h[live] = mix(value) * np.uint64(BASES[which])
    h = mix(h)
    for i in np.flatnonzero(size > 8 * _LANES).tolist():
        h[i] = xxhash.xxh64_intdigest(body[start[i]:end[i]].tobytes(), seed=which)
    return h


_KEEP = np.array([0, *((1 << 8 * k) - 1 for k in range(1, 9))], dtype=np.uint64)


def windows(hashes: np.ndarray, first: np.ndarray, length: int) -> np.ndarray:
    """Indices of the words that start a window of ``length`` words within one document."""
    per = np.diff(first)
    left = np.repeat(first[1:], per) - np.arange(len(hashes))
    return np.flatnonzero(left >= length)


def window_hashes(hashes: np.ndarray, at: np.ndarray, length: int, which: int = 0) -> np.ndarray:
    """Hash of the ``length`` values from each place of ``at`` on: runs of 1, 2, 4, ... values are hashed
    from pairs of the runs before, and the runs that make up ``length`` are joined; every step mixes."""
    base = np.uint64(BASES[which])
    run, width, done, out = hashes, 1, 0, None
    while True:
        if length & width:
            part = run[at + done]
            out = part.copy() if out is None else mix(out * base + part)
            done += width
        if 2 * width > length:
            return mix(out + np.uint64(length)) if len(out) else out
        step = run[:-width] * base if len(run) > width else run[:0].copy()
        step += run[width:] if len(run) > width else run[:0]
        run, width = mix(step), 2 * width


def all_windows(values: np.ndarray, length: int, base: int) -> np.ndarray:
    """Hash of every run of ``length`` values, by its start."""
    if len(values) < length:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * powers(base, len(values)), out=total[1:])
    own = total[length:] - total[:-length]
    own *= powers(pow(base, -1, 1 << 64), len(own))
    return mix(own)


def sliding(values: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """``best`` (np.minimum or np.maximum) over every run of ``width`` values: running bests from the
    left and from the right of blocks of ``width``, joined at the block border inside each run."""
    n = len(values)
    if n < width:
        return values[:0]
    padded = np.concatenate((values, np.full(-n % width, values[-1], dtype=values.dtype))).reshape(-1, width)
    left = best.accumulate(padded, axis=1).reshape(-1)
    right = best.accumulate(padded[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return best(right[:n - width + 1], left[width - 1:n])
