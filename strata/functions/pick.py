"""Seeded, reproducible choice from a list — the Spark form of ``random_element``.

The index is a 64-bit hash of (seed, key columns), so every executor computes the same pick
for the same key with no shared random state and no driver round trip.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def hash_index(n, *keys, seed: int = 42) -> Column:
    """0-based index in ``[0, n)`` from the seeded hash of ``keys``; ``n`` may be a column."""
    n_col = n if isinstance(n, Column) else F.lit(int(n))
    return F.pmod(F.xxhash64(F.lit(seed), *[_c(k) for k in keys]), n_col.cast("long"))


def pick(choices: Sequence[str], *keys, seed: int = 42, index_fn=None) -> Column:
    """Pick one literal from ``choices`` by hash of ``keys`` (``hash_index``, or ``index_fn``)."""
    arr = F.array(*[F.lit(c) for c in choices])
    return F.element_at(arr, ((index_fn or hash_index)(len(choices), *keys, seed=seed) + 1).cast("int"))


def md5_index(n, *keys, seed: int = 42) -> Column:
    """Like :func:`hash_index` but from the first 60 bits of ``md5('seed|k1|k2...')`` — a pick any
    SQL engine with ``md5`` can reproduce (used where results are checked against SQL)."""
    n_col = n if isinstance(n, Column) else F.lit(int(n))
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[_c(k).cast("string") for k in keys]))
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), n_col.cast("long"))
