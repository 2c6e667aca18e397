"""Value standardisation and fingerprints (all JVM-side column expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values shared with the source warehouse: the unknown-member text and the key separator.
NA = "N/A"
SEP = "|"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def std(x) -> Column:
    """``UPPER(TRIM(x))``; trims spaces only, like the source."""
    return F.upper(F.trim(_c(x)))


def na(x, default: str = NA) -> Column:
    """``COALESCE(UPPER(TRIM(x)), 'N/A')``."""
    return F.coalesce(std(x), F.lit(default))


def ckey(*cols) -> Column:
    """Composite business key ``CONCAT_WS('|', ...)``; NULL parts are skipped (quirk Q16)."""
    return F.concat_ws(SEP, *[_c(c).cast("string") for c in cols])


def fingerprint(*cols) -> Column:
    """Row fingerprint ``MD5(CONCAT_WS('|', cols))`` over the text form of each column."""
    return F.md5(ckey(*cols))


def differs(left: list, right: list) -> Column:
    """Change test of the source upserts: ``l1 != r1 OR l2 != r2 ...`` where a NULL comparison
    counts as "no change" (quirk Q10)."""
    cond = None
    for a, b in zip(left, right):
        term = _c(a) != _c(b)
        cond = term if cond is None else (cond | term)
    return F.coalesce(cond, F.lit(False))


def same(left: list, right: list) -> Column:
    """Equality test ``l1 = r1 AND ...``; a NULL comparison counts as "not the same"."""
    cond = None
    for a, b in zip(left, right):
        term = _c(a) == _c(b)
        cond = term if cond is None else (cond & term)
    return F.coalesce(cond, F.lit(False))
