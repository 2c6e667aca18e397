"""Latest-record-per-key selection.

``ROW_NUMBER() OVER (PARTITION BY key ORDER BY ...) = 1``. Catalyst turns the rank-1 filter
into a ``WindowGroupLimit`` that runs once *before* the shuffle (partial) and once after, so a
hot key is cut down to one row per map task before it is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def latest_by(df: DataFrame, keys: Sequence, order: Sequence[Column]) -> DataFrame:
    """Keep the first row of each ``keys`` group under ``order``.

    ``order`` must be a total order inside a group (add tie-breakers such as a row hash,
    quirk Q14), otherwise the surviving row is not defined — exactly as in the source.
    """
    w = Window.partitionBy(*[_c(k) for k in keys]).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") == 1).drop("_rank")


def first_per_key(df: DataFrame, key, order: Sequence[Column]) -> DataFrame:
    """"Any one row" lookup (``LIMIT 1`` / lateral top-1, J3/L2) made deterministic."""
    return latest_by(df, [key], order)


def map_recency() -> list[Column]:
    """Order of a mapping table's rows for one id: the latest load first (ties: source system, hash — Q13)."""
    return [F.col("load_dt").desc(), F.col("source_system").asc(), F.col("hash_value").asc()]
