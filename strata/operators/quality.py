"""Data-quality checks that stand in for the source's declared constraints.

Each check returns a DataFrame of violations (empty = pass), computed with aggregates and
anti joins — never by collecting rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.sequence import with_next


def dq_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def dq_foreign_key(child: DataFrame, child_col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Child values with no parent row, with how many child rows carry them."""
    orphans = child.select(F.col(child_col).alias("_v")).join(
        parent.select(F.col(parent_col).alias("_v")).distinct(), "_v", "left_anti")
    return orphans.groupBy(F.col("_v").alias(child_col)).agg(F.count(F.lit(1)).alias("n_rows"))


def null_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NULL count of every column in ``cols`` (one aggregate pass, one row per column)."""
    agg = df.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in cols])
    stacked = agg.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"),
                                                      F.col(c).alias("n_nulls")) for c in cols])).alias("s"))
    return stacked.select("s.column_name", "s.n_nulls")


def dq_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """D3: columns declared NOT NULL that hold NULLs, with their count."""
    return null_counts(df, cols).filter(F.col("n_nulls") > 0)


def dq_max_length(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    """Rows whose text is longer than the declared width, counted per column."""
    agg = df.agg(*[F.sum((F.length(c) > n).cast("long")).alias(c) for c, n in limits.items()])
    stacked = agg.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"),
                                                      F.col(c).alias("n_too_long")) for c in limits])).alias("s"))
    return stacked.select("s.column_name", "s.n_too_long").filter(F.col("n_too_long") > 0)


def _scd_flags(versions: DataFrame, key: str, start: str, end: str, active: str) -> DataFrame:
    # next version start per key via a bucketed lead, so a key with very many versions is not one task
    v = with_next(versions.select(key, start, end, active), key, start, "_nxt", bucket="month")
    return v.select(key,
                    F.coalesce(F.col("_nxt") <= F.col(end), F.lit(False)).cast("long").alias("_overlap"),
                    F.col(active).cast("long").alias("_active"),
                    (F.col(end) < F.col(start)).cast("long").alias("_inverted"))


def dq_scd_report(versions: DataFrame, key: str, start: str = "start_dt", end: str = "end_dt",
                  active: str = "is_active") -> DataFrame:
    """D4 per key: versions, active versions, overlaps with the next version, inverted versions
    (per-key partial aggregates)."""
    return _scd_flags(versions, key, start, end, active).groupBy(key).agg(
        F.count(F.lit(1)).alias("n_versions"), F.sum("_active").alias("n_active"),
        F.sum("_overlap").alias("n_overlaps"), F.sum("_inverted").alias("n_inverted"))


def dq_scd(versions: DataFrame, key: str, start: str = "start_dt", end: str = "end_dt",
           active: str = "is_active") -> DataFrame:
    """SCD2 sanity per key — overlapping versions, more or less than one active version,
    versions ending before they start. One row per key with any violation."""
    per_key = dq_scd_report(versions, key, start, end, active).select(
        key, "n_overlaps", "n_active", "n_inverted")
    return per_key.filter((F.col("n_overlaps") > 0) | (F.col("n_active") != 1) | (F.col("n_inverted") > 0))
