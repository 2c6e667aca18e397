"""Mixing sources to target weights.

Tokens (words) are summed per source, each source gets a target by water-filling, its repetition
rate is target / size, and every document is emitted ``floor(rate)`` times plus one more copy when
a number hashed from seed and doc_id falls below the fraction of the rate.

Edge cases: a null source is one source of its own, after all others; a null or empty text has size
0 and is repeated at its source's rate; a source without words has target 0 and rate 0; rows that
share a doc_id draw the same number; an empty table gives an empty result. Extra columns pass
through ``mix`` unchanged (working columns start with ``_mix_``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import WORD, stage, text_or_empty

WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
SEED = "mix-1"
_BITS = 52


def n_words(column: str = "text") -> Column:
    return F.regexp_count(text_or_empty(column), F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """One row per source: (source, source_size, target, rate). ``sizes`` has (source, size).

    Targets are ``min(max_repeat * size, level * weight)`` with one water level for all sources,
    chosen so that they add up to all tokens. Sources are taken in the order in which they reach
    their cap; the level with the first k capped rises while the next source is over its cap and
    falls afterwards, so the level is the maximum over k. Only one row per source takes part.
    """
    per = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(int(w)).cast("long") for w in weights]), (rank - 1) % len(weights) + 1)
    per = per.withColumn("w", weight).withColumn("cap", F.col("source_size") * F.lit(max_repeat))
    everything = Window.partitionBy(F.lit(1))
    fill = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    open_w = F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0))
    per = per.withColumn("level", left / open_w)
    per = per.withColumn("level", F.max("level").over(everything))
    target = F.least(F.col("cap").cast("double"), F.col("level") * F.col("w"))
    per = per.withColumn("target", target)
    rate = F.when(F.col("source_size") > 0, F.least(F.lit(float(max_repeat)), F.col("target") / F.col("source_size")))
    return per.select("source", "source_size", "target", F.coalesce(rate, F.lit(0.0)).alias("rate"))


def bernoulli(key: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) that depends on seed and key alone."""
    digest = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(key.cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, _BITS // 4), 16, 10).cast("long") / F.lit(float(1 << _BITS))


def copies(rate: Column, key: Column, seed: str = SEED) -> Column:
    """``floor(rate)`` copies and one more with the probability of the fraction."""
    whole = F.floor(rate)
    return (whole + (bernoulli(key, seed) < rate - whole).cast("long")).cast("long")


def with_copies(docs: DataFrame, targets: DataFrame, key: str = "doc_id", seed: str = SEED) -> DataFrame:
    """``docs`` with ``_mix_source_size``, ``_mix_target`` and ``_mix_copies``. ``targets`` is a
    written table of one row per source, so the planner broadcasts it when its files are small and
    otherwise joins with AQE's splitting of the hot source."""
    t = targets.select(F.col("source").alias("_mix_source"), F.col("source_size").alias("_mix_source_size"),
                       F.col("target").alias("_mix_target"), F.col("rate").alias("_mix_rate"))
    return (docs.join(t, docs["source"].eqNullSafe(t["_mix_source"]), "left")
            .withColumn("_mix_copies", copies(F.col("_mix_rate"), F.col(key), seed))
            .drop("_mix_source", "_mix_rate"))


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeat: int = MAX_REPEAT, key: str = "doc_id",
        seed: str = SEED) -> DataFrame:
    """The mixed corpus: the rows of ``docs``, each as often as it is taken."""
    sizes = docs.select("source", n_words().alias("size"))
    targets = stage(source_targets(sizes, weights, max_repeat), "mix-targets")
    out = with_copies(docs, targets, key, seed).filter("_mix_copies > 0")
    again = F.explode(F.sequence(F.lit(1), F.col("_mix_copies").cast("int")))
    return out.select(*[out[c] for c in docs.columns], again.alias("_mix_no")).drop("_mix_no")


def mix_report(docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeat: int = MAX_REPEAT, key: str = "doc_id",
               seed: str = SEED) -> DataFrame:
    """Per document: its size, its source's size and target, and the words the mix takes of it."""
    sizes = stage(docs.select(key, "source", n_words().alias("size")), "mix-sizes")
    targets = stage(source_targets(sizes, weights, max_repeat), "mix-targets")
    out = with_copies(sizes, targets, key, seed)
    return out.select(key, "size", F.col("_mix_source_size").alias("source_size"), F.col("_mix_target").alias("target"),
                      (F.col("size") * F.col("_mix_copies")).alias("taken"), F.col("_mix_copies").alias("copies"))
