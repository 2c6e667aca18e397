"""Change-applying operators: SCD1 upsert with counts (U1/U2), insert-if-absent (U4),
conditional fact merge (U3) and last-writer watermark upsert (U5, in ``control``).

Set-based form of the source's row loops: one left join of the target with the batch on the
business key classifies every target row (keep / update), one anti join finds the inserts,
which get fresh ids from :func:`assign_keys`. Counts come from the tagged result, so they cost
one aggregate, never a second run of the transform.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.text import differs
from strata.operators.keys import assign_keys, max_id

ACTION = "_action"


def _ts(x) -> Column:
    return F.lit(x).cast("timestamp_ntz") if isinstance(x, str) else x


@dataclass
class UpsertResult:
    tagged: DataFrame       # target after the upsert, plus ``_action`` in {keep, update, insert}
    processed: DataFrame    # the batch as given (for the processed count)

    @property
    def table(self) -> DataFrame:
        return self.tagged.drop(ACTION)

    @property
    def inserted(self) -> DataFrame:
        return self.tagged.filter(F.col(ACTION) == "insert").drop(ACTION)

    @property
    def updated(self) -> DataFrame:
        return self.tagged.filter(F.col(ACTION) == "update").drop(ACTION)

    def counts(self) -> DataFrame:
        """One row: rows_processed, rows_inserted, rows_updated (two aggregates, no collect)."""
        acts = self.tagged.agg(
            F.sum((F.col(ACTION) == "insert").cast("long")).alias("rows_inserted"),
            F.sum((F.col(ACTION) == "update").cast("long")).alias("rows_updated"))
        proc = self.processed.agg(F.count(F.lit(1)).alias("rows_processed"), F.lit(1).alias("_one"))
        acts = acts.withColumn("_one", F.lit(1))
        return proc.join(acts, "_one").select(
            "rows_processed", F.coalesce("rows_inserted", F.lit(0)).alias("rows_inserted"),
            F.coalesce("rows_updated", F.lit(0)).alias("rows_updated"))


def upsert(target: DataFrame, source: DataFrame, key: str, compare: Sequence[str], batch_ts, *,
           id_col: str, insert_dt: str = "insert_dt", update_dt: str = "update_dt",
           touch_update_dt: bool = True, offset: int | None = None) -> UpsertResult:
    """SCD1 upsert keyed on ``key``.

    * key absent from the target: insert, new id, ``insert_dt = update_dt = batch_ts``;
    * key present and any ``compare`` column differs (a NULL comparison is "no change",
      quirk Q10): update those columns and ``update_dt`` (unless ``touch_update_dt`` is off,
      the compat form of quirk Q2); id, ``insert_dt`` and every other column are kept;
    * otherwise the target row is kept unchanged.

    ``source`` must hold one row per key (use ``latest_by`` first) and every target column
    except the id and audit columns.
    """
    ts = _ts(batch_ts)
    cols = target.columns
    src = source.select(key, *compare).select(F.col(key).alias("_sk"), *[F.col(c).alias(f"_s_{c}") for c in compare])
    joined = target.join(src, F.col(key) == F.col("_sk"), "left")
    change = F.col("_sk").isNotNull() & differs([F.col(c) for c in compare], [F.col(f"_s_{c}") for c in compare])
    out = []
    for c in cols:
        if c in compare:
            out.append(F.when(change, F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c))
        elif c == update_dt and touch_update_dt:
            out.append(F.when(change, ts).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    kept = joined.select(*out, F.when(change, F.lit("update")).otherwise(F.lit("keep")).alias(ACTION))

    new = source.join(target.select(key), key, "left_anti")
    start = max_id(target, id_col) if offset is None else offset
    new = assign_keys(new, [key], id_col, offset=start)
    ins = []
    for c in cols:
        if c in (insert_dt, update_dt):
            ins.append(ts.alias(c))
        elif c in new.columns:
            ins.append(F.col(c))
        else:
            ins.append(F.lit(None).cast(target.schema[c].dataType).alias(c))
    inserted = new.select(*ins, F.lit("insert").alias(ACTION))
    return UpsertResult(tagged=kept.unionByName(inserted), processed=source)


def insert_absent(target: DataFrame, source: DataFrame, key: Sequence[str] | str) -> UpsertResult:
    """``INSERT ... ON CONFLICT DO NOTHING`` (U4)."""
    keys = [key] if isinstance(key, str) else list(key)
    new = source.join(target.select(*keys), keys, "left_anti").select(*target.columns)
    tagged = target.withColumn(ACTION, F.lit("keep")).unionByName(new.withColumn(ACTION, F.lit("insert")))
    return UpsertResult(tagged=tagged, processed=source)


@dataclass
class MergeResult(UpsertResult):
    month_col: str = "month_id"

    def touched_months(self) -> DataFrame:
        """Months that received an insert or an update — the partitions to rewrite. Updates
        never move a row (its date is not updated), so a matched row's month is the target's.
        At most one row per calendar month: a bounded table."""
        return self.tagged.filter(F.col(ACTION) != "keep").select(self.month_col).distinct()

    def rewrite(self) -> DataFrame:
        """Rows of the touched months (all of them, kept rows included), for a dynamic
        partition overwrite of exactly those months."""
        return self.table.join(F.broadcast(self.touched_months()), self.month_col, "left_semi")


def merge_fact(target: DataFrame, source: DataFrame, key: str, compare: Sequence[str], batch_ts, *,
               id_col: str, month_col: str = "month_id", offset: int | None = None) -> MergeResult:
    """Conditional MERGE of a fact batch (U3): matched on ``key`` alone and any ``compare``
    column differs -> update those columns and ``update_dt``; not matched -> insert. The date,
    time and lineage columns of a matched row are never changed.

    A target row matching the batch may live in any month, so the key match is done on the whole target.
    Target and batch meet once, in a full outer join: a row of both is kept or updated, one of the batch
    alone is inserted. The new ids are numbered on the keys alone and joined to the batch on the same key
    before, so each side is shuffled once. ``source`` should be written (its keys are read first).
    Only the months returned by ``touched_months`` need to be written back.
    """
    ts = _ts(batch_ts)
    start = max_id(target, id_col) if offset is None else offset
    new_keys = source.select(key).join(target.select(key), key, "left_anti")
    ids = assign_keys(new_keys, [key], "_new_id", offset=start).withColumnRenamed(key, "_ik")
    given = [c for c in target.columns if c in source.columns and c not in (key, id_col, "insert_dt", "update_dt")]
    batch = source.select(F.col(key).alias("_sk"), *[F.col(c).alias(f"_s_{c}") for c in given])
    with_id = batch.filter(F.col("_sk").isNotNull()).join(ids, F.col("_sk") == F.col("_ik"), "left").drop("_ik")
    # rows without a key match nothing, but are inserted all the same
    keyless = batch.filter(F.col("_sk").isNull()).join(ids.filter(F.col("_ik").isNull()), F.col("_sk").eqNullSafe(F.col("_ik"))).drop("_ik")

    both = target.withColumn("_in_t", F.lit(True)).join(with_id.withColumn("_in_s", F.lit(True)), F.col(key) == F.col("_sk"), "full_outer")
    insert = F.col("_in_t").isNull()
    change = F.col("_in_t").isNotNull() & F.col("_in_s").isNotNull() & differs(
        [F.col(c) for c in compare], [F.col(f"_s_{c}") for c in compare])

    def inserted(c: str) -> Column:
        if c in ("insert_dt", "update_dt"):
            return ts
        if c in (key, id_col):
            return F.col("_sk" if c == key else "_new_id")
        return F.col(f"_s_{c}") if c in given else F.lit(None).cast(target.schema[c].dataType)

    def merged(c: str) -> Column:
        replaced = insert | change if c in compare or c == "update_dt" else insert
        return F.when(replaced, inserted(c)).otherwise(F.col(c)).alias(c)

    action = F.when(insert, F.lit("insert")).when(change, F.lit("update")).otherwise(F.lit("keep"))
    tagged = both.select(*[merged(c) for c in target.columns], action.alias(ACTION)).unionByName(
        keyless.select(*[inserted(c).alias(c) for c in target.columns], F.lit("insert").alias(ACTION)))
    return MergeResult(tagged=tagged, processed=source, month_col=month_col)
