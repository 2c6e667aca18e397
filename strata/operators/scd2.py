"""Type-2 history (H1–H4).

Event rule (per business key, events applied in time order; ``cur`` = version whose closed
interval holds the event time ``t``, ``nxt`` = first version starting after ``t``):

==========  =========  =====================================================================
cur         nxt        action
==========  =========  =====================================================================
same attrs  any        nothing
differs     absent     close cur at ``t - 1 min``; insert ``[t, open end]`` active, cur's id
differs     differs    close cur; insert ``[t, nxt.start - 1 min]`` inactive
differs     same       close cur; move nxt's start back to ``t``
absent      same       move nxt's start back to ``t``
absent      differs    insert ``[t, nxt.start - 1 min]`` inactive, nxt's id
absent      absent     insert ``[t, open end]`` active, new id
==========  =========  =====================================================================

"differs" is ``a1 != b1 OR ...`` with NULL meaning "no change"; "same" is ``a1 = b1 AND ...``
with NULL meaning "not the same".

Two paths:

* :func:`versions_from_events` — an in-order feed (every event later than the key's newest
  version). Then the rule reduces to gaps-and-islands: a version starts wherever the tracked
  attributes differ from the previous event; it ends one minute before the next version. The
  windows run per (key, time bucket), and the bucket seams are stitched with per-bucket
  summaries, so one very busy key is spread over many tasks instead of one.
* :class:`Fold` / :func:`scd2_merge` — late events (earlier than a version already stored).
  The result then depends on the order of arrival (quirk Q7: A@1, A@5, then late B@3 gives
  A[1..3) B[3..), not A,B,A), so it is a per-key sequential fold; only keys that received a
  late event go this way, and only their versions from the earliest late event on.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
import sys
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.dates import HIGH_TS, high_ts, minus_minute
from strata.functions.text import ckey, differs
from strata.operators.sequence import with_next
from strata.session import stage

HIGH = _dt.datetime.fromisoformat(HIGH_TS)
ONE_MIN = _dt.timedelta(minutes=1)

# The late-event fold runs in Python workers; ship this module's functions with the task
# (pickled by value) so executors need no installed copy of the package.
try:
    from pyspark import cloudpickle as _cloudpickle
    _cloudpickle.register_pickle_by_value(sys.modules[__name__])
except Exception:  # noqa: BLE001 — older cloudpickle: the package must then be installed on executors
    pass


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def dedupe_same_time(events: DataFrame, key: str, ts: str, attrs: Sequence[str]) -> DataFrame:
    """Quirk Q9: two events of one key at the same instant — keep the one with the greatest
    attribute fingerprint (the source would abort on the duplicate version key)."""
    w = Window.partitionBy(key, ts).orderBy(F.md5(ckey(*attrs)).desc())
    return events.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def versions_from_events(events: DataFrame, key: str, ts: str, attrs: Sequence[str], *,
                         bucket: str = "day", extra: Sequence[str] = ()) -> DataFrame:
    """H2: versions (key, attrs, extra, start_dt, end_dt, is_active) from an in-order feed.

    Tracked attributes must be non-NULL (the transforms fill them with 'N/A' / -1).
    Events of one key at the same instant: the greatest attribute fingerprint wins (Q9).
    """
    e = (events.select(key, ts, *attrs, *extra)
         .withColumn("_b", F.date_trunc(bucket, F.col(ts)))
         .withColumn("_h", F.md5(ckey(*attrs))))
    # Seam between buckets: the previous event of the first event in a bucket is the last event
    # of the key's previous non-empty bucket. One summary row per (key, bucket), computed with a
    # partial aggregate straight from the events (ties at the same instant: greatest fingerprint).
    last = e.groupBy(key, "_b").agg(F.max_by(F.struct(*attrs), F.struct(F.col(ts), F.col("_h"))).alias("_last"))
    last = (last.withColumn("_seam", F.lag("_last").over(Window.partitionBy(key).orderBy("_b")))
            .select(key, "_b", "_seam"))
    w = Window.partitionBy(key, "_b").orderBy(F.col(ts), F.col("_h").desc())
    e = e.withColumn("_pts", F.lag(ts).over(w))
    e = e.filter(F.col("_pts").isNull() | (F.col("_pts") != F.col(ts))).drop("_pts")
    e = e.withColumn("_prev", F.lag(F.struct(*attrs)).over(w))
    e = e.join(last, [key, "_b"], "left")
    prev = F.coalesce(F.col("_prev"), F.col("_seam"))
    change = prev.isNull() | differs([prev[a] for a in attrs], [F.col(a) for a in attrs])
    # The version starts are materialised once (written to the shared folder): both the in-bucket lead and
    # the per-bucket summary below read them, and the event windows are not run twice.
    v = stage(e.filter(change).select(key, F.col(ts).alias("start_dt"), *attrs, *extra, "_b"), "versions")
    # End of a version: one minute before the next version of the key (bucketed lead).
    v = with_next(v.drop("_b"), key, "start_dt", "_nxt", bucket=bucket)
    nxt = F.col("_nxt")
    return v.select(key, *attrs, *extra, "start_dt",
                    F.when(nxt.isNull(), high_ts()).otherwise(minus_minute(nxt)).alias("end_dt"),
                    nxt.isNull().alias("is_active"))


# ---------------------------------------------------------------------------------------
# Late events: the sequential fold of the event rule, per key.
# ---------------------------------------------------------------------------------------

def _differs(a: dict, b: dict, attrs) -> bool:
    # NULL comparison -> "no change"; any definite difference -> change.
    return any(a[x] is not None and b[x] is not None and a[x] != b[x] for x in attrs)


def _same(a: dict, b: dict, attrs) -> bool:
    return all(a[x] is not None and b[x] is not None and a[x] == b[x] for x in attrs)


def _fingerprint(row: dict, attrs) -> str:
    """``md5(concat_ws('|', attrs))``, as ``dedupe_same_time`` orders by."""
    return hashlib.md5("|".join(str(row[a]) for a in attrs if row[a] is not None).encode()).hexdigest()


class Fold:
    """The event rule over one key: stored versions by start and events by time, both read once and in
    order. Only the open version and the next stored one are held; a version is given out as soon as no
    later event can change it.

    A new key's id (or, with ``new_id_per_version``, every inserted version's id) is ``None`` and filled
    in by the caller. Versions that would end before they start (an event in the last minute before a
    version change, quirk Q8) are not inserted but counted.
    """

    def __init__(self, stored: Iterable[dict], attrs: Sequence[str], ts: str, id_col: str, new_id_per_version: bool,
                 stats: dict[str, int]):
        self.stored, self.attrs, self.ts, self.id_col = iter(stored), attrs, ts, id_col
        self.new_id_per_version, self.stats = new_id_per_version, stats
        self.open: dict | None = None
        self.next = self._read()

    def _read(self) -> dict | None:
        v = next(self.stored, None)
        return None if v is None else dict(v, _orig=True, _dirty=False)

    def _start(self, version: dict) -> Iterator[dict]:
        """``version`` becomes the open one; the one before it is final."""
        if self.open is not None:
            yield self._final(self.open)
        self.open = version

    @staticmethod
    def _final(version: dict) -> dict:
        return {k: x for k, x in version.items() if k not in ("_orig", "_dirty")}

    def _touch(self, version: dict) -> None:
        self.stats["updated"] += version["_orig"] and not version["_dirty"]
        version["_dirty"] = True

    def _move_back(self, t: _dt.datetime) -> Iterator[dict]:
        """The next stored version starts at ``t`` already."""
        self.next["start_dt"] = t
        self._touch(self.next)
        yield from self._start(self.next)
        self.next = self._read()

    def _insert(self, event: dict, end: _dt.datetime, active: bool, version_id) -> Iterator[dict]:
        t = event[self.ts]
        if end < t:
            self.stats["skipped"] += 1
            return
        row = {k: x for k, x in event.items() if k != self.ts}
        row.update(start_dt=t, end_dt=end, is_active=active, _orig=False, _dirty=True)
        row[self.id_col] = None if self.new_id_per_version else version_id
        self.stats["inserted"] += 1
        yield from self._start(row)

    def apply(self, event: dict) -> Iterator[dict]:
        """Apply the next event in time; gives out the versions that are final now."""
        t, attrs = event[self.ts], self.attrs
        while self.next is not None and self.next["start_dt"] <= t:
            yield from self._start(self.next)
            self.next = self._read()
        cur, nxt = self.open, self.next
        if cur is not None and cur["start_dt"] == t:
            # Q9 against stored versions: (key, start) is unique, so of a version and an event at the
            # same instant the greater fingerprint stays
            if _differs(cur, event, attrs) and _fingerprint(event, attrs) > _fingerprint(cur, attrs):
                cur.update({a: event[a] for a in attrs})
                self._touch(cur)
            return
        if cur is not None and cur["end_dt"] < t:
            cur = None
        if cur is not None and not _differs(cur, event, attrs):
            return
        if cur is not None:
            cur["end_dt"], cur["is_active"] = t - ONE_MIN, False
            self._touch(cur)
        if nxt is None:
            yield from self._insert(event, HIGH, True, cur and cur[self.id_col])
        elif _same(nxt, event, attrs):
            yield from self._move_back(t)
        else:
            yield from self._insert(event, nxt["start_dt"] - ONE_MIN, False, (cur or nxt)[self.id_col])

    def rest(self) -> Iterator[dict]:
        while self.next is not None:
            yield from self._start(self.next)
            self.next = self._read()
        if self.open is not None:
            yield self._final(self.open)


def fold_key(versions: list[dict], events: list[dict], attrs: Sequence[str], *,
             ts: str = "ts", id_col: str = "id", new_id_per_version: bool = False) -> tuple[list[dict], dict]:
    """Apply ``events`` (sorted by time) to one key's ``versions`` with the event rule.

    Each version is a dict with ``start_dt, end_dt, is_active``, the attrs and ``id_col``. Returns the
    final versions by start and counts (inserted, updated, skipped).
    """
    stats = {"inserted": 0, "updated": 0, "skipped": 0}
    fold = Fold(sorted(versions, key=lambda v: v["start_dt"]), attrs, ts, id_col, new_id_per_version, stats)
    out = [v for e in events for v in fold.apply(e)]
    return [*out, *fold.rest()], stats


ROWS = 1024  # rows that become Python objects at a time


def _key_runs(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[object, bool, pa.RecordBatch]]:
    """(key, whether events, rows): runs of at most ``ROWS`` rows of one key and kind, in order."""
    for batch in batches:
        for k in range(0, batch.num_rows, ROWS):
            part = batch.slice(k, ROWS)
            marks = list(zip(part.column("_key").to_pylist(), part.column("_event").to_pylist(), strict=True))
            begin = 0
            for i in range(1, len(marks) + 1):
                if i == len(marks) or marks[i] != marks[begin]:
                    yield *marks[begin], part.slice(begin, i - begin)
                    begin = i


def fold_sorted(batches: Iterable[pa.RecordBatch], columns: Sequence[str], attrs: Sequence[str], ts: str, id_col: str,
                new_id_per_version: bool) -> Iterator[pa.RecordBatch]:
    """Fold rows sorted by key, then stored versions by start, then events by time. Of the key in hand the
    stored versions wait as Arrow rows; events and finished versions pass by."""
    done: list[dict] = []
    key, stored, fold, schema = None, [], None, None
    stats = {"inserted": 0, "updated": 0, "skipped": 0}

    def flush() -> pa.RecordBatch:
        rows = [{c: r.get(c) for c in columns} for r in done]
        done.clear()
        return pa.RecordBatch.from_pylist(rows, schema=schema)

    def versions(runs: list[pa.RecordBatch]) -> Iterator[dict]:
        while runs:
            yield from ({c: r[c] for c in columns} for r in runs.pop(0).to_pylist())

    def end_of_key() -> Iterator[pa.RecordBatch]:
        for v in (fold or Fold(versions(stored), attrs, ts, id_col, new_id_per_version, stats)).rest():
            done.append(v)
            if len(done) >= ROWS:
                yield flush()

    for k, is_event, rows in _key_runs(batches):
        schema = schema or pa.schema([rows.schema.field(c) for c in columns])
        if k != key:
            yield from end_of_key()
            key, stored, fold = k, [], None
        if not is_event:
            stored.append(rows)
            continue
        fold = fold or Fold(versions(stored), attrs, ts, id_col, new_id_per_version, stats)
        for event in rows.to_pylist():
            event = {c: x for c, x in event.items() if c in columns and c not in ("start_dt", "end_dt", "is_active", id_col)} | {ts: event["_at"]}
            done += fold.apply(event)
            if len(done) >= ROWS:
                yield flush()
    yield from end_of_key()
    if done:
        yield flush()


def scd2_merge(existing: DataFrame, events: DataFrame, key: str, ts: str, attrs: Sequence[str], *,
               id_col: str, extra: Sequence[str] = (), new_id_per_version: bool = False) -> DataFrame:
    """H3: apply a batch of events to stored versions; returns all final versions of the keys
    that received events (other keys are untouched), ``id_col`` NULL where a new id is due.

    Keys whose every event is later than their newest stored version take the parallel
    gaps-and-islands path (seeded with that newest version); keys with a late event take the
    sequential fold, as a stream of rows sorted by key and time (``mapInArrow``).
    """
    vcols = [id_col, key, *attrs, *extra, "start_dt", "end_dt", "is_active"]
    existing = existing.select(*vcols)
    events = dedupe_same_time(events.select(key, ts, *attrs, *extra), key, ts, attrs)
    newest = existing.groupBy(key).agg(F.max("start_dt").alias("_newest"))
    late_keys = (events.join(newest, key).filter(F.col(ts) <= F.col("_newest")).select(key).distinct())

    # In-order keys: seed the feed with each key's newest version, then gaps-and-islands.
    ordered = events.join(late_keys, key, "left_anti")
    newest_v = (existing.join(newest, key)
                .filter(F.col("start_dt") == F.col("_newest")).drop("_newest")
                .join(ordered.select(key).distinct(), key, "left_semi"))
    seed = newest_v.select(key, F.col("start_dt").alias(ts), *attrs, *extra)
    fresh = versions_from_events(seed.unionByName(ordered), key, ts, attrs, extra=extra)
    ids = existing.groupBy(key).agg(F.min(id_col).alias(id_col))
    if new_id_per_version:
        # Keep the surrogate of the seeded version; every other version is new.
        fresh = fresh.join(newest_v.select(key, "start_dt", id_col), [key, "start_dt"], "left")
    else:
        fresh = fresh.join(ids, key, "left")
    fresh = fresh.select(*vcols)
    # their older versions are final already
    older = (existing.join(newest, key).filter(F.col("start_dt") < F.col("_newest")).drop("_newest")
             .join(ordered.select(key).distinct(), key, "left_semi").select(*vcols))

    # Late keys: their versions from the one holding the earliest late event onwards.
    schema = existing.schema
    late_ev = events.join(late_keys, key, "left_semi")
    first_late = late_ev.groupBy(key).agg(F.min(ts).alias("_first"))
    late_v = existing.join(late_keys, key, "left_semi")
    affected = (late_v.join(first_late, key)
                .filter(F.col("end_dt") >= F.col("_first")).drop("_first"))
    attrs_l = list(attrs)
    # Both are streamed through one sort by key and time; nothing is gathered but the stored versions of
    # the key in hand (from its earliest late event on).
    ntz = ("start_dt", "end_dt")
    typed = {f.name: T.TimestampNTZType() if f.name in ntz else f.dataType for f in schema.fields}
    rows = affected.select(F.col(key).alias("_key"), F.lit(False).alias("_event"), F.col("start_dt").cast("timestamp_ntz").alias("_at"),
                           *[F.col(c).cast(typed[c]).alias(c) for c in vcols])
    given = {key, *attrs, *extra}
    rows = rows.unionByName(late_ev.select(
        F.col(key).alias("_key"), F.lit(True).alias("_event"), F.col(ts).cast("timestamp_ntz").alias("_at"),
        *[(F.col(c) if c in given else F.lit(None)).cast(typed[c]).alias(c) for c in vcols]))
    rows = rows.repartition("_key").sortWithinPartitions("_key", "_event", "_at")
    attrs_l = list(attrs)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return fold_sorted(batches, vcols, attrs_l, ts, id_col, new_id_per_version)

    schema = T.StructType([T.StructField(c, typed[c]) for c in vcols])
    folded = rows.mapInArrow(fold, schema)
    untouched_late = late_v.join(first_late, key).filter(F.col("end_dt") < F.col("_first")).select(*vcols)
    return fresh.unionByName(older).unionByName(folded).unionByName(untouched_late)
