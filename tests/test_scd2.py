"""SCD2: the event rule (all seven cases), quirks Q7/Q8/Q9, and the two Spark paths checked
against the plain-Python fold."""

import datetime as dt
from collections.abc import Sequence
import hashlib
import random

import pyarrow as pa

from strata.operators.scd2 import HIGH, ONE_MIN, _differs, _same, fold_key, fold_sorted, scd2_merge, versions_from_events

D0 = dt.datetime(2024, 1, 1)
M = dt.timedelta(minutes=1)


def t(h):
    return D0 + dt.timedelta(hours=h)


def v(start, end, a, vid=1, active=False):
    return {"id": vid, "k": "e", "a": a, "start_dt": start, "end_dt": end, "is_active": active}


def ev(h, a):
    return {"k": "e", "ts": t(h), "a": a}


def run(versions, events):
    out, stats = fold_key(versions, events, ["a"])
    return sorted((x["start_dt"], x["end_dt"], x["a"], x["is_active"], x["id"]) for x in out), stats


def test_cur_same_does_nothing():
    out, st = run([v(t(0), HIGH, "A", active=True)], [ev(5, "A")])
    assert out == [(t(0), HIGH, "A", True, 1)] and st["inserted"] == st["updated"] == 0


def test_cur_differs_nxt_absent():
    out, _ = run([v(t(0), HIGH, "A", active=True)], [ev(5, "B")])
    assert out == [(t(0), t(5) - M, "A", False, 1), (t(5), HIGH, "B", True, 1)]


def test_cur_differs_nxt_differs():
    out, _ = run([v(t(0), t(10) - M, "A"), v(t(10), HIGH, "C", active=True)], [ev(5, "B")])
    assert out == [(t(0), t(5) - M, "A", False, 1), (t(5), t(10) - M, "B", False, 1), (t(10), HIGH, "C", True, 1)]


def test_cur_differs_nxt_same_extends_back():
    out, _ = run([v(t(0), t(10) - M, "A"), v(t(10), HIGH, "B", active=True)], [ev(5, "B")])
    assert out == [(t(0), t(5) - M, "A", False, 1), (t(5), HIGH, "B", True, 1)]


def test_cur_absent_nxt_same():
    out, _ = run([v(t(10), HIGH, "B", active=True)], [ev(5, "B")])
    assert out == [(t(5), HIGH, "B", True, 1)]


def test_cur_absent_nxt_differs():
    out, _ = run([v(t(10), HIGH, "B", vid=7, active=True)], [ev(5, "A")])
    assert out == [(t(5), t(10) - M, "A", False, 7), (t(10), HIGH, "B", True, 7)]


def test_cur_absent_nxt_absent_new_key():
    out, _ = run([], [ev(5, "A")])
    assert out == [(t(5), HIGH, "A", True, None)]


def test_q7_late_event_truncates():
    # A@1, A@5 in order, then B@3 arrives late: A[1..3) B[3..), the A@5 confirmation is lost
    first, _ = run([], [ev(1, "A"), ev(5, "A")])
    versions = [dict(zip(["start_dt", "end_dt", "a", "is_active", "id"], x), k="e") for x in first]
    out, _ = run(versions, [ev(3, "B")])
    assert [(s, a) for s, _, a, _, _ in out] == [(t(1), "A"), (t(3), "B")]


def test_q8_gap_minute_skips_inverted_version():
    # versions A[0, 10h-1min], C[10h, ...]; an event 30 s before 10h lies in no version
    late = {"k": "e", "ts": t(10) - dt.timedelta(seconds=30), "a": "B"}
    out, st = fold_key([v(t(0), t(10) - M, "A"), v(t(10), HIGH, "C", active=True)], [late], ["a"])
    assert st["skipped"] == 1 and len(out) == 2


def _python_h2(events):
    """Reference: fold of an in-order feed from nothing."""
    out = {}
    for k in sorted({e["k"] for e in events}):
        evs = sorted((e for e in events if e["k"] == k), key=lambda e: e["ts"])
        res, _ = fold_key([], evs, ["a"])
        out[k] = sorted((r["start_dt"], r["end_dt"], r["a"], r["is_active"]) for r in res)
    return out


def _random_events(seed, n_keys=40, n=25):
    rnd = random.Random(seed)
    rows = []
    for k in range(n_keys):
        ts = D0 + dt.timedelta(minutes=rnd.randint(0, 500))
        for _ in range(rnd.randint(1, n)):
            # gaps from 20 seconds to 3 days, so versions cross day buckets and hit the gap minute
            ts += dt.timedelta(seconds=rnd.choice([20, 90, 3600, 20000, 90000, 250000]))
            rows.append({"k": f"k{k}", "ts": ts, "a": rnd.choice("AAB" if k % 2 else "ABC")})
    return rows


def test_in_order_feed_equals_fold(spark):
    events = _random_events(3)
    df = spark.createDataFrame([(e["k"], e["ts"], e["a"]) for e in events], "k string, ts timestamp_ntz, a string")
    got = {}
    for r in versions_from_events(df, "k", "ts", ["a"]).collect():
        got.setdefault(r.k, []).append((r.start_dt, r.end_dt, r.a, r.is_active))
    assert {k: sorted(x) for k, x in got.items()} == _python_h2(events)


def test_same_instant_keeps_greatest_fingerprint(spark):
    df = spark.createDataFrame([("e", D0, "A"), ("e", D0, "B")], "k string, ts timestamp_ntz, a string")
    rows = versions_from_events(df, "k", "ts", ["a"]).collect()
    import hashlib
    winner = max("AB", key=lambda x: hashlib.md5(x.encode()).hexdigest())
    assert len(rows) == 1 and rows[0].a == winner


def test_merge_of_late_events_equals_fold(spark):
    rnd = random.Random(11)
    events = _random_events(5, n_keys=30, n=15)
    first = [e for e in events if rnd.random() < 0.6]
    late = [e for e in events if e not in first]
    base = _python_h2(first)
    ids = {k: i + 1 for i, k in enumerate(sorted(base))}
    vers = [{"id": ids[k], "k": k, "a": a, "start_dt": s, "end_dt": e, "is_active": act}
            for k, vs in base.items() for (s, e, a, act) in vs]
    expected = {}
    for k in sorted({e["k"] for e in late}):
        evs = sorted((e for e in late if e["k"] == k), key=lambda e: e["ts"])
        res, _ = fold_key([x for x in vers if x["k"] == k], evs, ["a"])
        expected[k] = sorted((r["start_dt"], r["end_dt"], r["a"], r["is_active"], r["id"]) for r in res)
    vdf = spark.createDataFrame([(x["id"], x["k"], x["a"], x["start_dt"], x["end_dt"], x["is_active"]) for x in vers],
                                "id long, k string, a string, start_dt timestamp_ntz, end_dt timestamp_ntz, "
                                "is_active boolean")
    edf = spark.createDataFrame([(e["k"], e["ts"], e["a"]) for e in late], "k string, ts timestamp_ntz, a string")
    got = {}
    for r in scd2_merge(vdf, edf, "k", "ts", ["a"], id_col="id").collect():
        got.setdefault(r.k, []).append((r.start_dt, r.end_dt, r.a, r.is_active, r.id))
    assert {k: sorted(x) for k, x in got.items()} == expected


# The event rule written the plain way (linear scans), as an independent reference.
def reference_fold(versions: list[dict], events: list[dict], attrs: Sequence[str], *,
             ts: str = "ts", id_col: str = "id", new_id_per_version: bool = False) -> tuple[list[dict], dict]:
    """Apply ``events`` (sorted by time) to one key's ``versions`` with the event rule.

    Each version is a dict with ``start_dt, end_dt, is_active``, the attrs and ``id_col``.
    A new key's id (or, with ``new_id_per_version``, every inserted version's id) is ``None``
    and filled in by the caller. Versions that would end before they start (an event in the
    last minute before a version change, quirk Q8) are not inserted but counted.
    Returns the final versions and counts (inserted, updated, skipped).
    """
    vs = [dict(v, _orig=True, _dirty=False) for v in versions]
    stats = {"inserted": 0, "updated": 0, "skipped": 0}

    def insert(ev, start, end, active, vid):
        if end < start:
            stats["skipped"] += 1
            return
        row = {a: ev[a] for a in attrs}
        row.update(start_dt=start, end_dt=end, is_active=active, _orig=False, _dirty=True)
        row[id_col] = None if new_id_per_version else vid
        for k, val in ev.items():
            if k not in row and k != ts:
                row[k] = val
        vs.append(row)
        stats["inserted"] += 1

    def touch(v):
        if v["_orig"] and not v["_dirty"]:
            stats["updated"] += 1
        v["_dirty"] = True

    for ev in events:
        t = ev[ts]
        at = [v for v in vs if v["start_dt"] == t]
        if at:  # (key, start) is unique: the greater of the two fingerprints stays
            text = {x: hashlib.md5(str(x).encode()).hexdigest() for x in (at[0]["a"], ev["a"])}
            if text[ev["a"]] > text[at[0]["a"]]:
                at[0]["a"] = ev["a"]
                touch(at[0])
            continue
        cur = next((v for v in vs if v["start_dt"] <= t <= v["end_dt"]), None)
        later = [v for v in vs if v["start_dt"] > t]
        nxt = min(later, key=lambda v: v["start_dt"]) if later else None
        if cur is not None and _differs(cur, ev, attrs):
            cur["end_dt"], cur["is_active"] = t - ONE_MIN, False
            touch(cur)
            if nxt is not None and _same(nxt, ev, attrs):
                nxt["start_dt"] = t
                touch(nxt)
            else:
                insert(ev, t, nxt["start_dt"] - ONE_MIN if nxt else HIGH, nxt is None, cur[id_col])
        elif cur is None and nxt is not None:
            if _same(nxt, ev, attrs):
                nxt["start_dt"] = t
                touch(nxt)
            else:
                insert(ev, t, nxt["start_dt"] - ONE_MIN, False, nxt[id_col])
        elif cur is None and nxt is None:
            insert(ev, t, HIGH, True, None)
    for v in vs:
        v.pop("_orig", None)
        v.pop("_dirty", None)
    return vs, stats



def test_fold_equals_reference_on_random_late_events():
    rnd = random.Random(21)
    for trial in range(300):
        events = sorted(({"k": "e", "ts": D0 + dt.timedelta(seconds=rnd.choice([30, 60, 90, 3600]) * rnd.randint(0, 40)),
                          "a": rnd.choice("ABC")} for _ in range(rnd.randint(1, 12))), key=lambda e: e["ts"])
        first, late = events[::2], events[1::2]
        base, _ = fold_key([], first, ["a"])
        got, st = fold_key([dict(v) for v in base], late, ["a"])
        exp, st2 = reference_fold([dict(v) for v in base], late, ["a"])
        key = lambda x: (x["start_dt"], x["end_dt"], x["a"], x["is_active"])
        assert sorted(map(key, got)) == sorted(map(key, exp)) and st == st2, trial


def test_fold_streams_a_key_with_very_many_late_events():
    """Versions leave while events are still coming in, and what is held does not grow with them."""
    schema = pa.schema([("_key", pa.string()), ("_event", pa.bool_()), ("_at", pa.timestamp("us")), ("id", pa.int64()), ("k", pa.string()),
                        ("a", pa.string()), ("start_dt", pa.timestamp("us")), ("end_dt", pa.timestamp("us")), ("is_active", pa.bool_())])
    read = []

    def batches():
        yield pa.RecordBatch.from_pylist([{"_key": "e", "_event": False, "_at": t(0), "id": 1, "k": "e", "a": "A", "start_dt": t(0),
                                           "end_dt": HIGH, "is_active": True}], schema=schema)
        for b in range(60):
            read.append(b)
            yield pa.RecordBatch.from_pylist([{"_key": "e", "_event": True, "_at": t(1) + dt.timedelta(minutes=5 * (500 * b + i)), "k": "e",
                                               "a": "AB"[i % 2]} for i in range(500)], schema=schema)
        yield pa.RecordBatch.from_pylist([{"_key": "f", "_event": True, "_at": t(1), "k": "f", "a": "A"}], schema=schema)

    rows, first = [], None
    for batch in fold_sorted(batches(), ["id", "k", "a", "start_dt", "end_dt", "is_active"], ["a"], "ts", "id", False):
        first = len(read) if first is None else first
        assert batch.num_rows <= 2048
        rows += batch.to_pylist()
    assert first < 10 and len(rows) == 60 * 500 + 1      # A goes on until the first B; one version for the other key
    assert [r["id"] for r in rows if r["k"] == "f"] == [None] and sum(r["is_active"] for r in rows) == 2
