import datetime as dt

from strata.operators.pit import point_in_time_join
from strata.operators.staging import stage_append, stage_loads, stage_rows
from strata.plans import standin as S

D = dt.datetime


def _versions(spark):
    return spark.createDataFrame(
        [(1, "e", "A", D(2024, 1, 1), D(2024, 3, 1, 8, 59)), (2, "e", "B", D(2024, 3, 1, 9, 0), D(9999, 12, 31, 23, 59, 59))],
        "sid long, k string, a string, start_dt timestamp_ntz, end_dt timestamp_ntz")


def test_point_in_time_join_and_gap_minute(spark):
    facts = spark.createDataFrame([(1, "e", D(2024, 2, 1)), (2, "e", D(2024, 3, 1, 8, 59, 30)),
                                   (3, "e", D(2024, 5, 1)), (4, "x", D(2024, 5, 1))],
                                  "fid int, k string, ts timestamp_ntz")
    for bucketed in (False, True):
        out = point_in_time_join(facts, _versions(spark), fact_key="k", fact_ts="ts", version_key="k", take=["a"],
                                 id_col="sid", out_id="sid", bucket_months=bucketed)
        got = {r.fid: (r.sid, r.v_a) for r in out.collect()}
        # the instant in the last minute before a change matches no version (Q8)
        assert got == {1: (1, "A"), 2: (-1, None), 3: (2, "B"), 4: (-1, None)}


def test_stage_rows_and_append(spark):
    cols = ["transaction_id", "timestamp", "v"]
    raw = spark.createDataFrame([("T1", "2024-01-01 10:00:00", "a"), ("T1", "2024-01-01 09:00:00", "a"),
                                 (None, "2024-01-01 10:00:00", "b"), ("T2", None, "c"), ("T3", "2024-01-02", "d")],
                                "transaction_id string, timestamp string, v string")
    rows = stage_rows(raw, cols, "2024-02-01 00:00:00")
    empty = spark.createDataFrame([], rows.schema)
    r1 = stage_append(empty, rows)
    got = sorted((r.transaction_id, r.timestamp) for r in r1.new_rows.collect())
    # missing keys dropped (F1); rows differing only in time collapse, earliest kept (Q1)
    assert got == [("T1", "2024-01-01 09:00:00"), ("T3", "2024-01-02")]
    again = stage_append(r1.table, rows)
    assert again.new_rows.count() == 0 and again.table.count() == 2


def test_loads_in_one_pass(spark):
    """the rows of two loads staged in one pass are those that each appended after the other gives."""
    one, two = D(2024, 1, 1), D(2024, 2, 1)
    first = [("a", "T1", D(1997, 5, 1)), ("a", "T1", D(1997, 3, 1)), ("b", "T2", D(1997, 1, 1)), ("old", "T0", D(1996, 1, 1))]
    again = first + [("a", "T1", D(1996, 1, 1)), ("c", "T3", D(1999, 2, 1)), ("c", "T3", D(1999, 1, 1)), ("c", "T3", D(1999, 1, 1))]
    schema = "hash_value string, transaction_id string, event_dt timestamp_ntz, load_dt timestamp_ntz"
    load = lambda rows, at: spark.createDataFrame([(*r, at) for r in rows], schema)
    stored = load([("old", "T0", D(1990, 1, 1))], D(2023, 1, 1))
    b1, b2 = load(first, one), load(again, two)
    r1 = stage_append(stored, b1, order=["event_dt"])
    r2 = stage_append(r1.table, b2, order=["event_dt"])
    both = stage_loads(stored, b2.unionByName(b1), time_col="event_dt")
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    assert rows(both.table) == rows(r2.table)
    assert rows(both.new_rows) == rows(r1.new_rows.unionByName(r2.new_rows)) == [
        ("a", "T1", D(1997, 3, 1), one), ("b", "T2", D(1997, 1, 1), one), ("c", "T3", D(1999, 1, 1), two)]


def test_both_loads_join_the_lines_once(spark):
    """the lines of run_log's two loads are joined and fingerprinted once, a line of batch 1 is offered twice."""
    r1, r2 = S.staged(spark, "/root/testdata/sf0.001")
    assert r2.table._jdf.queryExecution().optimizedPlan().toString().count("Join Inner") == 1
    assert r1.table.count() + r2.new_rows.count() == r2.table.count()
    feed = spark.createDataFrame([("h", "1|1", D(1997, 1, 1)), ("i", "1|2", D(1998, 1, 1)), ("j", "1|3", None)],
                                 "hash_value string, transaction_id string, event_dt timestamp_ntz")
    assert sorted((r[0], str(r[3])) for r in S.deliveries(feed).collect()) == [
        ("h", S.BATCH1_TS), ("h", S.BATCH2_TS), ("i", S.BATCH2_TS)]
