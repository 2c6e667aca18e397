import datetime as dt

from strata.operators.upsert import merge_fact, upsert

T = "id long, k string, a string, b int, source_system string, insert_dt timestamp_ntz, update_dt timestamp_ntz"
OLD = dt.datetime(2024, 1, 1)


def _target(spark):
    return spark.createDataFrame([(1, "x", "A", 1, "S", OLD, OLD), (2, "y", "B", None, "S", OLD, OLD),
                                  (3, "z", "C", 3, "S", OLD, OLD)], T)


def test_upsert_classifies_and_counts(spark):
    src = spark.createDataFrame([("x", "A", 1, "S2"), ("y", "B", 5, "S2"), ("z", "Q", 3, "S2"), ("w", "N", 0, "S2")],
                                "k string, a string, b int, source_system string")
    res = upsert(_target(spark), src, "k", ["a", "b"], "2024-02-01 00:00:00", id_col="id")
    rows = {r.k: r for r in res.table.collect()}
    assert rows["x"].update_dt == OLD                       # unchanged
    assert rows["y"].b is None and rows["y"].update_dt == OLD   # NULL -> 5 is not a change (Q10)
    assert rows["z"].a == "Q" and rows["z"].update_dt == dt.datetime(2024, 2, 1)
    assert rows["z"].insert_dt == OLD and rows["z"].source_system == "S"   # lineage kept on update
    assert rows["w"].id == 4 and rows["w"].insert_dt == dt.datetime(2024, 2, 1)
    c = res.counts().first()
    assert (c.rows_processed, c.rows_inserted, c.rows_updated) == (4, 1, 1)


def test_upsert_compat_keeps_update_dt(spark):
    src = spark.createDataFrame([("z", "Q", 3, "S")], "k string, a string, b int, source_system string")
    res = upsert(_target(spark), src, "k", ["a", "b"], "2024-02-01 00:00:00", id_col="id", touch_update_dt=False)
    assert {r.k: r.update_dt for r in res.table.collect()}["z"] == OLD


def test_upsert_twice_is_idempotent(spark):
    src = spark.createDataFrame([("w", "N", 0, "S")], "k string, a string, b int, source_system string")
    first = upsert(_target(spark), src, "k", ["a", "b"], "2024-02-01 00:00:00", id_col="id").table
    again = upsert(first, src, "k", ["a", "b"], "2024-03-01 00:00:00", id_col="id").counts().first()
    assert (again.rows_inserted, again.rows_updated) == (0, 0)


def test_merge_fact_touched_months(spark):
    tgt = spark.createDataFrame([(1, "s1", 10, 202401, OLD, OLD), (2, "s2", 20, 202402, OLD, OLD)],
                                "sid long, src string, q int, month_id int, insert_dt timestamp_ntz, "
                                "update_dt timestamp_ntz")
    src = spark.createDataFrame([("s1", 11, 202406), ("s3", 5, 202403)], "src string, q int, month_id int")
    res = merge_fact(tgt, src, "src", ["q"], "2024-07-01 00:00:00", id_col="sid")
    # the updated row stays in its own month (date is never updated)
    assert sorted(r.month_id for r in res.touched_months().collect()) == [202401, 202403]
    rows = {r.src: r for r in res.rewrite().collect()}
    assert set(rows) == {"s1", "s3"} and rows["s1"].q == 11 and rows["s1"].month_id == 202401
