"""Physical-plan properties the scale design relies on."""

from strata.plans import driver_queries as Q


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_is_cut_before_the_shuffle(spark):
    plan = _plan(Q.latest_per_key(spark, "/root/testdata/sf0.001"))
    # a partial WindowGroupLimit runs below the hash exchange (later in the tree string), the final above
    shuffle = plan.find("Exchange hashpartitioning")
    assert shuffle > 0
    assert plan.find("Final", plan.find("WindowGroupLimit")) < shuffle
    assert plan.find("WindowGroupLimit", shuffle) > shuffle and "Partial" in plan[shuffle:]


def test_scans_are_pruned(spark):
    plan = _plan(Q.stage_fingerprint(spark, "/root/testdata/sf0.001"))
    assert "l_tax" not in plan and "o_totalprice" not in plan       # unused columns never read
    assert "IsNotNull(l_orderkey)" in plan[plan.find("PushedFilters"):]
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderpriority:string>" in plan


def test_calendar_is_broadcast(spark):
    plan = _plan(Q.mart_time_of_day(spark, "/root/testdata/sf0.001"))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_scd2_windows_are_per_key_and_day(spark):
    import re
    plan = _plan(Q.scd2_history(spark, "/root/testdata/sf0.001"))
    # every event-level window is partitioned by (key, day bucket); only the per-bucket summaries
    # (one row per key and day) are windowed by key alone
    parts = re.findall(r"Window \[[^\]]*\], \[([^\]]*)\]", plan)
    assert parts and any("_b" in p for p in parts)
    assert "hashpartitioning(employee_src_id" in plan and "_b" in plan[plan.find("hashpartitioning(employee_src_id"):]
