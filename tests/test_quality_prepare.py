import datetime as dt
import random

from strata.operators import partitions, prepare, quality


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None)], "k int, s string")
    assert [(r.k, r.n_rows) for r in quality.dq_unique(df, ["k"]).collect()] == [(1, 2)]
    parent = spark.createDataFrame([(1,)], "k int")
    assert [(r.k, r.n_rows) for r in quality.dq_foreign_key(df, "k", parent, "k").collect()] == [(2, 1)]
    assert [(r.column_name, r.n_nulls) for r in quality.dq_not_null(df, ["k", "s"]).collect()] == [("s", 1)]
    assert [(r.column_name, r.n_too_long) for r in quality.dq_max_length(df, {"s": 0}).collect()] == [("s", 2)]
    D = dt.datetime
    v = spark.createDataFrame([("e", D(2024, 1, 1), D(2024, 2, 1), False), ("e", D(2024, 1, 15), D(9999, 1, 1), True),
                               ("f", D(2024, 1, 1), D(2023, 1, 1), True)],
                              "k string, start_dt timestamp_ntz, end_dt timestamp_ntz, is_active boolean")
    bad = {r.k: (r.n_overlaps, r.n_active, r.n_inverted) for r in quality.dq_scd(v, "k").collect()}
    assert bad == {"e": (1, 1, 0), "f": (0, 1, 1)}


def test_rolling_window_cutoff(spark):
    # max date 2024-06-20 -> cut-off 2024-03-20: March detached, April kept (Q25)
    days = [dt.date(2024, m, 10) for m in (1, 2, 3, 4, 5)] + [dt.date(2024, 6, 20)]
    fact = partitions.with_month(spark.createDataFrame([(d,) for d in days], "date_id date"))
    states = {r.month_id: r.is_active for r in partitions.month_states(fact).collect()}
    assert states == {202401: False, 202402: False, 202403: False, 202404: True, 202405: True, 202406: True}
    assert partitions.first_active_month(fact) == 202404


def test_conform_first_and_split(spark):
    df = spark.createDataFrame([(1, "c", None), (2, "c", "X"), (3, "c", "Y"), (4, "d", "Z")],
                               "ord int, cust string, age string")
    got = {r.ord: r.age for r in prepare.conform_first(df, "cust", ["age"], "ord").collect()}
    assert got == {1: "X", 2: "X", 3: "X", 4: "Z"}
    rows = spark.createDataFrame([(f"t{i}",) for i in range(101)], "tid string")
    on, off = prepare.split_half(rows, row_key="tid")
    a, b = {r.tid for r in on.collect()}, {r.tid for r in off.collect()}
    assert len(a) == 50 and len(b) == 51 and not (a & b)


def test_assign_employees_matches_brute_force(spark):
    rnd = random.Random(4)
    bounds = [dt.datetime(2024, 1, 1), dt.datetime(2024, 4, 1), dt.datetime(2024, 7, 1)]
    roster = [(e, "C", city, addr, p) for e in range(20) for p in (0, 1)
              for city in [rnd.choice(["X", "Y"])] for addr in [rnd.choice(["a1", "a2"])]]
    sales = [(f"s{i}", bounds[0] + dt.timedelta(days=rnd.randint(0, 180)), "C", rnd.choice(["X", "Y", "Z"]),
              rnd.choice(["a1", "a2", "a3"])) for i in range(200)]
    rdf = spark.createDataFrame(roster, "employee_id long, country string, city string, address string, period_no int")
    sdf = spark.createDataFrame(sales, "tid string, ts timestamp_ntz, country string, city string, address string")
    got = {r.tid: r.employee_id for r in prepare.assign_employees(sdf, rdf, bounds, row_key="tid", ts="ts").collect()}
    for tid, ts, country, city, addr in sales:
        p = max(sum(b < ts for b in bounds) - 1, 0)
        primary = {e for e, c, ci, a, pp in roster if (c, ci, a, pp) == (country, city, addr, p)}
        fallback = {e for e, c, ci, a, pp in roster if (c, ci) == (country, city)}
        if primary:
            assert got[tid] in primary
        elif fallback:
            assert got[tid] in fallback
        else:
            assert got[tid] is None
