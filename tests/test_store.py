"""Storage and files: the CSV dialect, recovery after failed writes, atomic months, reset."""

import os

import pytest
from pyspark.sql import functions as F

import fixtures
from strata import schemas
from strata.operators import control
from strata.operators.scd2 import fold_key
from strata.plans import warehouse as W
from strata.plans.warehouse import Warehouse, active_fact, reset_warehouse, run_pipeline
from strata.sources.store import TableStore
from strata.sources.tables import read_sales_csv, text_schema, write_csv


def test_csv_round_trip(spark, tmp_dir):
    rows = [("1", 'say "hi", you', "3"), ("2", "two\nlines", "4"), ("3", 'q"x', None), ("4", "a,b", "c\\d"), ("5", "ä", "'")]
    schema = text_schema(["a", "b", "c"])
    path = os.path.join(tmp_dir, "out")
    write_csv(spark.createDataFrame(rows, schema), path)
    assert sorted(tuple(r) for r in read_sales_csv(spark, path, schema).collect()) == rows
    raw = os.path.join(tmp_dir, "raw.csv")
    with open(raw, "w") as f:
        f.write('a,b,c\n1,"say ""hi"", you",3\n2,"two\nlines",4\n')
    assert [tuple(r) for r in read_sales_csv(spark, raw, schema).orderBy("a").collect()] == [
        ("1", 'say "hi", you', "3"), ("2", "two\nlines", "4")]


@pytest.mark.parametrize("line", ["4,5", "6,7,8,9"])
def test_malformed_rows_are_errors(spark, tmp_dir, line):
    raw = os.path.join(tmp_dir, "raw.csv")
    with open(raw, "w") as f:
        f.write(f"a,b,c\n1,2,3\n{line}\n")
    with pytest.raises(Exception):
        read_sales_csv(spark, raw, text_schema(["a", "b", "c"])).collect()


def failing(df):
    return df.withColumn("x", F.raise_error(F.lit("lost")).cast("long"))


def test_writes_go_on_after_a_failed_one(spark, tmp_dir):
    st, df = TableStore(spark, tmp_dir), spark.createDataFrame([(1, 202401)], "x long, month_id int")
    for write, read in ((lambda d: st.write("t", d), lambda: st.read("t")),
                        (lambda d: st.append("a", d), lambda: st.read_appended("a", df.schema)),
                        (lambda d: st.overwrite_partitions("p", d, "month_id"), lambda: st.read_partitioned("p", df.schema))):
        write(df)
        with pytest.raises(Exception):
            write(failing(df))
        assert [r.x for r in read().collect()] == [1]
        write(df.withColumn("x", F.lit(2).cast("long")))
        assert [r.x for r in read().collect()][-1] == 2


def test_months_are_replaced_by_the_manifest(spark, tmp_dir):
    st = TableStore(spark, tmp_dir)
    schema = "x long, month_id int"
    st.overwrite_partitions("f", spark.createDataFrame([(1, 202401), (2, 202402)], schema), "month_id")
    df = spark.createDataFrame([(3, 202402), (4, 202403)], schema)
    # a crash after the months are written and before the manifest is: nothing has changed
    real, st.write = st.write, lambda *a: (_ for _ in ()).throw(OSError("crash"))
    with pytest.raises(OSError):
        st.overwrite_partitions("f", df, "month_id")
    st.write = real
    read = lambda: sorted(tuple(r) for r in st.read_partitioned("f", df.schema).collect())
    assert read() == [(1, 202401), (2, 202402)]
    st.overwrite_partitions("f", df, "month_id")
    assert read() == [(1, 202401), (3, 202402), (4, 202403)]
    st.remove_superseded("f")
    assert read() == [(1, 202401), (3, 202402), (4, 202403)]
    plan = st.read_partitioned("f", df.schema).filter("month_id = 202403")
    assert plan.inputFiles() and all("month_id=202403" in f for f in plan.inputFiles()) or plan.count() == 1


def test_load_recovers_after_a_failed_step(spark, tmp_path_factory, monkeypatch):
    base = str(tmp_path_factory.mktemp("recover"))
    files = fixtures.write_batches(base)
    run_pipeline(spark, *files["b1"], f"{base}/a", "2024-07-01 00:00:00")
    good = Warehouse.load_sales
    monkeypatch.setattr(Warehouse, "load_sales", lambda self: (_ for _ in ()).throw(ValueError("broken " + "x" * 400)))
    with pytest.raises(ValueError):
        run_pipeline(spark, *files["b1"], f"{base}/b", "2024-07-01 00:00:00")
    log = TableStore(spark, f"{base}/b").read_appended("mta_logs", control.LOGS_SCHEMA)
    last = log.filter("rows_processed = -1").first()
    assert last.error_code == "XX000" and last.error_message.endswith("X" * 400)
    monkeypatch.setattr(Warehouse, "load_sales", good)
    run_pipeline(spark, *files["b1"], f"{base}/b", "2024-07-01 06:00:00")
    keys = ["sale_src_id", "date_id", "quantity", "total_amount"]
    a, b = (sorted(tuple(r) for r in active_fact(spark, f"{base}/{x}").select(*keys).collect()) for x in "ab")
    assert a == b and a
    with pytest.raises(ValueError, match="not later"):
        run_pipeline(spark, *files["b2"], f"{base}/b", "2024-07-01 00:00:00")
    created = reset_warehouse(spark, f"{base}/b")
    assert "ce_customers" in created
    assert TableStore(spark, f"{base}/b").read_appended("src_online_retail_sales", schemas.SRC_ONLINE).count() == 0


def test_sqlstate_of_a_spark_error(spark):
    try:
        spark.sql("SELECT no_such_column")
    except Exception as exc:  # noqa: BLE001
        assert control.sqlstate(exc) == "42703"


def test_event_at_the_instant_of_a_stored_version():
    t = W.LOW
    out, _ = fold_key([{"id": 1, "a": "A", "start_dt": t, "end_dt": W.HIGH, "is_active": True}], [{"ts": t, "a": "B"}], ["a"])
    assert len(out) == 1 and out[0]["start_dt"] == t and out[0]["end_dt"] == W.HIGH
