"""What the mended steps move and compute: once, and no more than they need."""

import datetime as dt
import os

from pyspark.sql import functions as F

from strata.operators import bloom
from strata.operators.keys import assign_keys, probe
from strata.operators.pit import point_in_time_join
from strata.operators.upsert import ACTION, merge_fact
from strata.plans import standin as S
from strata.plans import whole_run
from strata.sources.tables import ONLINE_SCHEMA, read_sales_csv, write_csv


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_numbering_joins_nothing_back(spark):
    """rows with further columns are numbered where they are written."""
    rows = spark.createDataFrame([("b", 1), ("a", 2), ("c", 3)], "k string, v int")
    out = assign_keys(rows, ["k"], "id", offset=5)
    assert plan(out).count("Join") == 1  # with the counts of the files
    assert {tuple(r) for r in out.collect()} == {("a", 2, 6), ("b", 1, 7), ("c", 3, 8)}


def test_numbering_of_repeated_and_null_keys(spark):
    """Each row of a repeated key gets every id of that key, as the join on the key gave."""
    rows = spark.createDataFrame([("b", 1), ("b", 2), (None, 3), ("c", 4)], "k string, v int")
    out = sorted((r["id"], r["v"]) for r in assign_keys(rows, ["k"], "id").collect())
    assert out == [(1, 3), (2, 1), (2, 2), (3, 1), (3, 2), (4, 4)]


def test_merge_meets_once(spark, tmp_path):
    """target and batch meet in one full join; rows without a key are inserted."""
    ts = dt.datetime(2024, 1, 1)
    schema = "sid long, src string, q int, insert_dt timestamp_ntz, update_dt timestamp_ntz, month_id int"
    target = spark.createDataFrame([(1, "a", 1, ts, ts, 202401), (2, "b", 2, ts, ts, 202402), (3, None, 3, ts, ts, 202402)], schema)
    spark.createDataFrame([("a", 9, 202401), ("b", 2, 202402), ("d", 4, 202403), (None, 5, 202403)], "src string, q int, month_id int") \
        .write.parquet(str(tmp_path / "batch"))
    res = merge_fact(target, spark.read.parquet(str(tmp_path / "batch")), "src", ["q"], "2024-07-01 00:00:00", id_col="sid")
    assert plan(res.tagged).count("Join FullOuter") == 1
    got = {(r["sid"], r["src"], r["q"], r["month_id"], r[ACTION]) for r in res.tagged.collect()}
    assert got == {(1, "a", 9, 202401, "update"), (2, "b", 2, 202402, "keep"), (3, None, 3, 202402, "keep"),
                   (4, None, 5, 202403, "insert"), (5, "d", 4, 202403, "insert")}
    assert {r[0] for r in res.touched_months().collect()} == {202401, 202403}


def test_point_in_time_join_with_a_known_range_reads_no_facts(spark):
    """the facts are not computed for their range."""
    fails = F.when(F.col("k") == "a", F.raise_error(F.lit("read"))).otherwise(F.col("k"))
    facts = spark.createDataFrame([("a", dt.datetime(2024, 1, 5))], "k string, ts timestamp_ntz").withColumn("k", fails.cast("string"))
    versions = spark.createDataFrame([("a", dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1), 7)],
                                     "vk string, start_dt timestamp_ntz, end_dt timestamp_ntz, id long")
    point_in_time_join(facts.withColumn("ts", F.when(F.length("k") > 0, F.col("ts"))), versions, fact_key="k", fact_ts="ts", version_key="vk",
                       take=[], id_col="id", bucket_months=True, fact_range=(dt.date(2024, 1, 1), dt.date(2024, 12, 31)))


def test_batches_in_one_pass(spark):
    """the rows of both batches are those that each gives by itself."""
    day = lambda y, h, tid="1|1": (1, tid, dt.datetime(y, 1, 1), h, "SA_ONLINE")
    rows = [day(1997, "a"), day(1996, "b"), day(1999, "c"), day(1996, "d", "1|2"), day(1999, "e", "1|3"), day(1996, "f", "1|4")]
    feed = spark.createDataFrame([*rows, (1, "1|4", None, "g", "SA_ONLINE")],
                                 "order_key long, transaction_id string, event_dt timestamp_ntz, hash_value string, source_system string")
    for c in ("customer_id", "product_id", "employee_id", "payment_method", "card_type", "verification_method"):
        feed = feed.withColumn(c, F.col("hash_value"))
    for c in ("quantity", "price", "discount", "total_amount"):
        feed = feed.withColumn(c, F.lit(1))
    both = S.channel_sales_of_batches(feed)
    cols = ["sale_src_id", "event_dt", "product_id"]
    as_set = lambda df: {tuple(r) for r in df.select(*cols).collect()}
    assert as_set(both.filter("_first")) == as_set(S.channel_sales(S.batch1(feed)))
    assert as_set(both.filter("_last")) == as_set(S.channel_sales(feed))
    assert both.count() == 5


def test_filters_move_hashes_only(spark):
    """Whoever asks for the parts alone does not shuffle the keys."""
    keys = spark.range(3000).select(F.md5(F.col("id").cast("string")).alias("k"), F.lit(7).alias("part"))
    filters = bloom.build(keys, "k", "part", F.lit(4))
    parts = bloom.may_hold(keys, "k", filters).select("part").distinct()
    assert "Aggregate [k" not in plan(parts) and "array(" not in plan(filters).split("RepartitionByExpression")[1]
    assert [r[0] for r in parts.collect()] == [7]


def test_probe_of_a_table_smaller_than_the_batch(spark):
    """F8: the stored keys are then compared with the batch as they are."""
    stored, batch = spark.range(3).withColumnRenamed("id", "k"), spark.range(2, 9).withColumnRenamed("id", "k")
    assert probe(stored, batch, "k", exact=False).count() == 3
    assert [r[0] for r in probe(stored, batch, "k").collect()] == [2]
    assert [r[0] for r in probe(batch, stored, "k", exact=False).collect()] == [2]


def test_compressed_raw_files_hold_the_same_rows(spark, tmp_path):
    """the raw files of the whole loads."""
    row = {c: "x" for c in ONLINE_SCHEMA.fieldNames()} | {"product_name": 'a "b"\nc, d', "browser_used": None}
    df = spark.createDataFrame([tuple(row[c] for c in ONLINE_SCHEMA.fieldNames())] * 50, ONLINE_SCHEMA)
    write_csv(df, str(tmp_path / "z"), compression="gzip")
    assert all(f.endswith((".gz", ".crc", "_SUCCESS")) for f in os.listdir(tmp_path / "z"))
    assert read_sales_csv(spark, str(tmp_path / "z"), ONLINE_SCHEMA).collect() == df.collect()
    assert whole_run.csv_batches.__defaults__ == ((1, 2),)


def test_one_lookup_per_key(spark):
    """the sales are joined once for each dimension key."""
    star = S.Star(spark, "/root/testdata/sf0.001")
    assert plan(star.fact_rows(star.feed)).count("LeftOuter") == 4


def test_product_map_reads_the_latest_rows_only(spark, monkeypatch):
    """what is written of the feed is at most two rows a product and channel."""
    seen = {}
    real = S.stage
    monkeypatch.setattr(S, "stage", lambda df, name: seen.setdefault(name, real(df, name)))
    S.product_map(spark, "/root/testdata/sf0.001")
    feed = seen["map-feed"]
    assert feed.groupBy("source_system", "product_id").count().filter("count > 2").count() == 0

