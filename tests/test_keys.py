import datetime as dt
import random

from pyspark.sql import functions as F

from strata.operators.keys import SALTS, assign_keys, ensure_default, lookup, lookup_first, map_or_mint, salt_of
from strata.operators.pit import point_in_time_join


def test_assign_keys_dense_ordered_with_offset(spark):
    keys = [f"k{i:04d}" for i in range(500)]
    random.Random(1).shuffle(keys)
    df = spark.createDataFrame([(k,) for k in keys], "k string").repartition(7)
    out = {r.k: r.id for r in assign_keys(df, ["k"], "id", offset=100).collect()}
    assert sorted(out.values()) == list(range(101, 601))
    assert [out[k] for k in sorted(out)] == list(range(101, 601))


def test_ensure_default_is_idempotent(spark):
    df = spark.createDataFrame([(1, "A")], "id long, name string")
    once = ensure_default(df, {"id": -1, "name": "N/A"}, "id")
    twice = ensure_default(once, {"id": -1, "name": "N/A"}, "id")
    assert sorted(r.id for r in twice.collect()) == [-1, 1]


def test_lookup_falls_back_to_unknown(spark):
    facts = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    dim = spark.createDataFrame([("a", 10)], "k string, id long")
    got = sorted(r.x for r in lookup(facts, dim, "k", "k", "id", "x").collect())
    assert got == [-1, -1, 10]


def test_lookup_first_takes_one_row(spark):
    facts = spark.createDataFrame([("a",)], "k string")
    dim = spark.createDataFrame([("a", 3, "z"), ("a", 3, "b"), ("a", 3, "c")], "k string, id long, src string")
    out = lookup_first(facts, dim, "k", "k", "id", "x", order=[F.col("src").asc()]).collect()
    assert len(out) == 1 and out[0].x == 3


MAP = "product_id long, product_src_id string, name string, source_system string, source_entity string, " \
      "hash_value string, load_dt timestamp_ntz"


def test_map_or_mint_reuses_ids_and_appends_new_hashes(spark):
    empty = spark.createDataFrame([], MAP)
    b1 = spark.createDataFrame([("P1", "LAMP", "ON", "E"), ("P1", "LAMP", "OFF", "E"), ("P2", "DESK", "ON", "E")],
                               "product_src_id string, name string, source_system string, source_entity string")
    m1 = map_or_mint(b1, empty, "product_src_id", "product_id", ["name"], "2024-01-01 00:00:00")
    t1 = m1.table.cache()
    ids = {r.product_src_id: r.product_id for r in t1.collect()}
    assert ids == {"P1": 1, "P2": 2} and t1.count() == 3          # one id, two rows for P1
    # batch 2: P1 renamed (new hash, same id), P3 new; A->B->A revert keeps B active (Q17)
    b2 = spark.createDataFrame([("P1", "LAMP2", "ON", "E"), ("P3", "SOFA", "ON", "E"), ("P1", "LAMP", "ON", "E")],
                               "product_src_id string, name string, source_system string, source_entity string")
    m2 = map_or_mint(b2, t1, "product_src_id", "product_id", ["name"], "2024-02-01 00:00:00")
    rows = m2.rows.collect()
    assert sorted((r.product_src_id, r.name, r.product_id) for r in rows) == [("P1", "LAMP2", 1), ("P3", "SOFA", 3)]


def test_assign_keys_joins_other_columns_back(spark):
    df = spark.createDataFrame([("b", 2), ("a", 1), (None, 3)], "k string, v int")
    assert {r.k: (r.v, r.id) for r in assign_keys(df, ["k"], "id").collect()} == {None: (3, 1), "a": (1, 2), "b": (2, 3)}


def test_lookup_spreads_the_unknown_key(spark):
    """The unknown key joins on NULL with a salt, so its rows do not meet in one task."""
    facts = spark.createDataFrame([(i, "N/A") for i in range(1000)] + [(-1, "a")], "i long, k string")
    dim = spark.createDataFrame([("a", 10), ("N/A", -1)], "k string, id long")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = lookup(facts, dim, "k", "k", "id", "x")
        per_task = [r[0] for r in out.groupBy(F.spark_partition_id()).count().select("count").collect()]
        assert len(per_task) > 1 and max(per_task) < 500
        assert out.filter("x = 10").count() == 1 and out.filter("x = -1").count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_hot_keys_are_looked_up_like_any_other(spark):
    """'-1' and 'N/A' are spread over tasks, but a dimension that holds them answers for them."""
    facts = spark.createDataFrame([(i, k) for i, k in enumerate(["-1", "N/A", None, "5", "7"] * 40)], "f long, k string")
    dim = spark.createDataFrame([("-1", 11), ("5", 15), ("N/A", -1)], "key string, id long")
    got = {(r["k"], r["id"]) for r in lookup(facts, dim, "k", "key", "id", "id").collect()}
    assert got == {("-1", 11), ("N/A", -1), (None, -1), ("5", 15), ("7", -1)}
    assert lookup(facts, dim, "k", "key", "id", "id").count() == 200
    bare = spark.createDataFrame([("5", 15)], "key string, id long")
    assert {(r["k"], r["id"]) for r in lookup(facts, bare, "k", "key", "id", "id", default=None).collect()} == {
        ("-1", None), ("N/A", None), (None, None), ("5", 15), ("7", None)}


def test_hot_key_is_spread(spark):
    rows = spark.range(5000).select("id", F.lit("N/A").alias("k"))
    salts = rows.select(salt_of(F.col("k"), rows.columns).alias("s")).groupBy("s").count().collect()
    assert len(salts) == SALTS and max(r["count"] for r in salts) < 200


def test_point_in_time_join_of_a_hot_key_that_is_held(spark):
    t = dt.datetime(2024, 1, 1)
    facts = spark.createDataFrame([(i, "-1", t) for i in range(100)], "f long, k string, ts timestamp_ntz")
    versions = spark.createDataFrame([("-1", t, t, 4)], "vk string, start_dt timestamp_ntz, end_dt timestamp_ntz, id long")
    for bucketed in (False, True):
        out = point_in_time_join(facts, versions, fact_key="k", fact_ts="ts", version_key="vk", take=[], id_col="id", bucket_months=bucketed)
        assert [r["id"] for r in out.collect()] == [4] * 100
