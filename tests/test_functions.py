import hashlib

from pyspark.sql import functions as F

from strata.functions import ckey, differs, fingerprint, md5_index, na, same, std


def test_standardise_and_keys(spark):
    df = spark.createDataFrame([("  visa ", None, "x")], "a string, b string, c string")
    r = df.select(std("a").alias("s"), na("b").alias("n"), ckey("a", "b", "c").alias("k"),
                  fingerprint("c", "b").alias("h")).first()
    assert r.s == "VISA" and r.n == "N/A"
    assert r.k == "  visa |x"                       # NULL parts are skipped (Q16)
    assert r.h == hashlib.md5(b"x").hexdigest()     # same digest as any md5(concat_ws(...))


def test_change_tests_ignore_null(spark):
    df = spark.createDataFrame([(1, 1, None, 5), (1, 2, 3, 3), (None, None, None, None)],
                               "a int, b int, c int, d int")
    rows = df.select(differs(["a", "c"], ["b", "d"]).alias("diff"), same(["a"], ["b"]).alias("same")).collect()
    assert [r.diff for r in rows] == [False, True, False]    # NULL comparison: no change (Q10)
    assert [r.same for r in rows] == [True, False, False]    # NULL comparison: not the same


def test_md5_index_is_portable(spark):
    r = spark.range(1).select(md5_index(7, F.lit("abc")).alias("i")).first()
    digest = hashlib.md5(b"42|abc").hexdigest()
    assert r.i == int(digest[:15], 16) % 7
