import datetime as dt
import random

from pyspark.sql import functions as F

from strata.operators.prepare import CARD_TYPES, REGION_COUNTRIES
from strata.plans.preparation import prepare_sales, write_sales_files
from strata.sources.tables import OFFLINE_COLUMNS, OFFLINE_SCHEMA, ONLINE_COLUMNS, ONLINE_SCHEMA, read_sales_csv

RAW = ("transaction_id string, timestamp string, customer_id string, customer_age string, customer_gender string, "
       "customer_location string, product_id string, product_category string, price string, quantity string, "
       "discount string, total_amount string, payment_method string")


def _raw(spark, n=240):
    rnd = random.Random(7)
    cats = ["Books", "Clothing", "Electronics"]
    rows = []
    for i in range(n):
        c = f"C{rnd.randint(1, 40)}"
        p = f"P{rnd.randint(1, 30)}"
        ts = dt.datetime(2023, 1, 1) + dt.timedelta(hours=rnd.randint(0, 24 * 500))
        rows.append((f"T{i}", ts.isoformat(sep=" "), c, str(rnd.randint(18, 70)), rnd.choice("MF"),
                     rnd.choice(list(REGION_COUNTRIES)), p, rnd.choice(cats), "10.00", "2", "0.10", "18.00",
                     rnd.choice(["Credit Card", "Debit Card", "PayPal", "Cash"])))
    return spark.createDataFrame(rows, RAW)


def test_prepare_sales(spark, tmp_dir):
    online, offline = prepare_sales(spark, _raw(spark))
    on, off = online.collect(), offline.collect()
    assert len(on) == 120 and len(off) == 120
    assert online.columns == ONLINE_COLUMNS and offline.columns == OFFLINE_COLUMNS
    assert not ({r.transaction_id for r in on} & {r.transaction_id for r in off})
    # one age / gender per customer
    per_cust = online.groupBy("customer_id").agg(F.countDistinct("customer_age").alias("a"),
                                                 F.countDistinct("customer_gender").alias("g"))
    assert per_cust.filter("a > 1 or g > 1").count() == 0
    # card details only for card payments
    for r in on:
        if r.payment_method in CARD_TYPES:
            assert r.card_type in CARD_TYPES[r.payment_method]
        else:
            assert r.card_type is None and r.verification_method is None
    # employees work in the sale's city
    for r in off:
        assert r.employee_id is not None and r.purchase_country in REGION_COUNTRIES[r.purchase_region]
    a, b = write_sales_files(online, offline, tmp_dir)
    assert read_sales_csv(spark, a, ONLINE_SCHEMA).count() == 120
    assert read_sales_csv(spark, b, OFFLINE_SCHEMA).count() == 120


def test_split_narrows_to_the_middle_row(spark):
    """Whatever number of rows may be ordered at once, the halves are those of a full sort."""
    import hashlib
    from strata.operators.prepare import split_half
    keys = [f"k{i}" for i in range(777)]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    order = sorted(keys, key=lambda k: (hashlib.md5(f"42|{k}".encode()).hexdigest(), k))
    for small in (1, 50, 10_000):
        online, offline = split_half(df, row_key="k", small=small)
        assert {r["k"] for r in online.collect()} == set(order[:388]) and {r["k"] for r in offline.collect()} == set(order[388:])
    online, offline = split_half(df.limit(1), row_key="k")
    assert online.count() == 0 and offline.count() == 1


def test_roster_covers_every_employee_once(spark):
    from strata.operators.prepare import roster_periods
    import datetime as dt
    bounds = [dt.datetime(2024, 1, 1), dt.datetime(2024, 4, 2), dt.datetime(2024, 6, 30)]
    employees = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, "none")], "employee_id long, city string")
    places = spark.createDataFrame([("a", "x"), ("a", "y"), ("a", "y"), ("b", "z")], "city string, address string")
    rows = sorted((r["employee_id"], r["period_start"], r["period_end"], r["city"], r["address"]) for r in roster_periods(employees, places, bounds).collect())
    assert [(e, s, n) for e, s, n, _, _ in rows] == [(e, s, n) for e in (1, 2, 3) for s, n in zip(bounds, bounds[1:])]
    assert all((c, a) in {("a", "x"), ("a", "y"), ("b", "z")} for *_, c, a in rows)
