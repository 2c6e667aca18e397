"""The data-preparation job (entry point D) as one Spark job: raw online sales dataset ->
conformed and enriched sales -> exact half split -> online and offline CSV files.

Raw columns used: transaction_id, timestamp, customer_id, customer_age, customer_gender,
customer_location (a region name), product_id, product_category, price, quantity, discount,
total_amount, payment_method.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.pick import pick
from strata.operators import prepare as P
from strata.sources.tables import OFFLINE_COLUMNS, ONLINE_COLUMNS, read_sales_csv, text_schema, write_csv

# Column order of the enriched data set before the split, and its renames.
ENRICHED = [
    "transaction_id", "timestamp", "customer_id", "customer_first_name", "customer_last_name", "customer_email",
    "customer_age", "customer_gender", "product_id", "product_name", "price", "product_manufacturer",
    "product_category", "product_subcategory", "customer_location", "customer_country", "customer_city",
    "customer_address", "employee_id", "employee_first_name", "employee_last_name", "employee_email",
    "quantity", "discount", "total_amount", "payment_method", "card_type", "verification_method",
    "device_type", "browser_used",
]
RENAMES = {"customer_location": "purchase_region", "customer_country": "purchase_country",
           "customer_city": "purchase_city", "customer_address": "purchase_address"}


def read_raw(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """The raw sales files with ``_row``: file path, then block, then position. Splits are scheduled by
    size, so the position alone is no file order."""
    df = read_sales_csv(spark, path, text_schema(columns))
    return df.withColumn("_row", F.struct(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"),
                                          F.monotonically_increasing_id().alias("n")))


def prepare_sales(spark: SparkSession, raw: DataFrame, seed: int = P.SEED) -> tuple[DataFrame, DataFrame]:
    """Returns (online, offline) with the 22 columns of each channel's file."""
    df = raw
    if "_row" not in df.columns:  # the order of rows for "first"; read_raw gives the order of the files
        df = df.withColumn("_row", F.struct(F.monotonically_increasing_id().alias("n")))
    # One age and gender per customer, one category per product (first seen)
    df = P.conform_first(df, "customer_id", ["customer_age", "customer_gender"], "_row")
    df = P.conform_first(df, "product_id", ["product_category"], "_row")
    df = (df.withColumn("customer_first_name", F.initcap(pick(P.WORDS, "customer_id", seed=seed + 11)))
            .withColumn("customer_last_name", F.initcap(pick(P.WORDS, "customer_id", seed=seed + 12))))
    # Subcategory and manufacturer chosen per product from its category's list; E6 names
    df = P.pick_by_category(df, "product_id", "product_category", P.CATEGORY_SUBCATEGORIES, "product_subcategory",
                            seed=seed)
    df = P.pick_by_category(df, "product_id", "product_category", P.CATEGORY_MANUFACTURERS,
                            "product_manufacturer", seed=seed + 1)
    df = P.product_names(df, key="product_id", category="product_category", subcategory="product_subcategory",
                         manufacturer="product_manufacturer", seed=seed)
    # Country / city / address per sale, within the sale's region
    locs = P.location_table(spark, seed=seed)
    df = P.assign_locations(df.withColumnRenamed("customer_location", "_region"), locs, row_key="transaction_id",
                            region="_region", seed=seed)
    df = (df.withColumnRenamed("_region", "customer_location").withColumnRenamed("country", "customer_country")
            .withColumnRenamed("city", "customer_city").withColumnRenamed("address", "customer_address"))
    # Period grid from the data's time range, roster, employee per sale
    ts = F.trim("timestamp").cast("timestamp_ntz")
    lo, hi = df.agg(F.min(ts), F.max(ts)).first()
    bounds = P.period_bounds(lo, hi, seed=seed) if lo else [_dt.datetime(1900, 1, 1), _dt.datetime(1900, 1, 2)]
    roster = P.employee_roster(spark, locs, bounds, seed=seed)
    sales = (df.withColumn("_ts", ts).withColumnRenamed("customer_country", "country")
               .withColumnRenamed("customer_city", "city").withColumnRenamed("customer_address", "address"))
    sales = P.assign_employees(sales, roster, bounds, row_key="transaction_id", ts="_ts", seed=seed)
    df = (sales.withColumnRenamed("country", "customer_country").withColumnRenamed("city", "customer_city")
               .withColumnRenamed("address", "customer_address").drop("_ts"))
    names = roster.select("employee_id", "employee_first_name", "employee_last_name").distinct()
    df = df.join(F.broadcast(names), "employee_id", "left")                # <= 2,000 employees
    # E-mails
    df = P.emails(df, key="customer_id", first="customer_first_name", last="customer_last_name",
                  out="customer_email", seed=seed)
    df = P.emails(df, key="employee_id", first="employee_first_name", last="employee_last_name",
                  out="employee_email", seed=seed + 1)
    # Card details only for card payments; device and browser per row
    df = P.card_details(df, row_key="transaction_id", seed=seed)
    df = P.devices(df, row_key="transaction_id", seed=seed)
    # Column order and names, exact half split after a seeded shuffle
    df = df.select(*[F.col(c).cast("string").alias(RENAMES.get(c, c)) for c in ENRICHED])
    online, offline = P.split_half(df, row_key="transaction_id", seed=seed)
    return online.select(*ONLINE_COLUMNS), offline.select(*OFFLINE_COLUMNS)


def write_sales_files(online: DataFrame, offline: DataFrame, out_dir: str) -> tuple[str, str]:
    """The two CSV files (header, one folder each)."""
    a, b = f"{out_dir}/online_retail_sales", f"{out_dir}/offline_retail_sales"
    write_csv(online, a)
    write_csv(offline, b)
    return a, b
