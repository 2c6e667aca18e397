"""Readers for the input tables: driver parquet tables and the warehouse's raw sales CSV files."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
                 "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table (``<sf_dir>/<name>.parquet``)."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


class Tables:
    """Lazy accessor: ``Tables(spark, dir).lineitem`` reads ``lineitem.parquet``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name not in DRIVER_TABLES:
            raise AttributeError(name)
        return read_table(self.spark, self.sf_dir, name)


# Column lists of the two raw sales files (all text, header line) — fixed by the file layout.
ONLINE_COLUMNS = [
    "transaction_id", "timestamp", "customer_id", "customer_first_name", "customer_last_name",
    "customer_email", "customer_age", "customer_gender", "product_id", "product_name", "price",
    "product_manufacturer", "product_category", "product_subcategory", "quantity", "discount",
    "total_amount", "payment_method", "card_type", "verification_method", "device_type", "browser_used",
]
OFFLINE_COLUMNS = [
    "transaction_id", "timestamp", "product_id", "product_name", "price", "product_manufacturer",
    "product_category", "product_subcategory", "purchase_region", "purchase_country", "purchase_city",
    "purchase_address", "employee_id", "employee_first_name", "employee_last_name", "employee_email",
    "quantity", "discount", "total_amount", "payment_method", "card_type", "verification_method",
]


def text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


ONLINE_SCHEMA = text_schema(ONLINE_COLUMNS)
OFFLINE_SCHEMA = text_schema(OFFLINE_COLUMNS)


#: The dialect of the sales files, for reading (batch and stream) and writing: a header line, quotes
#: doubled inside quoted fields, line breaks allowed in them; a row with a wrong number of fields is
#: an error. Quoted line breaks make one file one task, so large inputs come as many files.
CSV_READ = {"header": True, "quote": '"', "escape": '"', "multiLine": True, "mode": "FAILFAST", "enforceSchema": True}
CSV_WRITE = {"header": True, "quote": '"', "escape": '"'}


def read_sales_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All-text CSV scan with a header (S1/S2). Empty fields are NULL (quirk Q23); a malformed row
    fails the load."""
    return spark.read.options(**CSV_READ).schema(schema).csv(path)


def write_csv(df: DataFrame, path: str, compression: str = "none") -> None:
    """CSV sink with header."""
    df.write.mode("overwrite").options(**CSV_WRITE, compression=compression).csv(path)
