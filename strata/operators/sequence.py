"""``lead`` over a key without putting the whole key in one task.

The rows of a key are windowed per (key, time bucket); the value that follows the last row of a
bucket is the first value of the key's next non-empty bucket, taken from a per-bucket summary
(one row per key and bucket). A key holding a third of all rows is therefore spread over as many
tasks as it has buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def with_next(df: DataFrame, key: str, order_col: str, out: str, *, bucket: str = "day") -> DataFrame:
    """Add ``out`` = the next ``order_col`` value of the same key (``lead``), NULL for the last."""
    d = df.withColumn("_b", F.date_trunc(bucket, F.col(order_col)))
    d = d.withColumn("_next", F.lead(order_col).over(Window.partitionBy(key, "_b").orderBy(order_col)))
    firsts = d.groupBy(key, "_b").agg(F.min(order_col).alias("_first"))
    firsts = (firsts.withColumn("_next_b", F.lead("_first").over(Window.partitionBy(key).orderBy("_b")))
              .select(key, "_b", "_next_b"))
    d = d.join(firsts, [key, "_b"], "left")
    return d.withColumn(out, F.coalesce(F.col("_next"), F.col("_next_b"))).drop("_b", "_next", "_next_b")
