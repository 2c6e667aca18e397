"""Helpers shared by the operators: table access, written intermediates, word patterns."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import strata
from strata.session import checkpoint_dir

#: A word: a maximal run without ASCII white space (the same split as ``bytes.split()``).
WORD = r"[^\x20\x09-\x0D]+"
ASCII_SPACE = " \t\n\x0b\x0c\r"
U64 = (1 << 64) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the folder that driver and executors share (``spark.checkpoint.dir``)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage ends here, a lost
    executor costs nothing, and the planner sees the true size of what follows."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application: none of them need have it installed."""
    sc = spark.sparkContext
    if getattr(sc, "_strata_shipped", False):
        return
    root = Path(strata.__file__).resolve().parent
    path = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="strata-code-")), "strata_code.zip")
    with zipfile.ZipFile(path, "w") as out:  # Spark's file server hands it out from the driver
        for f in sorted(root.rglob("*.py")):
            out.write(f, Path(root.name) / f.relative_to(root))
    sc.addPyFile(path)
    sc._strata_shipped = True


def map_arrow(df: DataFrame, work: Callable, schema) -> DataFrame:
    """``df.mapInArrow(work, schema)`` on executors that have this package."""
    ship(df.sparkSession)
    return df.mapInArrow(work, schema)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row (a lambda variable is never inlined)."""
    return F.transform(F.array(value), body)[0]


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))
