"""Spark session helpers.

Cluster settings (``spark.checkpoint.dir``, shuffle partitions, memory) come from the
session the caller hands in. We only fill in defaults where nothing is set, which is the
case in local tests and the bench.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "strata",
              shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """Build (or reuse) a session. ``master`` defaults to ``local[N]`` with N from
    ``STRATA_CPUS`` / ``BENCH_CPUS`` or the machine's core count."""
    cpus = os.environ.get("STRATA_CPUS") or os.environ.get("BENCH_CPUS") or str(os.cpu_count() or 4)
    builder = SparkSession.builder.appName(app).master(master or f"local[{cpus}]")
    settings = dict(_DEFAULTS)
    settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions or int(cpus))
    settings.setdefault("spark.driver.memory", os.environ.get("STRATA_DRIVER_MEMORY", "8g"))
    settings.update(conf)
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Rows in memory take ten to fifty times the space of the files of staged and stored tables (measured on
#: the tables of a whole load: 9 to 52).
UNPACKED = 16
_FACTOR = "spark.sql.sources.fileCompressionFactor"


@contextmanager
def unpacked_sizes(spark: SparkSession) -> Iterator[None]:
    """While it lasts the planner takes files for ``UNPACKED`` times their size, unless the session has a
    factor of its own. Without it a table whose file is below the broadcast threshold passes through the
    driver, whatever its rows take there; the sizes that AQE measures are not touched."""
    before = spark.conf.get(_FACTOR)
    if float(before) != 1.0:
        yield
        return
    spark.conf.set(_FACTOR, str(float(UNPACKED)))
    try:
        yield
    finally:
        spark.conf.set(_FACTOR, before)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only a local session that names none (tests) gets a scratch folder; on a cluster that would be
    each machine's own disk, so there it is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="strata-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` into the reliable checkpoint folder and return a DataFrame that reads
    it back (no ``localCheckpoint``: a lost executor must not lose the data)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it back: like :func:`cut_lineage`, but
    columnar, and the planner knows the size of what it reads. Zstandard: these files are read once or twice."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/stage-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
