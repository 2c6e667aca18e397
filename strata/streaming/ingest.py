"""Staging load as a Structured Streaming job over a landing folder.

New CSV files dropped into ``source_dir`` are picked up by the file source (its offsets live in
the stream checkpoint), each micro-batch is fingerprinted and appended to the staging table
with the same exactly-once rule as the batch load (``ON CONFLICT (hash_value) DO NOTHING``).
If a micro-batch is retried after its append committed, the anti join on the fingerprint
makes the retry insert nothing.

Rows carry the wall clock at which their micro-batch was staged. A warehouse run sets its watermarks
to its ``batch_ts``, so take that from the same clock, after the stream has stopped.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from strata import schemas
from strata.operators.keys import probe
from strata.operators.staging import stage_append, stage_rows, staging_order
from strata.session import stage
from strata.sources.store import TableStore
from strata.sources.tables import CSV_READ, OFFLINE_COLUMNS, OFFLINE_SCHEMA, ONLINE_COLUMNS, ONLINE_SCHEMA

CHANNELS = {
    "online": (ONLINE_SCHEMA, ONLINE_COLUMNS, "src_online_retail_sales", schemas.SRC_ONLINE),
    "offline": (OFFLINE_SCHEMA, OFFLINE_COLUMNS, "src_offline_retail_sales", schemas.SRC_OFFLINE),
}


def stage_stream(spark: SparkSession, source_dir: str, root: str, channel: str = "online", *,
                 checkpoint: str, available_now: bool = True,
                 max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the staging stream for one channel; returns the running query.

    ``checkpoint`` holds the offsets: a folder that outlives the application, the same on every start.

    ``available_now`` processes everything present and stops (a scheduled incremental load);
    otherwise the query keeps running on a processing-time trigger.
    """
    raw_schema, columns, table, src_schema = CHANNELS[channel]
    store = TableStore(spark, root)
    reader = spark.readStream.schema(raw_schema).options(**CSV_READ)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.csv(source_dir)

    def load(batch: DataFrame, epoch_id: int) -> None:
        load_dt = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None).isoformat(sep=" ")
        rows = stage(stage_rows(batch, columns, load_dt), table)
        existing = store.read_appended(table, src_schema)
        # the same order as the batch load, so the surviving row of equal fingerprints is the same
        res = stage_append(existing, rows, order=staging_order(columns),
                           existing_hashes=probe(existing.select("hash_value"), rows, "hash_value"))
        store.append(table, res.new_rows)

    writer = stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
