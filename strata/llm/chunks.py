"""Chunks: rows that hold a few MB of documents each, so that numpy works on many texts at once.

A chunk is one row (chunk id, bytes of text, compressed Arrow batch). Chunks are written once to the
shared folder; whatever is found out about a chunk later is joined to it by its id, so nothing
depends on how a scan is split or in which order its rows come.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm import rolling
from strata.llm.common import map_arrow, stage

CHUNK_BYTES = 2 << 20
TASK_CHUNKS = 2  # chunks whose bodies, or whose share of the parts, a task reads on average
SCHEMA = "chunk long, n_bytes long, body binary"
_IPC = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=3))


def pack(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=_IPC) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpack(body: bytes) -> pa.RecordBatch:
    with pa.ipc.open_stream(body) as reader:
        return reader.read_next_batch()


def chunked(docs: DataFrame, text: str = "text", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``docs`` as a written table of chunks. A document longer than ``chunk_bytes`` is a chunk of its
    own; texts travel as UTF-8 bytes, all other columns as they are."""
    rows = docs.withColumn(text, F.col(text).cast("binary"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            size = np.asarray(pc.fill_null(pc.binary_length(batch.column(batch.schema.names.index(text))), 0), dtype=np.int64)
            at = np.concatenate(([0], np.cumsum(size)))
            start = 0
            while start < batch.num_rows:
                end = int(np.searchsorted(at, at[start] + chunk_bytes, side="right")) - 1
                end = min(max(end, start + 1), batch.num_rows)
                body = pack(batch.slice(start, end - start))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number], pa.int64()), pa.array([int(at[end] - at[start])], pa.int64()),
                     pa.array([body], pa.binary())], names=["chunk", "n_bytes", "body"])
                number, start = number + 1, end

    return stage(map_arrow(rows, run, SCHEMA), "chunks")


def body_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a binary column; a null is empty."""
    column = pc.fill_null(column, b"").cast(pa.large_binary())
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64, count=n + 1, offset=8 * column.offset) if n else np.zeros(1, np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def squeeze(values: np.ndarray) -> bytes:
    """Integers as compressed bytes, byte planes apart (high planes of small numbers vanish)."""
    values = np.ascontiguousarray(values)
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.dtype.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unsqueeze(blob: bytes, dtype) -> np.ndarray:
    dtype = np.dtype(dtype)
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(dtype.itemsize, -1).T).reshape(-1).view(dtype)


def tasks_for(chunks: DataFrame) -> int:
    """Tasks among which what is known about all chunks is dealt: their load stays the same at any size."""
    return max(1, -(-chunks.count() // TASK_CHUNKS))


def found_per_chunk(found: DataFrame, name: str) -> DataFrame:
    """(chunk, found: array of (part, blob)): what was found out about each chunk. A chunk gets at
    most one row from each part, so a list is bounded by the number of parts."""
    return found.groupBy("chunk").agg(F.collect_list(F.struct("part", "blob")).alias(name))


def map_chunks(chunks: DataFrame, work: Callable[[int, pa.RecordBatch, list], Iterator[pa.RecordBatch]],
               schema: str | T.StructType, found: DataFrame | None = None) -> DataFrame:
    """``work(chunk, batch, found)`` for each chunk; ``found`` is its list of (part, blob)."""
    if found is None:
        rows = chunks.select("chunk", "body")
    else:
        n = tasks_for(chunks)
        rows = chunks.select("chunk", "body").repartition(n, "chunk")
        rows = rows.join(found_per_chunk(found.repartition(n, "chunk"), "found"), "chunk", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                known = batch.column(2)[k].as_py() if batch.num_columns > 2 else None
                yield from work(batch.column(0)[k].as_py(), unpack(batch.column(1)[k].as_buffer()),
                                [(x["part"], x["blob"]) for x in known or []])
        rolling.release()  # the worker process lives on

    return map_arrow(rows, run, schema)


def merge_parts(found: DataFrame, work: Callable[[list[int], list[bytes]], Iterator[tuple[int, bytes]]],
                tasks: int) -> DataFrame:
    """Per part: ``work(part, chunks, blobs)`` yields (chunk, blob) answers -> (chunk, part, blob). The parts
    are dealt to ``tasks`` tasks."""
    def run(part_table: pa.Table) -> pa.Table:
        part = part_table.column("part")[0].as_py()
        answers = list(work(part, part_table.column("chunk").to_pylist(), part_table.column("blob").to_pylist()))
        return pa.table({"chunk": pa.array([c for c, _ in answers], pa.int64()),
                         "part": pa.array([part] * len(answers), pa.int64()),
                         "blob": pa.array([b for _, b in answers], pa.binary())})

    return found.repartition(tasks, "part").groupBy("part").applyInArrow(run, "chunk long, part long, blob binary")


def blob_rows(chunk: int, parts: np.ndarray, blobs: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([chunk] * len(blobs), pa.int64()), pa.array(parts, pa.int64()), pa.array(blobs, pa.binary())],
        names=["chunk", "part", "blob"])


BLOBS = "chunk long, part long, blob binary"
