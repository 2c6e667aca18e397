"""Token files: ids of whole documents in independent zstandard frames.

A file holds, in ascending doc_id order, the ids of its documents as little-endian unsigned 32-bit
integers, cut into frames of ``FRAME_IDS`` ids (the last one is shorter), each compressed on its own.
Two skippable frames follow: a document index (doc_id and first id of each document, as an Arrow
stream) and the seek table of the public zstandard seekable format: compressed size, decompressed
size and checksum (low 32 bits of XXH64 of the decompressed bytes) of every frame, then the number of
frames, a descriptor byte and the magic number. Any zstandard reader decompresses the whole file; a
reader of some documents seeks to their frames only.

Writing ranges the texts by doc_id, so files follow each other in that order, and each task writes one
file through Arrow's file systems under a name of its own. The manifest lists the files of the tasks
that succeeded; what a lost or repeated task left behind is not in it.

Edge cases: null doc_ids come first; rows that share a doc_id stand in the order of their text hashes;
a null or empty text has the end id alone; a document may span frames; an empty table gives an empty
manifest. Other columns do not take part.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import map_arrow, stage
from strata.llm.tokens import encode_column

FRAME_IDS = 1 << 16
LEVEL = 3
#: Fixed values of the zstandard and seekable formats.
SKIPPABLE, SEEK_SKIPPABLE, SEEKABLE_MAGIC, HAS_CHECKSUMS = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1, 0x80
_FOOTER = struct.Struct("<IBI")
_ENTRY = np.dtype([("packed", "<u4"), ("size", "<u4"), ("checksum", "<u4")])
MANIFEST = "part int, path string, n_docs long, n_ids long"
DOCUMENT = "doc_id long, start long, n_tokens long, ids binary"


def open_fs(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI as Spark writes it (``file:/x`` has one slash there)."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[5:]
    return pafs.FileSystem.from_uri(path)


class FrameWriter:
    """Appends documents to one file."""

    def __init__(self, sink):
        self.sink, self.zstd = sink, zstandard.ZstdCompressor(level=LEVEL)
        self.entries, self.docs, self.first = [], [], []
        self.held, self.n_held, self.n_ids = [], 0, 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc_id)
        self.first.append(self.n_ids)
        self.held.append(ids.astype("<u4", copy=False))
        self.n_held += len(ids)
        self.n_ids += len(ids)
        if self.n_held >= FRAME_IDS:
            self._cut(self.n_held // FRAME_IDS)

    def _cut(self, frames: int) -> None:
        ids = np.concatenate(self.held) if self.held else np.zeros(0, "<u4")
        for k in range(frames):
            raw = ids[k * FRAME_IDS:(k + 1) * FRAME_IDS].tobytes()
            packed = self.zstd.compress(raw)
            self.sink.write(packed)
            self.entries.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        rest = ids[frames * FRAME_IDS:]
        self.held, self.n_held = [rest], len(rest)

    def close(self) -> None:
        if self.n_held:
            self._cut(1)
        index = pa.BufferOutputStream()
        batch = pa.RecordBatch.from_arrays([pa.array(self.docs, pa.int64()), pa.array(self.first, pa.int64())], names=["doc_id", "first"])
        with pa.ipc.new_stream(index, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_batch(batch)
        index = index.getvalue().to_pybytes()
        table = np.array(self.entries, dtype=_ENTRY).tobytes() + _FOOTER.pack(len(self.entries), HAS_CHECKSUMS, SEEKABLE_MAGIC)
        # the index ends with its own length, so a reader finds it backwards from the seek table
        self.sink.write(struct.pack("<II", SKIPPABLE, len(index) + 4) + index + struct.pack("<I", len(index)))
        self.sink.write(struct.pack("<II", SEEK_SKIPPABLE, len(table)) + table)


class FrameReader:
    """Reads documents of one file, decompressing only the frames that hold them."""

    def __init__(self, source):
        self.source, size = source, source.size()
        n, flags, magic = _FOOTER.unpack(source.read_at(_FOOTER.size, size - _FOOTER.size))
        if magic != SEEKABLE_MAGIC or flags != HAS_CHECKSUMS:
            raise ValueError("not a token file")
        table_at = size - _FOOTER.size - n * _ENTRY.itemsize
        self.entries = np.frombuffer(source.read_at(n * _ENTRY.itemsize, table_at), dtype=_ENTRY)
        self.frame_at = np.concatenate(([0], np.cumsum(self.entries["packed"], dtype=np.int64)))
        length, = struct.unpack("<I", source.read_at(4, table_at - 12))
        with pa.ipc.open_stream(source.read_at(length, table_at - 12 - length)) as index:
            batch = index.read_next_batch()
        self.docs = batch.column(0).to_pylist()
        n_ids = int(self.entries["size"].sum(dtype=np.int64)) // 4
        self.bounds = np.concatenate((np.asarray(batch.column(1)), [n_ids]))
        self.zstd, self.cached = zstandard.ZstdDecompressor(), (-1, b"")

    def _frame(self, k: int) -> bytes:
        if self.cached[0] != k:
            size, checksum = int(self.entries["size"][k]), int(self.entries["checksum"][k])
            raw = self.zstd.decompress(self.source.read_at(int(self.entries["packed"][k]), int(self.frame_at[k])), max_output_size=size)
            if len(raw) != size or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != checksum:
                raise ValueError(f"frame {k} is damaged")
            self.cached = (k, raw)
        return self.cached[1]

    def ids(self, i: int) -> bytes:
        """The ids of the i-th document as little-endian bytes."""
        a, b = int(self.bounds[i]), int(self.bounds[i + 1])
        out = []
        for k in range(a // FRAME_IDS, (max(b - 1, a)) // FRAME_IDS + 1):
            base = k * FRAME_IDS
            out.append(self._frame(k)[4 * max(a - base, 0):4 * (min(b, base + FRAME_IDS) - base)])
        return b"".join(out)


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Writes the token files of ``docs`` into ``folder`` and returns their manifest (a written table:
    part, path, n_docs, n_ids; parts ascend with doc_id)."""
    fs, path = open_fs(folder)
    fs.create_dir(path, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        own = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.zst"
        fs, path = open_fs(own)
        sink = writer = None
        for batch in batches:
            if batch.num_rows and writer is None:
                sink = fs.open_output_stream(path, compression=None)
                writer = FrameWriter(sink)
            for doc, ids in zip(batch.column(0).to_pylist(), encode_column(batch.column(1), tokenizer, end_id), strict=True):
                writer.add(doc, ids)
        if writer is not None:
            writer.close()
            sink.close()
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([own]), pa.array([len(writer.docs)], pa.int64()),
                                              pa.array([writer.n_ids], pa.int64())], names=["part", "path", "n_docs", "n_ids"])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return stage(map_arrow(ranged, run, MANIFEST), "token-manifest")


def read(manifest: DataFrame) -> DataFrame:
    """Every document of the files: (doc_id, start, n_tokens, ids), ``start`` being the ids of all
    documents before it."""
    n_files = max(1, manifest.count())
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    files = manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                fs, at = open_fs(path)
                with fs.open_input_file(at) as source:
                    reader = FrameReader(source)
                    for k in range(0, len(reader.docs), 1024):
                        own = reader.docs[k:k + 1024]
                        bounds = reader.bounds[k:k + len(own) + 1]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(own, pa.int64()), pa.array(bounds[:-1] + base), pa.array(np.diff(bounds)),
                             pa.array([reader.ids(k + j) for j in range(len(own))], pa.binary())],
                            names=["doc_id", "start", "n_tokens", "ids"])

    return map_arrow(files.select("path", "base").repartition(n_files), run, DOCUMENT)


def read_documents(path: str, doc_ids: Sequence[int]) -> dict[int, np.ndarray]:
    """The ids of some documents of one file; only their frames are read."""
    fs, at = open_fs(path)
    with fs.open_input_file(at) as source:
        reader = FrameReader(source)
        wanted = set(doc_ids)
        return {d: np.frombuffer(reader.ids(i), dtype="<u4") for i, d in enumerate(reader.docs) if d in wanted}
