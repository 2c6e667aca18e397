"""Substring dedup: words covered by a window of words that also starts earlier are removed.

Three passes over written chunks of text:

1. Each chunk puts its window hashes into a count-min sketch (``DEPTH`` rows of cells) of its own.
   The sketches travel as sparse sorted cells, cut into parts of the cell range; each part adds the
   sketches of all chunks up and tells every chunk which of its cells hold two windows or more.
   Cells are as many as the corpus has bytes, so the sketch grows with the input; a part is always
   a bounded array in one task, and no task or driver holds the whole sketch.
2. A sketch never undercounts, so only windows whose cells are all repeated can repeat. Each chunk
   keeps the earliest start of such a window and removes the later ones; one entry per window and
   chunk goes to a part chosen by its hash, where windows are grouped by 96-bit hash (its steps mix, see ``rolling``) and all but the
   earliest start are sent back. A window in a third of all documents costs one entry per chunk.
3. Each chunk drops the words that removed windows cover.

"Earlier" is smaller doc_id, or same doc_id and earlier start. Edge cases: a null doc_id stands before
all others; rows that share a doc_id count as one document, so equal starts in them are equally early
and both stay; a null or empty text has no words; texts under one window lose nothing; an empty table
gives an empty result. All other columns pass through.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.chunks import BLOBS, blob_rows, body_of, chunked, map_chunks, merge_parts, squeeze, tasks_for, unsqueeze
from strata.llm.rolling import window_hashes, windows, word_hashes, words

WINDOW = 20
PART_BYTES = 32 << 20  # bytes of text whose repeated windows meet in one part of the exact grouping
_TURNS = (1, 0x9E3779B97F4A7C15)  # one odd multiplier for each row of the sketch
DEPTH = len(_TURNS)
_NULL_ID = np.iinfo(np.int64).min


def sketch_shape(n_bytes: int) -> tuple[int, int]:
    """(log2 of the cells in a row, log2 of the cells in a part) for a corpus of ``n_bytes``."""
    width = max(20, (max(n_bytes, 1) - 1).bit_length())
    return width, min(max(width - 8, 18), 27)


def _cells(hashes: np.ndarray, row: int, width: int) -> np.ndarray:
    """The cell of each window in a row of the sketch; rows are laid out one after the other."""
    return (hashes * np.uint64(_TURNS[row]) >> np.uint64(64 - width)) + np.uint64(row << width)


def _text(batch: pa.RecordBatch, text: str) -> tuple[np.ndarray, np.ndarray]:
    return body_of(batch.column(batch.schema.names.index(text)))


def _sketch(chunks: DataFrame, text: str, length: int, width: int, part: int) -> DataFrame:
    def work(chunk: int, batch: pa.RecordBatch, _: list) -> Iterator[pa.RecordBatch]:
        body, offsets = _text(batch, text)
        start, end, first = words(body, offsets)
        hashes = word_hashes(body, start, end)
        hashes = window_hashes(hashes, windows(hashes, first, length), length)
        for row in range(DEPTH):
            cells = np.sort(_cells(hashes, row, width))
            new = np.concatenate(([True], cells[1:] != cells[:-1])) if len(cells) else np.zeros(0, bool)
            at = np.flatnonzero(new)
            many = np.diff(np.concatenate((at, [len(cells)]))) > 1
            cells = cells[at]
            parts = cells >> np.uint64(part)
            code = ((cells & np.uint64((1 << part) - 1)) << np.uint64(1) | many).astype(np.uint32)
            cut = np.flatnonzero(np.concatenate(([True], parts[1:] != parts[:-1]))) if len(parts) else np.zeros(0, int)
            if len(cut):
                blobs = [squeeze(np.diff(x, prepend=np.uint32(0))) for x in np.split(code, cut[1:])]
                yield blob_rows(chunk, parts[cut].astype(np.int64), blobs)

    return map_chunks(chunks, work, BLOBS)


def _repeated_cells(sketches: DataFrame, part: int, tasks: int) -> DataFrame:
    """(chunk, part, blob): the cells of each chunk that hold two windows or more in the whole corpus."""
    def work(_: int, chunk_ids: list[int], blobs: list[bytes]) -> Iterator[tuple[int, bytes]]:
        merged = np.zeros(1 << part, dtype=np.uint8)  # counts up to 2 are all that is asked of them
        for blob in blobs:
            code = np.cumsum(unsqueeze(blob, np.uint32), dtype=np.uint32)
            cells = code >> 1
            merged[cells] = np.minimum(merged[cells] + 1 + (code & 1), 2)
        for chunk, blob in zip(chunk_ids, blobs, strict=True):
            cells = np.cumsum(unsqueeze(blob, np.uint32), dtype=np.uint32) >> 1
            cells = cells[merged[cells] > 1]
            if len(cells):
                yield chunk, squeeze(np.diff(cells, prepend=np.uint32(0)))

    return merge_parts(sketches, work, tasks)


def _member(values: np.ndarray, sorted_set: np.ndarray) -> np.ndarray:
    if not len(sorted_set):
        return np.zeros(len(values), dtype=bool)
    at = np.searchsorted(sorted_set, values)
    at[at == len(sorted_set)] = 0
    return sorted_set[at] == values


_ENTRY = np.dtype([("h1", "<u8"), ("h2", "<u4"), ("id", "<i8"), ("start", "<u4"), ("row", "<u4")])


def _join(blobs: list[bytes]) -> bytes:
    return struct.pack(f"<{len(blobs)}I", *map(len, blobs)) + b"".join(blobs)


def _split(blob: bytes, n: int) -> Iterator[bytes]:
    at = 4 * n
    for size in struct.unpack_from(f"<{n}I", blob):
        yield blob[at:at + size]
        at += size


def _squeeze_places(e: np.ndarray) -> bytes:
    """Row and start of entries, which are in that order."""
    return _join([squeeze(np.diff(e["row"], prepend=np.uint32(0))), squeeze(e["start"])])


def _unsqueeze_places(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    rows, starts = _split(blob, 2)
    return np.cumsum(unsqueeze(rows, "<u4"), dtype=np.uint32), unsqueeze(starts, "<u4")


def _squeeze_entries(e: np.ndarray) -> bytes:
    return _join([squeeze(e["h1"]), squeeze(e["h2"]), squeeze(np.diff(e["id"], prepend=np.int64(0))), _squeeze_places(e)])


def _unsqueeze_entries(blob: bytes) -> np.ndarray:
    h1, h2, ids, places = _split(blob, 4)
    h1 = unsqueeze(h1, "<u8")
    e = np.empty(len(h1), dtype=_ENTRY)
    e["h1"], e["h2"], e["id"] = h1, unsqueeze(h2, "<u4"), np.cumsum(unsqueeze(ids, "<i8"))
    e["row"], e["start"] = _unsqueeze_places(places)
    return e


def _later(e: np.ndarray) -> np.ndarray:
    """Which entries start later than the earliest entry of their window."""
    order = np.lexsort((e["start"], e["id"], e["h2"], e["h1"]))
    s = e[order]
    new = np.ones(len(s), dtype=bool)
    new[1:] = (s["h1"][1:] != s["h1"][:-1]) | (s["h2"][1:] != s["h2"][:-1])
    head = np.flatnonzero(new)[np.cumsum(new) - 1] if len(s) else np.zeros(0, int)
    later = np.empty(len(s), dtype=bool)
    later[order] = (s["id"] != s["id"][head]) | (s["start"] != s["start"][head])
    return later


def _candidates(chunks: DataFrame, repeated: DataFrame, key: str, text: str, length: int, width: int, part: int,
                log_parts: int) -> DataFrame:
    def work(chunk: int, batch: pa.RecordBatch, found: list) -> Iterator[pa.RecordBatch]:
        if not found:
            return
        body, offsets = _text(batch, text)
        start, end, first = words(body, offsets)
        w1 = word_hashes(body, start, end)
        at = windows(w1, first, length)
        h1 = window_hashes(w1, at, length)
        known = np.concatenate([np.cumsum(unsqueeze(b, np.uint32), dtype=np.uint64) + np.uint64(p << part)
                                for p, b in sorted(found)])
        hit = np.ones(len(h1), dtype=bool)
        for row in range(DEPTH):
            hit &= _member(_cells(h1, row, width), known)
        at, h1 = at[hit], h1[hit]
        ids = np.asarray(batch.column(batch.schema.names.index(key)).cast(pa.int64()).fill_null(_NULL_ID))
        e = np.empty(len(at), dtype=_ENTRY)
        rows = np.searchsorted(first, at, side="right") - 1
        e["h1"], e["h2"] = h1, window_hashes(word_hashes(body, start, end, 1), at, length, 1) >> np.uint64(32)
        e["id"], e["row"], e["start"] = ids[rows], rows, at - first[rows]
        later = _later(e)
        if later.any():
            yield blob_rows(chunk, np.array([-1 - chunk]), [_squeeze_places(e[later])])  # settled here
        e = e[~later]
        parts = (e["h1"] >> np.uint64(64 - log_parts)).astype(np.int64)
        order = np.argsort(parts, kind="stable")
        parts, cut = np.unique(parts[order], return_index=True)
        if len(parts):
            yield blob_rows(chunk, parts, [_squeeze_entries(x) for x in np.split(e[order], cut[1:])])

    return map_chunks(chunks, work, BLOBS, repeated)



def _removed(candidates: DataFrame, tasks: int) -> DataFrame:
    """(chunk, part, blob): the places in each chunk whose window starts earlier somewhere."""
    def work(part: int, chunk_ids: list[int], blobs: list[bytes]) -> Iterator[tuple[int, bytes]]:
        if part < 0:
            yield from zip(chunk_ids, blobs, strict=True)
            return
        lists = [_unsqueeze_entries(b) for b in blobs]
        later = np.split(_later(np.concatenate(lists)), np.cumsum([len(x) for x in lists])[:-1])
        for chunk, e, which in zip(chunk_ids, lists, later, strict=True):
            if which.any():
                yield chunk, _squeeze_places(e[which])

    return merge_parts(candidates, work, tasks)


def _kept(chunks: DataFrame, removed: DataFrame, text: str, length: int, columns: list[str], schema: T.StructType) -> DataFrame:
    def work(_: int, batch: pa.RecordBatch, found: list) -> Iterator[pa.RecordBatch]:
        body, offsets = _text(batch, text)
        start, end, first = words(body, offsets)
        edge = np.zeros(len(start) + 1, dtype=np.int32)
        for _, blob in found:
            rows, starts = _unsqueeze_places(blob)
            at = first[rows] + starts
            np.add.at(edge, at, 1)
            np.add.at(edge, at + length, -1)
        gone = np.cumsum(edge[:-1]) > 0
        lost = np.concatenate(([0], np.cumsum(gone)))
        kept, raw = [], body.tobytes()
        for k in range(batch.num_rows):
            a, b = first[k], first[k + 1]
            if lost[b] > lost[a]:
                own = raw[offsets[k]:offsets[k + 1]].split()
                kept.append(b" ".join([own[i] for i in np.flatnonzero(~gone[a:b]).tolist()]))
            else:
                kept.append(b" ".join(raw[offsets[k]:offsets[k + 1]].split()))
        out = [batch.column(batch.schema.names.index(c)) for c in columns]
        out = [x.cast(pa.string()) if c == text else x for c, x in zip(columns, out, strict=True)]
        out += [pa.array(np.diff(first), pa.int64()), pa.array(lost[first[1:]] - lost[first[:-1]], pa.int64()),
                pa.array(kept, pa.binary()).cast(pa.string())]
        yield pa.RecordBatch.from_arrays(out, names=schema.names)

    return map_chunks(chunks, work, schema, removed)


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` with ``_d_words`` (words), ``_d_removed`` (of them removed) and ``_d_kept``
    (the words that stay, joined by one space)."""
    chunks = chunked(docs, text)
    n_bytes = int(chunks.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0])
    width, part = sketch_shape(n_bytes)
    log_parts = max(4, (n_bytes // PART_BYTES).bit_length())
    tasks = tasks_for(chunks)
    repeated = _repeated_cells(_sketch(chunks, text, length, width, part), part, tasks)
    removed = _removed(_candidates(chunks, repeated, key, text, length, width, part, log_parts), tasks)
    schema = T.StructType([*docs.schema.fields, T.StructField("_d_words", T.LongType()),
                           T.StructField("_d_removed", T.LongType()), T.StructField("_d_kept", T.StringType())])
    return _kept(chunks, removed, text, length, docs.columns, schema)


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = WINDOW) -> DataFrame:
    """``docs`` without repeated passages: a text that lost words holds what stays, other texts are
    unchanged, and documents that lost all their words go. ``n_chars`` follows the text, if present."""
    out = dedup(docs, key, text, length)
    out = out.filter((F.col("_d_removed") == 0) | (F.col("_d_removed") < F.col("_d_words")))
    out = out.withColumn(text, F.when(F.col("_d_removed") > 0, F.col("_d_kept")).otherwise(F.col(text)))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length(text).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
