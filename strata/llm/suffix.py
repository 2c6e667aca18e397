"""Suffix-array dedup: bytes covered by a long string that also starts somewhere else are removed.

Sorting every suffix of the corpus would move its text many times over, so the array is sparse. Of
the ``LENGTH // 2``-byte strings in each window of ``LENGTH`` bytes, the one with the least hash is the
window's anchor; equal windows have equal anchors at equal places, so it is enough to sort the suffixes
that start at anchors, each with the bytes before it, and every window is looked at from its anchor.

1. Each chunk lists the hashes of its anchors; parts of the hash range count them over all chunks.
   An anchor that occurs once settles its windows: they are unique.
2. The suffixes at repeated anchors go to buckets by range: splitters are sampled from the suffixes,
   and compared on all leading bytes that a window can hold, then on the bytes before the anchor, so
   an anchor in a third of all documents is spread over many buckets. Equal contexts within a chunk
   are sent once.
3. A bucket sorts its suffixes by multikey quicksort, and their preceding bytes likewise. Runs of
   neighbours with a long enough common prefix on either side are the windows that occur twice. Where
   splitters cut through the suffixes of one anchor, its windows are also compared across buckets, by
   128-bit hash.
4. Each chunk drops the bytes that its repeated windows cover.

Edge cases: a null text is empty; texts shorter than ``LENGTH`` lose nothing; repeated rows are
different places, whatever their doc_id; runs of one byte are windows that overlap their copies and
go; an empty table gives an empty result. All other columns pass through. What stays is bytes: a cut
may fall inside a character.
"""

from __future__ import annotations

import struct
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.chunks import BLOBS, blob_rows, body_of, chunked, map_chunks, merge_parts, squeeze, tasks_for, unsqueeze
from strata.llm.common import stage
from strata.llm.rolling import BASES, all_windows, byte_values, mix, powers, sliding, spans
from strata.llm.suffix_sort import as_tokens, common_prefix, multikey_sort

LENGTH = 200
PART_BYTES = 64 << 20    # bytes of text whose anchors meet in one part
BUCKET_BYTES = 16 << 20  # bytes of text that make one more bucket
SAMPLES = 20             # sampled suffixes per bucket
MOST_SAMPLES = 1_000_000
_HASH_SHIFT = np.uint64(16)  # 48 bits of an anchor's hash are sent


def _join(blobs: list[bytes]) -> bytes:
    return struct.pack(f"<{len(blobs)}I", *map(len, blobs)) + b"".join(blobs)


def _split(blob: bytes, n: int) -> list[bytes]:
    out, at = [], 4 * n
    for size in struct.unpack_from(f"<{n}I", blob):
        out.append(blob[at:at + size])
        at += size
    return out


def anchors(body: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, hash) of the anchors of all windows of ``length`` bytes that lie in one document."""
    half = length // 2
    hashes = all_windows(byte_values(body), half, BASES[0])
    width = length - half + 1
    least = sliding(hashes, width, np.minimum)
    inside = np.zeros(len(least) + 1, dtype=np.int32)
    size = np.diff(offsets)
    long = size >= length
    np.add.at(inside, offsets[:-1][long], 1)
    np.add.at(inside, offsets[1:][long] - length + 1, -1)
    least = np.where(np.cumsum(inside[:-1]) > 0, least, 0)
    edge = np.zeros(width - 1, dtype=np.uint64)
    most = sliding(np.concatenate((edge, least, edge)), width, np.maximum)  # by k-gram position
    at = np.flatnonzero((most == hashes) & (most > 0)) if len(least) else np.zeros(0, dtype=np.int64)
    return at, hashes[at]


class _Contexts:
    """The bytes around anchors: up to ``before`` in front, up to ``length`` from the anchor on."""

    def __init__(self, at: np.ndarray, offsets: np.ndarray, length: int):
        doc = np.searchsorted(offsets, at, side="right") - 1
        self.at = at
        self.before = np.minimum(at - offsets[doc], length - length // 2)
        self.after = np.minimum(offsets[doc + 1] - at, length)

    def __getitem__(self, which) -> _Contexts:
        own = object.__new__(_Contexts)
        own.at, own.before, own.after = self.at[which], self.before[which], self.after[which]
        return own

    def key(self, raw: bytes, i: int) -> bytes:
        """What suffixes are ranged by: bytes from the anchor on, then the bytes before it, backwards."""
        p = int(self.at[i])
        return raw[p:p + int(self.after[i])] + raw[p - int(self.before[i]):p][::-1]


def _distinct_hashes(hashes: np.ndarray, log_parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(sorted 48-bit hashes, whether each occurs twice, parts, where each part starts)."""
    h = np.sort(hashes >> _HASH_SHIFT)
    first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))) if len(h) else np.zeros(0, np.int64)
    many = np.diff(np.concatenate((first, [len(h)]))) > 1
    h = h[first]
    parts, cut = np.unique(h >> np.uint64(48 - log_parts), return_index=True)
    return h, many, parts.astype(np.int64), cut


_SAMPLE = -1


def _anchor_lists(chunks: DataFrame, text: str, length: int, log_parts: int, rate: float) -> DataFrame:
    def work(chunk: int, batch: pa.RecordBatch, _: list) -> Iterator[pa.RecordBatch]:
        body, offsets = body_of(batch.column(batch.schema.names.index(text)))
        at, hashes = anchors(body, offsets, length)
        h, many, parts, cut = _distinct_hashes(hashes, log_parts)
        if len(parts):
            yield blob_rows(chunk, parts, [_join([squeeze(np.diff(x, prepend=np.uint64(0))), np.packbits(m).tobytes()])
                                           for x, m in zip(np.split(h, cut[1:]), np.split(many, cut[1:]), strict=True)])
        taken = np.flatnonzero(np.random.default_rng(chunk).random(len(at)) < rate)
        if len(taken):
            near, raw = _Contexts(at[taken], offsets, length), body.tobytes()
            yield blob_rows(chunk, np.full(len(taken), _SAMPLE), [near.key(raw, i) for i in range(len(taken))])

    return map_chunks(chunks, work, BLOBS)


def _repeated_anchors(lists: DataFrame, tasks: int) -> DataFrame:
    """(chunk, part, blob): which of each chunk's sorted hashes occur twice or more in the corpus, as bits."""
    def work(_: int, chunk_ids: list[int], blobs: list[bytes]) -> Iterator[tuple[int, bytes]]:
        hashes, many = [], []
        for blob in blobs:
            h, m = _split(blob, 2)
            hashes.append(np.cumsum(unsqueeze(h, "<u8"), dtype=np.uint64))
            many.append(np.unpackbits(np.frombuffer(m, np.uint8), count=len(hashes[-1])).astype(bool))
        flat = np.concatenate(hashes)
        order = np.argsort(flat, kind="stable")
        same = flat[order][1:] == flat[order][:-1]
        twice = np.zeros(len(flat), dtype=bool)
        twice[order[1:]] |= same
        twice[order[:-1]] |= same
        twice |= np.concatenate(many)
        for chunk, own in zip(chunk_ids, np.split(twice, np.cumsum([len(h) for h in hashes])[:-1]), strict=True):
            yield chunk, np.packbits(own).tobytes()

    return merge_parts(lists, work, tasks)


def splitters(keys: list[bytes], buckets: int, half: int) -> tuple[list[bytes], set[bytes]]:
    """(splitters, anchors that they cut through) from sampled keys. A splitter is cut to the anchor
    of its key, so that the anchor's suffixes stay together, unless the one before has that anchor too."""
    keys = sorted(keys)
    out: list[bytes] = []
    cut: set[bytes] = set()
    for k in range(1, buckets):
        key = keys[len(keys) * k // buckets] if keys else b""
        if out and out[-1][:half] == key[:half]:
            if key > out[-1]:
                out.append(key)
                cut.add(key[:half])
        elif key:
            out.append(key[:half])
    return out, cut


def _suffixes(chunks: DataFrame, repeated: DataFrame, text: str, length: int, log_parts: int, split: list[bytes]) -> DataFrame:
    """Rows for buckets (part: bucket, blob: suffixes with contexts) and settled spans (part < 0)."""
    def work(chunk: int, batch: pa.RecordBatch, found: list) -> Iterator[pa.RecordBatch]:
        body, offsets = body_of(batch.column(batch.schema.names.index(text)))
        at, hashes = anchors(body, offsets, length)
        h, _, parts, cut = _distinct_hashes(hashes, log_parts)
        bits = dict(found)
        sizes = np.diff(np.concatenate((cut, [len(h)])))
        again = np.concatenate([np.unpackbits(np.frombuffer(bits[p], np.uint8), count=n).astype(bool)
                                for p, n in zip(parts.tolist(), sizes.tolist(), strict=True)]) if len(h) else np.zeros(0, bool)
        at = at[again[np.searchsorted(h, hashes >> _HASH_SHIFT)]]
        if not len(at):
            return
        near = _Contexts(at, offsets, length)
        # equal contexts within the chunk: all their windows occur twice, and one of them travels on
        a, b = near.at - near.before, near.at + near.after
        ident = np.empty(len(at), dtype=[("x", "<u8"), ("y", "<u8"), ("a", "<i8"), ("b", "<i8")])
        ident["x"], ident["y"] = (spans(byte_values(body, w), a, b, BASES[w]) for w in (0, 1))
        ident["a"], ident["b"] = near.before, near.after
        order = np.lexsort((ident["b"], ident["a"], ident["y"], ident["x"]))
        new = np.concatenate(([True], ident[order][1:] != ident[order][:-1]))
        count = np.diff(np.concatenate((np.flatnonzero(new), [len(at)])))
        many = np.empty(len(at), dtype=bool)
        many[order] = np.repeat(count > 1, count)
        if many.any():
            yield blob_rows(chunk, np.array([-1 - chunk]), [_squeeze_spans(a[many], b[many])])
        lead = np.sort(order[new])
        near, settled, raw = near[lead], many[lead], body.tobytes()
        bucket = np.fromiter((bisect_right(split, near.key(raw, i)) for i in range(len(lead))), dtype=np.int64, count=len(lead))
        order = np.argsort(bucket, kind="stable")
        names, first = np.unique(bucket[order], return_index=True)
        yield blob_rows(chunk, names, [_pack_contexts(body, near[x], settled[x]) for x in np.split(order, first[1:])])

    return map_chunks(chunks, work, BLOBS, repeated)


def _squeeze_spans(start: np.ndarray, end: np.ndarray) -> bytes:
    order = np.argsort(start, kind="stable")
    start, end = start[order], end[order]
    return _join([squeeze(np.diff(start, prepend=0).astype(np.uint32)), squeeze((end - start).astype(np.uint32))])


def _unsqueeze_spans(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    start, size = (unsqueeze(x, "<u4") for x in _split(blob, 2))
    start = np.cumsum(start, dtype=np.int64)
    return start, start + size


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, .. (size[0] of them), start[1], .."""
    ends = np.cumsum(size)
    return np.repeat(start - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)


def _pack_contexts(body: np.ndarray, near: _Contexts, settled: np.ndarray) -> bytes:
    around = body[_ranges(near.at - near.before, near.before + near.after)]
    return _join([zstandard.ZstdCompressor(level=3).compress(around.tobytes()), squeeze(near.before.astype(np.uint16)),
                  squeeze(near.after.astype(np.uint16)), squeeze(near.at.astype(np.uint32)), np.packbits(settled).tobytes()])


class _Bucket:
    """The suffixes of one bucket, from all chunks."""

    def __init__(self, chunk_ids: list[int], blobs: list[bytes], length: int):
        self.length, self.half = length, length - length // 2
        parts = [_split(b, 5) for b in blobs]
        before, after, at = ([unsqueeze(p[k], t).astype(np.int64) for p in parts] for k, t in ((1, "<u2"), (2, "<u2"), (3, "<u4")))
        sizes = [len(x) for x in at]
        self.settled = np.concatenate([np.unpackbits(np.frombuffer(p[4], np.uint8), count=n).astype(bool)
                                       for p, n in zip(parts, sizes, strict=True)])
        self.chunk = np.repeat(np.array(chunk_ids, dtype=np.int64), sizes)
        self.before, self.after, self.at = map(np.concatenate, (before, after, at))
        around = np.frombuffer(b"".join(zstandard.ZstdDecompressor().decompress(p[0]) for p in parts), dtype=np.uint8)
        own = self.before + self.after
        anchor = np.cumsum(own) - own + self.before
        self.right = self._rows(around, anchor, np.arange(length), self.after)
        self.left = self._rows(around, anchor, -1 - np.arange(self.half), self.before)

    @staticmethod
    def _rows(around: np.ndarray, anchor: np.ndarray, step: np.ndarray, size: np.ndarray) -> np.ndarray:
        """One row of bytes per suffix, zero beyond its size."""
        out = np.zeros((len(anchor), len(step)), dtype=np.uint8)
        for k in range(0, len(anchor), 1 << 14):
            at = anchor[k:k + (1 << 14), None] + step[None, :]
            known = np.arange(len(step))[None, :] < size[k:k + (1 << 14), None]
            out[k:k + (1 << 14)] = np.where(known, around[np.where(known, at, 0)], 0)
        return out

    def solve(self, cut: set[bytes], log_parts: int) -> Iterator[tuple[int, int, bytes]]:
        """(chunk, part, blob): settled spans of each chunk (part < 0), and windows to compare across
        buckets, by parts of their hash range (chunk -1)."""
        n, length = len(self.at), self.length
        sizes = (self.after << 16 | self.before).astype(np.uint64)[:, None]
        tokens = np.concatenate((as_tokens(self.right), as_tokens(self.left), sizes), axis=1)
        order = multikey_sort(tokens)
        new = np.concatenate(([True], (tokens[order[1:]] != tokens[order[:-1]]).any(axis=1)))  # distinct contexts
        shared = common_prefix(self.right, order)
        group = np.cumsum(shared < length // 2)  # suffixes with one anchor
        kind = np.cumsum(new) - 1
        lead = order[new]
        copies = np.bincount(kind)
        prefix, group = shared[new], group[new]
        low, high = np.full(len(lead), length), np.full(len(lead), -1)
        kinds = np.bincount(group)
        several = np.flatnonzero(kinds[group] > 1)
        if len(several):
            self._windows(lead[several], group[several], prefix[several], several, low, high)
        whole = (copies > 1) | self.settled[lead]
        low = np.where(whole, np.maximum(0, length - self.after[lead]), low)
        high = np.where(whole, self.before[lead], high)
        at, chunk, own = self.at[order], self.chunk[order], kind
        hit = high[own] >= 0
        start, end = (at - high[own])[hit], (at - low[own] + length)[hit]
        chunk = chunk[hit]
        for c in np.unique(chunk).tolist():
            mine = chunk == c
            yield c, -1 - c, _squeeze_spans(start[mine], end[mine])
        if cut:
            half = length // 2
            apart = np.array([bytes(r) in cut for r in self.right[lead, :half]], dtype=bool)
            if apart.any():
                yield from self._to_compare(lead[apart], whole[apart], low[apart], high[apart], log_parts)

    def _windows(self, lead: np.ndarray, group: np.ndarray, prefix: np.ndarray, place: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        """For distinct contexts that share their anchor with others: the least and the greatest number
        of bytes before the anchor with which a window occurs twice. ``lead`` is in suffix order."""
        n, length = len(lead), self.length
        tokens = np.concatenate((group.astype(np.uint64)[:, None], as_tokens(self.left[lead])), axis=1)
        by_left = multikey_sort(tokens)
        left_prefix = common_prefix(self.left[lead], by_left)
        left_prefix[group[by_left] != np.concatenate(([-1], group[by_left][:-1]))] = -1
        prefix = prefix.copy()
        prefix[group != np.concatenate(([-1], group[:-1]))] = -1
        before, after = self.before[lead], self.after[lead]
        run = np.empty(n, dtype=np.int64)
        for d in range(self.half + 1):
            there = np.flatnonzero((before >= d) & (after >= length - d))
            run[by_left] = np.cumsum(left_prefix < d)
            pair = (np.cumsum(prefix < length - d) * (n + 1) + run)[there]
            by_pair = np.argsort(pair, kind="stable")
            same = pair[by_pair][1:] == pair[by_pair][:-1]
            twice = np.zeros(len(there), dtype=bool)
            twice[by_pair[1:]] |= same
            twice[by_pair[:-1]] |= same
            hit = place[there[twice]]
            low[hit] = np.minimum(low[hit], d)
            high[hit] = d

    def _to_compare(self, lead: np.ndarray, whole: np.ndarray, low: np.ndarray, high: np.ndarray,
                    log_parts: int) -> Iterator[tuple[int, int, bytes]]:
        """The windows of these contexts, each once: two hashes, and chunk and start where it occurs
        once in the bucket so far (chunk -1 where it is known to occur twice)."""
        found = []
        for k in range(0, len(lead), 4096):
            own = lead[k:k + 4096]
            row = np.concatenate((self.left[own][:, ::-1], self.right[own]), axis=1)
            totals = []
            for which in (0, 1):
                values = byte_values(row, which) * powers(BASES[which], row.shape[1])[None, :]
                totals.append(np.concatenate((np.zeros((len(own), 1), np.uint64), np.cumsum(values, axis=1, dtype=np.uint64)), axis=1))
            for d in range(self.half + 1):
                there = np.flatnonzero((self.before[own] >= d) & (self.after[own] >= self.length - d))
                e = np.empty(len(there), dtype=_WINDOW)
                at = self.half - d
                e["x"], e["y"] = (mix((t[there, at + self.length] - t[there, at]) + np.uint64(d)) for t in totals)
                known = whole[k + there] | ((low[k + there] <= d) & (d <= high[k + there]))
                e["chunk"] = np.where(known, -1, self.chunk[own[there]])
                e["start"] = np.where(known, 0, self.at[own[there]] - d)
                found.append(e)
        e = np.concatenate(found)
        e = e[np.lexsort((e["chunk"], e["y"], e["x"]))]
        new = np.concatenate(([True], (e["x"][1:] != e["x"][:-1]) | (e["y"][1:] != e["y"][:-1])))
        keep = new | (e["chunk"] >= 0)
        e = e[keep]
        parts, first = np.unique(e["x"] >> np.uint64(64 - log_parts), return_index=True)
        for part, own in zip(parts.tolist(), np.split(e, first[1:]), strict=True):
            yield -1, part, _join([squeeze(own[c]) for c in _WINDOW.names])


_WINDOW = np.dtype([("x", "<u8"), ("y", "<u8"), ("chunk", "<i8"), ("start", "<u4")])


def _solve_buckets(rows: DataFrame, length: int, cut: set[bytes], log_parts: int, tasks: int) -> DataFrame:
    def run(table: pa.Table) -> pa.Table:
        if table.column("part")[0].as_py() < 0:
            return table.select(["chunk", "part", "blob"])  # spans that their chunk has settled
        bucket = _Bucket(table.column("chunk").to_pylist(), table.column("blob").to_pylist(), length)
        out = list(bucket.solve(cut, log_parts))
        return pa.table({"chunk": pa.array([x[0] for x in out], pa.int64()), "part": pa.array([x[1] for x in out], pa.int64()),
                         "blob": pa.array([x[2] for x in out], pa.binary())})

    return rows.repartition(tasks, "part").groupBy("part").applyInArrow(run, BLOBS)


def _across(solved: DataFrame, length: int, tasks: int) -> DataFrame:
    """All repeated spans: settled ones as they are, and those of windows found in two buckets."""
    def work(part: int, chunk_ids: list[int], blobs: list[bytes]) -> Iterator[tuple[int, bytes]]:
        if part < 0:
            yield from zip(chunk_ids, blobs, strict=True)
            return
        lists = [[unsqueeze(x, _WINDOW[c]) for x, c in zip(_split(b, 4), _WINDOW.names, strict=True)] for b in blobs]
        x, y, chunk, start = (np.concatenate(c) for c in zip(*lists, strict=True))
        order = np.lexsort((y, x))
        same = (x[order][1:] == x[order][:-1]) & (y[order][1:] == y[order][:-1])
        twice = np.zeros(len(x), dtype=bool)
        twice[order[1:]] |= same
        twice[order[:-1]] |= same
        twice &= chunk >= 0
        for c in np.unique(chunk[twice]).tolist():
            own = start[twice & (chunk == c)].astype(np.int64)
            yield c, _squeeze_spans(own, own + length)

    return merge_parts(solved, work, tasks)


def _kept(chunks: DataFrame, removed: DataFrame, text: str, columns: list[str], schema: T.StructType) -> DataFrame:
    def work(_: int, batch: pa.RecordBatch, found: list) -> Iterator[pa.RecordBatch]:
        body, offsets = body_of(batch.column(batch.schema.names.index(text)))
        edge = np.zeros(len(body) + 1, dtype=np.int32)
        for _, blob in found:
            start, end = _unsqueeze_spans(blob)
            np.add.at(edge, start, 1)
            np.add.at(edge, end, -1)
        gone = np.cumsum(edge[:-1]) > 0
        lost = np.concatenate(([0], np.cumsum(gone)))
        begins = gone.copy()
        begins[1:] &= ~gone[:-1]
        first = np.unique(offsets[:-1][offsets[:-1] < len(body)])
        begins[first] = gone[first]
        runs = np.concatenate(([0], np.cumsum(begins)))
        kept = [body[a:b].tobytes() if lost[a] == lost[b] else body[a:b][~gone[a:b]].tobytes()
                for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        out = [batch.column(batch.schema.names.index(c)) for c in columns]
        out = [x.cast(pa.string()) if c == text else x for c, x in zip(columns, out, strict=True)]
        out += [pa.array(np.diff(offsets), pa.int64()), pa.array(np.diff(lost[offsets]), pa.int64()),
                pa.array(np.diff(runs[offsets]), pa.int64()), pa.array(kept, pa.binary())]
        yield pa.RecordBatch.from_arrays(out, names=schema.names)

    return map_chunks(chunks, work, schema, removed)


def dedup(docs: DataFrame, text: str = "text", length: int = LENGTH) -> DataFrame:
    """The rows of ``docs`` with ``_x_bytes`` (bytes), ``_x_removed`` (of them removed), ``_x_spans``
    (maximal removed runs) and ``_x_kept`` (the bytes that stay)."""
    chunks = chunked(docs, text)
    n_bytes = int(chunks.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0])
    log_parts = max(4, (n_bytes // PART_BYTES).bit_length())
    buckets = max(2, n_bytes // BUCKET_BYTES)
    n_anchors = max(1, 2 * n_bytes // (length - length // 2 + 2))
    rate = min(1.0, min(SAMPLES * buckets, MOST_SAMPLES) / n_anchors)
    lists = stage(_anchor_lists(chunks, text, length, log_parts, rate), "anchors")
    sample = lists.filter(F.col("part") == _SAMPLE).select("blob").collect()  # about MOST_SAMPLES at most
    split, cut = splitters([bytes(r["blob"]) for r in sample], buckets, length // 2)
    tasks = tasks_for(chunks)
    repeated = _repeated_anchors(lists.filter(F.col("part") != _SAMPLE), tasks)
    suffixes = _suffixes(chunks, repeated, text, length, log_parts, split)
    removed = _across(_solve_buckets(suffixes, length, cut, log_parts, tasks), length, tasks)
    schema = T.StructType([*docs.schema.fields, T.StructField("_x_bytes", T.LongType()), T.StructField("_x_removed", T.LongType()),
                           T.StructField("_x_spans", T.LongType()), T.StructField("_x_kept", T.BinaryType())])
    return _kept(chunks, removed, text, docs.columns, schema)
