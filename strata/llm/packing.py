"""Best-fit packing with certified bounds.

Documents become pieces of at most ``CAPACITY`` tokens; full pieces are sequences of their own. The
others are dealt over partitions, and each partition packs its own by best-fit decreasing. Dual
feasible functions give a lower bound of the bins that its pieces need; a partition that meets its
bound is certified and keeps its bins, apart from its emptiest one. All pieces of partitions with a
gap, and the pieces of emptiest bins, are exchanged: they are dealt anew over as many partitions as
they fill and packed again, until a round has one partition, nothing is left, or ``ROUNDS`` are over.

A partition holds about ``PARTITION_BINS`` bins whatever the size of the corpus. Only lengths travel;
ids stay in a written table and join their places at the end.

Edge cases: a null or empty text is one piece that holds the end id alone; rows that share a doc_id
(repeated documents) are packed one by one; an empty table gives an empty result; other columns do not
take part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import map_arrow, stage
from strata.llm.tokens import encode_column

CAPACITY = 2048
END_ID = 0
PARTITION_BINS = 4096
ROUNDS = 5
PIECES = "item long, doc_id long, piece int, start long, length long, ids binary"


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, key: str = "doc_id",
           text: str = "text", limits: tuple[int, int] | None = None) -> DataFrame:
    """The pieces of all documents, ids as little-endian unsigned 32-bit integers. A document over the
    capacity is cut so that all its pieces but the first are full."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item = TaskContext.get().partitionId() << 36
        for batch in batches:
            for k in range(0, batch.num_rows, 1024):
                part = batch.slice(k, 1024)
                rows = []
                for doc, ids in zip(part.column(0).to_pylist(), encode_column(part.column(1), tokenizer, end_id, limits), strict=True):
                    first = (len(ids) - 1) % capacity + 1
                    cuts = [0, *range(first, len(ids) + 1, capacity)]
                    for piece, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                        rows.append((item, doc, piece, a, b - a, ids[a:b].astype("<u4").tobytes()))
                        item += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()), strict=True)],
                    names=["item", "doc_id", "piece", "start", "length", "ids"])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return stage(map_arrow(rows, run, PIECES), "pieces")


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Bins that ``counts[size]`` pieces of each size need at least: the best of two families of dual
    feasible functions, one that rounds sizes above 1 - e up and below e down, and one that rounds
    sizes to k-ths of a bin."""
    sizes = np.flatnonzero(counts)
    n = counts[sizes].astype(np.int64)
    if not len(sizes):
        return 0
    best = -(-int(sizes @ n) // capacity)
    for e in np.unique(np.concatenate(([1], sizes[2 * sizes <= capacity]))).tolist():
        value = np.where(sizes > capacity - e, capacity, np.where(sizes < e, 0, sizes))
        best = max(best, -(-int(value @ n) // capacity))
    for k in range(1, 33):
        whole = (k + 1) * sizes % capacity == 0
        value = np.where(whole, sizes * k, (k + 1) * sizes // capacity * capacity)  # in 1 / (k * capacity)
        best = max(best, -(-int(value @ n) // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(bin, offset) of each piece and the number of bins: longest first, each into the fullest bin
    that still takes it. Open bins are kept by free space; a bit set finds the tightest."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    free_set, n = 0, 0  # bit f: a bin with f tokens free is open
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        above = free_set >> size
        if above:
            free = size + (above & -above).bit_length() - 1
            own = stacks[free].pop()
            if not stacks[free]:
                free_set ^= 1 << free
        else:
            free, own, n = capacity, n, n + 1
        bins[i], offsets[i] = own, capacity - free
        if left := free - size:
            if not stacks[left]:
                free_set |= 1 << left
            stacks[left].append(own)
    return bins, offsets, n


_PLACED = "item long, length long, bin long, offset long, exchange boolean"


def _pack_round(items: DataFrame, groups: int, round_no: int, capacity: int) -> DataFrame:
    dealt = items.select("item", "length", F.pmod(F.xxhash64("item", F.lit(round_no)), F.lit(groups)).alias("grp"))

    def run(table: pa.Table) -> pa.Table:
        grp = table.column("grp")[0].as_py()
        order = np.argsort(np.asarray(table.column("item")))  # rows of a shuffle come in any order
        item, length = np.asarray(table.column("item"))[order], np.asarray(table.column("length"))[order]
        own, offset, n = best_fit_decreasing(length, capacity)
        fill = np.bincount(own, weights=length, minlength=n)
        if groups == 1:
            exchange = np.zeros(len(item), bool)
        elif n > lower_bound(np.bincount(length, minlength=capacity + 1), capacity):
            exchange = np.ones(len(item), bool)
        else:
            exchange = (own == int(np.argmin(fill))) & (fill.min() < capacity)
        number = (round_no << 56) | (grp << 32) | own
        return pa.table({"item": item, "length": length, "bin": number, "offset": offset, "exchange": exchange})

    return stage(dealt.groupBy("grp").applyInArrow(run, _PLACED), f"packed-{round_no}")


def places(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(item, sequence_id, offset) for the pieces (item, length) of a written table."""
    done = items.filter(F.col("length") == capacity).select("item", F.col("item").alias("sequence_id"),
                                                            F.lit(0).cast("long").alias("offset"))
    left = items.filter(F.col("length") < capacity)
    for round_no in range(1, ROUNDS + 1):
        tokens = int(left.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0])
        if not tokens:
            break
        last = round_no == ROUNDS
        groups = -(-tokens // (capacity * PARTITION_BINS * (4 if last else 1)))
        packed = _pack_round(left, groups, round_no, capacity)
        last = last or groups == 1
        kept = packed if last else packed.filter(~F.col("exchange"))
        done = done.unionByName(kept.select("item", F.col("bin").alias("sequence_id"), "offset"))
        if last:
            break
        left = packed.filter("exchange").select("item", "length")
    return done


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, key: str = "doc_id",
         text: str = "text", digest: bool = False, limits: tuple[int, int] | None = None) -> DataFrame:
    """Every piece with its ids (or, with ``digest``, their CRC-32) and its place. ``limits`` bound the
    tokenizer's memory (see ``tokens``)."""
    cut = pieces(docs, tokenizer, capacity, end_id, key, text, limits)
    where = places(cut.select("item", "length"), capacity)
    ids = F.crc32("ids").alias("ids_crc32") if digest else F.col("ids")
    return cut.select("item", "doc_id", "piece", "start", "length", ids).join(where, "item").drop("item")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, length, ids): the training sequences of a packed corpus with ids."""
    parts = packed.groupBy("sequence_id").agg(F.sum("length").alias("length"),
                                              F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    joined = F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    return parts.select("sequence_id", "length", joined.alias("ids"))
