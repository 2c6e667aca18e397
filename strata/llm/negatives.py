"""Hard negatives of labelled vectors: rows of another label that score almost as high as a positive.

Every anchor gets its best rows of the same label as positives and, for each positive, the best rows
of other labels whose score lies in a window below the positive's. Both searches are BOND scans: a
block of rows is held dimension by dimension, and the dimensions are read in the anchor's descending
magnitude. After each few dimensions, the least and largest value of the dimensions still to come
bound every row's score from both sides, and rows that can no longer enter any window, or that ``keep``
rows of the window surely beat, leave the candidate bitmap. What is left at the last dimension has its
exact score.

Components become floor(scale * x), so scores are integers: computed in doubles while every sum is
below 2^53, else in Python integers; a score beyond 64 bits is given as the nearest long.

Anchors are a stated query set: they meet all rows in blocks of at most ``ANCHOR_CELLS`` components, one
scan of the rows for the positives and one for the negatives of a block. A task keeps the best rows
of each window over all its blocks of rows, so it returns at most ``keep`` rows a window, and the merge
ranks these.

Edge cases: rows whose id, label or vector is null, whose vector is empty, or with a component that is
null, not finite, or not finite after scaling take no part. Vectors of different lengths are not
compared. Rows that repeat an id are candidates of their own, but a row is never a positive or negative
of its own id; of several rows with one anchor id the least (label, vector) is the anchor. An anchor
without positives, or a positive without negatives in its window, gives no rows. An empty table gives
an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import map_arrow, stage

POSITIVES = 5
NEGATIVES = 5
SCALE = 256
LOW_PERCENT = 80       # a negative has at least this share of its positive's score
HIGH_PERCENT = 100     # and at most this share
ANCHOR_CELLS = 1 << 18  # components of the anchors that travel with one scan
BLOCK_CELLS = 1 << 18   # components of a block of rows
STEP = 8               # dimensions between two looks at the bounds
EXACT = 2.0 ** 53
LONG_MIN, LONG_MAX = -(1 << 63), (1 << 63) - 1
_HITS = "anchor_id long, w int, id long, score long"


@dataclass
class Anchor:
    id: int
    label: int
    vec: np.ndarray
    windows: list[tuple[float, float]]        # score ranges, both ends included
    best: list[list[tuple[int, int]]] = field(default_factory=list)  # per window: (-score, id), best first


def scaled_rows(vectors: DataFrame, key: str, vector: str, label: Column, scale: int = SCALE) -> DataFrame:
    """A written table (id, label, vec): the rows that take part, components scaled and floored."""
    rows = vectors.select(F.col(key).cast("long").alias("id"), label.cast("long").alias("label"),
                          F.transform(vector, lambda x: x.cast("double") * F.lit(float(scale))).alias("vec"))
    usable = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & (F.size("vec") > 0)
    rows = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.coalesce(usable, F.lit(False)))
    # rint of x - 0.5 would round; floor in Spark gives a long, which large doubles do not fit
    whole = F.transform("vec", lambda x: F.when(F.abs(x) < 2.0 ** 52, F.floor(x).cast("double")).otherwise(x))
    return stage(rows.select("id", "label", whole.alias("vec")), "negatives-rows")


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, labels, columns) of rows with one vector length, ``columns`` one row per dimension. Small
    batches are gathered, so blocks do not depend on how the table is split into files."""
    held: dict[int, list] = {}
    for batch in batches:
        vec = batch.column(2)
        sizes = np.diff(np.asarray(vec.offsets))
        for d in np.unique(sizes).tolist():
            at = np.flatnonzero(sizes == d)
            own = vec.take(pa.array(at)) if len(at) < len(sizes) else vec
            matrix = np.asarray(own.flatten(), dtype=np.float64).reshape(-1, d)
            ids, labels = np.asarray(batch.column(0))[at], np.asarray(batch.column(1))[at]
            wide = max(64, BLOCK_CELLS // d)
            for k in range(0, len(at), wide):
                group = held.setdefault(d, [])
                group.append((ids[k:k + wide], labels[k:k + wide], matrix[k:k + wide]))
                if sum(len(x[0]) for x in group) >= wide:
                    yield _block(held.pop(d))
    for group in held.values():
        yield _block(group)


def _block(group: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, labels, rows = (np.concatenate(x) for x in zip(*group, strict=True))
    return ids, labels, np.ascontiguousarray(rows.T)


def bond(columns: np.ndarray, low: np.ndarray, high: np.ndarray, anchor: np.ndarray, rows: np.ndarray,
         windows: list[tuple[float, float]], keep: int, beaten: list) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per window: (rows, scores) of the candidates that may be among its best ``keep``, exact.

    ``rows`` are the candidates; ``low`` and ``high`` bound each dimension; ``beaten[w]`` is the score
    below which a row of window w cannot count any more (None: no such score yet).
    """
    order = np.argsort(-np.abs(anchor).astype(np.float64), kind="stable")
    ends = anchor * low, anchor * high
    least, most = np.minimum(*ends)[order], np.maximum(*ends)[order]
    rest_least, rest_most = least.sum(), most.sum()
    partial = columns[0][rows] * 0
    alive = np.ones((len(windows), len(rows)), dtype=bool)
    beaten = list(beaten)
    for k in range(0, len(order), STEP):
        for d in order[k:k + STEP]:
            partial = partial + columns[d][rows] * anchor[d]
        rest_least, rest_most = rest_least - least[k:k + STEP].sum(), rest_most - most[k:k + STEP].sum()
        if k + STEP >= len(order):
            rest_least = rest_most = 0 * rest_least
        down, up = partial + rest_least, partial + rest_most
        for w, (a, b) in enumerate(windows):
            alive[w] &= (up >= a) & (down <= b)
            if beaten[w] is not None:
                alive[w] &= up >= beaten[w]
            sure = down[alive[w] & (down >= a) & (up <= b)]
            if len(sure) >= keep:  # the keep-th of them is surely reached by keep rows
                mark = np.sort(sure)[-keep]
                beaten[w] = mark if beaten[w] is None else max(beaten[w], mark)
                alive[w] &= up >= beaten[w]
        left = alive.any(axis=0)
        n = int(left.sum())
        if n == 0:
            break
        if n < 0.75 * len(rows):
            rows, partial, alive = rows[left], partial[left], alive[:, left]
    return [(rows[alive[w]], partial[alive[w]]) for w in range(len(windows))]


def _scan(batches: Iterator[pa.RecordBatch], anchors: list[Anchor], same: bool, keep: int) -> Iterator[pa.RecordBatch]:
    """Each anchor's best rows of every window over all blocks of a task."""
    for a in anchors:
        a.best = [[] for _ in a.windows]
    for ids, labels, columns in blocks(batches):
        low, high = columns.min(axis=1), columns.max(axis=1)
        reach = np.maximum(np.abs(low), np.abs(high))
        whole = None
        for a in anchors:
            if len(a.vec) != len(columns) or not a.windows:
                continue
            rows = np.flatnonzero(((labels == a.label) if same else (labels != a.label)) & (ids != a.id))
            if not len(rows):
                continue
            vec, held, ends = a.vec, columns, (low, high)
            if float(np.abs(vec) @ reach) * 2 >= EXACT:  # too large for doubles: the same scan in Python integers
                if whole is None:
                    whole = _integers(columns)
                vec, held, ends = _integers(vec), whole, (whole.min(axis=1), whole.max(axis=1))
            beaten = [-best[keep - 1][0] if len(best) >= keep else None for best in a.best]
            found = bond(held, *ends, vec, rows, a.windows, keep, beaten)
            for w, (at, scores) in enumerate(found):
                if len(at):
                    some = [(-int(s), i) for s, i in zip(scores.tolist(), ids[at].tolist(), strict=True)]
                    a.best[w] = sorted(a.best[w] + some)[:keep]
    out = [(a.id, w, i, min(max(-s, LONG_MIN), LONG_MAX)) for a in anchors for w, best in enumerate(a.best) for s, i in best]
    columns = list(zip(*out, strict=True)) or [(), (), (), ()]
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64()), strict=True)],
                                     names=["anchor_id", "w", "id", "score"])


def _integers(x: np.ndarray) -> np.ndarray:
    out = np.empty(x.shape, dtype=object)
    out.ravel()[:] = [int(v) for v in x.ravel()]
    return out


def _best(rows: DataFrame, anchors: list[Anchor], same: bool, keep: int) -> DataFrame:
    """(anchor_id, w, id, score, n): the best ``keep`` rows of every window, n counting from 1."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _scan(batches, [Anchor(a.id, a.label, a.vec, a.windows) for a in anchors], same, keep)

    hits = map_arrow(rows, run, _HITS)
    n = F.row_number().over(Window.partitionBy("anchor_id", "w").orderBy(F.col("score").desc(), "id"))
    return hits.withColumn("n", n).filter(F.col("n") <= keep)


def window(score: int, low: int = LOW_PERCENT, high: int = HIGH_PERCENT) -> tuple[int, int]:
    """The scores s with low * score <= 100 * s <= high * score."""
    return -(-low * score // 100), high * score // 100


def mine(vectors: DataFrame, is_anchor: Column, key: str = "vec_id", vector: str = "embedding",
         label: Column | None = None, positives: int = POSITIVES, negatives: int = NEGATIVES, scale: int = SCALE,
         low: int = LOW_PERCENT, high: int = HIGH_PERCENT, anchor_cells: int = ANCHOR_CELLS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score, positive_rank) for the
    rows that ``is_anchor`` selects by their id (a condition on a column named ``id``); ``label`` is an
    integer expression (default: the column label)."""
    spark = vectors.sparkSession
    rows = scaled_rows(vectors, key, vector, F.col("label") if label is None else label, scale)
    chosen = rows.filter(is_anchor).groupBy("id").agg(F.min(F.struct("label", "vec")).alias("row"))
    chosen = chosen.select("id", "row.label", "row.vec")
    cells = chosen.agg(F.sum(F.size("vec"))).first()[0] or 0
    n_blocks = max(1, -(-cells // anchor_cells))
    chosen = stage(chosen.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(n_blocks)).cast("int")), "negatives-anchors")
    out = []
    for b in range(n_blocks):
        anchors = [Anchor(r["id"], r["label"], np.array(r["vec"]), [(float("-inf"), float("inf"))])
                   for r in chosen.filter(F.col("block") == b).collect()]
        if not anchors:
            continue
        by_id = {a.id: a for a in anchors}
        found = {}
        for r in _best(rows, anchors, True, positives).collect():
            found.setdefault(r["anchor_id"], []).append((r["n"], r["id"], r["score"]))
        for a in anchors:
            a.windows = [window(s, low, high) for _, _, s in sorted(found.get(a.id, []))]
        pairs = [(i, n - 1, p, s) for i in by_id for n, p, s in sorted(found.get(i, []))]
        pairs = spark.createDataFrame(pairs, "anchor_id long, w int, positive_id long, positive_score long")
        hits = _best(rows, anchors, False, negatives)
        hits = hits.join(F.broadcast(pairs), ["anchor_id", "w"])  # at most ``positives`` rows an anchor of the block
        out.append(stage(hits.select(
            "anchor_id", "positive_id", F.col("n").alias("rank"), F.col("id").alias("negative_id"), "positive_score",
            F.col("score").alias("negative_score"), (F.col("w") + 1).alias("positive_rank")), "negatives-found"))
    if not out:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long, positive_rank int")
    found = out[0]
    for more in out[1:]:
        found = found.unionByName(more)
    return found
