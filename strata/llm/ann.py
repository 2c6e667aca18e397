"""Approximate nearest neighbours by cosine, with an inverted multi-index.

Vectors are brought to length one and cut in two halves. Each half is quantised by a codebook of its
own, trained by k-means on a bounded sample; a pair of centroids is a cell of the index, and every
vector is in one cell. A query walks the pairs by summed distance with a heap until the cells it has
seen hold ``SHARE`` of all entries, and these are reranked by the exact cosine of the original vectors.
The share is what recall needs on vectors without clusters (measured in README); clustered vectors
reach the same recall with much less. The centroids of a half follow from the number of entries, so that
cells stay equally full.

Equal vectors are one entry: it keeps the ``neighbours + 1`` smallest ids, more can never be among the
nearest. Equal queries are searched once. The cells of one first-half centroid are a row of the grid;
the entries of a row are cut into blocks of about ``BLOCK``, the queries that visit it as well, so a
task multiplies two bounded matrices whatever a cell holds.

Edge cases: vectors that are null, zero, or hold a null or a component that is not finite take no part,
neither as query nor as candidate; ids that repeat are separate rows, but a query never finds its own
id; ties go to the smaller id; with fewer candidates than neighbours all are returned; vectors shorter
than two components are one half; a table may hold one length of vectors only, others raise an error;
rows without an id take no part. Extra columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import map_arrow, stage

NEIGHBOURS = 5
CELL_ENTRIES = 2       # entries of an average cell; the centroids of a half follow from it
MOST_CENTROIDS = 128    # of each half, for any table
SAMPLE = 20_000
SHARE = 0.65
BLOCK = 4_096
SEED = 11


@dataclass
class Codebooks:
    first: np.ndarray   # (centroids, half)
    second: np.ndarray  # (centroids, rest)
    cells: np.ndarray | None = None  # entries in each cell, (centroids, centroids)

    def assign(self, unit: np.ndarray) -> np.ndarray:
        h = self.first.shape[1]
        a, b = _distances(unit[:, :h], self.first).argmin(1), _distances(unit[:, h:], self.second).argmin(1)
        return a * len(self.second) + b

    def walk(self, unit: np.ndarray, wanted: int) -> list[int]:
        """The cells of one query, nearest pairs first, until they hold ``wanted`` entries. Pairs
        (i, j) of the sorted centroid lists enter the heap when (i-1, j) or (i, j-1) has left it."""
        h = self.first.shape[1]
        d1, d2 = _distances(unit[None, :h], self.first)[0], _distances(unit[None, h:], self.second)[0]
        o1, o2 = np.argsort(d1, kind="stable"), np.argsort(d2, kind="stable")
        heap, seen, out, held = [(float(d1[o1[0]] + d2[o2[0]]), 0, 0)], {(0, 0)}, [], 0
        while heap and held < wanted:
            _, i, j = heapq.heappop(heap)
            n = int(self.cells[o1[i], o2[j]])
            if n:
                out.append(int(o1[i]) * len(o2) + int(o2[j]))
                held += n
            for a, b in ((i + 1, j), (i, j + 1)):
                if a < len(o1) and b < len(o2) and (a, b) not in seen:
                    seen.add((a, b))
                    heapq.heappush(heap, (float(d1[o1[a]] + d2[o2[b]]), a, b))
        return out


def _distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return (centroids ** 2).sum(1)[None, :] - 2 * (x @ centroids.T) + (x ** 2).sum(1)[:, None]


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    if not x.shape[1] or not len(x):
        return np.zeros((1, x.shape[1]))
    centroids = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(15):
        own = _distances(x, centroids).argmin(1)
        size = np.bincount(own, minlength=len(centroids))
        for c in np.flatnonzero(size):
            centroids[c] = x[own == c].mean(0)
        for c in np.flatnonzero(size == 0):
            centroids[c] = x[rng.integers(len(x))]
    return centroids


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    """A list column as doubles, one row each; all lists must be equally long."""
    n = len(column)
    flat = np.asarray(column.flatten(), dtype=np.float64)
    if n and len(flat) % n or n and (np.diff(np.asarray(column.offsets)) != len(flat) // n).any():
        raise ValueError("vectors of different lengths")
    return flat.reshape(n, -1) if n else np.zeros((0, 0))


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # keeps squares in range
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def entries(vectors: DataFrame, key: str, vector: str, neighbours: int = NEIGHBOURS) -> DataFrame:
    """A written table (entry, vec, ids): the distinct usable vectors with their smallest ids. The
    ids are cut in every task before the shuffle, so a vector in a third of all rows is a few rows."""
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("vec"))
    rows = rows.filter(F.col("id").isNotNull() & _usable(F.col("vec")))
    ranked = rows.withColumn("n", F.row_number().over(Window.partitionBy("vec").orderBy("id")))
    kept = ranked.filter(F.col("n") <= neighbours + 1)
    grouped = kept.groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids"))  # neighbours + 1 at most
    return stage(grouped.select(F.xxhash64("vec").alias("entry"), "vec", "ids"), "ann-entries")


def centroids_for(n_entries: int) -> int:
    """Centroids of each half: their pairs are cells of ``CELL_ENTRIES`` entries on average."""
    return min(max(round((n_entries / CELL_ENTRIES) ** 0.5), 2), MOST_CENTROIDS)


def train(found: DataFrame, centroids: int, sample: int = SAMPLE) -> Codebooks | None:
    """Codebooks from at most ``sample`` vectors, taken in hash order."""
    rows = found.select("vec", "entry").orderBy(F.xxhash64(F.lit(SEED), "entry"), "entry").limit(sample).collect()
    if not rows:
        return None
    x = _unit(np.array([r["vec"] for r in rows], dtype=np.float64))
    half, rng = x.shape[1] // 2, np.random.default_rng(SEED)
    return Codebooks(_kmeans(x[:, :half], centroids, rng), _kmeans(x[:, half:], centroids, rng))


def index(found: DataFrame, books: Codebooks) -> DataFrame:
    """A written table (cell, entry, vec, ids): every entry in its cell."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cell = books.assign(_unit(_matrix(batch.column(1))))
                yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), *batch.columns], names=["cell", "entry", "vec", "ids"])

    rows = found.select("entry", "vec", "ids")
    schema = T.StructType([T.StructField("cell", T.IntegerType()), *rows.schema.fields])
    return stage(map_arrow(rows, run, schema), "ann-index")


def _visits(queries: DataFrame, books: Codebooks, wanted: int) -> DataFrame:
    """(line, query, qvec, cells): the cells that a query walks, by rows of the grid."""
    width = len(books.second)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                at, lines, cells = [], [], []
                for i, q in enumerate(_unit(_matrix(part.column(1)))):
                    walked = np.sort(np.array(books.walk(q, wanted), dtype=np.int32))
                    own, cut = np.unique(walked // width, return_index=True)
                    at += [i] * len(own)
                    lines += own.tolist()
                    cells += [x.tolist() for x in np.split(walked, cut[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(lines, pa.int32()), part.column(0).take(pa.array(at, pa.int64())), part.column(1).take(pa.array(at, pa.int64())),
                     pa.array(cells, pa.list_(pa.int32()))], names=["line", "query", "qvec", "cells"])

    rows = queries.select("query", "qvec")
    schema = T.StructType([T.StructField("line", T.IntegerType()), *rows.schema.fields, T.StructField("cells", T.ArrayType(T.IntegerType()))])
    return map_arrow(rows, run, schema)


_HITS = "query long, entry long, score double, ids array<long>"


def _rerank(left: pa.Table, right: pa.Table, neighbours: int, width: int) -> pa.Table:
    """The nearest visited entries of one block for each query of one block."""
    names = [x.split()[0] for x in _HITS.split(", ")]
    rows, cols, scores = [np.zeros(0, int)], [np.zeros(0, int)], [np.zeros(0)]
    if left.num_rows and right.num_rows:
        q, e = _matrix(left.column("qvec").combine_chunks()), _matrix(right.column("vec").combine_chunks())
        q, e = q / np.abs(q).max(1, keepdims=True), e / np.abs(e).max(1, keepdims=True)
        norm_q, norm_e = np.sqrt((q * q).sum(1)), np.sqrt((e * e).sum(1))
        cell = np.asarray(right.column("cell")) % width
        first = np.asarray([i[0] for i in right.column("ids").to_pylist()])
        visited = np.zeros(width, dtype=bool)
        for i, cells in enumerate(left.column("cells").to_pylist()):
            visited[:] = False
            visited[np.array(cells) % width] = True
            at = np.flatnonzero(visited[cell])
            if not len(at):
                continue
            score = np.clip(e[at] @ q[i] / (norm_e[at] * norm_q[i]), -1.0, 1.0)
            k = min(neighbours + 1, len(at))  # one of them may hold the query's own id alone
            near = np.flatnonzero(score >= np.partition(score, len(at) - k)[len(at) - k])
            near = near[np.lexsort((first[at[near]], -score[near]))][:k]
            rows.append(np.full(len(near), i))
            cols.append(at[near])
            scores.append(score[near])
    rows, cols, scores = np.concatenate(rows), np.concatenate(cols), np.concatenate(scores)
    return pa.table([left.column("query").take(pa.array(rows)), right.column("entry").take(pa.array(cols)),
                     pa.array(scores), right.column("ids").take(pa.array(cols))], names=names)


def search(vectors: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding",
           neighbours: int = NEIGHBOURS, share: float = SHARE, centroids: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest rows of each row that ``is_query`` selects."""
    found = entries(vectors, key, vector, neighbours)
    books = train(found, centroids or centroids_for(found.count()))
    spark = vectors.sparkSession
    if books is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    indexed = index(found, books)
    width = len(books.second)
    books.cells = np.zeros((len(books.first), width), dtype=np.int64)  # centroids**2 numbers
    for r in indexed.groupBy("cell").count().collect():
        books.cells[r["cell"] // width, r["cell"] % width] = r["count"]
    # enough for an answer, however small the share
    wanted = max(neighbours + 1, int(np.ceil(share * books.cells.sum())))
    rows = vectors.filter(is_query).select(F.col(key).cast("long").alias("query_id"), F.col(vector).alias("qvec"))
    rows = rows.filter(F.col("query_id").isNotNull() & _usable(F.col("qvec")))
    rows = rows.select("query_id", "qvec", F.xxhash64("qvec").alias("query"))
    members = stage(rows.select("query_id", "query"), "ann-members")
    visits = stage(_visits(rows.dropDuplicates(["query"]), books, wanted), "ann-visits")
    # blocks: the entries of a line over its pieces, its queries over theirs; every piece meets every piece
    pieces = F.element_at(F.lit([max(1, -(-int(n) // BLOCK)) for n in books.cells.sum(1)]), F.col("line") + 1)
    asked = visits.groupBy("line").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("qbs"))
    asked = F.broadcast(asked)  # one row per centroid of a half
    left = visits.join(asked, "line").withColumn("qb", F.pmod(F.xxhash64("query"), F.col("qbs")).cast("int"))
    left = left.select("line", "qb", F.explode(F.sequence(F.lit(0), pieces - 1)).alias("eb"), "query", "qvec", "cells")
    right = indexed.withColumn("line", F.floor(F.col("cell") / width).cast("int")).join(asked, "line")
    right = right.withColumn("eb", F.pmod(F.xxhash64(F.lit(1), "entry"), pieces).cast("int"))
    right = right.select("line", "eb", F.explode(F.sequence(F.lit(0), F.col("qbs") - 1)).alias("qb"), "cell", "entry", "vec", "ids")
    by = ["line", "eb", "qb"]
    hits = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(lambda a, b: _rerank(a, b, neighbours, width), _HITS)
    best = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("ids")[0])
    hits = stage(hits.withColumn("n", F.row_number().over(best)).filter(F.col("n") <= neighbours + 1).drop("n"), "ann-hits")
    pairs = members.join(hits, "query").select("query_id", "score", F.explode("ids").alias("vec_id")).filter("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return pairs.withColumn("rank", rank).filter(F.col("rank") <= neighbours).select("query_id", "rank", "vec_id", "score")
