"""Ranked lexical search: the best documents of each item by an integer form of BM25, over FP-trees.

Items come in blocks of at most ``BLOCK_TERMS`` terms. For a block, one scan reads every document,
counts its terms, and writes a restricted vector: the counts of the block's terms only. Document
frequencies, N and L are sums over these vectors. In a second scan each task gathers some thousand
restricted vectors at a time, orders each one's terms by falling document frequency, and builds an
FP-tree: vectors that begin with the same terms share the path. A node knows, for its whole subtree, the
largest count of every term and the smallest m, which bound the score that any of its documents can
reach. Each item goes through the tree depth first, the child with the highest bound first, and leaves
out every subtree whose bound is below the item's k-th score so far; groups of at most ``LEAF``
documents are not split further and scored exactly. A task keeps an item's best documents over all its
trees, so it returns at most ``k`` rows an item, and the merge ranks these.

A term's weight is floor(1000 ln((2N + 2) / (2 df + 1))) in doubles; all else is integer.

Edge cases: a null or empty text has no term and is in no count; an item without terms has no result, one
whose terms no document holds neither; a weight of 0 adds nothing, and only scores above 0 are returned.
Rows with the same doc_id or the same text are documents of their own; equal scores go by ascending
doc_id, null last. Rows with the same item_id are items of their own and are ranked apart; their
ranks repeat. Empty tables give an empty result. Extra columns are ignored. Texts are read whole,
whatever their length.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.chunks import body_of
from strata.llm.common import map_arrow, stage

K = 10
BLOCK_TERMS = 20_000   # distinct terms of one block of items; a single item may have more
LEAF = 16
TASK_DOCS = 8_192
TREE_CELLS = 1 << 22   # documents of a tree times terms of the block
#: bytes of a term stay, A-Z become a-z, all others become spaces; bytes from 0x80 on belong to terms
_FOLD = bytes(c if c >= 0x80 or chr(c).isalnum() and not chr(c).isupper() else ord(chr(c).lower()) if chr(c).isupper() else 0x20
              for c in range(256))
_VECTORS = "doc long, n long, terms array<int>, counts array<int>"
_HITS = "item int, doc long, score long"
_LAST = (1 << 63) - 1  # stands for a null doc_id in ties


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text, ASCII capitals folded."""
    return text.translate(_FOLD).split()


@dataclass
class Block:
    items: list[tuple[int, list[int]]]  # (item number, its terms by number)
    number: dict[bytes, int]            # term -> number
    weight: np.ndarray | None = None    # per term number
    rank: np.ndarray | None = None      # per term number, 0 for the most frequent term


def item_blocks(items: DataFrame, key: str, text: str, block_terms: int) -> tuple[DataFrame, int]:
    """Items with a number and a block of their own; blocks hold about ``block_terms`` terms together."""
    rows = items.select(F.col(key).alias("item_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = stage(rows.withColumn("at", F.monotonically_increasing_id()), "lexical-items")
    size = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n_blocks = max(1, -(-size // (8 * block_terms)))  # a term with its separators rarely has fewer letters
    block = F.pmod(F.xxhash64("at"), F.lit(n_blocks)).cast("int")
    return rows.withColumn("block", block), n_blocks


def restricted(docs: DataFrame, number: dict[bytes, int], key: str, text: str) -> DataFrame:
    """A written table (doc, n, terms, counts): every document's length in terms, and the counts of those
    of its terms that have a number. Documents without any term are left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                part = batch.slice(k, 512)
                body, at = body_of(part.column(1))
                rows, lengths, sizes, terms, counts = [], [], [], [], []
                for i in range(part.num_rows):
                    found = terms_of(body[at[i]:at[i + 1]].tobytes())
                    if not found:
                        continue
                    held = [(number[t], c) for t, c in Counter(found).items() if t in number]
                    rows.append(i)
                    lengths.append(len(found))
                    sizes.append(len(held))
                    terms += [t for t, _ in held]
                    counts += [c for _, c in held]
                offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(rows, pa.int64())), pa.array(lengths, pa.int64()),
                     pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())), pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int32()))],
                    names=["doc", "n", "terms", "counts"])

    rows = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).cast("binary").alias("text"))
    return stage(map_arrow(rows.filter("text is not null"), run, _VECTORS), "lexical-vectors")


@dataclass
class Tree:
    """An FP-tree over documents in path order. Node 0 is the root; a node's documents are a range."""
    docs: np.ndarray      # doc_id, in path order
    m: np.ndarray         # in path order
    tf: np.ndarray        # (documents, terms) int32, in path order, columns by falling frequency
    start: np.ndarray     # per node: first document
    end: np.ndarray       # per node: past the last document
    children: list[np.ndarray]
    top: np.ndarray       # (nodes, terms): largest count in the subtree
    least: np.ndarray     # per node: smallest m in the subtree

    @staticmethod
    def build(docs: np.ndarray, m: np.ndarray, tf: np.ndarray, leaf: int = LEAF) -> Tree:
        paths = [np.flatnonzero(row).tolist() for row in tf]
        order = sorted(range(len(paths)), key=paths.__getitem__)
        paths = [paths[i] for i in order]
        docs, m, tf = docs[order], m[order], tf[order]
        start, end, children = [0], [len(paths)], [[]]
        todo = [0]
        while todo:
            node = todo.pop()
            a, b = start[node], end[node]
            if b - a <= leaf:
                continue
            first, last = paths[a], paths[b - 1]
            depth = 0  # the path that all documents of the node share; they are sorted, so the ends tell
            while depth < len(first) and depth < len(last) and first[depth] == last[depth]:
                depth += 1
            k = a
            while k < b:
                begin = k
                if len(paths[k]) == depth:  # documents whose path ends here
                    while k < b and len(paths[k]) == depth:
                        k += 1
                else:
                    term = paths[k][depth]
                    while k < b and paths[k][depth] == term:
                        k += 1
                if (begin, k) == (a, b):
                    break  # equal paths: one leaf, whatever its size
                children[node].append(len(start))
                if len(paths[begin]) > depth:
                    todo.append(len(start))
                start.append(begin)
                end.append(k)
                children.append([])
        top = np.zeros((len(start), tf.shape[1]), dtype=tf.dtype)
        least = np.zeros(len(start), dtype=np.int64)
        for i in reversed(range(len(start))):  # children come after their parents
            inner = children[i]
            top[i] = top[inner].max(axis=0) if inner else tf[start[i]:end[i]].max(axis=0)
            least[i] = least[inner].min() if inner else m[start[i]:end[i]].min()
        return Tree(docs, m, tf, np.array(start), np.array(end), [np.array(c, dtype=np.int64) for c in children], top, least)


def scores(tf: np.ndarray, m: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Scores of rows of counts; with the largest counts and the smallest m of a subtree, its bound."""
    tf = tf.astype(np.int64)
    return (1_000_000_000 * tf // (1000 * tf + 8 * m[:, None]) * weight).sum(axis=1)  # m is 10 at least


def search_tree(tree: Tree, terms: np.ndarray, weight: np.ndarray, best: list[tuple[int, int]], k: int) -> int:
    """Adds the tree's documents to ``best``, a heap of (score, -doc) with the worst first. Returns the
    number of documents that were scored."""
    seen = 0
    bound = scores(tree.top[:1, terms], tree.least[:1], weight)
    todo = [(int(bound[0]), 0)]
    while todo:
        bound, node = todo.pop()
        if bound <= 0 or len(best) >= k and bound < best[0][0]:  # an equal score may have a smaller doc_id
            continue
        inner = tree.children[node]
        if len(inner):
            below = scores(tree.top[np.ix_(inner, terms)], tree.least[inner], weight)
            order = np.argsort(below, kind="stable")  # the last one is visited first
            todo.extend((int(below[i]), int(inner[i])) for i in order if below[i] > 0)
            continue
        a, b = tree.start[node], tree.end[node]
        own = scores(tree.tf[a:b, terms], tree.m[a:b], weight)
        seen += b - a
        at = np.flatnonzero(own > 0)
        if len(best) >= k:
            at = at[own[at] >= best[0][0]]
        if len(at) > k:  # copies: the k best of them are enough
            at = at[np.lexsort((tree.docs[a:b][at], -own[at]))][:k]
        for s, doc in zip(own[at].tolist(), tree.docs[a:b][at].tolist(), strict=True):
            (heapq.heappushpop if len(best) >= k else heapq.heappush)(best, (s, -doc))
    return seen


def _trees(batches: Iterator[pa.RecordBatch], block: Block, n_docs: int, n_terms: int) -> Iterator[Tree]:
    """FP-trees over the restricted vectors of a task, each of a bounded number of documents."""
    width = len(block.number)
    wide = max(LEAF, TREE_CELLS // max(width, 1))
    held: list = []

    def build() -> Tree:
        docs, n, tf = (np.concatenate(x) for x in zip(*held, strict=True))
        held.clear()
        m = np.array([10 + 90 * x * n_docs // n_terms for x in n.tolist()], dtype=np.int64)
        return Tree.build(docs, m, tf)

    for batch in batches:
        terms, counts = batch.column(2), batch.column(3)
        some = np.diff(np.asarray(terms.offsets)) > 0
        batch = batch.filter(pa.array(some))
        for k in range(0, batch.num_rows, wide):
            part = batch.slice(k, wide)
            terms, counts = part.column(2), part.column(3)
            sizes = np.diff(np.asarray(terms.offsets))
            tf = np.zeros((part.num_rows, width), dtype=np.int32)
            tf[np.repeat(np.arange(part.num_rows), sizes), block.rank[np.asarray(terms.flatten())]] = np.asarray(counts.flatten())
            held.append((np.asarray(pc.fill_null(part.column(0), _LAST)), np.asarray(part.column(1)), tf))
            if sum(len(x[0]) for x in held) >= wide:
                yield build()
    if held:
        yield build()


def _ranked(vectors: DataFrame, block: Block, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(item, doc, score): each task's ``k`` best documents of every item of a block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = [(i, block.rank[t], block.weight[t]) for i, t in block.items if len(t)]
        best: dict[int, list[tuple[int, int]]] = {i: [] for i, _, _ in queries}
        for tree in _trees(batches, block, n_docs, n_terms):
            for i, terms, weight in queries:
                search_tree(tree, terms, weight, best[i], k)
        out = [(i, -d, s) for i, heap in best.items() for s, d in heap]
        items, docs, points = list(zip(*out, strict=True)) or ((), (), ())
        docs = pa.array(docs, pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(items, pa.int32()), pc.if_else(pc.equal(docs, _LAST), None, docs), pa.array(points, pa.int64())],
                                         names=["item", "doc", "score"])

    return map_arrow(vectors, run, _HITS)


def rank(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
         item_text: str = "text", k: int = K, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of every item."""
    numbered, n_blocks = item_blocks(items, item_key, item_text, block_terms)
    out = []
    for b in range(n_blocks):
        rows = numbered.filter(F.col("block") == b).select("at", "text").orderBy("at").collect()
        number: dict[bytes, int] = {}
        own = [(i, sorted({number.setdefault(t, len(number)) for t in terms_of(r["text"].encode())})) for i, r in enumerate(rows)]
        if not number:
            continue
        vectors = restricted(docs, number, key, text)
        n_docs, n_terms = vectors.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not n_docs:
            continue
        df = np.zeros(len(number), dtype=np.int64)  # one number per term of the block
        for r in vectors.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
            df[r["t"]] = r["count"]
        weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in df.tolist()], dtype=np.int64)
        order = np.lexsort((np.arange(len(df)), -df))
        place = np.empty(len(df), dtype=np.int64)
        place[order] = np.arange(len(df))
        block = Block([(i, np.array(t, dtype=np.int64)) for i, t in own], number, weight, place)
        vectors = vectors.repartition(-(-n_docs // TASK_DOCS))  # small on disk, but each row is work
        hits = _ranked(vectors, block, n_docs, n_terms, k)
        n = F.row_number().over(Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc").asc_nulls_last()))
        hits = hits.withColumn("rank", n).filter(F.col("rank") <= k)
        at = docs.sparkSession.createDataFrame([(i, r["at"]) for i, r in enumerate(rows)], "item int, at long")
        out.append(stage(hits.join(F.broadcast(at), "item").select("at", "rank", F.col("doc").alias("doc_id"), "score"), "lexical-found"))
    schema = f"item_id {dict(items.dtypes)[item_key]}, rank int, doc_id long, score long"
    if not out:
        return docs.sparkSession.createDataFrame([], schema)
    found = out[0]
    for more in out[1:]:
        found = found.unionByName(more)
    return found.join(numbered.select("at", "item_id"), "at").select("item_id", "rank", "doc_id", "score")
