"""Quality classifier from weak labels.

Overlapping heuristic labellers vote good, bad or abstain on every document. Expectation-maximisation
over the counted vote patterns of the whole corpus estimates how accurate each labeller is, and gives
each document a posterior label. A linear scorer over hashed features (words, word endings and word
shapes, and a few counts in steps) is trained on the posterior labels of a bounded sample
(``SAMPLE`` documents, in hash order) and scores every document. A document is kept when its score
reaches one half.

Features are hashed into ``BUCKETS`` weights, so the model has one size whatever the vocabulary, and a
document is a sparse row of at most that many numbers.

Edge cases: a null or empty text, or one of white space, has no features besides its counts and is
scored like any other; repeated rows get equal scores; null doc_ids pass through; an empty table gives
an empty result, and without any document the score is one half.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.chunks import body_of
from strata.llm.common import map_arrow
from strata.llm.quality_rules import RuleModel, _posterior, estimate
from strata.llm.rolling import BASES, byte_values, mix, spans, word_hashes, words

LABELLERS = ("length", "symbols", "symbol_words", "lines", "repeats", "letters", "distinct")
BUCKETS = 1 << 16
SAMPLE = 6_000
EPOCHS = 20
SEED = 5
ROWS = 512

_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>{}[]=_~^\\/@+")] = True
_SHAPE = np.arange(256, dtype=np.uint8)  # letters and digits are alike, other bytes are themselves
_SHAPE[_LETTER] = ord("a")
_SHAPE[ord("0"):ord("9") + 1] = ord("0")


@dataclass
class Batch:
    """Counts of some documents, and what hashed features need."""
    body: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    hashes: np.ndarray
    counts: dict[str, np.ndarray]


def _per_doc(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return total[bounds[1:]] - total[bounds[:-1]]


def _repeated(keys: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Per document: how many of its keys equal an earlier one of the same document."""
    order = np.lexsort((keys, doc))
    again = (keys[order][1:] == keys[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    return np.bincount(doc[order][1:][again], minlength=n) if len(keys) else np.zeros(n, np.int64)


def measure(body: np.ndarray, offsets: np.ndarray) -> Batch:
    n = len(offsets) - 1
    start, end, first = words(body, offsets)
    hashes = word_hashes(body, start, end)
    doc = np.repeat(np.arange(n), np.diff(first))
    symbol = _SYMBOL[body] if len(body) else np.zeros(0, bool)
    # lines: cut at line feeds and document ends; only lines with a word count
    breaks = np.unique(np.concatenate((offsets, np.flatnonzero(body == 0x0A) + 1)))
    begin, stop = breaks[:-1], breaks[1:]
    line_doc = np.searchsorted(offsets, begin, side="right") - 1
    content = stop - (body[stop - 1] == 0x0A) if len(stop) else stop
    with_word = np.searchsorted(start, stop) > np.searchsorted(start, begin)
    begin, content, line_doc = begin[with_word], content[with_word], line_doc[with_word]
    line_key = spans(byte_values(body), begin, content, BASES[0]) + (content - begin).astype(np.uint64)
    # five-word runs, for repeats
    at = np.flatnonzero(np.arange(len(start)) + 5 <= np.repeat(first[1:], np.diff(first))) if len(start) else np.zeros(0, np.int64)
    runs = spans(hashes, at, at + 5, BASES[1])
    counts = {
        "words": np.diff(first), "bytes": np.bincount(doc, weights=end - start, minlength=n).astype(np.int64),
        "letters": _per_doc(_LETTER[body], offsets), "symbols": _per_doc(symbol, offsets),
        "symbol_words": np.bincount(doc[symbol[end - 1]], minlength=n) if len(end) else np.zeros(n, np.int64),
        "lines": np.bincount(line_doc, minlength=n), "dup_lines": _repeated(line_key, line_doc, n),
        "runs": np.bincount(doc[at], minlength=n), "dup_runs": _repeated(runs, doc[at], n),
        "dup_words": _repeated(hashes, doc, n),
    }
    return Batch(body, start, end, first, hashes, counts)


def votes(c: dict[str, np.ndarray]) -> np.ndarray:
    """(documents, labellers) of -1, 0, 1."""
    def vote(bad: np.ndarray, good: np.ndarray) -> np.ndarray:
        return np.where(bad, -1, np.where(good, 1, 0)).astype(np.int8)
    n = c["words"]
    return np.stack([
        vote(n < 25, n >= 50),
        vote(10 * c["symbols"] > n, 100 * c["symbols"] <= n),
        vote(10 * c["symbol_words"] > n, 100 * c["symbol_words"] <= n),
        vote(10 * c["dup_lines"] > 3 * c["lines"], c["dup_lines"] == 0),
        vote(4 * c["dup_runs"] > c["runs"], 50 * c["dup_runs"] <= c["runs"]),
        vote(100 * c["letters"] < 75 * c["bytes"], 100 * c["letters"] >= 88 * c["bytes"]),
        vote((n >= 25) & (100 * c["dup_words"] > 90 * n), (n >= 25) & (100 * c["dup_words"] <= 80 * n)),
    ], axis=1)


def features(b: Batch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, bucket, value) of the hashed features; each kind of feature of a document has
    length one."""
    n = len(b.first) - 1
    doc = np.repeat(np.arange(n), np.diff(b.first))
    shape = spans(byte_values(_SHAPE[b.body]), np.maximum(b.end - 3, b.start), b.end, BASES[0]) if len(b.start) else b.hashes
    tail = spans(byte_values(b.body), np.maximum(b.end - 2, b.start), b.end, BASES[0]) if len(b.start) else b.hashes
    docs, buckets, values = [], [], []
    for salt, keys in enumerate((b.hashes, mix(shape + np.uint64(1)), mix(tail + np.uint64(2)))):
        bucket = (mix(keys + np.uint64(salt << 32)) >> np.uint64(48)).astype(np.int64)  # 2**16 buckets
        pair, count = np.unique(doc * BUCKETS + bucket, return_counts=True)
        d, value = pair // BUCKETS, np.sqrt(count)
        norm = np.sqrt(np.bincount(d, weights=value ** 2, minlength=n))
        docs.append(d)
        buckets.append(pair % BUCKETS)
        values.append(value / norm[d])
    words_of = np.maximum(b.counts["words"], 1)
    steps = [np.log2(words_of).astype(np.int64)] + [
        np.minimum(10 * b.counts[k] // np.maximum(b.counts[of], 1), 15)
        for k, of in (("symbols", "words"), ("symbol_words", "words"), ("dup_lines", "lines"), ("dup_runs", "runs"), ("letters", "bytes"))]
    for salt, step in enumerate(steps, 8):
        key = mix(step.astype(np.uint64) + np.uint64(salt << 32)) >> np.uint64(48)
        docs.append(np.arange(n))
        buckets.append(key.astype(np.int64))
        values.append(np.full(n, 0.5))
    return np.concatenate(docs), np.concatenate(buckets), np.concatenate(values)


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Batch]]:
    for batch in batches:
        for k in range(0, batch.num_rows, ROWS):
            part = batch.slice(k, ROWS)
            yield part, measure(*body_of(part.column(1)))


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))


def patterns(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(votes, n): documents by vote pattern, at most 3**7 rows; each task adds up its own first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, int] = {}
        for _, b in _batches(batches):
            names, counts = np.unique(votes(b.counts) + 1, axis=0, return_counts=True)
            for v, n in zip(names, counts, strict=True):
                name = "".join(map(str, v))
                total[name] = total.get(name, 0) + int(n)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["votes", "n"])

    return map_arrow(_rows(docs, key, text), run, "votes string, n long").groupBy("votes").agg(F.sum("n").alias("n"))


def sample(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SAMPLE) -> DataFrame:
    """(votes, buckets, values) of the first ``size`` documents in hash order; rows equal in key and text
    are one document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, b in _batches(batches):
            doc, bucket, value = features(b)
            order = np.argsort(doc, kind="stable")
            cut = np.cumsum(np.bincount(doc, minlength=part.num_rows))[:-1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(["".join(map(str, v)) for v in votes(b.counts) + 1], pa.string()),
                 pa.array([x.tolist() for x in np.split(bucket[order], cut)], pa.list_(pa.int32())),
                 pa.array([x.tolist() for x in np.split(value[order], cut)], pa.list_(pa.float32()))], names=["votes", "buckets", "values"])

    marked = docs.withColumn("_c_mark", F.xxhash64(F.lit(SEED), F.col(key), F.xxhash64(text)))
    last = marked.select("_c_mark").distinct().orderBy("_c_mark").limit(size).agg(F.max("_c_mark")).first()[0]
    chosen = marked.filter(F.col("_c_mark") <= F.lit(last)) if last is not None else marked
    copy = F.row_number().over(Window.partitionBy("_c_mark").orderBy(F.lit(0)))  # cut in every task first
    return map_arrow(_rows(chosen.withColumn("_c_no", copy).filter("_c_no = 1"), key, text), run, "votes string, buckets array<int>, values array<float>")


@dataclass
class Scorer:
    weights: np.ndarray
    bias: float
    labellers: RuleModel


def train(rows: list[tuple[np.ndarray, np.ndarray, float]]) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels: averaged stochastic gradients with steps by Adagrad."""
    rng, w, bias = np.random.default_rng(SEED), np.zeros(BUCKETS), 0.0
    size, total, n = np.full(BUCKETS, 1e-2), np.zeros(BUCKETS), 0
    bias_size, bias_total = 1e-2, 0.0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            at, x, y = rows[i]
            p = 1 / (1 + np.exp(-np.clip(w[at] @ x + bias, -30, 30)))
            g = (p - y) * x + 1e-6 * w[at]
            size[at] += g * g
            w[at] -= 0.2 * g / np.sqrt(size[at])
            bias_size += (p - y) ** 2
            bias -= 0.2 * (p - y) / np.sqrt(bias_size)
        total, bias_total, n = total + w, bias_total + bias, n + 1
    return (total / n, bias_total / n) if n else (w, bias)


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SAMPLE) -> Scorer:
    code = lambda v: tuple(int(x) - 1 for x in v)
    counted = patterns(docs, key, text).collect()
    model = estimate(sorted((code(r["votes"]), int(r["n"])) for r in counted), len(LABELLERS))
    found = sample(docs, key, text, size).collect()
    rows = sorted(((r["votes"], r["buckets"], r["values"]) for r in found), key=lambda r: (r[0], r[1]))
    learned = [(np.array(b, dtype=np.int64), np.array(v), _posterior(model, code(t))) for t, b, v in rows]
    return Scorer(*train(learned), model)


def score(docs: DataFrame, model: Scorer, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, b in _batches(batches):
            doc, bucket, value = features(b)
            z = np.bincount(doc, weights=model.weights[bucket] * value, minlength=part.num_rows) + model.bias
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))], names=["doc_id", "score"])

    return map_arrow(_rows(docs, key, text), run, "doc_id long, score double")


def classify(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, score, kept."""
    out = score(docs, fit(docs, key, text), key, text)
    return out.select("doc_id", "score", (F.col("score") >= 0.5).alias("kept"))
