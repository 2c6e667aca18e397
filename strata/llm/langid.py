"""Language identification with a byte convolutional network.

Filters of several widths slide over one-hot bytes of fixed-length windows, each filter's maximum
over a window is kept, and a softmax over languages follows. The network is trained in numpy on a
bounded sample (``PER_LANGUAGE`` documents of each language, ``CLIPS`` windows of each, chosen by
hash) on the driver; it is then applied to every window of every text, in batches, inside tasks. A
document's score is the mean probability of its language over its windows.

A filter over one-hot bytes is a table look-up, and two neighbouring bytes are looked up at once.

Edge cases: a text that is null or has no letter is ``und`` with score 0; so is everything when no
document has a language; with one language known, that one is predicted with score 1. A null doc_id
is never held out. Ties go to the first language by code point. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.chunks import body_of
from strata.llm.common import map_arrow

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
PER_LANGUAGE = 800
SPARE = 4
CLIPS = 3
EPOCHS = 8
BATCH = 128
SEED = 7
UNKNOWN = "und"


@dataclass
class Network:
    languages: list[str]
    filters: list[np.ndarray]  # per width: (width, 256, FILTERS)
    bias: np.ndarray           # (len(WIDTHS) * FILTERS,)
    out: np.ndarray            # (len(WIDTHS) * FILTERS, languages)
    out_bias: np.ndarray


def held_out(key: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def sample(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, clip): the training windows, at most ``PER_LANGUAGE * CLIPS`` of each language, from
    documents that are not held out. Before the documents of a language are ranked by hash, a threshold
    on the hash leaves about ``SPARE`` times as many as are wanted, however large the table is."""
    mark = F.xxhash64(F.lit(SEED), F.col(key), F.col(text))
    rows = docs.filter(~held_out(key) & F.col(lang).isNotNull())
    known = {r["lang"]: r["n"] for r in rows.groupBy(F.col(lang).alias("lang")).agg(F.count(F.lit(1)).alias("n")).collect()}
    shares = [F.when(F.col(lang) == F.lit(x), F.lit(SPARE * PER_LANGUAGE / n)) for x, n in sorted(known.items()) if n > SPARE * PER_LANGUAGE]
    share = F.coalesce(*shares, F.lit(1.0)) if shares else F.lit(1.0)
    rows = rows.filter((F.shiftrightunsigned(mark, 32) <= share * float(1 << 32)) & F.col(text).rlike(r"\p{L}"))
    size = F.length(text)
    at = [F.pmod(F.xxhash64(F.lit(k), mark), F.greatest(size - WINDOW, F.lit(1))).cast("int") + 1 for k in range(CLIPS)]
    rows = rows.select(F.col(lang).alias("lang"), mark.alias("mark"),
                       F.array(*[F.substring(F.col(text), a, F.lit(WINDOW)) for a in at]).alias("clips"))
    first = Window.partitionBy("lang").orderBy("mark")
    rows = rows.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= PER_LANGUAGE)
    return rows.select("lang", "mark", F.posexplode("clips").alias("k", "clip"))


def _windows(body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(windows, document of each): texts cut into windows, the last one filled with spaces."""
    size = np.diff(offsets)
    per = -(-size // WINDOW)
    doc = np.repeat(np.arange(len(size)), per)
    k = np.arange(len(doc)) - np.repeat(np.cumsum(per) - per, per)
    start = offsets[doc] + k * WINDOW
    at = start[:, None] + np.arange(WINDOW)
    inside = at < offsets[doc + 1][:, None]
    at[~inside] = 0
    return np.where(inside, body[at] if len(body) else 0, 32).astype(np.uint8), doc


def _convolve(windows: np.ndarray, filters: np.ndarray) -> np.ndarray:
    """(positions, windows, filters) responses of one width; ``windows`` is (length, windows)."""
    width, n = len(filters), len(windows)
    return sum(filters[j][windows[j:n - width + 1 + j]] for j in range(width))


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(clips: list[bytes], labels: list[int], languages: list[str]) -> Network:
    """Adam on the cross entropy; gradients pass through the position of each filter's maximum."""
    rng = np.random.default_rng(SEED)
    n_out = len(WIDTHS) * FILTERS
    net = Network(languages, [rng.normal(0, 0.2, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS],
                  np.zeros(n_out, np.float32), rng.normal(0, 0.2, (n_out, len(languages))).astype(np.float32),
                  np.zeros(len(languages), np.float32))
    x = np.full((len(clips), WINDOW), 32, dtype=np.uint8)
    for i, c in enumerate(clips):
        x[i, :min(len(c), WINDOW)] = np.frombuffer(c[:WINDOW], dtype=np.uint8)
    y = np.eye(len(languages), dtype=np.float32)[labels]
    params = [*net.filters, net.bias, net.out, net.out_bias]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    step = 0
    for _ in range(EPOCHS):
        for rows in np.array_split(rng.permutation(len(x)), max(1, len(x) // 64)):
            w, peaks, tops = x[rows].T, [], []
            for f in net.filters:
                r = _convolve(w, f)
                peaks.append(r.argmax(axis=0))
                tops.append(r.max(axis=0))
            z = np.concatenate(tops, axis=1) + net.bias
            a = np.maximum(z, 0)
            d = (_softmax(a @ net.out + net.out_bias) - y[rows]) / len(rows)
            dz = (d @ net.out.T) * (z > 0)
            grads = []
            for k, f in enumerate(net.filters):
                g, own = np.zeros_like(f), dz[:, k * FILTERS:(k + 1) * FILTERS]
                for j in range(len(f)):
                    seen = w[peaks[k] + j, np.arange(len(rows))[:, None]]
                    np.add.at(g[j], (seen, np.arange(FILTERS)[None, :]), own)
                grads.append(g)
            grads += [dz.sum(axis=0), a.T @ d, d.sum(axis=0)]
            step += 1
            for p, g, (m, v) in zip(params, grads, moments, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= 0.01 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return net


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Network | None:
    rows = sample(docs, key, text, lang).orderBy("lang", "mark", "k").collect()
    if not rows:
        return None
    languages = sorted({r["lang"] for r in rows})
    return train([r["clip"].encode() for r in rows], [languages.index(r["lang"]) for r in rows], languages)


class _Applied:
    """The network with look-up tables of byte pairs, for many windows."""

    def __init__(self, net: Network):
        self.net, self.tables = net, []
        for f in net.filters:
            own = [(f[j][:, None, :] + f[j + 1][None, :, :]).reshape(1 << 16, FILTERS) for j in range(0, len(f) - 1, 2)]
            self.tables.append((len(f), own, f[-1] if len(f) % 2 else None))

    def __call__(self, windows: np.ndarray) -> np.ndarray:
        """Language probabilities of each window."""
        tops = []
        for k in range(0, len(windows), BATCH):
            w = np.ascontiguousarray(windows[k:k + BATCH].T)
            pairs = w[:-1].astype(np.uint16) << 8 | w[1:]
            found = []
            for width, own, last in self.tables:
                n = WINDOW - width + 1
                r = own[0].take(pairs[:n], axis=0)
                for j, table in enumerate(own[1:], 1):
                    r += table.take(pairs[2 * j:2 * j + n], axis=0)
                if last is not None:
                    r += last.take(w[width - 1:width - 1 + n], axis=0)
                found.append(np.maximum.reduce(r, axis=0))
            tops.append(np.concatenate(found, axis=1))
        a = np.maximum(np.concatenate(tops) + self.net.bias, 0)
        return _softmax(a @ self.net.out + self.net.out_bias)


def predict(docs: DataFrame, net: Network | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of every row."""
    languages = [] if net is None else net.languages
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"),
                       F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("letters"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = _Applied(net) if net is not None else None
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                names, scores = [UNKNOWN] * part.num_rows, [0.0] * part.num_rows
                body, offsets = body_of(part.column(1))
                if apply is not None and len(body):
                    windows, doc = _windows(body, offsets)
                    total = np.zeros((part.num_rows, len(languages)))
                    for b in range(0, len(windows), 4096):
                        p = apply(windows[b:b + 4096])
                        for c in range(len(languages)):
                            total[:, c] += np.bincount(doc[b:b + 4096], weights=p[:, c], minlength=part.num_rows)
                    mean = total / np.maximum(np.bincount(doc, minlength=part.num_rows), 1)[:, None]
                    best = mean.argmax(axis=1)
                    for i, letters in enumerate(part.column(2).to_pylist()):
                        if letters:
                            names[i], scores[i] = languages[best[i]], min(max(float(mean[i, best[i]]), 0.0), 1.0)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                                 names=["doc_id", "lang_pred", "score"])

    return map_arrow(rows, run, "doc_id long, lang_pred string, score double")


def identify(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score; the network learns from rows that aren't held out."""
    out = predict(docs, fit(docs, key, text, lang), key, text)
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")
