"""The training-data operators against brute force, on small documents with every awkward case."""

from __future__ import annotations

import glob
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus as C
import corpus_pipeline
from strata.llm import (ann, classifier, graph, langid, mixing, packing, quality_rules, queries, simhash, substring, suffix,
                        suffix_sort, token_files, tokens)
from strata.llm.common import shared_path
from strata.llm.oracle import ORACLE_SQL

SF = "/root/testdata/sf0.001"
BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def rows():
    return C.rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, C.SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], C.SCHEMA)


def pairs(rows):
    return [(r[0], r[1]) for r in rows]


def bag(found):
    return Counter(tuple(r) for r in found)


# --- 1 mixing
def test_mixing_targets_and_copies(docs, rows):
    out = mixing.mix_report(docs).collect()
    assert len(out) == len(rows)
    size = Counter()
    for r in rows:
        size[r[3]] += len(C.words(r[1]))
    names = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), float(sum(size.values()))
    while True:  # reshare the excess until no source is above three times its size
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 3 * size[s]}
        if not over:
            break
        for s in over:
            target[s] = 3.0 * size[s]
            left -= target[s]
        open_ -= over
    target.update({s: level * weight[s] for s in open_})
    source = {r[0]: r[3] for r in rows}
    for r in out:
        s = source[r["doc_id"]] if r["doc_id"] is not None else None
        if r["doc_id"] is not None:
            assert r["target"] == pytest.approx(target[s]) and r["source_size"] == size[s]
        assert r["taken"] == r["size"] * r["copies"] and 0 <= r["copies"] <= 3
    again = mixing.mix_report(docs.repartition(2)).collect()
    assert bag(out) == bag(again)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r["copies"] for r in out)


def test_mixing_hits_its_targets(spark):
    data = [(i, "w " * (1 + i % 7), f"s{i % 4}") for i in range(8000)]
    out = mixing.mix_report(spark.createDataFrame(data, "doc_id long, text string, source string"))
    per = {i % 4: 0 for i in range(4)}
    targets = {}
    for r in out.collect():
        per[r["doc_id"] % 4] += r["taken"]
        targets[r["doc_id"] % 4] = r["target"]
    assert all(abs(per[s] - targets[s]) < 0.03 * targets[s] for s in per)
    assert sum(targets.values()) == pytest.approx(sum(1 + i % 7 for i in range(8000)))


def test_mixing_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.sql(ORACLE_SQL["op1_mixing"]).fetchall()
    got = queries.op1_mixing(spark, SF).collect()
    assert bag(want) == bag(got)


# --- 2 suffix array
def check_bytes(docs, data):
    out = suffix.dedup(docs.select("doc_id", "text", "copies", "chunk"))
    got = out.select("doc_id", "_x_bytes", "_x_removed", "_x_spans", "_x_kept").collect()
    assert bag((a, b, c, d, bytes(e)) for a, b, c, d, e in got) == bag(C.repeats_of_bytes(data))


def test_suffix_array(docs, rows):
    check_bytes(docs, pairs(rows))


def test_suffix_array_across_buckets(docs, rows, monkeypatch):
    """Many buckets and small chunks: splitters cut through anchors."""
    monkeypatch.setattr(suffix, "BUCKET_BYTES", 2000)
    monkeypatch.setattr(suffix, "SAMPLES", 400)
    monkeypatch.setattr(suffix, "chunked", lambda d, text: __import__("strata.llm.chunks", fromlist=["chunked"]).chunked(d, text, 3000))
    real, cuts = suffix.splitters, []
    monkeypatch.setattr(suffix, "splitters", lambda *a: cuts.append(real(*a)) or cuts[-1])
    check_bytes(docs, pairs(rows))
    assert cuts[0][1], "no splitter cut through an anchor; the test proves nothing"


def test_multikey_sort():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 500):
        t = rng.integers(0, 3, (n, 4)).astype(np.uint64)
        assert (t[suffix_sort.multikey_sort(t)] == t[np.lexsort(t.T[::-1])]).all()


# --- 3 substring
def test_substring(docs, rows):
    got = substring.dedup(docs).select("doc_id", "_d_words", "_d_removed", "_d_kept").collect()
    assert bag((a, b, c, d.encode()) for a, b, c, d in got) == bag(C.repeats_of_words(pairs(rows)))


def test_substring_keeps_columns_and_sketch_bounds(docs, rows):
    out = substring.without_repeats(docs)
    assert out.columns == docs.columns
    want = {(d, n): k for d, n, r, k in C.repeats_of_words(pairs(rows)) if r and r < n}
    for r in out.collect():
        if r["copies"] is not None and (r["doc_id"], len(C.words(r["text"]))) in want:
            assert r["n_chars"] == len(r["text"])
    # a tiny sketch, in which most cells are shared, changes nothing
    import strata.llm.substring as own
    shape, own.sketch_shape = own.sketch_shape, lambda n: (12, 6)
    try:
        test_substring(docs, rows)
    finally:
        own.sketch_shape = shape


# --- 4 neighbours
def test_neighbours_exact_on_awkward_vectors(spark):
    rng = np.random.default_rng(1)
    data = [(i, rng.normal(size=6).tolist(), "x") for i in range(300)]
    data += [(300 + i, data[0][1], "x") for i in range(40)]                       # a hot vector
    data += [(400, [v * 4 for v in data[5][1]], "x"), (401, None, "x"), (402, [0.0] * 6, "x"), (403, [1.0, None] + [0.0] * 4, "x"),
             (404, [float("nan")] * 6, "x"), (405, [float("inf")] + [0.0] * 5, "x"), (None, data[3][1], "x"), (450, [1e200] * 6, "x")]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, cell string")
    got = ann.search(df, F.col("vec_id") % 50 == 0, share=1.0, centroids=4).collect()
    usable = [(i, np.array(v)) for i, v, _ in data if i is not None and v is not None and None not in v and np.isfinite(v).all() and any(v)]
    unit = {i: v / np.abs(v).max() / np.linalg.norm(v / np.abs(v).max()) for i, v in usable}
    for q in [i for i, _ in usable if i % 50 == 0]:
        near = sorted(((-round(float(unit[q] @ u), 10), i) for i, u in unit.items() if i != q))[:5]
        mine = sorted((r["rank"], r["vec_id"], round(r["score"], 10)) for r in got if r["query_id"] == q)
        assert [(-s, i) for _, i, s in mine] == near and [r for r, _, _ in mine] == [1, 2, 3, 4, 5]


def test_neighbours_recall_and_empty(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    got = {}
    for r in ann.search(df, F.col("vec_id") % 50 == 0).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    x = {r["vec_id"]: np.array(r["embedding"], dtype=float) for r in df.collect()}
    ids = np.array(sorted(x))
    m = np.stack([x[i] / np.linalg.norm(x[i]) for i in ids])
    hits = sum(len(got[q] & set(ids[np.argsort(-np.where(ids == q, -9, m @ m[k]))[:5]].tolist())) for k, q in enumerate(ids.tolist()) if q % 50 == 0)
    assert hits >= 0.9 * 5 * len(got)
    assert ann.search(df.limit(0), F.lit(True)).count() == 0
    two = spark.createDataFrame([(0, [1.0, 0.0]), (50, [0.0, 1.0])], "vec_id long, embedding array<float>")
    assert sorted((r["query_id"], r["vec_id"], r["score"]) for r in ann.search(two, F.lit(True)).collect()) == [(0, 50, 0.0), (50, 0, 0.0)]


# --- 5 packing
def test_packing_round_trip(docs, rows):
    packed = packing.pack(docs, BYTE, capacity=64)
    got, library = packed.collect(), Tokenizer.from_file(BYTE)
    want = bag(tuple(library.encode(r[1] or "", add_special_tokens=False).ids + [0]) for r in rows)
    seqs = {}
    for r in got:
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        assert 0 < r["length"] <= 64 and (r["piece"] == 0 or r["length"] == 64) and len(r["ids"]) == 4 * r["length"]
    for s in seqs.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 64
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    single = {d: p for d, p in by.items() if d is not None and sum(r[0] == d for r in rows) == 1}
    for d, p in single.items():
        p.sort(key=lambda r: r["piece"])
        ids = np.frombuffer(b"".join(r["ids"] for r in p), "<u4").tolist()
        assert want[tuple(ids)] and [r["start"] for r in p] == np.cumsum([0] + [r["length"] for r in p])[:-1].tolist()
    total = sum(r["length"] for r in got)
    assert total == sum(len(k) * n for k, n in want.items())
    assert len(seqs) <= -(-total // 64) + 1
    assert packing.sequences(packed).agg(F.sum("length")).first()[0] == total


def test_packing_exchange_and_bounds(spark, monkeypatch):
    monkeypatch.setattr(packing, "PARTITION_BINS", 8)
    rng = np.random.default_rng(2)
    lengths = rng.choice([30, 36, 40, 64, 7, 51], 900).tolist()
    items = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "item long, length long").cache()
    got = packing.places(items, 64).collect()
    assert sorted(r["item"] for r in got) == list(range(900))
    fill = Counter()
    for r in got:
        fill[r["sequence_id"]] += lengths[r["item"]]
    assert max(fill.values()) <= 64
    bound = packing.lower_bound(np.bincount(lengths, minlength=65), 64)
    assert bound <= len(fill) <= bound * 1.03 + 1


def test_lower_bound_is_one():
    assert packing.lower_bound(np.bincount([33] * 10, minlength=65), 64) == 10
    assert packing.lower_bound(np.bincount([22] * 9, minlength=65), 64) >= 4
    for seed in range(20):
        x = np.random.default_rng(seed).integers(1, 65, 200)
        assert packing.lower_bound(np.bincount(x, minlength=65), 64) <= packing.best_fit_decreasing(x, 64)[2]


def test_tokens_equal_the_library(rows):
    real = [r[0] for r in duckdb.sql(f"SELECT coalesce(text, '') FROM '{SF}/documents.parquet'").fetchall()]
    texts = [r[1] or "" for r in rows] + real
    for path in (BYTE, WORD):
        want = [e.ids + [9] for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
        own = tokens.Encoder(path)
        for _ in range(2):
            assert [x.tolist() for x in own.encode(texts, 9)] == want
    own = tokens.Encoder(BYTE, known_pieces=50)
    assert [x.tolist() for t in texts for x in own.encode([t], 9)] == [
        e.ids + [9] for e in Tokenizer.from_file(BYTE).encode_batch(texts, add_special_tokens=False)]


# --- 6 SimHash
def test_simhash(docs, rows):
    fps = [C.fingerprint(r[1]) for r in rows]
    want = bag((r[0], f, c) for r, f, c in zip(rows, fps, C.component_ids(fps, [r[0] for r in rows]), strict=True))
    got = simhash.near_duplicates(docs).collect()
    assert bag((r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in got) == want
    kept = simhash.one_per_group(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    groups = C.component_ids(fps, [r[0] for r in rows])
    assert sorted(i for i in ids if i is not None) == sorted({g for g in groups if g is not None})


def links_of(spark, fps):
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    labels = {r["node"]: r["label"] for r in graph.components(simhash.links(df)).collect()}
    groups = {}
    for f in fps:
        s = f - (1 << 64) if f >> 63 else f
        groups.setdefault(labels.get(s, s), set()).add(f)
    return sorted(map(sorted, groups.values()))


@pytest.mark.parametrize("limit", [64, 2])
def test_simhash_links_lose_nothing(spark, monkeypatch, limit):
    """Random fingerprints with neighbours at every distance; a tiny group limit makes groups dense."""
    monkeypatch.setattr(simhash, "GROUP_LIMIT", limit)
    rng = np.random.default_rng(4)
    fps = {int(x) for x in rng.integers(0, 1 << 64, 60, dtype=np.uint64)}
    for f in list(fps)[:25]:
        for d in (1, 2, 3, 4, 3):
            f ^= sum(1 << int(b) for b in rng.choice(64, d, replace=False))
            fps.add(f)
    fps = sorted(fps)
    ids = C.component_ids(fps, list(range(len(fps))))
    want = {}
    for f, c in zip(fps, ids, strict=True):
        want.setdefault(c, []).append(f)
    assert links_of(spark, fps) == sorted(map(sorted, want.values()))


def test_simhash_visitors_do_not_pass_through_the_driver(spark):
    """The points of a few fingerprints look small to the planner, but are thousands of rows of each."""
    links = simhash._ball_links(spark.range(40).select(F.xxhash64("id").alias("fp")))
    plan = links._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(1, k) for k in range(2, 40)] + [(5, 5)]
    got = {r["node"]: r["label"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 1 for i in range(1, 40)}}


# --- 7 classifier
def labelled(spark):
    return {r["doc_id"]: r["quality"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}


def test_classifier(spark, docs, rows, empty):
    got = {r["doc_id"]: r["kept"] for r in queries.op7_classifier(spark, "/root/testdata/sf0.01").collect()}
    truth = labelled(spark)
    good = [got[d] for d, q in truth.items() if q]
    bad = [got[d] for d, q in truth.items() if not q]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.2
    out = classifier.classify(docs).collect()
    assert Counter(r["doc_id"] for r in out) == Counter(r[0] for r in rows) and all(0 <= r["score"] <= 1 for r in out)
    assert classifier.classify(empty).count() == 0


# --- 8 token files
def test_token_files(spark, docs, rows):
    folder = shared_path(spark, "test-token-files")
    manifest = token_files.write(docs, folder, WORD, end_id=1)
    got = sorted(token_files.read(manifest).collect(), key=lambda r: r["start"])
    library = Tokenizer.from_file(WORD)
    want = bag((r[0], tuple(library.encode(r[1] or "", add_special_tokens=False).ids + [1])) for r in rows)
    assert bag((r["doc_id"], tuple(np.frombuffer(r["ids"], "<u4").tolist())) for r in got) == want
    at = 0
    for r in got:
        assert r["start"] == at and len(r["ids"]) == 4 * r["n_tokens"]
        at += r["n_tokens"]
    ids = [-1 if r["doc_id"] is None else r["doc_id"] for r in got]
    assert ids == sorted(ids)
    # any zstandard reader gets all ids; a damaged frame is noticed
    import io

    import zstandard
    path = manifest.orderBy("part").first()["path"].removeprefix("file:")
    whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(open(path, "rb").read()), read_across_frames=True).read()
    assert whole == b"".join(bytes(r["ids"]) for r in got)[:len(whole)] and whole
    some = token_files.read_documents(path, [3, 5])
    assert all(tuple(v.tolist()) in {k[1] for k in want if k[0] == d} for d, v in some.items())
    raw = bytearray(open(path, "rb").read())
    raw[20] ^= 0xFF
    import pyarrow as pa
    with pytest.raises(Exception):
        reader = token_files.FrameReader(pa.BufferReader(bytes(raw)))
        [reader.ids(i) for i in range(len(reader.docs))]


def test_frames_hold_documents_across_their_borders(monkeypatch):
    import io

    import pyarrow as pa
    monkeypatch.setattr(token_files, "FRAME_IDS", 10)
    sink = io.BytesIO()
    writer, docs = token_files.FrameWriter(sink), [np.arange(n, dtype=np.uint32) + 1000 * n for n in (3, 0, 37, 10, 1, 20)]
    for i, d in enumerate(docs):
        writer.add(i, d)
    writer.close()
    reader = token_files.FrameReader(pa.BufferReader(sink.getvalue()))
    assert [np.frombuffer(reader.ids(i), "<u4").tolist() for i in range(6)] == [d.tolist() for d in docs]


# --- 9 language
def test_language(spark, docs, rows, empty):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {r["doc_id"]: r["lang"] for r in df.collect()}
    out = langid.identify(df).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in out)
    assert np.mean([truth[r["doc_id"]] == r["lang_pred"] for r in out if r["held_out"]]) > 0.97
    shuffled = df.select("doc_id", "text", "source", F.when(langid.held_out(), F.lit("zz")).otherwise(F.col("lang")).alias("lang"))
    assert bag(langid.identify(shuffled).collect()) == bag(out)  # labels of held-out documents are never seen
    small = {(r["doc_id"], r["lang_pred"]) for r in langid.identify(docs).collect()}
    for i, r in enumerate(rows):
        if not any(c.isalpha() for c in r[1] or ""):
            assert (r[0], "und") in small
    assert langid.identify(empty).count() == 0
    unlabelled = langid.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r["lang_pred"], r["score"]) for r in unlabelled} == {("und", 0.0)}


# --- 10 quality rules
def test_quality_rules(spark, docs, rows, empty):
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    out = quality_rules.judge(docs)
    assert bag(out.select(*names).collect()) == bag((r[0], *C.base_counts(r[1])) for r in rows)
    for r in out.collect():
        failed = r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"]
        assert r["base_failed"] == failed and not (failed and r["kept"])
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(r["doc_id"] for r in out.collect() if r["kept"])
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    got = {r["doc_id"]: r["kept"] for r in queries.op10_quality_rules(spark, "/root/testdata/sf0.01").collect()}
    truth = labelled(spark)
    assert np.mean([got[d] for d, q in truth.items() if q]) > 0.93
    assert np.mean([got[d] for d, q in truth.items() if not q]) < 0.2


def test_rule_accuracies_are_recovered():
    rng = np.random.default_rng(0)
    good = rng.random(20000) < 0.8
    right = (0.9, 0.75, 0.95, 0.6)
    v = np.stack([np.where(rng.random(20000) < 0.2, 0, np.where((rng.random(20000) < a) == good, 1, -1)) for a in right], axis=1)
    patterns = Counter(map(tuple, v.tolist()))
    model = quality_rules.estimate(sorted(patterns.items()), 4, iterations=300)
    assert abs(model.prior - 0.8) < 0.08
    assert all(abs(g - a) < 0.08 for g, a in zip(model.on_good, right, strict=True))


# --- all
def test_empty_tables(empty):
    assert mixing.mix_report(empty).count() == 0 and mixing.mix(empty).count() == 0
    assert suffix.dedup(empty).count() == 0
    assert substring.without_repeats(empty).count() == 0
    assert simhash.near_duplicates(empty).count() == 0 and simhash.one_per_group(empty).count() == 0
    assert packing.pack(empty, BYTE).count() == 0
    assert token_files.read(token_files.write(empty, shared_path(empty.sparkSession, "none"), WORD, 1)).count() == 0
    assert quality_rules.judge(empty).count() == 0 and quality_rules.keep_good(empty).count() == 0


def test_pipeline(spark, docs, rows):
    """Each stage on the awkward documents, against what brute force keeps of its own input."""
    now = docs
    for name, step in corpus_pipeline.STAGES:
        before = now.collect()
        now = step(spark, now, SF).cache()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert now.columns == docs.columns
        after = now.collect()
        if name == "simhash_near_dedup":
            fps = [C.fingerprint(r["text"]) for r in before]
            ids = C.component_ids(fps, [r["doc_id"] for r in before])
            assert len({i for i in ids if i is not None}) == sum(r["doc_id"] is not None for r in after)
        if name == "substring_dedup":
            want = [k for _, n, r, k in C.repeats_of_words([(r["doc_id"], r["text"]) for r in before]) if not r or r < n]
            assert Counter(b" ".join(C.words(r["text"])) for r in after) == Counter(want)
    assert after


def test_registered():
    import __spark_entry__ as entry
    names = set(entry.queries())
    assert {f"op{n}" for n in range(1, 11)} <= {x.split("_")[0] for x in names} and "pipeline" in names
    assert not glob.glob("/root/repo/strata/llm/*.json")
