"""Cases that once went wrong, and plain versions of the classifier's counts and the language network."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus as C
from strata.llm import ann, classifier, graph, langid, rolling, simhash, substring
from strata.llm.quality_rules import RuleModel, _posterior

DOC = "doc_id long, text string"


def test_one_per_group_keeps_texts_that_share_an_id(spark):
    rng = random.Random(1)
    a, b, c, d = (C.sentence(rng, 60) for _ in range(4))
    rows = [(3, a), (5, a), (5, b), (9, c), (9, c), (None, d), (None, d), (None, a), (None, None), (4, ""), (7, b + " x")]
    kept = Counter(tuple(r) for r in simhash.one_per_group(spark.createDataFrame(rows, DOC).repartition(3)).collect())
    fps = [C.fingerprint(t) for _, t in rows]
    groups = {}
    for (i, t), f in zip(rows, fps, strict=True):
        root = next((g for g in groups if any((f ^ x).bit_count() <= 3 for x in groups[g][0])), f)
        groups.setdefault(root, ([], []))
        groups[root][0].append(f)
        groups[root][1].append((i, t))
    assert sum(kept.values()) == len(groups)
    for _, members in groups.values():
        least = min(members, key=lambda r: (r[0] is None, r[0] or 0))[0]
        assert sum(n for r, n in kept.items() if r in members) == 1
        assert any(kept[r] for r in members if r[0] == least)
    assert kept[(3, a)] == 1 and kept[(5, b)] == 1 and kept[(9, c)] == 1 and kept[(None, d)] == 1 and kept[(4, "")] == 1


def thue_morse(n, letters="ab"):
    return "".join(letters[i.bit_count() % 2] for i in range(n))


def test_words_that_collide_in_polynomial_hashes_stay_apart(spark):
    one, two = thue_morse(2048), thue_morse(2048, "ba")
    rng = random.Random(2)
    rest = [C.sentence(rng, 1) for _ in range(19)]
    docs = [(1, " ".join([one, *rest])), (2, " ".join([two, *rest])), (3, " ".join([one, *rest]))]
    got = {r["doc_id"]: r["_d_removed"] for r in substring.dedup(spark.createDataFrame(docs, DOC)).collect()}
    assert got == {1: 0, 2: 0, 3: 20}


@pytest.mark.parametrize("which", [0, 1])
def test_hashes_of_words_and_windows(which):
    rng = random.Random(3)
    words = [bytes(rng.randrange(0x21, 0x7F) for _ in range(n)) for n in [*range(1, 140), 700, 8, 8, 16, 64, 65]]
    words += [w[:-1] + bytes([w[-1] ^ 1]) for w in words] + words[:40] + [thue_morse(k).encode() for k in (2, 4, 64, 128, 1024, 4096)]
    body = np.frombuffer(b" ".join(words), dtype=np.uint8)
    start, end, first = rolling.words(body, np.array([0, len(body)]))
    h = rolling.word_hashes(body, start, end, which).tolist()
    assert len(set(h)) == len(set(words)) and all(h[i] == h[words.index(w)] for i, w in enumerate(words))
    values = np.array([x % 3 for x in h], dtype=np.uint64)
    for length in (1, 2, 3, 5, 8, 20, 31):
        at = np.arange(len(values) - length + 1)
        found = rolling.window_hashes(values, at, length, which).tolist()
        plain = [tuple(values[i:i + length].tolist()) for i in at]
        assert len(set(zip(plain, found, strict=True))) == len(set(plain)) == len(set(found))
    assert len(rolling.window_hashes(values[:3], np.zeros(0, int), 20, which)) == 0


def test_neighbours_prune_and_reach_the_recall(spark):
    """Ten thousand vectors without clusters at the shipped share: entries are left out, recall holds."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(10_000, 32))
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    books = ann.train(ann.entries(df, "vec_id", "embedding"), ann.centroids_for(len(x)))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    books.cells = np.bincount(books.assign(unit), minlength=len(books.first) * len(books.second)).reshape(len(books.first), -1)
    wanted = math.ceil(ann.SHARE * len(x))
    seen = sum(books.cells.reshape(-1)[c] for c in books.walk(unit[0], wanted))
    assert wanted <= seen < 0.75 * len(x)
    got = {}
    for r in ann.search(df, F.col("vec_id") % 50 == 0).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = 0
    for q in range(0, len(x), 50):
        s = unit @ unit[q]
        s[q] = -2
        hits += len(set(np.argsort(-s)[:5].tolist()) & got[q])
    assert hits / (5 * len(got)) >= 0.9 and len(got) == 200


@pytest.mark.parametrize("n", [40, 200, 500])
def test_neighbours_on_small_tables(spark, n):
    rng = np.random.default_rng(n)
    x = rng.normal(size=(n, 64))
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    got = Counter(r["query_id"] for r in ann.search(df, F.col("vec_id") % 10 == 0).collect())
    assert set(got.values()) == {5} and len(got) == n // 10


def test_null_ends_are_no_edges(spark):
    edges = spark.createDataFrame([(1, 2), (None, 2), (3, None), (None, None), (2, 4), (5, 5)], "a long, b long")
    assert sorted(tuple(r) for r in graph.components(edges).collect()) == [(1, 1), (2, 1), (4, 1)]


# --- 7 classifier
def plain_votes(text):
    raw = (text or "").encode()
    w = raw.split()
    letters = sum(chr(x).isalpha() if x < 0x80 else True for x in raw)
    symbols = sum(x in b"#*$%&|<>{}[]=_~^\\/@+" for x in raw)
    ends = sum(x[-1] in b"#*$%&|<>{}[]=_~^\\/@+" for x in w)
    lines = [x for x in raw.split(b"\n") if x.split()]
    runs = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    again = lambda xs: len(xs) - len(set(xs))
    n, size = len(w), sum(map(len, w))

    def vote(bad, good):
        return -1 if bad else 1 if good else 0
    return (vote(n < 25, n >= 50), vote(10 * symbols > n, 100 * symbols <= n), vote(10 * ends > n, 100 * ends <= n),
            vote(10 * again(lines) > 3 * len(lines), again(lines) == 0), vote(4 * again(runs) > len(runs), 50 * again(runs) <= len(runs)),
            vote(100 * letters < 75 * size, 100 * letters >= 88 * size),
            vote(n >= 25 and 100 * again(w) > 90 * n, n >= 25 and 100 * again(w) <= 80 * n))


def measured(rows):
    raw = [(t or "").encode() for t in rows]
    body = np.frombuffer(b"".join(raw), dtype=np.uint8)
    return classifier.measure(body, np.concatenate(([0], np.cumsum([len(x) for x in raw]))))


def test_votes_match_plain_counts():
    texts = [r[1] for r in C.rows()] + ["a\n\nb\na\n", "x y\nx y", "\n", "# # #", "q" * 3]
    assert [tuple(v) for v in classifier.votes(measured(texts).counts).tolist()] == [plain_votes(t) for t in texts]


def test_features_match_plain_counts():
    """Each word, word ending and shape is one feature, weighted by the root of its count."""
    texts = [r[1] for r in C.rows()]
    doc, bucket, value = classifier.features(measured(texts))
    for i, t in enumerate(texts):
        w = C.words(t)
        shape = lambda x: bytes(ord("a") if chr(c).isalpha() or c >= 0x80 else ord("0") if chr(c).isdigit() else c for c in x)
        kinds = [Counter(w), Counter(shape(x)[-3:] for x in w), Counter(x[-2:] for x in w)]
        own = np.sort(value[doc == i])
        plain = [math.sqrt(c / sum(k.values())) for k in kinds for c in k.values()] + [0.5] * 6
        if len(own) == len(plain):  # no two features share a bucket
            np.testing.assert_allclose(own, np.sort(plain), atol=1e-6)
        assert abs((own ** 2).sum() - sum(1 for k in kinds if k) - 1.5) < 1e-6 and len(own) <= len(plain)


def test_scores_match_a_plain_sum(spark):
    rng = np.random.default_rng(6)
    model = classifier.Scorer(rng.normal(size=classifier.BUCKETS), -0.25, RuleModel(0.5, (0.9,) * 7, (0.9,) * 7))
    rows = [(i, r[1]) for i, r in enumerate(C.rows())]
    got = {r["doc_id"]: r["score"] for r in classifier.score(spark.createDataFrame(rows, DOC), model).collect()}
    for i, t in rows:
        _, bucket, value = classifier.features(measured([t]))
        z = sum(model.weights[b] * v for b, v in zip(bucket.tolist(), value.tolist(), strict=True)) - 0.25
        assert got[i] == pytest.approx(1 / (1 + math.exp(-min(max(z, -30), 30))))


def test_training_sample_does_not_depend_on_copies_or_order(spark):
    """Rows equal in key and text, more than the sample holds, are one document of it."""
    rng = random.Random(8)
    rows = [(i, C.sentence(rng, 30)) for i in range(60)]
    some = lambda df: sorted((r["votes"], tuple(r["buckets"])) for r in classifier.sample(df, size=20).collect())
    once = some(spark.createDataFrame(rows, DOC))
    assert len(once) == 20
    assert some(spark.createDataFrame(rows * 30, DOC).repartition(5)) == once
    assert some(spark.createDataFrame(rows[::-1] + rows[:1] * 900, DOC).repartition(3)) == once


def test_posterior_is_bayes():
    model = RuleModel(0.7, (0.9, 0.8), (0.6, 0.95))
    good, bad = 0.7 * 0.9 * 0.2, 0.3 * 0.4 * 0.95
    assert _posterior(model, (1, -1)) == pytest.approx(good / (good + bad))
    assert _posterior(model, (0, 0)) == pytest.approx(0.7)


# --- 9 language
def plain_probabilities(net, window):
    tops = []
    for f in net.filters:
        width = len(f)
        for k in range(f.shape[2]):
            tops.append(max(sum(float(f[j][window[p + j]][k]) for j in range(width)) for p in range(len(window) - width + 1)))
    a = [max(t + b, 0) for t, b in zip(tops, net.bias.tolist(), strict=True)]
    z = [sum(x * float(net.out[i][c]) for i, x in enumerate(a)) + float(net.out_bias[c]) for c in range(net.out.shape[1])]
    e = [math.exp(x - max(z)) for x in z]
    return [x / sum(e) for x in e]


@pytest.fixture(scope="module")
def net():
    rng = np.random.default_rng(9)
    n = len(langid.WIDTHS) * langid.FILTERS
    return langid.Network(["aa", "bb", "cc"], [rng.normal(size=(w, 256, langid.FILTERS)).astype(np.float32) for w in langid.WIDTHS],
                          rng.normal(size=n).astype(np.float32), rng.normal(size=(n, 3)).astype(np.float32) * 0.2, np.zeros(3, np.float32))


def test_looked_up_convolution_is_the_plain_one(net):
    rng = np.random.default_rng(10)
    windows = rng.integers(0, 256, (5, langid.WINDOW)).astype(np.uint8)
    fast = langid._Applied(net)(windows)
    for w, p in zip(windows, fast, strict=True):
        np.testing.assert_allclose(p, plain_probabilities(net, w.tolist()), atol=2e-5)
    for f in net.filters:
        slow = langid._convolve(windows.T, f)
        assert slow.shape == (langid.WINDOW - len(f) + 1, 5, langid.FILTERS)
        np.testing.assert_allclose(slow[7, 2], sum(f[j][windows[2, 7 + j]] for j in range(len(f))), atol=1e-4)


def test_predictions_are_means_over_windows(spark, net):
    rng = random.Random(11)
    rows = [(1, "kurz"), (2, C.sentence(rng, 200)), (3, "12 34"), (4, None), (5, "ä" * 700), (2, C.sentence(rng, 100))]
    got = langid.predict(spark.createDataFrame(rows, DOC), net).collect()
    for (doc, text), r in zip(rows, got, strict=True):
        assert r["doc_id"] == doc
        if text is None or not any(ch.isalpha() for ch in text):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            continue
        raw = text.encode()
        cuts = [raw[i:i + langid.WINDOW].ljust(langid.WINDOW) for i in range(0, len(raw), langid.WINDOW)]
        mean = np.mean([plain_probabilities(net, list(c)) for c in cuts], axis=0)
        assert r["lang_pred"] == net.languages[int(mean.argmax())] and r["score"] == pytest.approx(float(mean.max()), abs=1e-4)


def test_equal_probabilities_go_to_the_first_language(spark, net):
    flat = langid.Network(net.languages, net.filters, net.bias, np.zeros_like(net.out), net.out_bias)
    r = langid.predict(spark.createDataFrame([(1, "abc")], DOC), flat).first()
    assert r["lang_pred"] == "aa" and r["score"] == pytest.approx(1 / 3)


def test_language_sample_is_bounded_at_any_size(spark, monkeypatch):
    monkeypatch.setattr(langid, "PER_LANGUAGE", 40)
    rows = [(i, f"text number {i} of many", "ab"[i % 2], 1) for i in range(4000)] + [(9000 + i, f"rare {i}", "c", 1) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, mark int")
    found = Counter(r["lang"] for r in langid.sample(df).collect())
    assert found["a"] == found["b"] == 40 * langid.CLIPS and 0 < found["c"] <= 20 * langid.CLIPS
