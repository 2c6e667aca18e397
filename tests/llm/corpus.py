"""Small documents with every awkward case, and brute-force versions of the operators."""

from __future__ import annotations

import random
from collections import Counter

import xxhash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, copies int, chunk string, fp long, word array<string>"


def words(text):
    return (text or "").encode().split()


def sentence(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(n))


def rows():
    """Ordinary texts, exact and near copies, shared passages, nulls, empty and very long texts, white
    space of every kind, other scripts, ties and repeated rows, and columns whose names clash."""
    rng = random.Random(3)
    texts = [sentence(rng, rng.randint(20, 120)) for _ in range(40)]
    passage = sentence(rng, 70)
    texts += [texts[0], texts[0], texts[1] + " tail", "head " + texts[2]]
    texts += [f"{sentence(rng, 30)} {passage} {sentence(rng, 30)}" for _ in range(8)]
    texts += [None, None, "", "   \t\n ", "one", "ONE", "one two", "a\x0bb\x0cc\rd\ne  f", "¡Olé! naïve Œuvre ß 日本語 текст 12",
              "x" * 700, "ab " * 400, "line one is here\n" * 40, "# $ % & | < > * " * 30, "<|endoftext|> is text", "İstanbul ǅ   \x1c end"]
    texts += [sentence(rng, 6000) + " " + passage]
    texts += [texts[5] + "\n" + texts[5]]
    sources = ["b", "a", None, "ä", "Z"]
    out = [(i, t, ["en", "de", None][i % 3], sources[i % 5 if i % 2 else 0], len(t or ""), 7, "c", -1, ["w"]) for i, t in enumerate(texts)]
    out += [out[3], out[3]]                                             # repeated rows
    out += [(None, texts[7], "en", "a", 3, None, None, None, None), (None, None, None, None, None, None, None, None, None)]
    return out


def repeats_of_words(docs, n=20):
    """{row: (words, kept words)} of ``docs``: (doc_id, text); null ids first, equal ids are one document."""
    first, out = {}, []
    key = lambda d: -(1 << 70) if d is None else d
    for d, t in docs:
        w = words(t)
        for i in range(len(w) - n + 1):
            k = tuple(w[i:i + n])
            first[k] = min(first.get(k, (1 << 70, 0)), (key(d), i))
    for d, t in docs:
        w, gone = words(t), set()
        for i in range(len(w) - n + 1):
            if (key(d), i) > first[tuple(w[i:i + n])]:
                gone.update(range(i, i + n))
        out.append((d, len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def repeats_of_bytes(docs, n=200):
    seen, out = Counter(), []
    for _, t in docs:
        b = (t or "").encode()
        seen.update(b[i:i + n] for i in range(len(b) - n + 1))
    for d, t in docs:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - n + 1):
            if seen[b[i:i + n]] > 1:
                gone[i:i + n] = b"\x01" * n
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((d, len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone, strict=True) if not g)))
    return out


def fingerprint(text, n=3):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    shingles = [b" ".join(w[i:i + n]) for i in range(max(1, len(w) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def component_ids(fps, ids, bits=3):
    """The smallest id (nulls aside) reachable from each row."""
    distinct = sorted(set(fps))
    root = {f: f for f in distinct}

    def find(f):
        while root[f] != f:
            root[f] = root[root[f]]
            f = root[f]
        return f
    for i, a in enumerate(distinct):
        for b in distinct[i + 1:]:
            if (a ^ b).bit_count() <= bits:
                root[find(a)] = find(b)
    least = {}
    for f, d in zip(fps, ids, strict=True):
        if d is not None:
            least[find(f)] = min(least.get(find(f), d), d)
    return [least.get(find(f)) for f in fps]


def base_counts(text):
    w = words(text)
    found = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if found[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return len(w), sum(len(x.decode()) for x in w), symbols, dup, len(covered)
