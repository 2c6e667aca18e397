"""Tokenizing inside tasks: token ids of whole texts, exactly as the ``tokenizers`` library gives them.

Both public vocabularies split a text into pieces before they merge, and pieces are encoded one by
one. Pieces repeat, so each worker process keeps the ids of those it has met (a bounded table) and
asks the library for new ones only. A text with any character outside ``_PLAIN``, or with ``<|`` (the
start of a special token), is given to the library whole.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa

#: Latin letters and numbers of the characters in ``_PLAIN``.
_L = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xffŒœ"
_N = "0-9\xb2\xb3\xb9\xbc-\xbe"
_PLAIN = re.compile("[\t\n\r\x20-\x7e\xa1-\xffŒœ]*")
#: The piece patterns of the two vocabularies, as their files state them.
_PIECES = {
    "byte": re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^\s{_L}{_N}]+|\s+(?!\S)|\s+"),
    "word": re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^\s{_L}{_N}]+"),
}
#: What a worker process holds at most: pieces with known ids, characters encoded at a time. Together
#: about 500 MB; smaller numbers cost time (see ``SMALL``, about 300 MB), never results.
KNOWN_PIECES = 1_200_000
BATCH_CHARS = 6 << 20
SMALL = (300_000, 1 << 20)


def _grown(x: np.ndarray, n: int) -> np.ndarray:
    return x if n <= len(x) else np.concatenate((x, np.zeros(max(n, 2 * len(x)) - len(x), x.dtype)))


class Encoder:
    """Token ids by the vocabulary file at ``path``."""

    def __init__(self, path: str, known_pieces: int | None = None):
        self.known_pieces = known_pieces or KNOWN_PIECES
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are the parallelism
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        name = os.path.basename(path)
        self.pieces = next((p for k, p in _PIECES.items() if name.startswith(f"{k}_bpe_")), None)
        self.lower = name.startswith("word_bpe_")
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.n_ids = np.zeros(1 << 16, dtype=np.uint32), 0
        self.at, self.size = np.zeros(1 << 14, dtype=np.int64), np.zeros(1 << 14, dtype=np.int64)

    def _learn(self, new: list[str]) -> None:
        ids, size = [], []
        for k in range(0, len(new), 8192):  # encodings are large: few at a time
            groups = [new[j:j + 512] for j in range(k, min(k + 8192, len(new)), 512)]
            for e, g in zip(self.library.encode_batch(groups, is_pretokenized=True, add_special_tokens=False), groups, strict=True):
                ids.append(np.array(e.ids, dtype=np.uint32))
                size.append(np.bincount(np.array(e.word_ids, dtype=np.int64), minlength=len(g)))
        ids, size = np.concatenate(ids), np.concatenate(size)
        n, end = len(self.known), self.n_ids + len(ids)
        self.ids, self.at, self.size = _grown(self.ids, end), _grown(self.at, n + len(new)), _grown(self.size, n + len(new))
        self.ids[self.n_ids:end] = ids
        self.at[n:n + len(new)] = self.n_ids + np.cumsum(size) - size
        self.size[n:n + len(new)] = size
        self.known.update(zip(new, range(n, n + len(new)), strict=True))
        self.n_ids = end

    def _split(self, text: str) -> list[str] | None:
        if self.pieces is None or "<|" in text or _PLAIN.fullmatch(text) is None:
            return None
        return self.pieces.findall(text.lower() if self.lower else text)

    def encode(self, texts: list[str], end_id: int) -> list[np.ndarray]:
        """The ids of each text, ``end_id`` appended."""
        split = [self._split(t) for t in texts]
        whole = [t for t, s in zip(texts, split, strict=True) if s is None]
        whole = iter([e.ids for e in self.library.encode_batch_fast(whole, add_special_tokens=False)] if whole else [])
        met = pa.array(list(chain.from_iterable(s for s in split if s is not None)), pa.string()).dictionary_encode()
        distinct = met.dictionary.to_numpy(zero_copy_only=False)
        got = list(map(self.known.get, distinct))
        if None in got:
            new = [p for p, k in zip(distinct, got, strict=True) if k is None]
            if len(self.known) + len(new) > self.known_pieces:
                self._forget()
                new = list(distinct)
            self._learn(new)
            got = list(map(self.known.get, distinct)) if len(new) == len(distinct) else [
                self.known[p] if k is None else k for p, k in zip(distinct, got, strict=True)]
        k = np.array(got, dtype=np.int64)[np.asarray(met.indices)]
        at, size = self.at[k], self.size[k]
        ends = np.cumsum(size)
        flat = self.ids[np.repeat(at - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)]
        bounds = np.concatenate(([0], ends))
        out, n, last = [], 0, np.array([end_id], dtype=np.uint32)
        for s in split:
            if s is None:
                own = np.array(next(whole), dtype=np.uint32)
            else:
                own = flat[bounds[n]:bounds[n + len(s)]]
                n += len(s)
            out.append(np.concatenate((own, last)))
        return out


@lru_cache(maxsize=1)
def encoder(path: str, known_pieces: int | None = None) -> Encoder:
    """One encoder per worker process."""
    return Encoder(path, known_pieces)


def encode_column(column: pa.Array, path: str, end_id: int, limits: tuple[int, int] | None = None) -> Iterator[np.ndarray]:
    """Ids of each text of a string column (a null is empty), a bounded number of characters at a time.
    ``limits`` are (known pieces, characters); the module's own by default."""
    known_pieces, batch_chars = limits or (KNOWN_PIECES, BATCH_CHARS)
    own, texts, chars = encoder(path, known_pieces), [], 0
    for value in column:
        text = value.as_py() or ""
        texts.append(text)
        chars += len(text)
        if chars >= batch_chars:
            yield from own.encode(texts, end_id)
            texts, chars = [], 0
    if texts:
        yield from own.encode(texts, end_id)
