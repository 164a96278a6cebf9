"""Vectorised word, line and n-gram work on chunks of whole texts (NumPy).

A chunk is the UTF-8 bytes of some texts, each closed by a line feed.  Words are
maximal runs of bytes other than 0x20 and 0x09-0x0D; no byte of a longer UTF-8
sequence is one of these.  Lines, words and windows of words are equal if their bytes are: each
distinct one gets a number, windows by doubling from the numbers of their halves.  Only
n-gram features go by 64-bit polynomial hashes over per-byte random values."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
_rng = np.random.Generator(np.random.PCG64(2024))
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_P = np.uint64(0x9E3779B97F4A7C17)      # odd: it has an inverse modulo 2^64
_PINV = np.uint64(pow(int(_P), -1, 1 << 64))
_G = np.uint64(0xBF58476D1CE4E5B9)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """P^0..P^(n-1) and their inverses, modulo 2^64."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_P, _PINV)):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            _powers[k] = np.cumprod(p, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _G
    return h ^ (h >> np.uint64(29))


def chunks(texts: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) in runs of about ``most`` characters; null counts as empty.
    A text is never cut: a longer one is a chunk of its own."""
    first, held, size = 0, [], 0
    for i in range(len(texts)):
        t = texts[i].as_py() or ""
        if held and size + len(t) > most:
            yield first, held
            first, held, size = i, [], 0
        held.append(t)
        size += len(t) + 1
    if held:
        yield first, held


class Chunk:
    """Words and lines of some texts, by document."""

    def __init__(self, texts: list[str]):
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        data = np.frombuffer(b"\n" + b"\n".join(raw) + b"\n", np.uint8)
        self.n = len(texts)
        size = np.fromiter((len(r) for r in raw), np.int64, self.n)
        self.start = 1 + np.concatenate([[0], np.cumsum(size[:-1] + 1)])    # first byte of each text
        self.end = self.start + size
        space = _SPACE[data]
        edge = np.flatnonzero(space[1:] != space[:-1]) + 1
        self.w0, self.w1 = edge[0::2], edge[1::2]                           # words: [w0, w1)
        self.wdoc = np.searchsorted(self.start, self.w0, "right") - 1
        self.n_words = np.bincount(self.wdoc, minlength=self.n)
        self._data, self._space = data, space
        power, self._inv = _power(len(data) + 1)
        self._sum = np.concatenate([np.zeros(1, np.uint64),
                                    np.cumsum(_BYTE[data] * power[:len(data)], dtype=np.uint64)])
        self.whash = mix(self._hash(self.w0, self.w1))

    def _hash(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (self._sum[b] - self._sum[a]) * self._inv[a] + (b - a).astype(np.uint64)

    def _count(self, mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return total[self.end] - total[self.start]

    def word_chars(self) -> np.ndarray:
        """Code points in words: bytes that start a character."""
        return self._count(~self._space & ((self._data & 0xC0) != 0x80))

    def n_symbols(self) -> np.ndarray:
        return self._count(_SYMBOL[self._data])

    def _names(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """A number for each stretch [a, b) of bytes, equal for equal stretches only.  The
        stretches ascend and don't overlap."""
        if not len(a):
            return np.zeros(0, np.int64)
        edges = np.stack([a, b], 1).ravel().astype(np.int64)       # what lies between is numbered too
        coded = pa.Array.from_buffers(pa.large_binary(), len(edges) - 1, [
            None, pa.py_buffer(edges), pa.py_buffer(self._data)]).dictionary_encode()
        return coded.indices.to_numpy()[::2].astype(np.int64)

    def n_dup_lines(self) -> np.ndarray:
        """Lines with a word that equal an earlier line of their text."""
        feeds = np.flatnonzero(self._data == 10)
        a, b = feeds[:-1] + 1, feeds[1:]
        with_word = np.searchsorted(self.w0, a) != np.searchsorted(self.w0, b)
        a, b = a[with_word], b[with_word]
        doc = np.searchsorted(self.start, a, "right") - 1
        first = np.unique(self._names(a, b) * self.n + doc, return_index=True)[1]
        return np.bincount(doc, minlength=self.n) - np.bincount(doc[first], minlength=self.n)

    def n_repeat_words(self, width: int = 8) -> np.ndarray:
        """Words covered by windows of ``width`` words that their text holds twice or more."""
        m = len(self.w0) - width + 1
        if m <= 0:
            return np.zeros(self.n, np.int64)
        name, have = self._names(self.w0, self.w1), 1
        while have < width:                             # windows of the next power of two, then of the width itself
            step = min(have, width - have)
            pair = name[:len(name) - step] * (int(name.max()) + 1) + name[step:]
            name, have = np.unique(pair, return_inverse=True)[1], have + step
        at = np.flatnonzero(self.wdoc[:m] == self.wdoc[width - 1:])
        _, inverse, count = np.unique(name[at] * self.n + self.wdoc[at], return_inverse=True, return_counts=True)
        again = at[count[inverse] > 1]
        step = np.bincount(again, minlength=len(self.w0) + 1) \
            - np.bincount(again + width, minlength=len(self.w0) + 1)
        covered = np.cumsum(step)[:-1] > 0
        return np.bincount(self.wdoc[covered], minlength=self.n)


class Grams:
    """Hashed word and character n-grams of a chunk: ``parts`` yields, for each
    kind of n-gram, the feature of every gram and each text's range of grams."""

    def __init__(self, texts: list[str], chunk: Chunk, bits: int):
        self.texts, self.chunk, self.bits = texts, chunk, bits

    def _feature(self, h: np.ndarray, kind: int) -> np.ndarray:
        return (mix(h + np.uint64((kind * int(_G)) & (2**64 - 1))) >> np.uint64(64 - self.bits)).astype(np.int64)

    def parts(self, word_n: tuple[int, ...], char_n: tuple[int, ...]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        c = self.chunk
        first = np.concatenate([[0], np.cumsum(c.n_words)])
        for n in word_n:
            h = np.zeros(max(0, len(c.whash) - n + 1), np.uint64)
            for k in range(n):
                h = h * _P + c.whash[k:k + len(h)]
            yield self._feature(h, n), first[:-1], np.maximum(first[:-1], first[1:] - n + 1)
        points = np.frombuffer("".join(self.texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        first = np.concatenate([[0], np.cumsum([len(t) for t in self.texts])])
        for n in char_n:
            h = np.zeros(max(0, len(points) - n + 1), np.uint64)
            for k in range(n):
                h = h * _P + points[k:k + len(h)]
            yield self._feature(h, 100 + n), first[:-1], np.maximum(first[:-1], first[1:] - n + 1)
