"""Pieces of texts as byte-level pre-tokenizers cut them, and a bounded table of their ids."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

OTHER, LETTER, NUMBER, SPACE = range(4)
KNOWN = 200_000         # pieces that a table holds before it starts anew


class Classes:
    """Letter, number, white space or other, by code point: asked of the library's
    pre-tokenizer when a code point is first seen."""

    def __init__(self, tokenizer):
        self._cut = tokenizer.pre_tokenizer.pre_tokenize_str
        self._of = np.full(0x110000, -1, np.int8)

    def __call__(self, points: np.ndarray) -> np.ndarray:
        found = self._of[points]
        if len(found) and found.min() < 0:
            new = np.unique(points[found < 0])
            # behind a letter, a digit and a mark: the class that it does not part from
            probe = "".join(f"a{chr(c)}\n1{chr(c)}\n!{chr(c)}\n" for c in new.tolist())
            starts = np.zeros(len(probe) + 1, bool)
            starts[[s for _, (s, _) in self._cut(probe)]] = True
            letter, number, mark = (~starts[1 + 3 * k:len(probe):9] for k in range(3))
            self._of[new] = np.select([letter, number, mark], [LETTER, NUMBER, OTHER], SPACE)
            found = self._of[points]
        return found


def piece_starts(points: np.ndarray, kind: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where pieces begin; ``first`` are the places at which texts begin (each is taken as ended
    by the next).  Runs of a class are pieces, with one blank before them.  A run of
    white space before something else leaves its last character apart.  After ``'`` that
    begins a piece, an English ending is part of it."""
    n = len(points)
    start = np.zeros(n + 3, bool)
    opens = np.zeros(n + 3, bool)
    opens[first] = opens[n] = True
    start[:n] = opens[:n]
    start[1:n] |= kind[1:] != kind[:-1]
    run = start.copy()
    last = np.flatnonzero((kind == SPACE) & start[1:n + 1] & ~opens[1:n + 1])    # of a space run that something follows
    if n:
        start[last] = True
        start[last[points[last] == 32] + 1] = False
    quote = np.flatnonzero((points == 39) & start[:n] & run[:n] & ~opens[1:n + 1])
    if len(quote):
        ahead = np.concatenate([points, np.zeros(3, points.dtype)])
        a, b = ahead[quote + 1], np.where(opens[quote + 2], 0, ahead[quote + 2])
        two = np.isin(a, [ord(c) for c in "stmd"])
        three = ((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
        for k, those in ((2, quote[two]), (3, quote[three])):
            for d in range(1, k):
                start[those + d] = False
            start[those + k] = True
        start[np.flatnonzero(opens)] = True
    return np.flatnonzero(start[:n])


def code_points(data: bytes) -> np.ndarray:
    if data.isascii():
        return np.frombuffer(data, np.uint8)
    return np.frombuffer(data.decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32)


def bytes_before(points: np.ndarray) -> np.ndarray:
    """UTF-8 bytes before each code point, and in all."""
    if points.dtype == np.uint8:
        return np.arange(len(points) + 1)
    width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
    return np.concatenate([[0], np.cumsum(width)])


class PieceTable:
    """Ids of pieces.  ``learn`` gives the ids of new ones: (all ids one behind the other, how
    many each has).  Two generations are kept: when the young one has more than
    ``known`` pieces it becomes the old one, and what is met again moves over."""

    def __init__(self, learn: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], known: int = KNOWN):
        self._learn, self._known = learn, known
        self._start_anew()
        self._start_anew()

    def _start_anew(self) -> None:
        self.old: dict[bytes, int] = getattr(self, "young", {})
        self._old_ids = getattr(self, "_flat", None), getattr(self, "_place", None)
        self.young: dict[bytes, int] = {}
        self._flat, self._place = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def __len__(self) -> int:
        return len(self.young) + len(self.old)

    def _add(self, keys: list[bytes], flat: np.ndarray, width: np.ndarray) -> None:
        self.young.update(zip(keys, range(len(self.young), len(self.young) + len(keys))))
        self._flat = np.concatenate([self._flat, flat])
        self._place = np.concatenate([self._place, self._place[-1] + np.cumsum(width)])

    def ids(self, data, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces of ``data`` between consecutive ``edges``, and how many each has."""
        if len(edges) < 2:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        coded = pa.Array.from_buffers(pa.large_binary(), len(edges) - 1, [
            None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(data)]).dictionary_encode()
        edge = np.frombuffer(coded.dictionary.buffers()[1], np.int64)[:len(coded.dictionary) + 1].tolist()
        raw = coded.dictionary.buffers()[2].to_pybytes()
        pieces = [raw[a:b] for a, b in zip(edge, edge[1:])]
        if len(self.young) > self._known:
            self._start_anew()
        unseen = [p for p in pieces if p not in self.young]
        if unseen:
            again = [p for p in unseen if p in self.old]
            if again:
                flat, place = self._old_ids
                slot = np.array([self.old[p] for p in again])
                self._add(again, *gather(flat, place, slot))
                unseen = [p for p in unseen if p not in self.old]
            if unseen:
                self._add(unseen, *self._learn(unseen))
        slot = np.fromiter(map(self.young.__getitem__, pieces), np.int64, len(pieces))
        return gather(self._flat, self._place, slot[coded.indices.to_numpy()])


def gather(flat: np.ndarray, place: np.ndarray, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches ``place[s]`` to ``place[s + 1]`` of ``flat``, one behind the other, and their widths."""
    first = place[slot]
    width = place[slot + 1] - first
    total = int(width.sum())
    kind = np.int32 if max(total, len(flat)) < 1 << 31 else np.int64
    at = np.repeat((first - (np.cumsum(width) - width)).astype(kind), width)
    at += np.arange(total, dtype=kind)
    return flat[at], width
