"""Periodic runs in the word sequence of a text, by Baier grouping.

A run is a stretch of consecutive words with smallest period q, at least twice
as long as q, that no neighbouring word extends.  By the runs theorem each run
holds a Lyndon root: a word range that is the longest Lyndon word at its
first position, under the order of the words or under the opposite one.  So

1. phase one of Baier's suffix sorter groups the suffixes by their longest
   Lyndon prefix.  Groups are taken from the highest down; each member marks
   the nearest position before it that belongs to a lower group, and marked
   suffixes move into a new group right above their own, whose prefix is their
   old one with as many copies of the taken one behind it.  The length of a
   group's prefix when it is taken is the Lyndon array's value of its members.
   This is done under both orders; nothing is sorted beyond phase one;
2. each position's Lyndon word is a candidate root.  Longest common extensions
   to the left and right (LCE, by binary search over prefix hashes) stretch it;
   a stretch of enough words is a run;
3. every run found is compared word by word, so that no hash decides a result.

Only positions that can lie in a run of the asked exponent enter step 1: in a
run of exponent e every word occurs e times, so words that are rarer in their
segment cut it.  The cut is exact.  A batch's segments share one grouping; the
work is linear but for a factor log n of the binary search.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from kelpie.llm.common import columns, not_null_text

MIN_LENGTH, MIN_EXPONENT = 6, 4
_CUTS = 4               # rounds of cutting segments at rare words
_FIELDS = (2147483647, 2147483629)      # primes below 2^31: products of two residues fit 62 bits


# --- Lyndon arrays by Baier's phase one ----------------------------------------------------------

def lyndon_lengths(s: np.ndarray) -> np.ndarray:
    """Length of the longest Lyndon word at each position of ``s``.  A negative value
    separates segments: it is below every word and no Lyndon word holds one.
    ``s[0]`` must be a separator."""
    n = len(s)
    out = np.zeros(n, np.int64)
    order = np.argsort(s, kind="stable")
    ranked = s[order]
    first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    members = [order[a:b].tolist() for a, b in zip(first, [*first[1:], n]) if ranked[a] >= 0]
    size = [1] * len(members)
    below = list(range(-1, len(members) - 1))           # next lower and higher group
    above = [*range(1, len(members)), -1]
    group = [-1] * n
    for g, those in enumerate(members):
        for i in those:
            group[i] = g
    lower = list(range(n))                              # union-find: nearest position not yet taken
    taken_at, taken_size = [], []
    g = len(members) - 1
    while g >= 0:
        those = [i for i in members[g] if group[i] == g]    # the others have moved up
        width = size[g]
        for i in those:
            lower[i] = i - 1
        taken_at += those
        taken_size += [width] * len(those)
        count: dict[int, int] = {}
        for i in those:
            j = i - 1
            while (k := lower[j]) != j:
                lower[j] = k = lower[k]                 # halve the path
                j = k
            lower[i] = j
            if group[j] >= 0:
                count[j] = count.get(j, 0) + 1
        moved: dict[tuple[int, int], list[int]] = {}
        for j, c in count.items():
            moved.setdefault((-c, group[j]), []).append(j)
        for c, h in sorted(moved):                      # many copies first: fewer come to lie below them
            new, up = len(size), above[h]
            js = moved[c, h]
            size.append(size[h] - c * width)
            members.append(js)
            below.append(h)
            above.append(up)
            above[h] = new
            if up >= 0:
                below[up] = new
            for j in js:
                group[j] = new
        g = below[g]
    out[taken_at] = taken_size
    return out


# --- longest common extensions -------------------------------------------------------------------

class Extensions:
    """LCE of positions ``i`` and ``i + p``, many at a time, by prefix hashes in two prime
    fields over random values.  Equal stretches never differ in hash; :func:`runs`
    checks the reverse."""

    def __init__(self, s: np.ndarray, seed: int = 11):
        rng = np.random.Generator(np.random.PCG64(seed))
        code = np.where(s >= 0, s, 0)
        apart = np.flatnonzero(s < 0)
        top = int(code.max(initial=0)) + 1
        code[apart] = top + np.arange(len(apart))       # no separator equals another
        self._n = len(s)
        self._fields = []
        for field in _FIELDS:
            f = np.uint64(field)
            base = np.uint64(rng.integers(1 << 20, field - 1))
            power = np.ones(1, np.uint64)
            step = base
            while len(power) <= self._n:
                power = np.concatenate([power, power * step % f])
                step = step * step % f
            value = rng.integers(1, field, top + len(apart), dtype=np.uint64)
            total = np.cumsum(value[code] * power[:self._n] % f, dtype=np.uint64) % f
            self._fields.append((f, power, np.concatenate([np.zeros(1, np.uint64), total])))

    def _equal(self, i: np.ndarray, p: np.ndarray, m: np.ndarray) -> np.ndarray:
        same = np.ones(len(i), bool)
        for f, power, total in self._fields:
            left = (total[i + m] + f - total[i]) % f * power[p] % f
            same &= left == (total[i + p + m] + f - total[i + p]) % f
        return same

    def right(self, i: np.ndarray, p: np.ndarray) -> np.ndarray:
        """How many words from ``i`` on equal those from ``i + p`` on."""
        return self._search(np.zeros(len(i), np.int64), self._n - i - p, lambda m: self._equal(i, p, m))

    def left(self, i: np.ndarray, p: np.ndarray) -> np.ndarray:
        """How many words before ``i`` equal those before ``i + p``."""
        return self._search(np.zeros(len(i), np.int64), i, lambda m: self._equal(i - m, p, m))

    @staticmethod
    def _search(low: np.ndarray, high: np.ndarray, equal) -> np.ndarray:
        high = high.copy()
        while (low < high).any():
            middle = (low + high + 1) >> 1
            same = equal(middle)
            low = np.where(same, middle, low)
            high = np.where(same, high, middle - 1)
        return low


def _exact(s: np.ndarray, i: int, p: int) -> tuple[int, int]:
    """The stretch of period ``p`` around [i, i + p], word by word."""
    a = i
    while a > 0 and s[a - 1] >= 0 and s[a - 1] == s[a - 1 + p]:
        a -= 1
    b = i + p
    while b < len(s) and s[b] >= 0 and s[b] == s[b - p]:
        b += 1
    return a, b - a


def runs(s: np.ndarray, min_length: int = MIN_LENGTH, min_exponent: float = MIN_EXPONENT) -> np.ndarray:
    """Rows (start, length, period) of the runs of ``s``, by start, then period.  Negative
    values separate segments; ``s`` must begin and end with one."""
    if not (s >= 0).any():
        return np.empty((0, 3), np.int64)
    whole = max(2, int(min_exponent))
    extend, found = Extensions(s), []
    for order in (s, np.where(s >= 0, s.max() - s, -1)):
        p = lyndon_lengths(order)
        i = np.flatnonzero(p)
        for t in range(1, whole):       # the first root of a run recurs right behind itself
            i = i[i + t * p[i] < len(s)]
            i = i[s[i + t * p[i]] == s[i]]
        q = p[i]
        r, l = extend.right(i, q), extend.left(i, q)
        good = (l + r >= q) & (l + r + q >= min_length) & (l + r + q >= min_exponent * q)
        found.append(np.stack([i - l, q + l + r, q, i], 1)[good])
    rows = np.concatenate(found)
    rows = rows[np.unique(rows[:, [0, 2, 1]], axis=0, return_index=True)[1]]
    out = []
    for start, length, period, i in rows.tolist():
        if not np.array_equal(s[start:start + length - period], s[start + period:start + length]):
            start, length = _exact(s, i, period)        # two stretches met in both hashes
            if length < max(min_length, min_exponent * period, 2 * period):
                continue
        out.append((start, length, period))
    return np.array(sorted(set(out), key=lambda x: (x[0], x[2])), np.int64).reshape(-1, 3)


# --- texts ---------------------------------------------------------------------------------------

def _segments(code: np.ndarray, doc: np.ndarray, least: int, times: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions that may lie in a run, and the segment of each: cut at words that
    occur fewer than ``times`` times in their segment."""
    at, part = np.arange(len(code)), doc
    for _ in range(_CUTS):
        before = len(at)
        _, inverse, count = np.unique(part * (int(code.max(initial=0)) + 1) + code[at], return_inverse=True,
                                      return_counts=True)
        at = at[count[inverse] >= times]
        if not len(at):
            break
        new = np.concatenate([[True], (np.diff(at) != 1) | (np.diff(doc[at]) != 0)])
        part = np.cumsum(new) - 1
        long = np.bincount(part)[part] >= least
        at, part = at[long], part[long]
        if len(at) == before:
            break
    return at, part


def text_runs(words: list[list[bytes]], min_length: int, min_exponent: float) -> list[np.ndarray]:
    """The runs of each word list, with starts counted from its first word."""
    code = np.empty(sum(map(len, words)), np.int64)
    first = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)
    for k, those in enumerate(words):
        index: dict[bytes, int] = {}
        code[first[k]:first[k + 1]] = [index.setdefault(w, len(index)) for w in those]
    doc = np.repeat(np.arange(len(words)), np.diff(first))
    times = max(2, int(min_exponent))
    at, part = _segments(code, doc, max(min_length, times), times)
    if not len(at):
        return [np.empty((0, 3), np.int64)] * len(words)
    _, part = np.unique(part, return_inverse=True)
    place = np.arange(len(at)) + part + 1               # one separator before each segment
    s = np.full(place[-1] + 2, -1, np.int64)
    s[place] = np.unique(code[at], return_inverse=True)[1]
    origin = np.zeros(len(s), np.int64)
    origin[place] = at
    found = runs(s, min_length, min_exponent)
    found[:, 0] = origin[found[:, 0]]
    of = doc[found[:, 0]]
    found[:, 0] -= first[of]
    cuts = np.searchsorted(of, np.arange(len(words) + 1))
    return [found[a:b] for a, b in zip(cuts[:-1], cuts[1:])]


def collapse(words: list[bytes], found: np.ndarray) -> bytes:
    """The words but for those that a run holds after its first period."""
    if len(found):
        start, length, period = found.T
        step = np.bincount(start + period, minlength=len(words) + 1) - np.bincount(start + length, minlength=len(words) + 1)
        words = [words[i] for i in np.flatnonzero(np.cumsum(step)[:-1] == 0).tolist()]
    return b" ".join(words)


SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def find_runs(docs: DataFrame, min_length: int = MIN_LENGTH, min_exponent: float = MIN_EXPONENT) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_words, ``runs`` (start, length, period; by
    start, then period) of at least ``min_length`` words and ``min_exponent`` >= 2 periods, and
    ``collapsed``: the text's words joined by one space, without those that any run
    holds after its first period.

    Words are maximal runs of characters other than blank and U+0009 to U+000D.  A null
    text has no words: no runs, an empty ``collapsed``.  Each row is judged by itself,
    so null and repeated ids and repeated rows give a row each; texts of any length
    are taken whole.  Other columns are ignored; an empty table gives no rows."""
    if min_exponent < 2:
        raise ValueError("a run has at least two periods")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = [t.encode("utf-8", "surrogatepass").split() for t in b.column(1).to_pylist()]
            found = text_runs(words, min_length, min_exponent)
            offsets = np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int32)
            rows = np.concatenate([np.empty((0, 3), np.int64), *found])
            listed = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(
                [pa.array(np.ascontiguousarray(rows[:, k])) for k in range(3)], ["start", "length", "period"]))
            texts = pa.array([collapse(w, f) for w, f in zip(words, found)], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(w) for w in words], pa.int64()), listed, texts],
                ["doc_id", "n_words", "runs", "collapsed"])

    src = columns(docs, doc_id="long", text="string").withColumn("text", not_null_text())
    return src.mapInArrow(find, SCHEMA)
