"""Language identification by rank-order profiles.

A language's profile is the ranked list of its most frequent character n-grams
(one to three letters, word edges included), counted over all training rows in
Spark.  A document gets the same kind of list; its out-of-place distance to a
profile is the sum, over the document's n-grams, of how far the two ranks lie
apart, or the profile's length where the profile lacks the n-gram.  The nearest
profile wins.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kelpie.llm.common import columns

PROFILE = 400           # n-grams in a profile and in a document's list
HOLDOUT = 3
UNKNOWN = "und"
EDGE = ord("_")
FLUSH = 1 << 20         # distinct n-grams a task holds before it hands on partial counts

_letter: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """For every code point whether it is a letter."""
    if not _letter:
        _letter.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _letter[0]


def letters_only(text: str) -> np.ndarray:
    """Code points of the lower-cased text, every run of other characters one edge; empty without a letter."""
    low = unicodedata.normalize("NFC", text).lower()
    points = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    is_letter = _letters()[points]
    if not is_letter.any():
        return points[:0]
    points[~is_letter] = EDGE
    points = np.concatenate([[EDGE], points, [EDGE]])
    keep = np.ones(len(points), bool)
    keep[1:] = (points[1:] != EDGE) | (points[:-1] != EDGE)
    return points[keep]


def grams(points: np.ndarray) -> np.ndarray:
    """All n-grams as integers of three 21-bit places, the first character highest;
    their order is that of the strings."""
    one = points << 42
    two = one[:-1] | points[1:] << 21
    three = two[:-1] | points[2:]
    return np.concatenate([one[points != EDGE], two, three])


def counted(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    codes = np.sort(codes)
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.zeros(0, np.int64)
    return codes[first], np.diff(np.append(first, len(codes)))


def top(codes: np.ndarray, size: int) -> np.ndarray:
    """The most frequent n-grams, at equal counts in string order."""
    gram, n = counted(codes)
    return gram[np.argsort(-n, kind="stable")[:size]]


def _count_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts (lang, gram, n)."""
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

    def merged(lang: str) -> tuple[np.ndarray, np.ndarray]:
        gram, inverse = np.unique(np.concatenate([g for g, _ in held[lang]]), return_inverse=True)
        return gram, np.bincount(inverse, np.concatenate([n for _, n in held[lang]])).astype(np.int64)

    def flush() -> Iterator[pa.RecordBatch]:
        for lang in list(held):
            gram, n = merged(lang)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(gram), pa.string()), pa.array(gram, pa.int64()),
                                              pa.array(n, pa.int64())], ["lang", "gram", "n"])
            del held[lang]

    waiting: dict[str, list[np.ndarray]] = {}
    size = total = 0

    def fold() -> None:
        nonlocal size, total
        for lang, parts in waiting.items():
            held.setdefault(lang, []).append(counted(np.concatenate(parts)))
            held[lang] = [merged(lang)]
        waiting.clear()
        size, total = 0, sum(len(x[0][0]) for x in held.values())

    for b in batches:
        for i in range(b.num_rows):
            points = letters_only(b.column(1)[i].as_py())
            if len(points):
                codes = grams(points)
                waiting.setdefault(b.column(0)[i].as_py(), []).append(codes)
                size += len(codes)
            if size > FLUSH:
                fold()
                if total > FLUSH:
                    yield from flush()
    fold()
    yield from flush()


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a row is kept from training; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % HOLDOUT == 1, F.lit(False))


def learn(docs: DataFrame, size: int = PROFILE) -> dict[str, list[int]]:
    """Profiles from the rows of ``docs`` (text, lang) whose text and lang are not null.
    What reaches the driver is ``size`` n-grams a language."""
    rows = columns(docs, lang="string", text="string").where("lang IS NOT NULL AND text IS NOT NULL")
    counts = rows.mapInArrow(_count_partition, "lang string, gram long, n long") \
        .groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = (F.col("n").desc(), F.col("gram"))
    # ranked within slices of a language first, so that no task sees all its n-grams
    part = Window.partitionBy("lang", "part").orderBy(*order)
    whole = Window.partitionBy("lang").orderBy(*order)
    best = counts.withColumn("part", F.pmod(F.xxhash64("gram"), F.lit(32))) \
        .withColumn("r", F.row_number().over(part)).where(F.col("r") <= size).drop("part", "r") \
        .withColumn("r", F.row_number().over(whole)).where(F.col("r") <= size)
    out: dict[str, list[int]] = {}
    for row in sorted(best.select("lang", "r", "gram").collect()):
        out.setdefault(row["lang"], []).append(row["gram"])
    return out


@dataclass(frozen=True)
class Profiles:
    langs: list[str]
    gram: np.ndarray        # sorted n-grams of all profiles
    rank: np.ndarray        # (n-gram, language) -> rank, ``size`` where the profile lacks it
    size: int

    @classmethod
    def of(cls, lists: dict[str, list[int]], size: int = PROFILE) -> Profiles:
        langs = sorted(lists)
        gram = np.unique(np.array([g for l in langs for g in lists[l]], np.int64))
        rank = np.full((len(gram) + 1, len(langs)), size, np.int64)     # the last row: in no profile
        for k, lang in enumerate(langs):
            own = np.array(lists[lang], np.int64)
            rank[np.searchsorted(gram, own), k] = np.arange(len(own))
        return cls(langs, gram, rank, size)

    def predict(self, text: str | None) -> tuple[str, float]:
        points = letters_only(text or "")
        if not len(points) or not self.langs:
            return UNKNOWN, 0.0
        own = top(grams(points), self.size)
        at = np.minimum(np.searchsorted(self.gram, own), len(self.gram) - 1)
        at[self.gram[at] != own] = len(self.gram)
        ranks = self.rank[at]
        away = np.abs(ranks - np.arange(len(own))[:, None])
        away[ranks == self.size] = self.size
        distance = away.sum(0)
        best = int(distance.argmin())
        return self.langs[best], 1.0 - float(distance[best]) / (self.size * len(own))


def predict(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """(doc_id, lang_pred, score) for every row of ``docs`` (doc_id, text), by text alone.
    ``und`` with score 0 if the text is null, has no letter, or nothing was
    learned; at equal distances the first language in code point order; null
    ids and repeated rows are ordinary rows."""
    shared = docs.sparkSession.sparkContext.broadcast(profiles)     # languages x PROFILE n-grams

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value
        for b in batches:
            got = [p.predict(b.column(1)[i].as_py()) for i in range(b.num_rows)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([l for l, _ in got], pa.string()),
                                              pa.array([s for _, s in got], pa.float64())],
                                             ["doc_id", "lang_pred", "score"])

    return columns(docs, doc_id="long", text="string").mapInArrow(run, "doc_id long, lang_pred string, score double")
