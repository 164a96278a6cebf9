"""Periodic runs against plain versions: Lyndon words by definition, runs by scanning every period."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from kelpie.llm import periodic
from kelpie.llm.queries import op11_periodic_runs

from .helpers import WORD, awkward, clashing, documents, prose


def plain_lyndon(s):
    return [max(j - i for j in range(i + 1, len(s) + 1)
                if all(s[i:j] < s[k:j] for k in range(i + 1, j))) for i in range(len(s))]


def plain_runs(s, min_length, min_exponent):
    found = {}
    for p in range(1, len(s) // 2 + 1):
        i = 0
        while i + p < len(s):
            j = i
            while j + p < len(s) and s[j] == s[j + p]:
                j += 1
            if j > i and j - i + p >= max(min_length, min_exponent * p, 2 * p):
                found.setdefault((i, j - i + p), p)         # the smallest period wins
            i = j + 1
    return sorted((a, n, p) for (a, n), p in found.items())


def plain_collapse(words, found):
    dropped = {k for a, n, p in found for k in range(a + p, a + n)}
    return " ".join(w for k, w in enumerate(words) if k not in dropped)


def as_array(s):
    return np.array([-1, *s, -1])


@pytest.mark.parametrize("letters", [1, 2, 3, 5])
def test_lyndon_arrays_under_both_orders(letters):
    rng = random.Random(letters)
    for _ in range(150):
        s = [rng.randrange(letters) for _ in range(rng.randint(1, 22))]
        assert periodic.lyndon_lengths(as_array(s))[1:-1].tolist() == plain_lyndon(s)
        back = [letters - x for x in s]
        assert periodic.lyndon_lengths(as_array(back))[1:-1].tolist() == plain_lyndon(back)


def test_separators_bound_lyndon_words():
    s = np.array([-1, 0, 1, -1, 0, 0, 1, -1])
    assert periodic.lyndon_lengths(s).tolist() == [0, 2, 1, 0, 3, 2, 1, 0]


@pytest.mark.parametrize("least, exponent", [(2, 2), (6, 4), (3, 2.5), (1, 3)])
def test_runs_of_random_words(least, exponent):
    rng = random.Random(int(10 * exponent))
    for _ in range(300):
        s = [rng.randrange(rng.randint(1, 4)) for _ in range(rng.randint(1, 40))]
        got = periodic.runs(as_array(s), least, exponent)
        assert [(a - 1, n, p) for a, n, p in got.tolist()] == plain_runs(s, least, exponent)


@pytest.mark.parametrize("s", ["a" * 50, "ab" * 30 + "a", "abaababaabaab" * 4, "aab" * 9 + "aaaaaaa" + "b" * 8, "abcd" * 4 + "e" + "abcd" * 4])
def test_runs_of_periodic_words(s):
    codes = [ord(c) for c in s]
    for least, exponent in ((2, 2), (6, 4)):
        got = periodic.runs(as_array(codes), least, exponent)
        assert [(a - 1, n, p) for a, n, p in got.tolist()] == plain_runs(codes, least, exponent)


def test_fibonacci_and_thue_morse():
    a, b = "a", "ab"
    while len(b) < 300:
        a, b = b, b + a
    t = [bin(i).count("1") % 2 for i in range(512)]
    for s in ([ord(c) for c in b], t, t + [1 - x for x in t]):
        got = periodic.runs(as_array(s), 2, 2)
        assert [(x - 1, n, p) for x, n, p in got.tolist()] == plain_runs(s, 2, 2)


def test_a_hash_that_always_agrees_changes_nothing(monkeypatch):
    """The word-by-word check decides, not the hash."""
    s = [1, 2, 1, 2, 1, 2, 1, 2, 3, 3, 3, 3, 3, 3, 3]
    monkeypatch.setattr(periodic, "_FIELDS", ())
    got = periodic.runs(as_array(s), 6, 4)
    assert [(a - 1, n, p) for a, n, p in got.tolist()] == plain_runs(s, 6, 4)


def test_long_texts_in_linear_time():
    words = [b"w%d" % (i % 1000) for i in range(200_000)]
    assert periodic.text_runs([words], 6, 4)[0].tolist() == [[0, 200_000, 1000]]
    rng = np.random.default_rng(1)
    noise = [b"%d" % x for x in rng.integers(0, 2, 50_000)]
    got = periodic.text_runs([noise], 6, 4)[0]
    s = np.array([int(x) for x in noise])
    for a, n, p in got.tolist()[:200]:
        assert (s[a:a + n - p] == s[a + p:a + n]).all()


def texts():
    rows = awkward()
    rows += [(500, "na " * 40 + "batman", "en", "s0"), (501, "x " * 5, "en", "s0"), (502, "x " * 6, "en", "s0"),
             (503, "so \t la\nsi\x0bdo " * 9 + "la si do", "en", "s0"), (504, "a b a b a b a b a b a b", None, "s0"),
             (505, prose(1, 60) + " " + "la li lu " * 30 + prose(2, 40) + " ha" * 25, "en", "s1")]
    return rows


def plain_row(text, rewrite=None):
    words = WORD.findall(text or "")
    if rewrite is not None and words:
        words = rewrite(words)
    ids = {}
    s = [ids.setdefault(w, len(ids)) for w in words]
    found = plain_runs(s, 6, 4) if len(s) < 2000 else None
    return words, found


def test_find_runs(spark):
    rows = texts()
    got = periodic.find_runs(clashing(documents(spark, rows))).collect()
    assert len(got) == len(rows)
    have = sorted((str(r["doc_id"]), r["n_words"], tuple(tuple(x) for x in r["runs"]), r["collapsed"]) for r in got)
    want = []
    for d, t, _, _ in rows:
        words, found = plain_row(t)
        if found is None:
            found = [tuple(x) for x in periodic.text_runs([[w.encode() for w in words]], 6, 4)[0].tolist()]
        want.append((str(d), len(words), tuple(found), plain_collapse(words, found)))
    assert have == sorted(want)
    assert any(r["runs"] for r in got)


def test_empty_table_and_bad_exponent(spark):
    assert periodic.find_runs(documents(spark, [])).collect() == []
    with pytest.raises(ValueError):
        periodic.find_runs(documents(spark, []), min_exponent=1.5)


def test_query_against_the_plain_version(spark, tmp_path):
    rows = [(i, t, lang, s) for i, (_, t, lang, s) in enumerate(texts() * 4) if len(t or "") < 20_000] \
        + [(None, "ha " * 20, "en", "s0"), (None, None, None, None)]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = op11_periodic_runs(spark, str(tmp_path)).collect()
    changed, want = 0, []
    for d, t, _, _ in rows:
        rewrite = None
        if d is not None and (h := zlib.crc32(str(d).encode())) % 10 == 0:
            def rewrite(w, g=h // 10):
                n = len(w)
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
            changed += bool(t)
        words, found = plain_row(t, rewrite)
        best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None, None, None)
        want.append((d, len(found), *best, None if not found else 1000 * best[1] // best[2],
                     hashlib.sha256("".join(f"{a},{n},{p}\n" for a, n, p in found).encode()).hexdigest(),
                     hashlib.sha256(plain_collapse(words, found).encode()).hexdigest()))
    assert changed > 10
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want))
    assert dict(op11_periodic_runs(spark, str(tmp_path)).dtypes)["exponent_milli"] == "bigint"
