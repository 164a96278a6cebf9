import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from kelpie.llm import langid
from kelpie.llm.queries import QUERIES
from tests.llm.helpers import awkward, clashing, documents


def plain_grams(text):
    import unicodedata
    low = unicodedata.normalize("NFC", text).lower()
    words = "".join(c if c.isalpha() else " " for c in low).split()
    if not words:
        return []
    s = "_" + "_".join(words) + "_"
    return [s[i:i + n] for n in (1, 2, 3) for i in range(len(s) - n + 1) if s[i:i + n] != "_"]


def plain_top(counts, size):
    return [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:size]]


def plain_predict(text, profiles, size):
    counts = Counter(plain_grams(text or ""))
    if not counts or not profiles:
        return "und", 0.0
    own = plain_top(counts, size)
    away = {l: sum(abs(p.index(g) - r) if g in p else size for r, g in enumerate(own)) for l, p in sorted(profiles.items())}
    best = min(away, key=lambda l: (away[l], l))
    return best, 1 - away[best] / (size * len(own))


def name(code):
    return "".join(chr(c) for c in (code >> 42, code >> 21 & 0x1FFFFF, code & 0x1FFFFF) if c)


def test_profiles_and_predictions_against_the_plain_version(spark, monkeypatch):
    monkeypatch.setattr(langid, "FLUSH", 2000)      # partial counts are handed on early
    rows = awkward()
    counts = {}
    for _, t, lang, _ in rows:
        if t is not None and lang is not None:
            counts.setdefault(lang, Counter()).update(plain_grams(t))
    size = 60
    want = {lang: plain_top(c, size) for lang, c in counts.items()}
    df = clashing(documents(spark, rows).repartition(3))
    got = langid.learn(df, size)
    assert {l: [name(g) for g in p] for l, p in got.items()} == want
    p = langid.Profiles.of(got, size)
    found = sorted(map(str, ((r["doc_id"], r["lang_pred"], round(r["score"], 9)) for r in langid.predict(df, p).collect())))
    assert found == sorted(str((d, l, round(s, 9))) for d, t, _, _ in rows for l, s in [plain_predict(t, want, size)])


def test_texts_without_letters_and_without_profiles(spark):
    df = documents(spark, [(1, None, "en", "s"), (2, "", "en", "s"), (3, "12 !? 🙂", "en", "s"), (4, "abc", None, "s")])
    p = langid.Profiles.of(langid.learn(df))
    assert {(r["lang_pred"], r["score"]) for r in langid.predict(df, p).collect()} == {("und", 0.0)}
    assert langid.learn(documents(spark, [])) == {}
    assert langid.predict(documents(spark, []), p).count() == 0


def test_held_out_rows(spark):
    got = spark.range(500).select("id", langid.held_out("id").alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 3 == 1) for r in got)
    assert spark.sql("SELECT CAST(NULL AS long) doc_id").select(langid.held_out().alias("h")).first()["h"] is False


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    got = QUERIES["op9_language_id"](spark, sf).join(truth, "doc_id").where("held_out")
    r = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("right"), F.min("score").alias("lo"),
                F.max("score").alias("hi")).first()
    assert r["right"] > 0.97 and 0 <= r["lo"] <= r["hi"] <= 1


def test_grams_keep_string_order():
    codes = np.unique(langid.grams(langid.letters_only("Straße, où çà! aa a")))
    assert [name(c) for c in codes] == sorted(set(plain_grams("Straße, où çà! aa a")))
