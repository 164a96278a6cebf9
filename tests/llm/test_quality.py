from collections import Counter

import numpy as np
import pytest

from kelpie.llm import quality
from kelpie.llm.textstats import Chunk, chunks
from tests.llm.helpers import WORD, awkward, clashing, documents, prose


def plain(text):
    """The five counts, by the book."""
    text = text or ""
    w = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = {k for i in range(len(w) - 7) if windows[tuple(w[i:i + 8])] > 1 for k in range(i, i + 8)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


TEXTS = [t for _, t, _, _ in awkward()] + [
    "a\na\na \n a\n\n\n", "x " * 9, "a b c d e f g h i a b c d e f g h i", "### $$ <b>&amp;</b> |*|%", "\n", "é\né\n　\n　",
    "same line here\n" * 5, "1 2 3 4 5 6 7 8 " * 2 + "9", "a\x0b\x0c\rb", "🙂🙂 ß"]


def test_counts_against_the_plain_version():
    import pyarrow as pa
    for most in (1, 500, 1 << 20):
        got = []
        for first, texts in chunks(pa.array(TEXTS, pa.string()), most):
            assert first == len(got)
            c = Chunk(texts)
            got += list(zip(*(x.tolist() for x in (c.n_words, c.word_chars(), c.n_symbols(), c.n_dup_lines(),
                                                    c.n_repeat_words()))))
        assert got == [plain(t) for t in TEXTS]


def test_counts_on_random_texts():
    rng = np.random.default_rng(1)
    texts = ["".join(rng.choice(list("ab \n#é"), rng.integers(0, 120))) for _ in range(400)]
    c = Chunk(texts)
    got = list(zip(*(x.tolist() for x in (c.n_words, c.word_chars(), c.n_symbols(), c.n_dup_lines(), c.n_repeat_words()))))
    assert got == [plain(t) for t in texts]


def thue_morse(n, flip=0):
    return "".join("ab"[(bin(i).count("1") + flip) % 2] for i in range(n))


def test_counts_of_texts_that_collide_in_polynomial_hashes():
    """A Thue-Morse word and its complement have one hash modulo 2^64, whatever the base."""
    a, b = thue_morse(2048), thue_morse(2048, 1)
    texts = [f"{a}\n{b}", f"{a}\n{b}\n{a}", f"w0 w1 w2 w3 w4 w5 w6 {a} w0 w1 w2 w3 w4 w5 w6 {b}",
             f"w0 w1 w2 w3 w4 w5 w6 {a} w0 w1 w2 w3 w4 w5 w6 {a}", " ".join(thue_morse(4096)), "\n".join(thue_morse(4096))]
    c = Chunk(texts)
    got = list(zip(*(x.tolist() for x in (c.n_words, c.word_chars(), c.n_symbols(), c.n_dup_lines(), c.n_repeat_words()))))
    assert got == [plain(t) for t in texts]
    assert [g[3] for g in got[:3]] == [0, 1, 0] and [g[4] for g in got[2:4]] == [0, 16]


@pytest.mark.parametrize("width", [1, 2, 3, 5, 8, 11])
def test_windows_of_any_width(width):
    rng = np.random.default_rng(width)
    texts = [" ".join(rng.choice(list("abc"), rng.integers(0, 60))) for _ in range(100)]
    want = []
    for t in texts:
        w = t.split()
        seen = Counter(tuple(w[i:i + width]) for i in range(len(w) - width + 1))
        want.append(len({k for i in range(len(w) - width + 1) if seen[tuple(w[i:i + width])] > 1 for k in range(i, i + width)}))
    assert Chunk(texts).n_repeat_words(width).tolist() == want


def test_a_repeated_labelled_id_gives_one_row_of_the_sample(spark, monkeypatch):
    rows = [(i, junk(i) if i % 2 else prose(i, 60), "en", "s") for i in range(60)] \
        + [(7, prose(7000 + i % 50, 30), "en", "s") for i in range(3000)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    sizes, written = [], quality.write_and_read

    def seen(df, name, *more):
        out = written(df, name, *more)
        sizes.append(out.count())
        return out

    monkeypatch.setattr(quality, "write_and_read", seen)
    assert quality.train(documents(spark, rows), labels) is not None
    assert sizes == [60]


def junk(seed):
    return " ".join(w.upper() + "!!" for w in prose(seed, 60).split()) if seed % 2 else \
        " | ".join(w + "###" for w in prose(seed, 60).split())


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [(i, junk(i) if i % 4 == 0 else prose(i, 60 + i % 50), "en", "s") for i in range(600)]
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(400)] + [(None, 1), (3, None), (9999, 0)],
                                   "doc_id long, quality int")
    return documents(spark, rows), labels


@pytest.fixture(scope="module")
def model(labelled):
    return quality.train(*labelled)


def test_verdict_on_rows_it_has_not_seen(labelled, model):
    got = {r["doc_id"]: r for r in quality.judge(labelled[0], model).collect()}
    right = [got[i]["kept"] == (i % 4 > 0) for i in range(400, 600)]
    assert np.mean(right) > 0.97


def test_probabilities_are_calibrated(labelled, model):
    p = np.array([(r["quality"], r["doc_id"] % 4 > 0) for r in quality.judge(labelled[0], model).where("doc_id >= 400").collect()])
    assert abs(p[:, 0].mean() - p[:, 1].mean()) < 0.08 and ((p[:, 0] >= 0) & (p[:, 0] <= 1)).all()


def test_awkward_rows(spark, model):
    rows = awkward()
    got = quality.judge(clashing(documents(spark, rows)), model).collect()
    assert len(got) == len(rows)
    want = sorted(str((d, *plain(t))) for d, t, _, _ in rows)
    assert sorted(str(tuple(r)[:6]) for r in got) == want
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
        assert not (r["kept"] and r["base_failed"])


def test_filter_keeps_whole_rows(spark, labelled, model):
    docs = clashing(labelled[0])
    kept = {r["doc_id"] for r in quality.judge(docs, model).where("kept").collect()}
    out = quality.filter_documents(docs, model)
    assert out.columns == docs.columns and {r["doc_id"] for r in out.collect()} == kept
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert all(texts[r["doc_id"]] == r["text"] for r in out.collect())


def test_without_anything_to_learn(spark):
    docs = documents(spark)
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    one_class = spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, quality int")
    contradict = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (2, 0)], "doc_id long, quality int")
    for labels in (empty, one_class, contradict):
        assert quality.train(docs, labels) is None
    got = quality.judge(docs, None).collect()
    assert all(r["kept"] != r["base_failed"] for r in got)
    assert quality.judge(documents(spark, []), None).count() == 0
    assert quality.filter_documents(documents(spark, []), None).count() == 0


def test_the_sample_is_bounded(labelled):
    few = quality.train(*labelled, max_train=60)
    assert few is not None and np.count_nonzero(few.weights) < np.count_nonzero(quality.train(*labelled).weights)
