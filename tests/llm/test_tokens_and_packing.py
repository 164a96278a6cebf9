import hashlib
import zlib
from array import array
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from kelpie.llm import packing, token_files
from kelpie.llm.tokenizing import Encoder, public_path, runs
from tests.llm.helpers import awkward, clashing, documents

WORDS, BYTES = public_path("word_bpe_49k.json"), public_path("byte_bpe_50k.json")
ODD = ["", " ", "\n", " a  b", "a\n\nb", "tail ", "\0", "a\0b \0c", "it's 's 'S we'll", "<|endoftext|> x<|endoftext|>y <|startoftext|>",
       "é ́x", "ΣΑΣ İ", "a\x1cb \x1c c", "　x　y", "x\x85y", "word, word. Word! 12,5 a.b.c ...", "\t", "a\tb",
       "🙂 \U0001f642\U0001f642", "x" * 3000, "naïve café"]
ODD = [t.encode("utf-8", "ignore").decode() for t in ODD]
_libs, _own = {}, {}


def whole(path, texts):
    if path not in _libs:
        _libs[path] = Tokenizer.from_file(path)
    tok = _libs[path]
    return [array("I", e.ids).tolist() for e in tok.encode_batch(texts, add_special_tokens=False)]


def cached(path, texts):
    if path not in _own:
        _own[path] = Encoder(path)
    enc = _own[path]
    out = []
    for _, part in runs(pa.array(texts, pa.string()), 200):
        ids, start = enc.encode(part)
        out += [ids[a:b].tolist() for a, b in zip(start[:-1], start[1:])]
    return out


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_the_cache_gives_the_library_ids(path):
    texts = ODD + [t or "" for _, t, _, _ in awkward()]
    for _ in range(2):      # unseen words, then known ones
        assert cached(path, texts) == whole(path, texts)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("aAbé' \n\t.,!1 　\x1ćß<|endoftext>s"), max_size=40), max_size=6))
def test_the_cache_gives_the_library_ids_for_any_text(texts):
    for path in (WORDS, BYTES):
        assert cached(path, texts) == whole(path, texts)


def test_generations_of_the_cache(monkeypatch):
    from kelpie.llm import tokenizing
    monkeypatch.setattr(tokenizing, "GENERATION", 20)
    texts = [t or "" for _, t, _, _ in awkward()]
    enc = Encoder(BYTES)
    got = []
    for _, part in runs(pa.array(texts), 500):
        ids, start = enc.encode(part)
        got += [ids[a:b].tolist() for a, b in zip(start[:-1], start[1:])]
    assert got == whole(BYTES, texts) and len(enc._old) < 10_000


# --- token files ---------------------------------------------------------------------------------

def read_back(df):
    return [(r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"], list(r["ids"])) for r in df.collect()]


@pytest.mark.parametrize("size", [32 << 20, 2000])
def test_token_files_round_trip(spark, size):
    rows = awkward()
    manifest = token_files.write_tokens(clashing(documents(spark, rows)), WORDS, file_bytes=size)
    got = sorted(read_back(token_files.read_tokens(manifest)), key=lambda r: r[1])
    ids = [x + [1] for x in whole(WORDS, [t or "" for _, t, _, _ in rows])]
    assert sorted(map(str, zip([d for d, *_ in rows], ids))) == sorted(str((d, x)) for d, *_, x in got)
    assert [d for d, *_ in got] == sorted((d for d, *_ in rows), key=lambda d: -1 if d is None else d)
    at = 0
    for _, start, n, crc, x in got:
        assert (start, n, crc) == (at, len(x), zlib.crc32(np.array(x, "<u4").tobytes()))
        at += n
    assert manifest.agg({"documents": "sum"}).first()[0] == len(rows)


def test_short_document_access_and_dictionary_hash(spark):
    rows = [(i, f"document number {i} of a small table", "en", "s") for i in range(2000)]
    manifest = token_files.write_tokens(documents(spark, rows), WORDS).collect()
    found = {}
    for m in manifest:
        f = token_files.TokenFile(m["path"])
        for i in (5, 1500):
            for x in f.find(i):
                found[i] = x.tolist()
        assert f.dictionary != hashlib.sha256(b"").digest()         # a dictionary was learned
        f.close()
    assert found == {i: whole(WORDS, [rows[i][1]])[0] + [1] for i in (5, 1500)}


def test_a_wrong_dictionary_is_refused(spark):
    path = token_files.write_tokens(documents(spark, [(i, "a b c", "en", "s") for i in range(50)]), WORDS).first()["path"]
    folder = path.rsplit("/", 1)[0].removeprefix("file:")
    import pathlib
    name = next(pathlib.Path(folder).glob("*.zdict"))
    name.write_bytes(name.read_bytes() + b"x")
    with pytest.raises(ValueError):
        token_files.TokenFile(path)


def test_token_files_of_an_empty_table(spark):
    assert token_files.read_tokens(token_files.write_tokens(documents(spark, []), WORDS)).count() == 0


# --- packing -------------------------------------------------------------------------------------

def check_packed(rows, df, length):
    ids = [x + [1] for x in whole(BYTES, [t or "" for _, t, _, _ in rows])]
    want, got, sequences = defaultdict(list), defaultdict(list), defaultdict(list)
    for (d, *_), x in zip(rows, ids):
        want[d].append(x)
    for r in df.collect():
        x = np.frombuffer(bytes(r["ids"]), "<u4").tolist()
        assert len(x) == r["length"] > 0
        got[r["doc_id"]].append((r["doc_tokens"], r["start"], x))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(got) == set(want)
    for d in want:      # every id of every row once; rows that share an id are told apart by their ids
        assert sum(len(x) for *_, x in got[d]) == sum(map(len, want[d]))
        if len(want[d]) == 1:
            at = 0
            for total, start, x in sorted(got[d]):
                assert (total, start) == (len(want[d][0]), at) and x == want[d][0][at:at + len(x)]
                at += len(x)
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= length
    return [sum(n for _, n in s) for s in sequences.values()]


@pytest.mark.parametrize("length,windows", [(2048, 64), (64, 4), (7, 1)])
def test_packing_keeps_every_id(spark, length, windows):
    rows = awkward()
    fill = check_packed(rows, packing.pack(clashing(documents(spark, rows).coalesce(3)), BYTES, length, windows), length)
    if windows > 1:
        assert sum(fill) > 0.93 * length * (len(fill) - 1)


def test_packing_an_empty_table(spark):
    assert packing.pack(documents(spark, []), BYTES).count() == 0


def test_windows_are_bounded_and_best_fit():
    w = packing.Windows(10, 2)
    piece = lambda n: ("d", 0, n, n, b"")
    assert w.place(piece(6)) == [] and w.place(piece(7)) == []      # rooms 4 and 3
    assert w.place(piece(3)) == [[piece(7), piece(3)]]              # the tighter one, now full
    assert w.place(piece(8)) == [] and w.place(piece(5)) == [[piece(8)]]    # rooms 4 and 2: the fuller is emitted
    assert len(w.room) == 2 and w.place(piece(10)) == [[piece(10)]]
