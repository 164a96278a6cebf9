"""The BPE transducer against the tokenizers library."""

import hashlib
import json
import random

import numpy as np
import pytest

from kelpie.llm import bpe
from kelpie.llm.queries import op12_bpe_transducer
from kelpie.llm.tokenizing import public_path

from .helpers import awkward, clashing, documents, prose

PATH = public_path("byte_bpe_50k.json")
PARTS = [*"aabcdest'' '  \n\t!.,019éßñ漢字🙂　\x85\xa0İ\0", "'ll", "'re", "'ve", "'s", "'t", "<|endoftext|>", "<|end", " the",
         " and", "\r\n", "'Re", "  "]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def machine():
    return bpe.Transducer(PATH)


def ids(parts):
    return np.concatenate([np.zeros(0, np.uint32), *parts]).tolist()


def mixed(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def test_whole_texts(library, machine):
    texts = mixed(1, 5000) + [t for _, t, _, _ in awkward() if t is not None]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [ids(x) for x in machine.encode(texts)] == want


def test_every_code_point(library, machine):
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    rng = random.Random(2)
    rng.shuffle(points)
    texts = ["".join(f"a{chr(c)}1{chr(c)} {chr(c)}!" for c in points[i:i + 20_000]) for i in range(0, 100_000, 20_000)]
    texts.append("".join(f"x{chr(c)} {chr(c)}" for c in range(0x3100) if c not in (0,)))
    assert [ids(x) for x in machine.encode(texts)] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_streams_in_small_blocks(library, machine, monkeypatch):
    monkeypatch.setattr(bpe, "WINDOW", 8)
    rng = random.Random(3)
    for t in mixed(4, 1500):
        k = rng.randint(1, 7)
        got = ids(machine.stream(t[i:i + k] for i in range(0, len(t), k)))
        assert got == library.encode(t, add_special_tokens=False).ids, (k, t)


@pytest.mark.parametrize("text", ["x" * 9000, " " * 9000 + "a", "ab" * 5000 + "'s", "'" * 5001 + "s", " " * 9001 + "\n", "🙂" * 3000,
                                  "aé" * 4000 + " tail", "\n" * 5000 + " 1" * 5000, "!" * 4999 + "<|endoftext|>" + "!" * 9])
def test_open_runs(library, machine, text):
    want = library.encode(text, add_special_tokens=False).ids
    for k in (97, 1000, 1 << 20):
        assert ids(machine.stream(text[i:i + k] for i in range(0, len(text), k))) == want


def test_random_letters_in_one_piece(library, machine):
    rng = random.Random(5)
    for letters in ("etaoinshrdlu", "ab", "aeiou"):
        t = "".join(rng.choice(letters) for _ in range(30_000))
        want = library.encode(t, add_special_tokens=False).ids
        assert ids(machine.encode([t]).__next__()) == want
        assert ids(machine.stream(t[i:i + 777] for i in range(0, len(t), 777))) == want


def test_an_open_run_holds_a_window(machine):
    """Constant memory: what waits is a window and the lookahead, however long the run."""
    out, fed, waiting = 0, 0, 0

    def parts():
        nonlocal fed
        for _ in range(60):
            fed += 1000
            yield prose(1, 400).replace(" ", "").replace("\n", "").replace(",", "").replace(".", "")[:1000].ljust(1000, "e").encode()

    for tokens in machine._open_piece(parts()):
        out += sum(len(machine.merges.spelling[t]) for t in tokens)
        if out < fed or fed < 60_000:
            waiting = max(waiting, fed - out)
    assert out == 60_000
    assert waiting <= 2 * bpe.WINDOW + machine.merges.lookahead + 1000


def small_list(tmp_path, merges):
    letter = {b: c for c, b in bpe._byte_letters().items()}
    vocab = {letter[b]: b for b in range(256)}
    for a, b in merges:
        vocab[a + b] = len(vocab)
    spec = json.load(open(PATH))
    spec["added_tokens"] = []
    spec["model"].update(vocab=vocab, merges=[list(m) for m in merges])
    path = f"{tmp_path}/{hashlib.md5(repr(merges).encode()).hexdigest()}.json"
    json.dump(spec, open(path, "w"))
    return path


def test_lookahead_is_sufficient(tmp_path):
    """For random merge lists: tokens that end before the lookahead are those of every continuation."""
    rng = random.Random(6)
    for _ in range(25):
        known, merges = list("abc"), []
        while len(merges) < 14:
            a, b = rng.choice(known), rng.choice(known)
            if a + b not in known and len(a + b) < 9:
                merges.append((a, b))
                known.append(a + b)
        m = bpe.MergeList(small_list(tmp_path, merges))
        for _ in range(60):
            x = "".join(rng.choice("abc") for _ in range(rng.randint(0, 30))).encode()
            stable, at = [], 0
            for t in m.merge(x):
                at += len(m.spelling[t])
                if at <= len(x) - m.lookahead:
                    stable.append(t)
            for _ in range(12):
                y = "".join(rng.choice("abc") for _ in range(rng.randint(0, 20))).encode()
                assert m.merge(x + y)[:len(stable)] == stable


def test_chain_of_rules_gives_the_lookahead(tmp_path):
    assert bpe.MergeList(small_list(tmp_path, [])).lookahead == 0
    assert bpe.MergeList(small_list(tmp_path, [("a", "b")])).lookahead == 1
    # c|d decides b|c, which decides a|b
    assert bpe.MergeList(small_list(tmp_path, [("c", "d"), ("b", "c"), ("a", "b")])).lookahead == 3
    # in the other order no rule can be held up by a later one
    assert bpe.MergeList(small_list(tmp_path, [("a", "b"), ("b", "c"), ("c", "d")])).lookahead == 1
    with pytest.raises(ValueError):
        bpe.MergeList(small_list(tmp_path, [("ab", "c"), ("a", "b")]))


def test_pieces_merged_together_equal_pieces_alone(machine):
    rng = random.Random(7)
    pieces = list({bytes(rng.choice(b" etaonihsr") for _ in range(rng.randint(1, bpe.SHORT + 10))) for _ in range(2000)})
    flat, width = machine._learn(pieces)
    at = np.concatenate([[0], np.cumsum(width)])
    assert [flat[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [machine.merges.merge(p) for p in pieces]


def test_a_full_table_starts_anew(library, monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN", 50)
    t = bpe.Transducer(PATH)
    texts = mixed(8, 400)
    for i in range(0, 400, 20):
        assert [ids(x) for x in t.encode(texts[i:i + 20])] == \
            [e.ids for e in library.encode_batch(texts[i:i + 20], add_special_tokens=False)]
    assert len(t._table) < 2000


def test_decoding_ids_one_by_one(library, machine):
    rng = random.Random(9)
    for _ in range(3000):
        x = [rng.randrange(50257) for _ in range(rng.randint(0, 8))]
        parts = [np.array([i], np.uint32) for i in x]
        assert "".join(bpe.decode(machine.merges, parts)) == library.decode(x, skip_special_tokens=False)


def test_text_state_on_broken_bytes():
    rng = random.Random(10)
    lead = [0x41, 0x80, 0xBF, 0xC3, 0xE0, 0xA0, 0xED, 0xF0, 0x9F, 0x99, 0x82, 0xF5, 0xFF]
    for _ in range(5000):
        data = bytes(rng.choice(lead) for _ in range(rng.randint(0, 9)))
        state = bpe.TextState()
        assert "".join(state.feed(data[i:i + 1]) for i in range(len(data))) + state.finish() == data.decode("utf-8", "replace")


def test_documents(spark, library):
    rows = awkward() + [(700 + i, t, "en", None) for i, t in enumerate(mixed(11, 40))]
    docs = documents(spark, rows)
    got = bpe.encode_documents(clashing(docs), PATH).collect()
    want = [(d, library.encode(t or "", add_special_tokens=False).ids) for d, t, _, _ in rows]
    assert sorted((str(r["doc_id"]), r["n_tokens"], bytes(r["ids"])) for r in got) == \
        sorted((str(d), len(x), np.array(x, "<u4").tobytes()) for d, x in want)
    back = bpe.decode_documents(bpe.encode_documents(docs, PATH), PATH).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in back) == sorted((str(d), t or "") for d, t, _, _ in rows)
    assert bpe.encode_documents(documents(spark, []), PATH).collect() == []


def test_query(spark, library, tmp_path, monkeypatch):
    rows = awkward() + [(700 + i, t, "en", None) for i, t in enumerate(mixed(12, 60))] + [(900, prose(13, 9000) * 40, "en", "s")]
    assert len(rows[-1][1]) > bpe.BLOCK
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = op12_bpe_transducer(spark, str(tmp_path)).collect()
    want = []
    for d, t, _, _ in rows:
        x = library.encode(t or "", add_special_tokens=False).ids
        want.append((d, len(x), hashlib.sha256(np.array(x, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(library.decode(x, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want))
