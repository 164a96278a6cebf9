from collections import defaultdict

import numpy as np
import pytest

from kelpie.llm.mixing import Mix, permute, targets, word_starts
from tests.llm.helpers import WORD, awkward, clashing, documents, prose


def plain_targets(sizes, share=1.5, most=2):
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    w = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, capped = share * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in capped]
        rest = total - sum(capped.values())
        got = {s: rest * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if got[s] > most * sizes[s]]
        if not over:
            return got | capped
        capped |= {s: most * sizes[s] for s in over}


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 500}, {"b": 7, None: 100, "a": 0, "ä": 3, "z": 10_000},
                                   {None: 5}, {f"s{i}": (i * 37) % 11 * 100 for i in range(20)}, {"a": 0}])
def test_targets(spark, sizes):
    got = {r["source"]: r["target"] for r in targets(spark.createDataFrame(list(sizes.items()), "source string, size long")).collect()}
    want = plain_targets(sizes) if sum(sizes.values()) else dict.fromkeys(sizes, 0)
    assert set(got) == set(want) and all(abs(got[s] - want[s]) < 1e-6 * max(1, want[s]) for s in want)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 16, 17, 1000])
def test_permute_is_a_permutation(n):
    i = np.arange(n)
    for key in (0, 7):
        assert sorted(permute(i, np.full(n, n), np.full(n, key))) == list(range(n))
    if n > 100:
        assert (permute(i, np.full(n, n), np.full(n, 1)) != permute(i, np.full(n, n), np.full(n, 2))).mean() > 0.9


def test_word_starts():
    for t in ("", " ", "a", " a b\n\nc ", "é　x y\x0bz\x1cw"):
        raw = t.encode()
        assert word_starts(raw).tolist() == [len(t[:m.start()].encode()) for m in WORD.finditer(t)]


def words(t):
    return WORD.findall(t or "")


@pytest.mark.parametrize("block,lane,shard", [(64, 1 << 18, 1 << 14), (4, 1500, 64), (1, 4000, 256)])
def test_pieces_are_the_documents_words(spark, block, lane, shard):
    rows = awkward()
    mix = Mix(clashing(documents(spark, rows)), block=block, lane=lane, shard=shard)
    out = mix.pieces(untaken=True).collect()
    sizes, taken, docs = defaultdict(int), defaultdict(int), defaultdict(set)
    for d, t, _, s in rows:
        sizes[s] += len(words(t))
    goal = plain_targets(sizes)
    for r in out:
        docs[(r["s"], r["lane"], r["ord"])].add((r["doc_id"], r["size"], r["source"]))
        assert len(words(r["text"])) == r["words"]
        taken[(r["s"], r["lane"], r["ord"])] += r["words"]
    assert all(len(x) == 1 for x in docs.values())
    assert sorted(str(next(iter(x))) for x in docs.values()) == sorted(str((d, len(words(t)), s)) for d, t, _, s in rows)
    by_source = defaultdict(int)
    for k, n in taken.items():
        (_, size, s), = docs[k]
        assert n <= 2 * size
        by_source[s] += n
    for s in sizes:     # to the block, and half a block for each lane's last
        lanes = len({k[:2] for k, x in docs.items() if next(iter(x))[2] == s})
        assert abs(by_source[s] - goal[s]) <= block * (1 + lanes)
    texts = {(d, s): words(t) for d, t, _, s in rows}
    for r in out:
        if r["words"] and r["doc_id"] not in (None, 401):
            assert words(r["text"]) == texts[r["doc_id"], r["source"]][r["at"]:r["at"] + r["words"]]


def test_blocks_are_taken_evenly_and_slots_once(spark):
    rows = [(i, prose(i, 200), "en", f"s{i % 3}") for i in range(90)]
    out = Mix(documents(spark, rows), block=8, lane=500, shard=16).pieces().collect()
    times, slots, shards = defaultdict(set), defaultdict(set), defaultdict(int)
    for r in out:
        times[r["s"], r["block"]].add((r["epoch"], r["slot"]))
        slots[r["s"], r["slot"]].add((r["shard"], r["block"]))
        shards[r["shard"]] += 1
    assert all(len(x) == 1 for x in slots.values()) and all(len(x) <= 2 for x in times.values())
    for s in {k[0] for k in slots}:
        own = sorted(j for x, j in slots if x == s)
        assert own == list(range(len(own)))                         # gapless
        counts = [len(v) for (x, _), v in times.items() if x == s]
        assert max(counts) - min(counts) <= 1                       # a block again only after all others
    assert len(shards) > 20


def test_reruns_agree_whatever_the_partitions(spark):
    rows = awkward()
    a, b = (sorted(map(str, Mix(documents(spark, rows).repartition(n), block=4, lane=1500, shard=64)
                       .pieces().select("doc_id", "text", "shard", "slot", "at").collect())) for n in (1, 7))
    assert a == b


def test_documents_hold_what_is_taken(spark):
    rows = awkward()
    mix = Mix(documents(spark, rows), block=4, lane=1500, shard=64)
    pieces = defaultdict(int)
    for r in mix.pieces().collect():
        pieces[r["doc_id"]] += r["words"]
    got = defaultdict(int)
    out = mix.documents()
    for r in out.collect():
        got[r["doc_id"]] += len(words(r["text"]))
    assert got == pieces and out.columns == documents(spark, []).columns
    full = [r["text"] for r in Mix(documents(spark, [(1, "a b\nc", "en", "x"), (2, "d", "en", "y")]), block=1, lane=4,
                                   weights=(1,), share=2.0).documents().orderBy("doc_id").collect()]
    assert [words(t) for t in full] == [["a", "b", "c"] * 2, ["d", "d"]] and full[0].startswith("a b\nc\n")


def test_empty_tables(spark):
    mix = Mix(documents(spark, []))
    assert mix.pieces(untaken=True).count() == 0 and mix.targets.count() == 0
    assert Mix(documents(spark, [(1, None, "en", None), (2, " ", "en", "a")])).pieces(untaken=True).count() == 2


@pytest.fixture(scope="module")
def hot(spark):
    """3,000 rows without words and 2,000 equal rows in one source, few others."""
    rows = [(i, (None, "", " \n")[i % 3], "en", "empty") for i in range(3000)]
    rows += [(7, "w1 w2 w3 w4 w5", "en", "hot")] * 2000 + [(8000 + i, prose(i, 20), "en", "hot") for i in range(40)]
    return rows + [(9000 + i, prose(i, 30), "en", f"s{i % 2}") for i in range(20)]


def test_hot_rows_spread_over_lanes(spark, hot):
    mix = Mix(documents(spark, hot), block=8, lane=800, shard=64, rows=200)
    assert mix.hot_rows == 1
    out = mix.pieces(untaken=True).collect()
    docs, taken, lanes = {}, defaultdict(int), defaultdict(set)
    for r in out:
        k = (r["s"], r["lane"], r["ord"])
        docs[k] = (r["doc_id"], r["size"], r["source"])
        taken[k] += r["words"]
        lanes[r["source"], r["lane"]].add(r["ord"])
    assert sorted(map(str, docs.values())) == sorted(str((d, len(words(t)), s)) for d, t, _, s in hot)
    assert all(n <= 2 * docs[k][1] for k, n in taken.items())
    assert max(len(x) for (s, _), x in lanes.items() if s == "empty") <= 300
    assert max(len(x) for (s, _), x in lanes.items() if s == "hot") <= 500 and sum(s == "hot" for s, _ in lanes) >= 8
    goal = {r["source"]: r["target"] for r in mix.targets.collect()}
    for s in ("hot", "s0", "s1"):
        got = sum(n for k, n in taken.items() if docs[k][2] == s)
        assert abs(got - goal[s]) <= 8 * (1 + sum(x == s for x, _ in lanes))


def test_hot_rows_give_the_same_mix_whatever_the_partitions(spark, hot):
    a, b = (sorted(map(str, Mix(documents(spark, hot).repartition(n), block=8, lane=800, shard=64, rows=200)
                       .pieces().select("doc_id", "text", "shard", "slot", "at").collect())) for n in (1, 6))
    assert a == b


def test_ids_beyond_double_precision_keep_their_order(spark):
    big = 2 ** 53
    rows = [(big + i, f"a{i} b{i} c{i}", "en", "s") for i in range(40)] + [(None, "x y z", "en", "s")]
    out = Mix(documents(spark, rows), block=2, lane=1 << 18, weights=(1,), share=2.0).pieces().collect()
    order = sorted({(r["ord"], r["doc_id"]) for r in out})
    assert [d for _, d in order] == [None] + [big + i for i in range(40)]
