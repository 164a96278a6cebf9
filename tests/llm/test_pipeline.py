import numpy as np
from collections import defaultdict

import corpus_pipeline
from kelpie.llm import quality
from tests.llm.helpers import WORD, awkward, documents, prose
from tests.llm.test_secret_scan import KEY, OPAQUE
from tests.llm.test_simhash import none_last, plain_fingerprint, plain_representatives


def tables(spark, folder):
    rows = [r for r in awkward()] + [(1000 + i, prose(i, 60), "en", f"s{i % 5}") for i in range(200)]
    rows += [(2000 + i, " ".join(w.upper() + "###" for w in prose(i, 40).split()), "en", "s0") for i in range(80)]
    rows += [(3000, prose(77, 40) + f" {KEY} {OPAQUE} " + prose(78, 40), "en", "s1")]
    documents(spark, rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, int(i < 2000), 0) for i in [*range(1000, 1200), *range(2000, 2080)]],
                          "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return rows


def test_stage_by_stage(spark, tmp_path):
    sf = str(tmp_path / "sf")
    rows = tables(spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, sf)
        if name != "packing":
            assert result.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        result.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        out[name] = docs.collect()

    kept = {(r["doc_id"], r["text"]) for r in out["quality_rules"]}
    model = quality.train(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
    judged = quality.judge(spark.read.parquet(f"{sf}/documents.parquet"), model).where("kept").collect()
    assert sorted(str(r["doc_id"]) for r in judged) == sorted(str(r["doc_id"]) for r in out["quality_rules"])
    assert not any(d and 2000 <= d < 2080 for d, _ in kept)
    clean = {d for d, t, _, _ in rows if d and 1000 <= d < 1200 and len(WORD.findall(t)) >= 20}
    assert clean <= {d for d, _ in kept}

    left = [(r["doc_id"], r["text"]) for r in out["quality_rules"]]
    assert sorted((r["doc_id"] for r in out["simhash"]), key=none_last) == \
        plain_representatives([d for d, _ in left], [plain_fingerprint(t) for _, t in left])

    before = {r["doc_id"]: r["text"] for r in out["simhash"]}
    after = {r["doc_id"]: r for r in out["secret_scan"]}
    assert set(after) == set(before) and KEY not in after[3000]["text"] and OPAQUE not in after[3000]["text"]
    assert all(r["n_chars"] == len(r["text"]) for r in after.values())
    assert all(after[d]["text"] == t for d, t in before.items() if d != 3000)

    words = defaultdict(int)
    for r in out["mixing"]:
        n = len(WORD.findall(r["text"]))
        assert 0 < n <= 2 * len(WORD.findall(after[r["doc_id"]]["text"]))
        words[r["source"]] += n
    assert set(words) <= {r["source"] for r in after.values()}

    pieces = defaultdict(int)
    for r in out["packing"]:
        pieces[r["doc_id"]] += r["length"]
        assert len(np.frombuffer(bytes(r["ids"]), "<u4")) == r["length"]
    assert set(pieces) == {r["doc_id"] for r in out["mixing"]}


def test_run_and_empty_table(spark, tmp_path):
    sf = str(tmp_path / "sf")
    documents(spark, []).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    assert corpus_pipeline.run(spark, sf).count() == 0
    assert corpus_pipeline.ORACLE_SQL is None and len(corpus_pipeline.STAGES) == 5
