from collections import Counter

import pytest

from kelpie.llm.sharding import write_shards
from tests.llm.helpers import awkward, clashing, documents


def placed(df):
    return [(r["doc_id"], r["text"], r["shard"], r["slot"]) for r in df.collect()]


@pytest.mark.parametrize("shards,bucket", [(8, 64 << 20), (3, 1 << 12)])
def test_rows_law_and_whole_result(spark, shards, bucket):
    rows = placed(write_shards(documents(spark), shards=shards, bucket_bytes=bucket))
    assert Counter((d, t) for d, t, _, _ in rows) == Counter((d, t) for d, t, _, _ in awkward())
    sizes = Counter(s for *_, s, _ in rows)
    assert len(sizes) == shards and max(sizes.values()) - min(sizes.values()) <= 1
    for s in range(shards):
        assert sorted(k for *_, x, k in rows if x == s) == list(range(sizes[s]))


def test_seed_decides(spark, tmp_path):
    documents(spark).coalesce(2).write.parquet(str(tmp_path / "d"))
    df = spark.read.parquet(str(tmp_path / "d"))
    one, two, other = (sorted(placed(write_shards(df, seed=s)), key=str) for s in (1, 1, 2))
    assert one == two and one != other


def test_one_row_as_the_whole_table_scatters(spark):
    df = documents(spark, [(7, "same", "en", "s")] * 4000)
    got = write_shards(df, shards=4, bucket_bytes=1 << 10)
    assert Counter(r["shard"] for r in got.collect()) == {0: 1000, 1: 1000, 2: 1000, 3: 1000}


def test_order_looks_uniform(spark):
    """Mean rank of the first half of the ids is near the middle."""
    df = documents(spark, [(i, "t", "en", "s") for i in range(4000)])
    rank = {r["doc_id"]: r["shard"] * 500 + r["slot"] for r in write_shards(df).collect()}
    assert sorted(rank.values()) == list(range(4000))
    assert abs(sum(rank[i] for i in range(2000)) / 2000 - 2000) < 120


def test_clashing_columns_and_empty_table(spark):
    df = clashing(documents(spark))
    out = write_shards(df)
    assert {"shard_in", "slot_in", "shard", "slot"} <= set(out.columns) and out.count() == len(awkward())
    assert write_shards(documents(spark, [])).count() == 0


def test_no_python_in_the_plan(spark):
    plan = write_shards(documents(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
