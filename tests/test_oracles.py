"""Every registered query with an oracle gives the DuckDB rows at sf0.001;
the others run and keep a stable schema."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from kelpie.session import TABLES

SF = "/root/testdata/sf0.001"
QUERIES = queries()
ORACLE = oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
    assert len(QUERIES) >= 100


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["vec_id", "label", "pred", "conf", "tier"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    import sys
    import os
    sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
    from oracle_check import digest, type_mismatches
    frame = QUERIES[name](spark, SF)
    got = frame.toPandas()
    if name not in ORACLE:
        assert len(got.columns) > 0
        return
    exp = con.execute(ORACLE[name]).fetchdf()
    assert sorted(got.columns) == sorted(exp.columns)
    assert type_mismatches(frame.schema, con, ORACLE[name]) == {}
    assert len(got) == len(exp)
    assert digest(got) == digest(exp)
