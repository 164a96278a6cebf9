"""J01 - J04 in tiles: lists of data sources meet lists of models, and each tile is unpacked row by row."""

from pyspark.sql import functions as F

from kelpie.operators import registry as J

COLUMNS = ["ds_id", "model_id", "case", "by_federated_id"]


def sources(spark, n, fed="CAST(NULL AS STRING)"):
    return spark.range(n).selectExpr(
        "id AS ds_id", "'64' AS data_reshape", "IF(id % 2 = 0, '{\"a\": 1, \"b\": 2}', '{\"b\":2,\"a\":1}') AS restrictions",
        "IF(id % 11 = 10, NULL, id) AS total_msg", "id % 5 = 0 AS incremental", f"{fed} AS federated_string_id")


def takers(spark, n, fed="CAST(NULL AS STRING)"):
    return spark.range(n).selectExpr(
        "id AS model_id", "IF(id % 3 = 0, '64 7 7', '64') AS input_shape", "'{\"a\": 1, \"b\": 2}' AS data_restriction", "id AS min_data",
        "id % 3 = 0 AS distributed", "IF(id % 4 = 0, '{\"net\": \"x\"}', '{}') AS blockchain", f"{fed} AS federated_string_id")


def case_of(d, m):
    if m % 3 == 0:
        return 4 if d % 5 == 0 else 3
    return 2 if d % 5 == 0 else (5 if m % 4 == 0 else 1)


def sized(d, m):
    return case_of(d, m) in (2, 4) or (d % 11 != 10 and d >= m)


def collected(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


def test_pairs_of_one_shape_are_dealt_in_tiles(spark, monkeypatch, tmp_path):
    """One shape and restriction made one task of a join by shape."""
    monkeypatch.setattr(J, "TILE", 8)
    sources(spark, 90).write.parquet(f"{tmp_path}/ds")      # read back, no column is a constant
    takers(spark, 40).where("NOT distributed").write.parquet(f"{tmp_path}/ms")
    ds, ms = spark.read.parquet(f"{tmp_path}/ds"), spark.read.parquet(f"{tmp_path}/ms")
    got = J.match(ds, ms)
    assert collected(got) == sorted((d, m, case_of(d, m), False) for d in range(90) for m in range(40) if m % 3 and sized(d, m))
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        where = J.match(ds, ms).select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert where > 4


def unpacking(spark, pairs):
    """The explodes of the compiled plan, outermost first, and whether each is compiled into a loop."""
    old = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        lines = pairs()._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    return ["*(" in x.split("Generate")[0] for x in lines if "Generate explode" in x]


def test_pairs_of_one_id_are_handed_out_row_by_row(spark):
    """Two explodes compiled into one loop hold all pairs of a tile (a million) before the first is handed out."""
    ds, ms = sources(spark, 30, "'hot'"), takers(spark, 20, "'hot'")
    got = J.match(ds, ms).where("by_federated_id")
    assert collected(got) == sorted((d, m, case_of(d, m), True) for d in range(30) for m in range(20))
    assert unpacking(spark, lambda: J.match(ds, ms).where("by_federated_id")) == [True, False]


def test_texts_are_parsed_once_a_list(spark, tmp_path):
    """New models: the JSON of the data sources was parsed for each row."""
    ds, ms = sources(spark, 60), takers(spark, 20).where("NOT distributed")
    bad = ds.where("ds_id < 4").withColumn("ds_id", F.col("ds_id") + 100).withColumn(
        "restrictions", F.expr("CASE ds_id WHEN 100 THEN NULL WHEN 101 THEN 'null' WHEN 102 THEN '{' ELSE '{\"a\": 1}' END"))
    more = ms.where("model_id < 4").withColumn("data_restriction", F.expr("IF(model_id = 1, NULL, '{')"))
    got = J.match_new_models(ds.unionByName(bad), ms.unionByName(more))
    want = sorted((d, m, case_of(d, m), False) for d in range(60) if d % 5 and d % 11 != 10 for m in range(20) if m % 3 and sized(d, m))
    assert collected(got) == want
    ds.write.parquet(f"{tmp_path}/ds")      # read back, no column is a constant
    ms.write.parquet(f"{tmp_path}/ms")
    read = J.match_new_models(spark.read.parquet(f"{tmp_path}/ds"), spark.read.parquet(f"{tmp_path}/ms"))
    plan = read._jdf.queryExecution().optimizedPlan().toString().lower().splitlines()
    parsed = [x for x in plan if "json(restrictions" in x or "json(data_restriction" in x]
    assert parsed and all("collect_list" in x for x in parsed)


def test_cases_are_counted_where_tiles_are_unpacked(spark):
    """Pairs by id and by shape are one unpacking, compiled with the first part of the count."""
    fed = "IF(id % 7 = 0, 'x', NULL)"
    ds, ms = sources(spark, 60, fed), takers(spark, 20, fed)
    got = J.match(ds, ms).groupBy("case").count()
    want: dict[int, int] = {}
    for d in range(60):
        for m in range(20):
            if (m % 7 == 0) if d % 7 == 0 else m % 3 and sized(d, m):
                want[case_of(d, m)] = want.get(case_of(d, m), 0) + 1
    assert {r["case"]: r["count"] for r in got.collect()} == want
    assert unpacking(spark, lambda: J.match(ds, ms).groupBy("case").count()) == [True, False]


def test_a_stream_keeps_lists_not_rows(spark, tmp_path):
    """The state held a row for each data source and model, and each pair was one look into it."""
    from kelpie.streaming import processors as P
    ds, ms = sources(spark, 300, "IF(id % 7 = 0, 'x', NULL)"), takers(spark, 60, "IF(id % 7 = 0, 'x', NULL)")
    ds = ds.unionByName(ds.where("ds_id = 8")).withColumn("ds_id", F.expr("NULLIF(ds_id, 3)"))
    for k in range(2):
        ds.where(f"coalesce(ds_id, 0) % 2 = {k}").coalesce(1).write.mode("append").parquet(f"{tmp_path}/ds")
        ms.where(f"model_id % 2 = {k}").coalesce(1).write.mode("append").parquet(f"{tmp_path}/ms")
        q = P.run_to_table(P.match_stream(spark.readStream.schema(ds.schema).parquet(f"{tmp_path}/ds"),
                                          spark.readStream.schema(ms.schema).parquet(f"{tmp_path}/ms")), f"{tmp_path}/out", f"{tmp_path}/ck")
    rows = lambda df: sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)
    assert rows(spark.read.parquet(f"{tmp_path}/out")) == rows(J.match(ds, ms))
    assert sum(s["numRowsTotal"] for s in q.lastProgress["stateOperators"]) < 100


def test_lists_of_a_stream_are_cut(spark, monkeypatch):
    monkeypatch.setattr(J, "TILE", 7)
    monkeypatch.setattr(J, "_HELD", 40)
    side = spark.range(0, 100, 1, 2).selectExpr("IF(id % 3 = 0, NULL, id % 2 = 0) AS a", "IF(id = 5, NULL, id) AS v", "CAST(id AS STRING) AS w")
    got = J._in_lists(side, ["a"], ["v", "w"], "x")
    assert got.agg(F.max(F.size("_x"))).first()[0] == 7
    flat = got.select("a", F.explode("_x").alias("x")).select("a", "x.v", "x.w")
    assert sorted(map(str, flat.collect())) == sorted(map(str, side.collect()))
