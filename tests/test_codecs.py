"""Encode ∘ decode = identity for every RAW type; Avro; key bytes."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kelpie.functions import codecs as C


@pytest.mark.parametrize("dtype,vals", [
    ("float32", [[1.5, -2.0, 3.25], [0.0, 0.125, 7.0]]),
    ("float", [[1.5, -2.0], [3.0, 4.0]]),
    ("double", [[1.5, -2.0], [3.0, 4.0]]),
    ("half", [[1.5, -2.0], [3.0, 4.0]]),
    ("int64", [[1, -2, 3], [2 ** 40, 0, -1]]),
    ("int32", [[1, -2, 3], [7, 0, -1]]),
    ("int16", [[1, -2, 3], [7, 0, -1]]),
    ("int8", [[1, -2, 3], [7, 0, -1]]),
    ("uint8", [[0, 255, 3], [7, 0, 1]]),
    ("uint16", [[0, 65535, 3], [7, 0, 1]]),
    ("bool", [[True, False], [False, True]]),
])
def test_raw_roundtrip_arrow(dtype, vals):
    arr = pa.array(vals)
    b = C.raw_bytes(arr, dtype)
    assert b.to_pylist()[0] == np.asarray(vals[0], dtype=C.RAW_NUMPY[dtype]).tobytes()
    back = C.raw_values(b, dtype).to_pylist()
    assert [list(map(float, r)) for r in back] == [list(map(float, r)) for r in vals]


def test_raw_nulls_and_out_of_range():
    arr = pa.array([[1, 2], None])
    assert C.raw_values(C.raw_bytes(arr, "int32"), "int32").to_pylist() == [[1, 2], None]
    with pytest.raises(ValueError):
        C.raw_bytes(pa.array([[256]]), "uint8")


def test_raw_roundtrip_spark_and_reshape(spark):
    df = spark.createDataFrame([(1, [float(i) for i in range(6)], 3)], "id long, x array<float>, y int")
    enc = C.encode_raw(df, "x", "y", "float32", "int32")
    dec = C.decode_raw(enc, "float32", "2 3", "int32", "")
    r = dec.select("features", "label").first()
    assert r["features"] == [[0.0, 1.0, 2.0], [3.0, 4.0, 5.0]]
    assert r["label"] == 3


def test_avro_roundtrip_fixed_and_varint(spark):
    sch = "{'type': 'record', 'name': 'r', 'fields': [{'name': 'a', 'type': 'float'}, {'name': 'b', 'type': 'long'}, {'name': 's', 'type': 'string'}]}"
    df = spark.createDataFrame([(1.5, -300, "7.25"), (2.0, 5, "x")], "a float, b long, s string")
    enc = df.withColumn("value", C.encode_avro_col(["a", "b", "s"], sch))
    dec = enc.select(C.decode_avro_col("value", sch).alias("f")).collect()
    assert dec[0]["f"] == [1.5, -300.0, 7.25]
    assert dec[1]["f"][:2] == [2.0, 5.0] and dec[1]["f"][2] is None


def test_key_bytes(spark):
    df = spark.createDataFrame([(5, "ab", 300)], "i int, s string, big int")
    r = df.select(F.hex(C.key_bytes("i", "int")).alias("i"), F.hex(C.key_bytes("s", "str")).alias("s"),
                  C.key_bytes("big", "int").alias("b"), C.key_bytes_error("big", "int").alias("e"),
                  C.key_to_int(C.key_bytes("big", "int", width=2)).alias("back")).first()
    assert (r["i"], r["s"], r["b"], r["back"]) == ("05", "6162", None, 300)
    assert r["e"] is not None


def test_infer_format_detects_ragged(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([1.0],)], "x array<float>")
    r = C.infer_format(df, "x").first()
    assert r["data_type"] == "float32" and r["data_reshape"] == "ragged"


def test_json_dead_letter(spark):
    df = spark.createDataFrame([('{"k": 1}',), ('"k": 2}',)], "value string")
    out = C.decode_json(df, T.StructType([T.StructField("k", T.IntegerType())])).collect()
    assert out[0]["decoded"]["k"] == 1 and out[0]["decode_error"] is None
    assert out[1]["decode_error"] == "malformed json"


def test_connectors_fall_back_without_packages(spark):
    from kelpie.sources import connectors as K
    sch = "{'type': 'record', 'name': 'r', 'fields': [{'name': 'a', 'type': 'double'}]}"
    df = spark.createDataFrame([(2.5,)], "a double")
    enc = df.withColumn("value", K.encode_avro_col(spark, ["a"], sch))
    assert enc.select(K.decode_avro_col(spark, "value", sch).alias("f")).first()["f"] == [2.5]
    assert K.offsets_json("t", {0: 5, 1: 7}) == '{"t": {"0": 5, "1": 7}}'
