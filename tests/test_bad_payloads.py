"""Bad payloads alone fail; offsets beyond 32 bits."""

import json

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kelpie.functions import codecs as C

FIXED = json.dumps({"fields": [{"name": "a", "type": "float"}, {"name": "ok", "type": "boolean"}]})
MIXED = json.dumps({"fields": [{"name": "a", "type": "float"}, {"name": "n", "type": "long"}, {"name": "s", "type": "string"}]})


def test_raw_payloads_of_a_batch():
    arr = pa.array([np.float32([1, 2]).tobytes(), b"abc", None, b"", np.float32([3]).tobytes()], pa.binary())
    for kind in (pa.binary(), pa.large_binary()):
        for a in (arr.cast(kind), pa.concat_arrays([pa.array([b"x"], kind), arr.cast(kind)]).slice(1)):
            why = C.raw_errors(a, "float32")
            assert why.to_pylist() == [None, "3 bytes are no multiple of 4 (float32)", "no payload", None, None]
            assert C.raw_values(a, "float32", why.is_valid()).to_pylist() == [[1, 2], None, None, [], [3]]
            with pytest.raises(ValueError):
                C.raw_values(a, "float32")
    assert C.raw_values(arr.slice(0, 0), "float32").to_pylist() == []


@pytest.mark.parametrize("schema", [FIXED, MIXED])
def test_avro_records_with_nulls_and_broken_ones(schema):
    fields = C.parse_avro_schema(schema)
    rows = [{"a": 1.5, "ok": True, "n": -3, "s": "2.25"}, {"a": None, "ok": False, "n": 1, "s": "1"}, None, {"a": 4.0, "ok": False, "n": 7, "s": "é"}]
    kinds = {"float": pa.float32(), "boolean": pa.bool_(), "long": pa.int64(), "string": pa.string()}
    batch = pa.array([None if r is None else {n: r[n] for n, _ in fields} for r in rows], pa.struct([(n, kinds[t]) for n, t in fields]))
    packed = C.avro_bytes(batch, fields)
    assert [x is None for x in packed.to_pylist()] == [False, True, True, False]
    good = packed[0].as_py()
    arr = pa.array([good, good[:-1], None, good + b"!", b""], pa.binary())
    values, why = C.avro_try(arr, fields)
    assert [x is None for x in values.to_pylist()] == [False, True, True, True, True]
    assert why[0].as_py() is None and why[2].as_py() == "no payload" and all(why[i].as_py() for i in (1, 3, 4))
    assert values[0].as_py() == ([1.5, 1.0] if schema == FIXED else [1.5, -3.0, 2.25])
    with pytest.raises(ValueError):
        C.avro_values(arr, fields)
    assert C.avro_values(pa.array([good, None], pa.binary()), fields).to_pylist()[1] is None


def test_a_batch_of_three_gigabytes_keeps_its_offsets():
    gb = 1 << 30
    data = np.zeros(3 * gb, np.uint8)                       # pages that nothing touches take no memory
    data[[0, gb, 3 * gb - 1]] = [1, 2, 3]
    arr = C._binary(np.arange(4) * gb, data)
    assert pa.types.is_large_binary(arr.type)
    offs, raw = C._payloads(arr)
    assert offs.tolist() == [0, gb, 2 * gb, 3 * gb] and len(raw) == 3 * gb
    lists = C.raw_values(arr, "int8")
    assert pa.types.is_large_list(lists.type) and lists.offsets.to_pylist() == offs.tolist()
    assert lists.values[gb].as_py() == 2 and lists.values[3 * gb - 1].as_py() == 3
    assert C._payloads(arr.slice(1, 2))[0].tolist() == [0, gb, 2 * gb]
    assert pa.types.is_binary(C._binary(np.array([0, 5]), data[:5]).type)


def test_the_string_type(spark):
    df = spark.createDataFrame([(1, "héllo"), (2, ""), (3, None)], "id int, s string")
    raw = df.withColumn("value", C.encode_raw_col("s", "string")).unionByName(
        spark.createDataFrame([(4, None, None)], "id int, s string, value binary").withColumn("value", F.unhex(F.lit("FFFE"))))
    got = {r["id"]: (r["decoded"], r["error"]) for r in C.try_decode(raw, "RAW", {"data_type": "string"}).collect()}
    assert got == {1: (["héllo"], None), 2: ([""], None), 3: (None, "no payload"), 4: (None, "not UTF-8")}
    assert [r["x"] for r in raw.where("id < 4").orderBy("id").select(C.decode_raw_col("value", "string").alias("x")).collect()] == \
        [["héllo"], [""], None]


def test_one_bad_payload_among_good_ones(spark):
    rows = [(i, bytearray(np.float32([i, -i, 0, 1]).tobytes())) for i in range(500)] + [(500, bytearray(b"12345")), (501, None)]
    df = spark.createDataFrame(rows, "id int, value binary")
    out = C.try_decode(df, "raw", {"data_type": "float32", "data_reshape": "2 2"})
    bad = {r["id"]: r["error"] for r in out.where("error IS NOT NULL").collect()}
    assert bad == {500: "5 bytes are no multiple of 4 (float32)", 501: "no payload"}
    assert {r["id"]: r["decoded"] for r in out.where("error IS NULL").collect()}[7] == [[7, -7], [0, 1]]
    text = spark.createDataFrame([(1, '{"k": 1}'), (2, '{"k": '), (3, None)], "id int, value string")
    got = {r["id"]: (r["decoded"], r["error"]) for r in C.try_decode(text, "JSON", {"schema": T.StructType([T.StructField("k", T.IntegerType())])}).collect()}
    assert got[1][0]["k"] == 1 and got[1][1] is None and got[2] == (None, "malformed json") and got[3] == (None, "no payload")
    with pytest.raises(ValueError):
        C.try_decode(df, "XML", {})
