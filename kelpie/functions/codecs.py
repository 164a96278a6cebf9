"""Payload codecs: RAW tensors, Avro records, JSON and nested Telegraf JSON.

The byte work runs in Arrow-batched UDFs on the executors (one NumPy call per
batch, never a Python loop per element); everything else is built-in SQL.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# RAW type names accepted in input_config and their
# little-endian NumPy element types.  'float' is 8 bytes wide, 'float64'
# is accepted as an alias of 'double'.
RAW_NUMPY = {
    "half": "<f2",
    "float": "<f8",
    "float32": "<f4",
    "double": "<f8",
    "float64": "<f8",
    "int64": "<i8",
    "int32": "<i4",
    "int16": "<i2",
    "int8": "i1",
    "uint16": "<u2",
    "uint8": "u1",
    "bool": "?",
}

# Spark element type for each RAW type (unsigned types widen).
RAW_SPARK = {
    "half": T.FloatType(),
    "float": T.DoubleType(),
    "float32": T.FloatType(),
    "double": T.DoubleType(),
    "float64": T.DoubleType(),
    "int64": T.LongType(),
    "int32": T.IntegerType(),
    "int16": T.ShortType(),
    "int8": T.ByteType(),
    "uint16": T.IntegerType(),
    "uint8": T.ShortType(),
    "bool": T.BooleanType(),
}

# NumPy type the decoded values are widened to before they become Arrow.
_WIDE = {("f", 2): np.float32, ("u", 1): np.int16, ("u", 2): np.int32}


def _np_type(dtype: str) -> np.dtype:
    if dtype not in RAW_NUMPY:
        raise ValueError(f"unsupported RAW type {dtype!r}")
    return np.dtype(RAW_NUMPY[dtype])


def _leaf(arr: pa.Array):
    """(leaf values, per-row leaf offsets) of a possibly nested list array."""
    if not (pa.types.is_list(arr.type) or pa.types.is_large_list(arr.type)):
        n = len(arr)
        return arr, np.arange(n + 1, dtype=np.int64)
    offs = np.asarray(arr.offsets, dtype=np.int64)
    child = arr.values
    while pa.types.is_list(child.type) or pa.types.is_large_list(child.type):
        offs = np.asarray(child.offsets, dtype=np.int64)[offs]
        child = child.values
    return child, offs


def raw_bytes(arr: pa.Array, dtype: str) -> pa.Array:
    """Arrow array of numbers / (nested) lists -> binary of ``ndarray.tobytes()``."""
    npt = _np_type(dtype)
    leaf, offs = _leaf(arr)
    o0, o1 = int(offs[0]), int(offs[-1])
    vals = leaf.slice(o0, o1 - o0).to_numpy(zero_copy_only=False)
    if npt.kind in "iu":
        info = np.iinfo(npt)
        if len(vals) and (np.nanmin(vals) < info.min or np.nanmax(vals) > info.max):
            raise ValueError(f"value out of range for {dtype}")
    data = np.ascontiguousarray(vals.astype(npt)).view(np.uint8)
    return _binary((offs - o0) * npt.itemsize, data, arr.is_null() if arr.null_count else None)


_INT32 = 2**31 - 1


def _binary(offs: np.ndarray, data: np.ndarray, null: pa.Array | None = None) -> pa.Array:
    """Binary array over ``data``; one with 64-bit offsets where 32 don't reach."""
    wide = int(offs[-1]) > _INT32
    kind, width = (pa.large_binary(), np.int64) if wide else (pa.binary(), np.int32)
    out = pa.Array.from_buffers(kind, len(offs) - 1, [None, pa.py_buffer(offs.astype(width)), pa.py_buffer(data)])
    return out if null is None else pc.if_else(null, pa.scalar(None, kind), out)


def _payloads(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit offsets, bytes) of a binary array of either width."""
    wide = pa.types.is_large_binary(arr.type) or pa.types.is_large_string(arr.type)
    n, bufs = len(arr), arr.buffers()
    kind = np.dtype(np.int64 if wide else np.int32)
    offs = np.frombuffer(bufs[1], kind)[arr.offset:arr.offset + n + 1].astype(np.int64) if n else np.zeros(1, np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    return offs - offs[0], data[offs[0]:offs[-1]]


def _lists(offs: np.ndarray, values: pa.Array, null: pa.Array | None = None) -> pa.Array:
    if int(offs[-1]) > _INT32:
        return pa.LargeListArray.from_arrays(pa.array(offs), values, mask=null)
    return pa.ListArray.from_arrays(pa.array(offs.astype(np.int32)), values, mask=null)


def raw_errors(arr: pa.Array, dtype: str) -> pa.Array:
    """Why each payload can't be decoded as ``dtype``; null where it can."""
    npt = _np_type(dtype)
    length = np.diff(_payloads(arr)[0])
    null = arr.is_null().to_numpy(zero_copy_only=False)
    why = [None] * len(arr)
    for i in np.flatnonzero(null | (length % npt.itemsize != 0)).tolist():
        why[i] = "no payload" if null[i] else f"{length[i]} bytes are no multiple of {npt.itemsize} ({dtype})"
    return pa.array(why, pa.string())


def raw_values(arr: pa.Array, dtype: str, bad: pa.Array | None = None) -> pa.Array:
    """Binary Arrow array -> list array of ``dtype`` (``np.frombuffer`` per batch).  Rows marked
    in ``bad`` give null; without it a payload that isn't whole raises."""
    npt = _np_type(dtype)
    offs, raw = _payloads(arr)
    null = arr.is_null() if arr.null_count else None
    if bad is not None and bad.true_count:
        length, gone = np.diff(offs), bad.to_numpy(zero_copy_only=False)
        raw = raw[np.repeat(~gone, length)]
        offs = np.concatenate([[0], np.cumsum(np.where(gone, 0, length))])
        null = bad if null is None else pc.or_(null, bad)
    if (np.diff(offs) % npt.itemsize).any():
        raise ValueError(f"payload length is not a multiple of {npt.itemsize} bytes for {dtype}")
    vals = np.ascontiguousarray(raw).view(npt)
    wide = _WIDE.get((npt.kind, npt.itemsize))
    vals = vals.astype(wide if wide is not None else npt.newbyteorder("="), copy=False)
    return _lists(offs // npt.itemsize, pa.array(vals), null)


def _checked(values: pa.Array, errors: pa.Array) -> pa.Array:
    return pa.StructArray.from_arrays([values, errors], ["values", "error"])


def _udf_try(element: T.DataType, errors_of, values_of):
    """One pass over a batch: struct<values, error>."""

    @F.arrow_udf(T.StructType([T.StructField("values", T.ArrayType(element)), T.StructField("error", T.StringType())]))
    def run(a: pa.Array) -> pa.Array:
        errors = errors_of(a)
        return _checked(values_of(a, errors.is_valid()), errors)

    return run


def _udf_encode(dtype: str):
    @F.arrow_udf(T.BinaryType())
    def enc(a: pa.Array) -> pa.Array:
        return raw_bytes(a, dtype)
    return enc


def _udf_decode(dtype: str):
    @F.arrow_udf(T.ArrayType(RAW_SPARK[dtype]))
    def dec(a: pa.Array) -> pa.Array:
        return raw_values(a, dtype)
    return dec


def encode_raw_col(col: Column | str, dtype: str) -> Column:
    """S03 column form: numbers or (nested) arrays -> RAW bytes."""
    c = F.col(col) if isinstance(col, str) else col
    if dtype == "string":
        return F.encode(c, "UTF-8")
    _np_type(dtype)
    return _udf_encode(dtype)(c)


def decode_raw_col(col: Column | str, dtype: str) -> Column:
    """P01 column form: RAW bytes -> flat array (reshape with :func:`reshape_col`
    on a separate projection: a Python UDF cannot sit inside a lambda)."""
    c = F.col(col) if isinstance(col, str) else col
    if dtype == "string":       # the payload is one text
        return F.when(c.isNotNull(), F.array(F.validate_utf8(c.cast("string"))))
    _np_type(dtype)
    return _udf_decode(dtype)(c)


def try_decode_raw_col(col: Column | str, dtype: str) -> Column:
    """struct<values, error>: a payload that can't be decoded gives its reason and stops nothing."""
    c = F.col(col) if isinstance(col, str) else col
    if dtype == "string":
        text = F.try_validate_utf8(c.cast("string"))
        return F.struct(F.when(text.isNotNull(), F.array(text)).alias("values"),
                        F.when(c.isNull(), "no payload").when(text.isNull(), "not UTF-8").alias("error"))
    _np_type(dtype)
    return _udf_try(RAW_SPARK[dtype], lambda a: raw_errors(a, dtype), lambda a, bad: raw_values(a, dtype, bad))(c)


def reshape_col(flat: Column, reshape: str | None) -> Column:
    """Reshape a flat array by a blank-separated shape text (row-major)."""
    dims = [int(x) for x in (reshape or "").split() if x.strip()]
    if len(dims) <= 1:
        return flat
    def group(arr: Column, d: int) -> Column:
        # consecutive runs of d elements
        return F.transform(F.sequence(F.lit(0), F.floor(F.size(arr) / d).cast("int") - 1),
                           lambda i: F.slice(arr, i * d + 1, d))

    out = flat
    for d in reversed(dims[1:]):
        out = group(out, d)
    return out


def encode_raw(df: DataFrame, data_col: str, label_col: str | None, data_type: str,
               label_type: str | None = None) -> DataFrame:
    """RAW-encode feature (value) and label (key) columns of a frame."""
    out = df.withColumn("value", encode_raw_col(data_col, data_type))
    if label_col is not None:
        out = out.withColumn("key", encode_raw_col(label_col, label_type or data_type))
    else:
        out = out.withColumn("key", F.lit(None).cast("binary"))
    return out


def decode_raw(df: DataFrame, data_type: str, data_reshape: str | None = None,
               label_type: str | None = None, label_reshape: str | None = None,
               value: str = "value", key: str = "key") -> DataFrame:
    """Decode RAW value (features) and key (label) with the control record config.

    Separate UDFs for key and value keep column pruning intact; a label of
    one element collapses to a scalar (P02).
    """
    out = df.withColumn("features", decode_raw_col(value, data_type))
    if len((data_reshape or "").split()) > 1:
        out = out.withColumn("features", reshape_col(F.col("features"), data_reshape))
    if label_type:
        out = out.withColumn("label", decode_raw_col(key, label_type))
        if len((label_reshape or "").split()) > 1:
            out = out.withColumn("label", reshape_col(F.col("label"), label_reshape))
        else:
            out = out.withColumn("label", collapse_label("label"))
    return out


def collapse_label(col: Column | str) -> Column:
    """A length-1 label becomes its scalar; null stays null."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(F.size(c) == 1, c[0])


def key_bytes(col: Column | str, dtype: str, width: int = 1) -> Column:
    """Scalar -> key bytes.

    str -> UTF-8; int/bool -> ``width`` big-endian bytes (1 like the
    reference; values that do not fit give null, see :func:`key_bytes_error`);
    float -> 4-byte little-endian IEEE; bytes pass through.
    """
    c = F.col(col) if isinstance(col, str) else col
    if dtype in ("str", "string"):
        return F.encode(c, "UTF-8")
    if dtype in ("bytes", "binary"):
        return c
    if dtype in ("int", "bool"):
        v = c.cast("long") if dtype == "int" else c.cast("int").cast("long")
        lim = (1 << (8 * width)) - 1 if width < 8 else None
        hexed = F.lpad(F.hex(v), 2 * width, "0")
        ok = (v >= 0) & (v <= F.lit(lim)) if lim is not None else v.isNotNull()
        return F.when(ok, F.unhex(hexed))
    if dtype == "float":
        return encode_raw_col(c.cast("float"), "float32")
    raise ValueError(f"type {dtype!r} not supported for key bytes")


def key_bytes_error(col: Column | str, dtype: str, width: int = 1) -> Column:
    """Dead-letter reason for :func:`key_bytes` (null when the value encodes)."""
    c = F.col(col) if isinstance(col, str) else col
    if dtype not in ("int", "bool"):
        return F.lit(None).cast("string")
    v = c.cast("long") if dtype == "int" else c.cast("int").cast("long")
    lim = (1 << (8 * width)) - 1 if width < 8 else None
    bad = (v < 0) | (v > F.lit(lim)) if lim is not None else F.lit(False)
    return F.when(c.isNotNull() & bad, F.lit(f"does not fit {width} byte(s)"))


def key_to_int(col: Column | str) -> Column:
    """Big-endian key bytes -> integer."""
    c = F.col(col) if isinstance(col, str) else col
    return F.conv(F.hex(c), 16, 10).cast("long")


def infer_format(df: DataFrame, data_col: str, label_col: str | None = None) -> DataFrame:
    """(data_type, label_type, data_reshape, label_reshape) over the WHOLE table.

    Type comes from the schema; the shape from min/max array sizes, so ragged
    data shows up as ``ragged`` instead of being decided by the first row.
    """
    def type_name(dt: T.DataType) -> str:
        while isinstance(dt, T.ArrayType):
            dt = dt.elementType
        return {T.FloatType: "float32", T.DoubleType: "float64", T.LongType: "int64",
                T.IntegerType: "int32", T.ShortType: "int16", T.ByteType: "int8",
                T.BooleanType: "bool", T.StringType: "string"}.get(type(dt), dt.simpleString())

    def shape_exprs(name: str):
        dt = df.schema[name].dataType
        if not isinstance(dt, T.ArrayType):
            return F.lit(1).cast("long"), F.lit(1).cast("long")
        return F.min(F.size(name)).cast("long"), F.max(F.size(name)).cast("long")

    dmin, dmax = shape_exprs(data_col)
    aggs = [dmin.alias("_dmin"), dmax.alias("_dmax")]
    if label_col:
        lmin, lmax = shape_exprs(label_col)
        aggs += [lmin.alias("_lmin"), lmax.alias("_lmax")]
    stats = df.agg(*aggs)

    def shape(mn, mx):
        return F.when(F.col(mn) == F.col(mx), F.col(mn).cast("string")).otherwise(F.lit("ragged"))

    cols = [F.lit(type_name(df.schema[data_col].dataType)).alias("data_type")]
    cols.append(F.lit(type_name(df.schema[label_col].dataType)).alias("label_type") if label_col
                else F.lit(None).cast("string").alias("label_type"))
    cols.append(shape("_dmin", "_dmax").alias("data_reshape"))
    cols.append(shape("_lmin", "_lmax").alias("label_reshape") if label_col
                else F.lit(None).cast("string").alias("label_reshape"))
    return stats.select(*cols)


# ---------------------------------------------------------------- JSON ----

def decode_json(df: DataFrame, schema: T.DataType | str, value: str = "value",
                out: str = "decoded") -> DataFrame:
    """JSON payload -> typed column (PERMISSIVE); malformed rows keep a null
    value and get ``decode_error`` (for struct schemas via the corrupt-record column)."""
    txt = F.col(value).cast("string")
    if isinstance(schema, T.StructType):
        full = T.StructType(list(schema.fields) + [T.StructField("_corrupt_record", T.StringType())])
        p = F.from_json(txt, full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
        d = df.withColumn("_p", p)
        bad = txt.isNotNull() & F.col("_p._corrupt_record").isNotNull()
        return d.withColumn(out, F.when(~bad, F.struct(*[F.col("_p")[f.name].alias(f.name) for f in schema.fields]))) \
                .withColumn("decode_error", F.when(bad, F.lit("malformed json"))).drop("_p")
    parsed = F.from_json(txt, schema, {"mode": "PERMISSIVE"})
    return df.withColumn(out, parsed).withColumn(
        "decode_error", F.when(txt.isNotNull() & parsed.isNull(), F.lit("malformed json")))


def decode_telegraf(df: DataFrame, schema: T.DataType | str, value: str = "value",
                    out: str = "decoded") -> DataFrame:
    """Telegraf JSON whose ``fields.value`` is itself a JSON text."""
    inner = F.get_json_object(F.col(value).cast("string"), "$.fields.value")
    return df.withColumn(out, F.from_json(inner, schema, {"mode": "PERMISSIVE"}))


# ---------------------------------------------------------------- Avro ----

_AVRO_FIXED = {"float": "<f4", "double": "<f8", "boolean": "?"}


def parse_avro_schema(schema: str | dict) -> list[tuple[str, str]]:
    """Flat record schema -> [(field, type)]; single quotes are accepted."""
    if isinstance(schema, str):
        schema = json.loads(schema.replace("'", '"'))
    out = []
    for f in schema["fields"]:
        t = f["type"]
        if isinstance(t, list):  # ["null", x] unions are not part of the shipped schemas
            raise ValueError("union fields are not supported")
        if t not in ("float", "double", "boolean", "int", "long", "string"):
            raise ValueError(f"avro type {t!r} not supported")
        out.append((f["name"], t))
    return out


def _zigzag_varint(v: int) -> bytes:
    z = (v << 1) ^ (v >> 63)
    out = bytearray()
    while True:
        b = z & 0x7F
        z >>= 7
        if z:
            out.append(b | 0x80)
        else:
            out.append(b)
            return bytes(out)


def _read_varint(buf: bytes, i: int) -> tuple[int, int]:
    shift = z = 0
    while True:
        b = buf[i]
        i += 1
        z |= (b & 0x7F) << shift
        if not b & 0x80:
            break
        shift += 7
    return (z >> 1) ^ -(z & 1), i


def avro_bytes(batch: pa.StructArray, fields: list[tuple[str, str]]) -> pa.Array:
    """Encode flat records (Avro binary encoding, no container header).  Without unions a record can't
    hold a null: a row with one gives a null record."""
    n = len(batch)
    missing = batch.is_null()
    for name, _ in fields:
        missing = pc.or_(missing, batch.field(name).is_null())
    if all(t in _AVRO_FIXED for _, t in fields):
        dt = np.dtype([(name, _AVRO_FIXED[t]) for name, t in fields])
        rec = np.zeros(n, dtype=dt)
        for name, t in fields:
            column = batch.field(name)
            rec[name] = pc.fill_null(column, False if t == "boolean" else 0).to_numpy(zero_copy_only=False)
        return _binary(np.arange(n + 1) * dt.itemsize, rec.view(np.uint8), missing if missing.true_count else None)
    cols, none = [batch.field(name).to_pylist() for name, _ in fields], missing.to_pylist()
    out = []
    for r in range(n):  # varint fields: small per-record helper
        if none[r]:
            out.append(None)
            continue
        b = bytearray()
        for (name, t), col in zip(fields, cols):
            v = col[r]
            if t in _AVRO_FIXED:
                b += np.array([v], dtype=_AVRO_FIXED[t]).tobytes()
            elif t in ("int", "long"):
                b += _zigzag_varint(int(v))
            else:
                s = str(v).encode("utf-8")
                b += _zigzag_varint(len(s)) + s
        out.append(bytes(b))
    return pa.array(out, pa.binary())


def _avro_record(buf: bytes, fields: list[tuple[str, str]]) -> list[float | None]:
    i, row = 0, []
    for name, t in fields:
        if t in _AVRO_FIXED:
            w = np.dtype(_AVRO_FIXED[t]).itemsize
            row.append(float(np.frombuffer(buf[i:i + w], dtype=_AVRO_FIXED[t])[0]) if i + w <= len(buf) else buf[len(buf)])
            i += w
        elif t in ("int", "long"):
            v, i = _read_varint(buf, i)
            row.append(float(v))
        else:
            ln, i = _read_varint(buf, i)
            if ln < 0 or i + ln > len(buf):
                raise IndexError(name)
            s = buf[i:i + ln].decode("utf-8")
            i += ln
            try:
                row.append(float(s))
            except ValueError:
                row.append(None)
    if i != len(buf):
        raise ValueError(f"{len(buf)} bytes, the record ends after {i}")
    return row


def avro_try(arr: pa.Array, fields: list[tuple[str, str]]) -> tuple[pa.Array, pa.Array]:
    """(list<double> of the fields in schema order, reason): records that aren't whole give null and their reason."""
    n = len(arr)
    if all(t in _AVRO_FIXED for _, t in fields):
        dt = np.dtype([(name, _AVRO_FIXED[t]) for name, t in fields])
        offs, data = _payloads(arr)
        length, null = np.diff(offs), arr.is_null().to_numpy(zero_copy_only=False)
        good = ~null & (length == dt.itemsize)
        why = [None] * n
        for i in np.flatnonzero(~good).tolist():
            why[i] = "no payload" if null[i] else f"{length[i]} bytes, a record has {dt.itemsize}"
        rec = np.ascontiguousarray(data[np.repeat(good, length)]).view(dt)
        vals = np.stack([rec[name].astype(np.float64) for name, _ in fields], axis=1).reshape(-1)
        ends = np.concatenate([[0], np.cumsum(good)]) * len(fields)
        return _lists(ends, pa.array(vals), pa.array(~good) if not good.all() else None), pa.array(why, pa.string())
    out, why = [], []
    for buf in arr.to_pylist():
        try:
            out.append(None if buf is None else _avro_record(buf, fields))
            why.append("no payload" if buf is None else None)
        except IndexError:
            out.append(None)
            why.append(f"{len(buf)} bytes, the record is longer")
        except ValueError as e:
            out.append(None)
            why.append("not UTF-8" if isinstance(e, UnicodeDecodeError) else str(e))
    return pa.array(out, pa.list_(pa.float64())), pa.array(why, pa.string())


def avro_values(arr: pa.Array, fields: list[tuple[str, str]]) -> pa.Array:
    """Decode flat records to a list<double> of the fields in schema order; null stays null, a record that
    isn't whole raises."""
    values, why = avro_try(arr, fields)
    bad = [w for w in why.to_pylist() if w not in (None, "no payload")]
    if bad:
        raise ValueError(bad[0])
    return values


def encode_avro_col(cols: list[str], schema: str | dict) -> Column:
    """S05 column form: struct of the schema's fields -> Avro record bytes."""
    fields = parse_avro_schema(schema)

    @F.arrow_udf(T.BinaryType())
    def enc(s: pa.Array) -> pa.Array:
        return avro_bytes(s, fields)

    return enc(F.struct(*[F.col(c).alias(n) for c, (n, _) in zip(cols, fields)]))


def decode_avro_col(col: Column | str, schema: str | dict) -> Column:
    """P03 column form: Avro record bytes -> ARRAY<DOUBLE> in schema order."""
    fields = parse_avro_schema(schema)
    c = F.col(col) if isinstance(col, str) else col

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def dec(a: pa.Array) -> pa.Array:
        return avro_values(a, fields)

    return dec(c)


def try_decode_avro_col(col: Column | str, schema: str | dict) -> Column:
    """struct<values, error> as :func:`try_decode_raw_col`."""
    fields = parse_avro_schema(schema)
    c = F.col(col) if isinstance(col, str) else col

    @F.arrow_udf(T.StructType([T.StructField("values", T.ArrayType(T.DoubleType())), T.StructField("error", T.StringType())]))
    def run(a: pa.Array) -> pa.Array:
        return _checked(*avro_try(a, fields))

    return run(c)


def try_decode(df: DataFrame, fmt: str, config: dict, value: str = "value", out: str = "decoded") -> DataFrame:
    """F03 for every payload format: ``out`` and ``error`` from one pass over the payloads.

    ``fmt`` and ``config`` are those of a control record: RAW (data_type, data_reshape), AVRO
    (data_scheme) or JSON (schema: a struct type).  A bad or missing payload has a null ``out`` and its
    reason in ``error``, all others decode.  Route with ``error IS NULL``."""
    kind = fmt.upper()
    if kind == "JSON":
        d = decode_json(df, config["schema"], value, out)
        return d.withColumn(out, F.when(F.col(value).isNotNull(), F.col(out))) \
            .withColumn("error", F.when(F.col(value).isNull(), "no payload").otherwise(F.col("decode_error"))).drop("decode_error")
    if kind == "RAW":
        tried = try_decode_raw_col(value, config["data_type"])
    elif kind == "AVRO":
        tried = try_decode_avro_col(value, config["data_scheme"])
    else:
        raise ValueError(f"unknown payload format {fmt!r}")
    d = df.withColumn("_tried", tried)
    values = F.col("_tried.values")
    if kind == "RAW" and len((config.get("data_reshape") or "").split()) > 1:
        values = F.when(values.isNotNull(), reshape_col(values, config["data_reshape"]))
    return d.withColumn(out, values).withColumn("error", F.col("_tried.error")).drop("_tried")


def encode_avro(df: DataFrame, data_cols: list[str], data_schema, label_cols=None,
                label_schema=None) -> DataFrame:
    """Data record -> value, label record -> key."""
    out = df.withColumn("value", encode_avro_col(data_cols, data_schema))
    if label_cols:
        out = out.withColumn("key", encode_avro_col(label_cols, label_schema))
    return out


def decode_avro(df: DataFrame, data_schema, label_schema=None) -> DataFrame:
    """Value -> features, key -> label (list collapsed when one field)."""
    out = df.withColumn("features", decode_avro_col("value", data_schema))
    if label_schema is not None:
        out = out.withColumn("label", collapse_label(decode_avro_col("key", label_schema)))
    return out
