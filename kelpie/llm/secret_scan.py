"""Secret scans: multipart credential linking.

A text pass finds the parts of credentials.  Strong parts are reported by
themselves: ``assign`` (a named password, token or key), ``access`` (an access
key identifier) and ``hex`` (a long hexadecimal run).  Weak candidates are not:

* ``login``     a user name, account or client id given by name;
* ``opaque``    a long run of mixed letters and digits that no name announces;
* ``endpoint``  a URL or a host with a port.

Weak candidates are reported only when complementary parts co-occur in their
scope (a stretch of text without a blank line) no further than ``reach`` code
points away:

* an ``opaque`` run needs an identifier (``access`` or ``login``);
* a ``login`` needs a secret (``assign``, ``hex`` or ``opaque``);
* an ``endpoint`` needs both an identifier and a secret.

Co-occurrence is an interval join in Spark: each part is entered in all
``reach``-wide cells of its scope that it can reach, each weak candidate looks
up all cells from its start to its end, and the distance test follows.  It is a
semi join, so a candidate gives at most one row for each of its own cells, which
are made one again, however full of parts a document is.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kelpie.llm.common import aside, columns, write_and_read

REACH = 400
KINDS = ("assign", "access", "hex", "login", "opaque", "endpoint")   # also the order at equal starts
BASE = KINDS[:3]

ASSIGN = re.compile(
    r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")      # a run of 16 or more is found whole, a shorter one is dropped
LOGIN = re.compile(
    r"""(?ai:user_?name|user|login|account|client_?id|access_?key_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._-]{3,})""")
OPAQUE = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
# what `endpoints` finds; it is not searched with, as each letter of an unbroken run would be tried as a start
ENDPOINT = re.compile(r"[A-Za-z][A-Za-z0-9+.-]*://[^\s\"'<>]+|\b[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+:[0-9]{2,5}\b")
_REST, _PORT = re.compile(r"//[^\s\"'<>]+"), re.compile(r"[0-9]{2,5}\b")
_HOST = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789.-")
_EDGE = re.compile(r"\b")
BLANK_LINE = re.compile(r"\n[\x20\t\r]*\n")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Strong parts of one text: leftmost, not overlapping within a kind."""
    out = []
    if ":" in text or "=" in text:
        out += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 12]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return out


def _mixed(token: str) -> bool:
    """Lower case, upper case and digits all occur, as in random keys."""
    return any(c.islower() for c in token) and any(c.isupper() for c in token) and any(c.isdigit() for c in token)


def endpoints(text: str) -> Iterator[tuple[int, int]]:
    """The matches of ``ENDPOINT`` in linear time: from each colon to the left, never past the match before."""
    done, colon = 0, text.find(":")
    while colon >= 0:
        end = None
        if colon >= done and (rest := _REST.match(text, colon + 1)):
            at = colon
            while at > done and (text[at - 1] in _HOST or text[at - 1] == "+"):
                at -= 1
            while at < colon and not (text[at].isascii() and text[at].isalpha()):
                at += 1
            end = rest.end() if at < colon else None
        elif colon >= done and (port := _PORT.match(text, colon + 1)):
            at = dot = colon                        # dot: the last place of a dot that a label follows
            while at > done and text[at - 1] in _HOST and not (text[at - 1] == "." and text[at:at + 1] in ".:"):
                at -= 1
                if text[at] == "." and dot == colon:
                    dot = at
            while at < dot and (text[at] == "." or not _EDGE.match(text, at)):
                at += 1
            end = port.end() if at < dot < colon else None
        if end is not None:
            yield at, end
            done = end
        colon = text.find(":", max(colon + 1, done))


def weak_spans(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Weak candidates of one text outside its strong parts.  A kind whose
    complement is missing from the whole text can't be reported: it is not searched."""
    strong = sorted((s, e) for _, s, e in base)
    starts, reach = [s for s, _ in strong], list(accumulate((e for _, e in strong), max))

    def free(span: tuple[int, int]) -> bool:
        before = bisect_left(starts, span[1])       # the strong parts that begin before its end
        return not before or reach[before - 1] <= span[0]

    logins = [("login", *m.span()) for m in LOGIN.finditer(text) if free(m.span())] \
        if ":" in text or "=" in text else []
    if not logins and not any(k == "access" for k, _, _ in base):
        return []
    opaque = [("opaque", *m.span()) for m in OPAQUE.finditer(text) if free(m.span()) and _mixed(m[0])]
    if not opaque and not any(k in ("assign", "hex") for k, _, _ in base):
        return []
    return logins + opaque + [("endpoint", *m) for m in endpoints(text) if free(m)]


def _scopes(text: str, spans: list[tuple[str, int, int]]) -> list[int]:
    """For each span the number of blank lines before it."""
    marks = [m.start() for m in BLANK_LINE.finditer(text)]
    return [bisect_left(marks, s) for _, s, _ in spans]


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("scope", pa.int32())])
_PARTS = "array<struct<kind:string,start:int,end:int,scope:int>>"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        base, weak = [], []
        for i in range(b.num_rows):
            text = b.column(3)[i].as_py() or ""
            found = base_spans(text)
            more = weak_spans(text, found)
            scope = _scopes(text, found + more) if more else [0] * len(found)
            rows = [dict(zip(("kind", "start", "end", "scope"), (*s, c))) for s, c in zip(found + more, scope)]
            base.append(rows[:len(found)])
            weak.append(rows[len(found):])
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), b.column(2), pa.array(base, pa.list_(_SPAN)), pa.array(weak, pa.list_(_SPAN))],
            ["doc_id", "k1", "k2", "base", "weak"])


def row_key(text: str = "text", doc_id: str = "doc_id") -> list[Column]:
    """128 bits that rows share only if they agree in id and text; never null."""
    return [F.xxhash64(F.lit(1), F.col(doc_id), F.col(text)).alias("k1"),
            F.xxhash64(F.lit(2), F.col(text), F.col(doc_id)).alias("k2")]


def _linked(scan: DataFrame, reach: int) -> DataFrame:
    """(k1, k2, kind, start, end) of the weak candidates that have their complement."""
    some = scan.where(F.size("weak") > 0).dropDuplicates(["k1", "k2"])
    parts = some.select("k1", "k2", F.explode(F.concat("base", "weak")).alias("p")).select("k1", "k2", "p.*") \
        .withColumn("role", F.when(F.col("kind").isin("access", "login"), "id")
                    .when(F.col("kind") == "endpoint", "endpoint").otherwise("secret"))
    near = parts.where("role <> 'endpoint'").select(
        "k1", "k2", "scope", F.col("role").alias("other"), F.col("start").alias("s"), F.col("end").alias("e"),
        F.explode(F.expr(f"sequence((start - {reach}) div {reach} - 1, (end + {reach}) div {reach} + 1)")).alias("cell"))
    weak = parts.where(F.col("kind").isin("login", "opaque", "endpoint")).select("k1", "k2", "scope", "kind", "start", "end")

    def having(cands: DataFrame, role: str) -> DataFrame:
        n = near.where(F.col("other") == role).alias("n")
        c = cands.withColumn("cell", F.explode(F.expr(f"sequence(start div {reach}, end div {reach})"))).alias("c")
        return c.join(n, (F.col("c.k1") == F.col("n.k1")) & (F.col("c.k2") == F.col("n.k2"))
                      & (F.col("c.scope") == F.col("n.scope")) & (F.col("c.cell") == F.col("n.cell"))
                      & (F.col("n.s") - F.col("c.end") <= reach) & (F.col("c.start") - F.col("n.e") <= reach),
                      "left_semi").drop("cell").distinct()

    found = having(weak.where("kind = 'opaque'"), "id") \
        .unionByName(having(weak.where("kind = 'login'"), "secret")) \
        .unionByName(having(having(weak.where("kind = 'endpoint'"), "id"), "secret"))
    return found.select("k1", "k2", "kind", "start", "end")


def scan(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, k1, k2 (:func:`row_key`),
    ``base`` and ``spans``: sorted arrays of struct(kind, start, end), offsets in
    code points, end exclusive.  ``base`` has the strong parts, ``spans`` also the
    linked weak ones.  A null or empty text has none; rows that agree in id and
    text have equal spans; a null doc_id is kept; an empty table gives no rows."""
    src = columns(docs, doc_id="long", text="string")
    found = src.select("doc_id", *row_key(), "text").mapInArrow(
        _scan, f"doc_id long, k1 long, k2 long, base {_PARTS}, weak {_PARTS}")
    found = write_and_read(found, "secret-parts")
    linked = _linked(found, reach).groupBy("k1", "k2").agg(
        F.collect_list(F.struct("kind", "start", "end")).alias("linked"))

    def in_order(spans: Column) -> Column:
        order = F.create_map(*[x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))])
        keyed = F.transform(spans, lambda s: F.struct(
            s["start"].alias("start"), order[s["kind"]].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))
        return F.transform(F.array_sort(keyed), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"),
                                                                   s["end"].alias("end")))

    strong = F.transform("base", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"),
                                                    s["end"].alias("end")))
    return found.join(linked, ["k1", "k2"], "left").select(
        "doc_id", "k1", "k2", in_order(strong).alias("base"),
        in_order(F.when(F.col("linked").isNull(), strong).otherwise(F.concat(strong, "linked"))).alias("spans"))


def digest(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                 s["end"].cast("string"))), ",")


def redact(docs: DataFrame, mark: str = "[REDACTED]", reach: int = REACH) -> DataFrame:
    """``docs`` with every reported span replaced by ``mark`` (touching or
    overlapping spans by one); all other columns and all rows stay."""
    found = scan(docs, reach).where(F.size("spans") > 0) \
        .groupBy("k1", "k2").agg(F.first("spans").alias("_ss_spans"))
    k1, k2 = row_key()
    rows = aside(docs, "doc_id", "text")
    joined = rows.withColumns({"_ss_k1": k1, "_ss_k2": k2}).join(
        found.select(F.col("k1").alias("_ss_k1"), F.col("k2").alias("_ss_k2"), "_ss_spans"),
        ["_ss_k1", "_ss_k2"], "left")
    clean = F.expr(f"""
        aggregate(_ss_spans, named_struct('out', '', 'pos', 0),
          (a, s) -> named_struct(
            'out', CASE WHEN a.pos > 0 AND s.start <= a.pos THEN a.out
                        ELSE concat(a.out, substring(text, a.pos + 1, s.start - a.pos), '{mark}') END,
            'pos', greatest(a.pos, s.end)),
          a -> concat(a.out, substring(text, a.pos + 1)))""")
    return joined.withColumn("text", F.when(F.col("_ss_spans").isNull(), F.col("text")).otherwise(clean)) \
        .drop("_ss_k1", "_ss_k2", "_ss_spans").select(*rows.columns).toDF(*docs.columns)
