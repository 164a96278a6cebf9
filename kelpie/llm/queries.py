"""The registered queries of this package: one thin ``opN_<name>`` per operator,
over the whole of its table, and the corpus pipeline.  Their digest columns are
derived from what the operators return."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kelpie.llm.common import columns, not_null_text, prepare, read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def deco(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql.strip()
        return run
    return deco


@_query("op1_sharding")
def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in eight shuffled shards, law ``rows``; read from the written shards."""
    from kelpie.llm.sharding import write_shards

    out = write_shards(read_table(spark, sf_dir, "documents"), shards=8)
    return out.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(not_null_text()) + 1).cast("long").alias("size"),
        F.crc32(not_null_text().cast("binary")).cast("long").alias("text_crc32"),
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))


@_query("op10_secret_scan")
def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in every document."""
    from kelpie.llm.secret_scan import BASE, digest, scan

    out = scan(read_table(spark, sf_dir, "documents"))

    def n_of(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return out.select("doc_id", *[n_of(k) for k in BASE],
                      F.sha2(digest(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                      digest(F.col("spans")).alias("spans"))


@_query("op8_warc", """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, unhex(sha1(coalesce(html, ''))) AS d,
                  min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages),
b AS (SELECT *, list_transform(range(0, 20), lambda i: ('0x' || substr(hex(d), 2 * i::INT + 1, 2))::UTINYINT::INT) AS o FROM p)
SELECT page_id, n::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           ((((o[(j * 5) // 8 + 1] * 256 + coalesce(o[(j * 5) // 8 + 2], 0)) >> (11 - (j * 5) % 8)::INT) & 31) + 1)::BIGINT, 1)), '')
           AS payload_digest,
       CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > first THEN first END AS refers_to
FROM b
""")
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A record per page, written to ZIP-packaged archives and read back by ranges."""
    from kelpie.llm.warc import read_archives, write_archives

    out = read_archives(write_archives(read_table(spark, sf_dir, "pages")), with_payload=False)
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@_query("op3_quality_rules")
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, fixed limits and the trained verdict for every document."""
    from kelpie.llm.quality import judge, train

    docs = read_table(spark, sf_dir, "documents")
    return judge(docs, train(docs, read_table(spark, sf_dir, "labels")))


@_query("op9_language_id")
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by rank-order profiles learned from the rows not held out."""
    from kelpie.llm.langid import Profiles, held_out, learn, predict

    docs = read_table(spark, sf_dir, "documents")
    found = predict(docs, Profiles.of(learn(docs.where(F.col("doc_id").isNotNull() & ~held_out()))))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


@_query("op5_token_files")
def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, written to token files in doc_id order and read back."""
    from kelpie.llm.token_files import read_tokens, write_tokens
    from kelpie.llm.tokenizing import public_path

    written = write_tokens(read_table(spark, sf_dir, "documents"), public_path("word_bpe_49k.json"))
    return read_tokens(written, with_ids=False)


@_query("op6_packing")
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document packed into sequences of 2048 ids."""
    from kelpie.llm.packing import pack
    from kelpie.llm.tokenizing import public_path

    out = pack(read_table(spark, sf_dir, "documents"), public_path("byte_bpe_50k.json"))
    return out.select("doc_id", "start", "length", F.crc32("ids").cast("long").alias("ids_crc32"), "doc_tokens",
                      "sequence_id", "offset")


@_query("op4_simhash")
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and the components of those within four bits."""
    from kelpie.llm.simhash import cluster

    out = cluster(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@_query("op7_embedding_dedup")
def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings at cosine 0.9."""
    from kelpie.llm.embeddings import link

    return link(read_table(spark, sf_dir, "embeddings"))


@_query("op2_mixing")
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mix of all sources takes of every document."""
    from kelpie.llm.mixing import Mix

    mix = Mix(read_table(spark, sf_dir, "documents"))
    taken = mix.pieces(untaken=True).groupBy("s", "lane", "ord") \
        .agg(F.first("doc_id").alias("doc_id"), F.first("size").alias("size"), F.sum("words").alias("taken"))
    return taken.join(mix.targets.withColumn("s", F.col("s").cast("long")), "s") \
        .select("doc_id", "size", "source_size", "target", "taken")


@_query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline."""
    from corpus_pipeline import run

    return run(spark, sf_dir)


@_query("op11_periodic_runs")
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of at least six words and four periods; a tenth of the texts is made periodic first."""
    from kelpie.llm.periodic import find_runs

    docs = columns(read_table(spark, sf_dir, "documents"), doc_id="long", text="string")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    n = F.size(words)
    a = (g % n).cast("int")
    p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
    wave = F.slice(F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int"))), F.lit(1), n - a)
    docs = docs.withColumn("text", F.when((h % 10 == 0) & (n > 0), F.array_join(F.concat(F.slice(words, F.lit(1), a), wave), " "))
                           .otherwise(F.col("text")))
    found = find_runs(docs)
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.s")).alias("start"), F.col("best.length"),
        (-F.col("best.p")).alias("period"), F.floor(1000 * F.col("best.length") / -F.col("best.p")).alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


# crc32 by its table, the trees and the folds by recursion, a level a step
_MERKLE_SQL = """
WITH RECURSIVE tab AS (SELECT list(c ORDER BY n) AS t FROM (SELECT n, list_reduce(list_prepend(n, range(8)),
    lambda a, x: CASE WHEN a & 1 = 1 THEN xor(3988292384, a >> 1) ELSE a >> 1 END) AS c FROM range(256) r(n))),
ids AS (SELECT doc_id, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: ascii(x)::BIGINT)),
    lambda c, b: xor(tab.t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) AS crc FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL), tab),
f AS (SELECT d.doc_id, source, text, crc, CASE WHEN d.doc_id IS NULL THEN '-' ELSE len(CAST(d.doc_id AS VARCHAR)) || ':' || d.doc_id END
    || CASE WHEN source IS NULL THEN '-' ELSE octet_length(encode(source)) || ':' || source END
    || CASE WHEN lang IS NULL THEN '-' ELSE octet_length(encode(lang)) || ':' || lang END
    || CASE WHEN n_chars IS NULL THEN '-' ELSE len(CAST(n_chars AS VARCHAR)) || ':' || n_chars END AS head
    FROM documents d LEFT JOIN ids ON ids.doc_id = d.doc_id),
g AS (SELECT *, CASE WHEN crc % 5 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') END AS low FROM f),
h AS (SELECT doc_id, coalesce('1' || source, '0') AS tree,
    sha256(head || CASE WHEN text IS NULL THEN '-' ELSE octet_length(encode(text)) || ':' || text END) AS leaf,
    CASE WHEN low IS NOT NULL THEN sha256(head || octet_length(encode(low)) || ':' || low) END AS claimed FROM g),
leaves AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM h),
up AS (SELECT tree, 0 AS lvl, pos, n, leaf AS d FROM leaves
    UNION ALL SELECT tree, lvl + 1, pos // 16, (any_value(n) + 15) // 16, sha256(string_agg(d, '' ORDER BY pos)) FROM up WHERE n > 1 GROUP BY tree, lvl, pos // 16),
subs AS (SELECT tree, d, lvl AS deep, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos, count(*) OVER () AS n FROM up WHERE n = 1),
top AS (SELECT 0 AS lvl, pos, n, d FROM subs
    UNION ALL SELECT lvl + 1, pos // 16, (any_value(n) + 15) // 16, sha256(string_agg(d, '' ORDER BY pos)) FROM top WHERE n > 1 GROUP BY lvl, pos // 16),
steps AS (SELECT l.tree, l.pos, k.lvl AS step, string_agg(u.d, '' ORDER BY u.pos) FILTER (WHERE u.pos < l.pos >> (4 * k.lvl)) AS a,
        string_agg(u.d, '' ORDER BY u.pos) FILTER (WHERE u.pos > l.pos >> (4 * k.lvl)) AS z
    FROM leaves l JOIN (SELECT DISTINCT tree, lvl FROM up WHERE n > 1) k ON k.tree = l.tree
    JOIN up u ON u.tree = l.tree AND u.lvl = k.lvl AND u.pos >> 4 = l.pos >> (4 * k.lvl + 4) GROUP BY l.tree, l.pos, k.lvl
    UNION ALL SELECT l.tree, l.pos, s.deep + k.lvl, string_agg(u.d, '' ORDER BY u.pos) FILTER (WHERE u.pos < s.pos >> (4 * k.lvl)),
        string_agg(u.d, '' ORDER BY u.pos) FILTER (WHERE u.pos > s.pos >> (4 * k.lvl))
    FROM leaves l JOIN subs s ON s.tree = l.tree JOIN (SELECT DISTINCT lvl FROM top WHERE n > 1) k ON true
    JOIN top u ON u.lvl = k.lvl AND u.pos >> 4 = s.pos >> (4 * k.lvl + 4) GROUP BY l.tree, l.pos, s.deep, k.lvl),
fold AS (SELECT tree, pos, 0 AS step, coalesce(claimed, leaf) AS d FROM leaves
    UNION ALL SELECT o.tree, o.pos, o.step + 1, sha256(coalesce(s.a, '') || o.d || coalesce(s.z, ''))
    FROM fold o JOIN steps s ON s.tree = o.tree AND s.pos = o.pos AND s.step = o.step),
proof AS (SELECT l.tree, l.pos, sha256(coalesce(string_agg(coalesce(s.a, '') || coalesce(s.z, ''), '' ORDER BY s.step), '')) AS p
    FROM leaves l LEFT JOIN steps s ON s.tree = l.tree AND s.pos = l.pos GROUP BY l.tree, l.pos),
folded AS (SELECT tree, pos, arg_max(d, step) AS d FROM fold GROUP BY tree, pos)
SELECT l.doc_id, l.leaf, s.d AS subroot, r.d AS root, p.p AS proof_sha256, o.d AS folded_root, o.d = r.d AS verified
FROM leaves l JOIN subs s ON s.tree = l.tree JOIN (SELECT d FROM top WHERE n = 1) r ON true
JOIN proof p ON p.tree = l.tree AND p.pos = l.pos JOIN folded o ON o.tree = l.tree AND o.pos = l.pos
"""


@_query("op13_merkle_manifest", _MERKLE_SQL)
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaves, roots and folded proofs of every document; a fifth of the texts is tampered with."""
    from kelpie.llm.merkle import Manifest

    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.translate("text", upper, lower))
    return Manifest(read_table(spark, sf_dir, "documents"), tampered).prove()


@_query("op12_bpe_transducer")
def op12_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded by the streaming transducer and decoded again."""
    from kelpie.llm.bpe import round_trip
    from kelpie.llm.tokenizing import public_path

    return round_trip(read_table(spark, sf_dir, "documents"), public_path("byte_bpe_50k.json"))
