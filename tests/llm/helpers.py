"""Small documents tables with every awkward case, and plain versions of shared rules."""

import random
import re

from pyspark.sql import types as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])

SYLLABLES = "an the on tion er re in th at en ed is it or es st nt ti to and of ha ou ea ng as was".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    words = ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 3))) for _ in range(n)]
    out = []
    for i, w in enumerate(words):
        out.append(w + (rng.choice([".\n", ", ", ". "]) if i % 9 == 8 else " "))
    return "".join(out).strip()


def awkward() -> list[tuple]:
    """doc_id, text, lang, source: nulls, empty and very long texts, ties, repeated rows, odd characters."""
    rows = [(i, prose(i, 30 + 7 * (i % 23)), ("en", "de", "fr")[i % 3], f"s{i % 4}") for i in range(40)]
    rows += [(100 + i, prose(3, 120), "en", "s0") for i in range(30)]                   # copies
    rows += [(200 + i, prose(3, 120) + f" end{i}", "en", "s0") for i in range(10)]      # near copies
    rows += [(300, None, "en", "s1"), (301, "", "en", "s1"), (302, " \n\t ", None, None), (303, "word", None, None),
             (304, prose(9, 20_000), "en", "s2"), (305, "ÄÖÜ ß́ 　 é\x1cx Ⅷ 🙂 Ａ", "de", "s3"),
             (306, "a b c d e f g h " * 12, "fr", None), (307, "tok" * 5000, "fr", "s3"),
             (None, prose(5, 50), "en", "s1"), (None, None, None, None), (None, prose(6, 50), "en", "s1")]
    rows += [(400, prose(400, 80), "en", "s2")] * 5                                     # repeated rows
    rows += [(401, prose(401, 40), "en", "s2"), (401, prose(402, 45), "en", "s2")]      # one id, two texts
    return rows


def documents(spark, rows=None):
    rows = awkward() if rows is None else rows
    return spark.createDataFrame([(d, t, l, s, None if t is None else len(t)) for d, t, l, s in rows], DOCS)


def clashing(df):
    """The same rows with extra columns whose names operators use themselves."""
    from pyspark.sql import functions as F
    return df.select(F.lit("x").alias("TEXT"), F.lit(0).alias("Doc_Id"), "*", *[F.lit(i).alias(n) for i, n in enumerate(
        ("shard", "slot", "Slot_", "size", "lane", "ord", "words", "block", "s", "n", "h", "fp", "k1", "component_id", "label",
         "sequence_id", "offset", "bucket", "kept", "epoch", "at", "spans", "rep", "root", "c1"))])
