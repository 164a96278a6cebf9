"""Minimum slice and serving queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from kelpie.functions.codecs import decode_raw
from kelpie.functions.features import argmax
from kelpie.operators.models import fit_centroids
from kelpie.operators.serve import score, with_tier
from kelpie.plans.fixtures import embeddings_log, header_value
from kelpie.plans.registry import register
from kelpie.session import cut_lineage, scratch_path
from kelpie.sources.topics import (control_record, control_records, read_topic, string_to_ranges, topic_ranges,
                                   write_topic)

INPUT_CONFIG = {"data_type": "float32", "label_type": "int32", "data_reshape": "64", "label_reshape": ""}

LIMIT = 0.14   # near the median confidence of this data: both tiers get rows
TEMPERATURE = 10.0

# DuckDB: nearest-centroid softmax scores over the raw embeddings.
_CENTROID_SCORES = """
WITH e AS (SELECT vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings),
c AS (SELECT label AS k, i, avg(CAST(x AS DOUBLE)) AS c FROM e GROUP BY label, i),
s AS (SELECT e.vec_id, any_value(e.label) AS label, c.k, 10.0 * sum(CAST(e.x AS DOUBLE) * c.c) AS z
      FROM e JOIN c ON e.i = c.i GROUP BY e.vec_id, c.k),
p AS (SELECT vec_id, label, k, exp(z - max(z) OVER (PARTITION BY vec_id)) AS ez FROM s),
q AS (SELECT vec_id, label, k, ez / sum(ez) OVER (PARTITION BY vec_id) AS p FROM p),
m AS (SELECT vec_id, label, k, p, max(p) OVER (PARTITION BY vec_id) AS mp FROM q),
scored AS (SELECT vec_id, any_value(label) AS label, min(k) FILTER (WHERE p = mp) AS pred, max(mp) AS conf
           FROM m GROUP BY vec_id)
"""


def published_topic(spark, sf_dir):
    """Publish ``embeddings`` once as a RAW topic table in the shared folder and
    read it back (publishing IS writing; it also cuts the lineage)."""
    path = scratch_path(spark, f"topics/embeddings-{uuid.uuid4().hex}")
    write_topic(embeddings_log(spark, sf_dir), path)
    return read_topic(spark, path)


def published_scores(spark, sf_dir):
    """embeddings → RAW topic → control row → range read → decode → centroid scores."""
    log = published_topic(spark, sf_dir)
    ranges = topic_ranges(log)
    control = control_record(ranges, deployment_id=1, input_format="RAW", input_config=INPUT_CONFIG)
    # the trainer reads exactly the records its control row announces
    announced = string_to_ranges(control.select("topic"), "topic").select("topic", "partition", "start", "end")
    slice_ = control_records(announced, log)
    dec = decode_raw(slice_, INPUT_CONFIG["data_type"], INPUT_CONFIG["data_reshape"],
                     INPUT_CONFIG["label_type"], INPUT_CONFIG["label_reshape"])
    dec = dec.select(header_value("sample_id").cast("long").alias("vec_id"), "features", "label")
    dec = cut_lineage(dec)      # read by the fit and by the scores; nothing stays in executor memory
    model = fit_centroids(dec, temperature=TEMPERATURE)
    return score(dec, model)


@register("t10_score", _CENTROID_SCORES + f"""
SELECT vec_id, label, pred, round(conf, 6) AS conf,
       CASE WHEN conf >= {LIMIT} THEN 'final' ELSE 'upper' END AS tier
FROM scored""")
def t10_score(spark, sf_dir):
    s = with_tier(published_scores(spark, sf_dir), LIMIT)
    return s.select("vec_id", F.col("label").cast("int").alias("label"), argmax("values").alias("pred"),
                    F.round(F.array_max("values"), 6).alias("conf"), "tier")


@register("t11_route", _CENTROID_SCORES + f"""
SELECT CASE WHEN conf >= {LIMIT} THEN 'final' ELSE 'upper' END AS tier, count(*) AS n,
       CAST(sum(CASE WHEN pred = label THEN 1 ELSE 0 END) AS BIGINT) AS correct
FROM scored GROUP BY 1""")
def t11_route(spark, sf_dir):
    s = with_tier(published_scores(spark, sf_dir), LIMIT)
    return s.groupBy("tier").agg(F.count(F.lit(1)).alias("n"),
                                 F.sum((argmax("values") == F.col("label")).cast("long")).alias("correct"))
