"""Registry joins (J01-J13): dataset-model matching, expansions, chains,
lookups, semi/anti joins and positional truth joins.

Matching is an equi-join on (shape, canonical restriction JSON) plus a
residual predicate — never a models × datasources cross product.  Small
lookup sides are left to AQE, which broadcasts them after measuring.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kelpie.operators.sequence import PART, laid_by_range, range_position, range_running_sum
from kelpie.session import scratch_path


def canonical_json(col: Column | str) -> Column:
    """Key-order independent JSON text (variant objects keep keys sorted)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.to_json(F.try_parse_json(c))


def effective_shape(shape: Column | str, distributed: Column | str) -> Column:
    """Distributed models drop the last dimension when the shape has more than two."""
    s = F.col(shape) if isinstance(shape, str) else shape
    d = F.col(distributed) if isinstance(distributed, str) else distributed
    parts = F.split(F.trim(s), " ")
    return F.when(d & (F.size(parts) > 2), F.array_join(F.slice(parts, 1, F.size(parts) - 1), " ")).otherwise(s)


def has_blockchain(blockchain: Column | str) -> Column:
    """A model uses the ledger when its blockchain settings are a non-empty JSON object."""
    b = F.col(blockchain) if isinstance(blockchain, str) else blockchain
    return F.when(b == "{}", False).otherwise(F.coalesce(canonical_json(b) != F.lit("{}"), F.lit(False)))     # most need no parsing


def training_case(ds_incremental: Column, distributed: Column, has_chain: Column) -> Column:
    """Device case 1-5 from the flags (``has_chain`` from :func:`has_blockchain`)."""
    return (F.when(~distributed & ~ds_incremental & ~has_chain, 1)
             .when(~distributed & ~ds_incremental, 5)
             .when(~distributed, 2)
             .when(~ds_incremental, 3)
             .otherwise(4))


def server_case(distributed: Column, incremental: Column, federated: Column, blockchain: Column) -> Column:
    """Server case 1-9 of a deployment's model.  1-4 are the plain ones, 5-8 their federated forms, 9 the
    single federated one on a ledger; the ledger has no incremental or distributed form.  A flag
    that is null counts as not set."""
    d, i, f, b = (F.coalesce(c, F.lit(False)) for c in (distributed, incremental, federated, blockchain))
    plain = F.when(~d & ~i, 1).when(~d, 2).when(~i, 3).otherwise(4)
    return F.when(~f, plain).when(b & ~d & ~i, 9).otherwise(plain + 4)


def match(datasources: DataFrame, models: DataFrame) -> DataFrame:
    """J01 + J02: compatible (datasource, model) pairs with their training case.

    datasources: ds_id, data_reshape, restrictions, total_msg, incremental, federated_string_id
    models:      model_id, input_shape, data_restriction, min_data, distributed, blockchain, federated_string_id
    A datasource with a federated id matches only models with the same id
    (no shape, restriction or size test); the others need equal shape and
    restriction, and cases 1, 3 and 5 also ``total_msg >= min_data``.
    """
    return match_pairs(datasources, models)


def _sides(datasources: DataFrame, models: DataFrame, ds_more: Sequence[str] = (), m_more: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Both sides of the match with the columns it compares, and the texts they come from."""
    ds = datasources.select(
        *ds_more, "ds_id", "data_reshape", "total_msg", "incremental",
        F.col("federated_string_id").alias("ds_fed"),
        "restrictions", canonical_json("restrictions").alias("_ds_restr"))
    ms = models.select(
        *m_more, "model_id", "min_data", "distributed", "input_shape", "data_restriction", has_blockchain("blockchain").alias("_chain"),
        F.col("federated_string_id").alias("m_fed"),
        effective_shape("input_shape", "distributed").alias("_shape"),
        canonical_json("data_restriction").alias("_restr"))
    return ds, ms


def _has_id(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit("")) != ""


TILE = 1024         # rows of a tile's side
_HELD = 1 << 20     # rows of a stream's partition that are put in lists at once


def _in_tiles(side: DataFrame, by: list[str], row: list[str], name: str) -> DataFrame:
    """The columns ``row`` of each group ``by`` in lists ``_name`` of about :data:`TILE`, with the list's number
    ``_name_no``."""
    of = side.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) / TILE).alias("_of"))
    on = F.lit(True)
    for c in by:
        on = on & F.col(f"s.{c}").eqNullSafe(F.col(f"o.{c}"))
    return side.alias("s").join(of.alias("o"), on).select("s.*", "_of") \
        .groupBy(*by, F.pmod(F.xxhash64(*row), "_of").alias(f"_{name}_no")).agg(F.collect_list(F.struct(*row)).alias(f"_{name}"))


def _in_lists(side: DataFrame, by: list[str], row: list[str], name: str) -> DataFrame:
    """:func:`_in_tiles` for a stream, without state: each partition of a micro-batch makes lists of its own rows, of
    :data:`TILE` at most."""
    side, tile, held = side.select(*by, *row), TILE, _HELD
    kinds = {f.name: f for f in side.schema.fields}
    schema = T.StructType([*[kinds[c] for c in by], T.StructField(f"_{name}", T.ArrayType(T.StructType([kinds[c] for c in row])))])

    def lists(batches):
        import numpy as np
        import pyarrow as pa
        rows = pa.Table.from_batches(batches)
        groups = rows.group_by(by, use_threads=False).aggregate([(c, "list") for c in row]).combine_chunks()
        ends = groups[f"{row[0]}_list"].chunk(0).offsets.to_numpy().astype(np.int64)
        parts = -(-np.diff(ends) // tile)
        group = np.repeat(np.arange(len(parts)), parts)
        within = np.arange(len(group)) - np.repeat(np.cumsum(parts) - parts, parts)
        cuts = pa.array(np.append(ends[group] + within * tile, ends[-1]), pa.int32())
        values = pa.StructArray.from_arrays([groups[f"{c}_list"].chunk(0).values for c in row], fields=[rows.schema.field(c) for c in row])
        keys = groups.select(by).take(group).combine_chunks()
        return pa.RecordBatch.from_arrays([*[keys[c].chunk(0) for c in by], pa.ListArray.from_arrays(cuts, values)], names=[*by, f"_{name}"])

    def pack(batches):
        some, n = [], 0
        for b in batches:
            if b.num_rows:
                some.append(b)
                n += b.num_rows
            if n >= held:
                yield lists(some)
                some, n = [], 0
        if n:
            yield lists(some)

    return side.mapInArrow(pack, schema).withColumn(f"_{name}_no", F.xxhash64(F.col(f"_{name}")[0]))


def _tiles(ds: DataFrame, ms: DataFrame) -> DataFrame:
    """``case``, ``by_federated_id``, ``_ds``, ``_m``: lists of data sources with the lists of models that they meet.
    Few ids or shapes hold many rows on both sides, so a join of the rows would leave as many tasks as keys; tiles
    are dealt evenly, to a stated number of partitions, as their bytes say nothing of their pairs."""
    lists, flags = _in_lists if ds.isStreaming or ms.isStreaming else _in_tiles, ["distributed", "_chain"]
    ds_row, m_row = ["total_msg", "ds_id"], ["min_data", "model_id"]
    case = training_case(F.col("incremental"), F.col("distributed"), F.col("_chain"))

    def met(sources, takers, key, by_id):
        return sources.join(takers, key).select(case.alias("case"), F.lit(by_id).alias("by_federated_id"), "_ds", "_m",
                                                F.xxhash64(*key, case, "_ds_no", "_m_no").alias("_to"))

    named = lists(ds.where(_has_id("ds_fed")), ["ds_fed", "incremental"], ds_row, "ds").withColumnRenamed("ds_fed", "_fed")
    asked = lists(ms.where(_has_id("m_fed")), ["m_fed", *flags], m_row, "m").withColumnRenamed("m_fed", "_fed")
    # lists of equal texts: a text is parsed once a list.  A bad or missing one stands as a word that equals no
    # JSON; with null in its place Spark would test, and so parse, the text of every row
    free = lists(ds.where(~_has_id("ds_fed")), ["data_reshape", "restrictions", "incremental"], ds_row, "ds") \
        .withColumns({"_shape": F.col("data_reshape"), "_restr": F.coalesce(canonical_json("restrictions"), F.lit("ds"))})
    able = lists(ms, ["input_shape", "data_restriction", *flags], m_row, "m") \
        .withColumns({"_shape": effective_shape("input_shape", "distributed"), "_restr": F.coalesce(canonical_json("data_restriction"), F.lit("model"))})
    return met(named, asked, ["_fed"], True).unionByName(met(free, able, ["_shape", "_restr"], False)) \
        .repartition(int(ds.sparkSession.conf.get("spark.sql.shuffle.partitions")), "_to")


def match_pairs(datasources: DataFrame, models: DataFrame, near: Column | None = None, ds_more: Sequence[str] = (),
                m_more: Sequence[str] = ()) -> DataFrame:
    """:func:`match` for frames or streams; ``near`` is a further condition, over the columns ``ds_more`` and ``m_more``."""
    ds, ms = _sides(datasources, models, ds_more, m_more)
    if near is None:
        # compiled into one loop, two explodes would hold all pairs of a tile before handing one out; a lambda is
        # not compiled, so it keeps them apart
        pairs = _tiles(ds, ms).select("case", "by_federated_id", F.explode(F.transform("_ds", lambda d: d)).alias("_d"), "_m") \
            .select("case", "by_federated_id", "_d", F.explode("_m").alias("_m")).select("case", "by_federated_id", "_d.*", "_m.*")
    else:
        by_id = ds.drop("_ds_restr").where(_has_id("ds_fed")).join(
            ms.drop("_restr", "_shape").where(_has_id("m_fed")), (F.col("ds_fed") == F.col("m_fed")) & near).withColumn("by_federated_id", F.lit(True))
        by_shape = ds.where(~_has_id("ds_fed")).join(
            ms, (F.col("data_reshape") == F.col("_shape")) & (F.col("_ds_restr") == F.col("_restr")) & near).withColumn("by_federated_id", F.lit(False))
        compared = ["ds_id", "total_msg", "model_id", "min_data", "by_federated_id",
                    training_case(F.col("incremental"), F.col("distributed"), F.col("_chain")).alias("case")]
        pairs = by_id.select(*compared).unionByName(by_shape.select(*compared))
    return pairs.where(F.col("by_federated_id") | F.col("case").isin(2, 4) | (F.col("total_msg") >= F.col("min_data"))) \
        .select("ds_id", "model_id", "case", "by_federated_id")


_TOP = (1 << 63) - 1


def match_counts(datasources: DataFrame, models: DataFrame) -> DataFrame:
    """J01 + J02 without the pairs: (ds_id, case, n), how many models each data source matches.

    Models and data sources fall into classes of equal shape, restriction and flags.  In a class a data
    source matches the models whose ``min_data`` is at most its ``total_msg``: their number is a running
    sum over the distinct sizes of both sides, in range partitions.  So a class that holds a third
    of both sides costs its members, not their product."""
    ds, ms = _sides(datasources, models)
    flags = ["distributed", "_chain"]
    case = training_case(F.col("incremental"), F.col("distributed"), F.col("_chain"))
    ids = ms.where(_has_id("m_fed")).groupBy("m_fed", *flags).agg(F.count(F.lit(1)).alias("n"))
    by_id = ds.where(_has_id("ds_fed")).join(ids, F.col("ds_fed") == F.col("m_fed")).select("ds_id", case.alias("case"), "n")

    # an incremental data source has no size test: it stands above all sizes, as does a model without a size
    cls = ["shape", "restr", *flags]
    sizes = ms.select(F.col("_shape").alias("shape"), F.col("_restr").alias("restr"), *flags,
                      F.coalesce(F.col("min_data"), F.lit(_TOP)).cast("long").alias("size")) \
        .groupBy(*cls, "size").agg(F.count(F.lit(1)).alias("models")).withColumn("asks", F.lit(0))
    both = F.explode(F.array(*[F.struct(F.lit(d).alias("distributed"), F.lit(c).alias("_chain")) for d in (False, True) for c in (False, True)]))
    members = ds.where(~_has_id("ds_fed")).select(
        "ds_id", "incremental", F.col("data_reshape").alias("shape"), F.col("_ds_restr").alias("restr"),
        F.when(F.col("incremental"), F.lit(_TOP)).when(F.col("total_msg").isNotNull(), F.least("total_msg", F.lit(_TOP - 1)))
        .cast("long").alias("size"),
        both.alias("f")).select("ds_id", "incremental", "shape", "restr", "f.*", "size").where("size IS NOT NULL")
    asked = members.select(*cls, "size").distinct().select(*cls, "size", F.lit(0).cast("long").alias("models"), F.lit(1).alias("asks"))
    laid = laid_by_range(sizes.select(*cls, "size", "models", "asks").unionByName(asked), cls, ["size", "asks"])
    answers = range_running_sum(laid, cls, ["size", "asks"], "models", "n").where("asks = 1 AND n > 0").select(*cls, "size", "n")
    by_shape = members.join(answers, [*cls, "size"]).select("ds_id", case.alias("case"), "n")
    return by_id.unionByName(by_shape).groupBy("ds_id", "case").agg(F.sum("n").cast("long").alias("n"))


def match_new_models(datasources: DataFrame, models: DataFrame) -> DataFrame:
    """New models against stored, non-incremental datasources with a known size."""
    stored = datasources.where(~F.col("incremental") & F.col("total_msg").isNotNull())
    return match(stored, models)


def first_launch(matches: DataFrame, fed: str, order: list[str]) -> DataFrame:
    """One launch per federated id: the first match by ``order`` (min_by, no sort)."""
    rest = [c for c in matches.columns if c != fed]
    return matches.groupBy(fed).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r")) \
        .select(fed, *[F.col("_r")[c].alias(c) for c in rest])


def federated_models(models: DataFrame) -> DataFrame:
    """(fed, model_id): the first model of each federated id, its representative."""
    return models.where(F.coalesce(F.col("federated_string_id"), F.lit("")) != "") \
        .groupBy(F.col("federated_string_id").alias("fed")).agg(F.min("model_id").alias("model_id"))


def first_launch_by_id(datasources: DataFrame, models: DataFrame) -> DataFrame:
    """J05 without the pairs of an id: its first data source and its first model, each found by a partial
    aggregate before the join, so an id that a third of both sides share costs two rows."""
    first = datasources.where(F.coalesce(F.col("federated_string_id"), F.lit("")) != "") \
        .groupBy(F.col("federated_string_id").alias("fed")).agg(F.min("ds_id").alias("ds_id"))
    return first.join(federated_models(models), "fed").select("fed", "ds_id", "model_id")


def expand_results(deployments: DataFrame, config_models: DataFrame, config: str) -> DataFrame:
    """One result row (status ``created``) per model of the deployment's configuration."""
    return deployments.join(config_models, config).withColumn("status", F.lit("created"))


def model_chain(spark: SparkSession, models: DataFrame, roots: DataFrame, key: str = "model_id",
                parent: str = "father_id") -> DataFrame:
    """Roots plus all their descendants, with the depth at which they are first met.

    Level by level: the frontier is joined to its children, and what a root has
    met before is left out, so a cycle ends and no depth or row limit applies.
    Each level is one step of the chain, written to the shared folder."""
    links = models.select(F.col(key).alias("id"), F.col(parent).alias("parent")) \
        .where("id IS NOT NULL AND parent IS NOT NULL")
    path = scratch_path(spark, f"chain-{uuid.uuid4().hex}")
    level = roots.select(F.col(key).alias("root"), F.col(key).alias("id"))
    schema, depth = level.schema, 0
    level = level.where("root IS NOT NULL").distinct()
    while True:
        # stored levels have known sizes, so small ones are broadcast
        level.write.parquet(f"{path}/depth={depth}")
        frontier = spark.read.schema(schema).parquet(f"{path}/depth={depth}")
        if frontier.isEmpty():
            break
        met = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path)
        level = frontier.withColumnRenamed("id", "parent").join(links, "parent").select("root", "id").distinct() \
            .join(met.select("root", "id"), ["root", "id"], "left_anti")
        depth += 1
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("depth", T.IntegerType())])) \
        .option("basePath", path).parquet(path).select("root", F.col("id").alias("model_id"), "depth")


def nested_view(parent: DataFrame, child: DataFrame, key: str, sort_key: str) -> DataFrame:
    """Parent rows with their children in ``sort_key`` order, long form:
    one row per child with its index and the child count (a parent without
    children keeps one row with null child columns).  Rendering the nested
    list is left to the presentation layer, so a parent with millions of
    children never becomes one row."""
    from kelpie.operators.sequence import dense_position
    kids = dense_position(child, key, sort_key, name="child_idx", with_total=True) \
        .withColumnRenamed("child_idx_total", "n_children")
    return parent.join(kids, key, "left").withColumn("n_children", F.coalesce(F.col("n_children"), F.lit(0)))


def suggest_input(results: DataFrame, inferences: DataFrame, datasources: DataFrame, key: str) -> DataFrame:
    """Input format/config: existing inference config, else the latest
    datasource of the deployment, else blank."""
    inf = inferences.select(key, F.col("input_format").alias("_if"), F.col("input_config").alias("_ic"))
    ds = datasources.select(key, F.col("input_format").alias("_df"), F.col("input_config").alias("_dc"))
    j = results.join(inf, key, "left").join(ds, key, "left")
    return j.select(*results.columns,
                    F.coalesce("_if", "_df", F.lit("")).alias("input_format"),
                    F.coalesce("_ic", "_dc", F.lit("")).alias("input_config"))


def _named(rows: DataFrame, key: str) -> DataFrame:
    """The keys that ``rows`` name, each once: many rows name one key, and a join would sort them all."""
    return rows.select(key).distinct()


def deletable(models: DataFrame, config_models: DataFrame, key: str) -> DataFrame:
    """Models in no configuration (anti join); :func:`in_use` is the semi join."""
    return models.join(_named(config_models, key), key, "left_anti")


def in_use(models: DataFrame, config_models: DataFrame, key: str) -> DataFrame:
    return models.join(_named(config_models, key), key, "left_semi")


def remaining(unlabelled: DataFrame, taken: DataFrame, key: str) -> DataFrame:
    """Pseudo-labelled rows leave the pool."""
    return unlabelled.join(_named(taken, key), key, "left_anti")


def weight_map(weights: dict) -> dict[int, float] | None:
    """J12 parameter check: keys cast to int, bad entries dropped, none valid -> None."""
    out = {}
    for k, v in (weights or {}).items():
        try:
            out[int(k)] = float(v)
        except (TypeError, ValueError):
            continue
    return out or None


def with_sample_weight(df: DataFrame, weights: dict | None, label: str = "label", out: str = "weight") -> DataFrame:
    """Per-row weight from the class-weight map (default 1.0); one-hot labels
    use their argmax.  A map literal keeps the lookup inside codegen."""
    w = weight_map(weights) if weights is not None else None
    if w is None:
        return df.withColumn(out, F.lit(1.0))
    m = F.create_map(*[x for k, v in sorted(w.items()) for x in (F.lit(k), F.lit(v))])
    lab = F.col(label)
    from pyspark.sql.types import ArrayType
    if isinstance(df.schema[label].dataType, ArrayType):
        lab = F.array_position(lab, F.array_max(lab)) - 1
    return df.withColumn(out, F.coalesce(F.element_at(m, lab.cast("int")), F.lit(1.0)))


def attach_truth(pred: DataFrame, truth: DataFrame, key: str = "sample_id") -> DataFrame:
    """The prediction of sample i meets the truth of sample i through the
    carried sample id (an equi-join, not a global row number)."""
    return pred.join(truth, key)


def attach_truth_by_position(pred: DataFrame, truth: DataFrame, pred_order: Sequence[str], truth_order: Sequence[str],
                             by: str | None = None) -> DataFrame:
    """J13 where records carry no sample id: the i-th prediction (of a topic ``by``) meets the i-th truth, in
    the order in which they were sent.  Positions come from range partitions, so any order will do and no
    side is ever one task; what has no partner on the other side is left out.  Adds ``index``, from 1."""
    keys = [] if by is None else [by]
    p = range_position(laid_by_range(pred, by, pred_order), by, pred_order, name="_pos").drop(PART)
    t = range_position(laid_by_range(truth, by, truth_order), by, truth_order, name="_pos").drop(PART)
    return p.join(t, [*keys, "_pos"]).withColumn("index", F.col("_pos") + 1).drop("_pos")
