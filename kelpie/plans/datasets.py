"""X03 dataset plug-in: a data set yields training, test and inference rows
as DataFrames and parses prediction records (the driver never sees rows)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kelpie.functions.features import parse_prediction
from kelpie.operators.splits import split_random
from kelpie.session import read_table


class Dataset:
    """Protocol: ``training()``, ``test()``, ``inference()``, ``parse(values)``."""

    kind = "softmax"

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def rows(self) -> DataFrame:
        raise NotImplementedError

    def _split(self) -> DataFrame:
        return split_random(self.rows(), "id", 0.0, 0.2, seed=13)

    def training(self) -> DataFrame:
        return self._split().where(F.col("split") == "train").drop("split")

    def test(self) -> DataFrame:
        return self._split().where(F.col("split") == "test").drop("split")

    def inference(self) -> DataFrame:
        return self.test().drop("label")

    def parse(self, values: str | Column = "values") -> tuple[Column, Column]:
        return parse_prediction(values, self.kind)


class EmbeddingsDataset(Dataset):
    """The image-like fixture: 64 floats, 10 classes."""

    def rows(self) -> DataFrame:
        em = read_table(self.spark, self.sf_dir, "embeddings")
        return em.select(F.col("vec_id").alias("id"), F.col("embedding").alias("features"), "label")


class SensorDataset(Dataset):
    """Occupancy-like fixture from lineitem: four measures, binary label."""

    kind = "sigmoid"

    def rows(self) -> DataFrame:
        li = read_table(self.spark, self.sf_dir, "lineitem")
        return li.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
                         F.array("l_quantity", "l_extendedprice", "l_discount", "l_tax").alias("features"),
                         (F.col("l_returnflag") == "R").cast("int").alias("label"))


DATASETS = {"embeddings": EmbeddingsDataset, "sensor": SensorDataset}
