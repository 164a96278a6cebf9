"""File sources and sinks: sensor CSV, labelled CSV, API JSON records, run
exports (S18-S20, S22).  Declared schemas, no inference on the hot path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Sensor CSV header (index, date, five measures, label).
SENSOR_HEADER = ["index", "date", "Temperature", "Humidity", "Light", "CO2", "HumidityRatio", "Occupancy"]

SENSOR_SCHEMA = T.StructType([
    T.StructField("index", T.LongType()), T.StructField("date", T.StringType()),
    *[T.StructField(c, T.DoubleType()) for c in SENSOR_HEADER[2:7]],
    T.StructField("Occupancy", T.IntegerType())])


def read_sensor_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV; columns 2-6 become float32 features, column 7 the label."""
    df = spark.read.schema(SENSOR_SCHEMA).option("header", True).csv(path)
    return df.select("index", "date",
                     F.array(*[F.col(c).cast("float") for c in SENSOR_HEADER[2:7]]).alias("features"),
                     F.col("Occupancy").cast("float").alias("label"))


def write_sensor_csv(df: DataFrame, path: str) -> None:
    """S18 write-back with the 8-column header."""
    df.select(*SENSOR_HEADER).write.mode("overwrite").option("header", True).csv(path)


def read_labelled_csv(spark: SparkSession, path: str, target: str, schema: T.StructType | None = None) -> DataFrame:
    """One target column, every other numeric column a feature (in file order)."""
    r = spark.read.option("header", True)
    r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
    df = r.csv(path)
    feats = [f.name for f in df.schema.fields if f.name != target and isinstance(f.dataType, T.NumericType)]
    return df.select(*df.columns, F.array(*[F.col(c).cast("double") for c in feats]).alias("features"))


PARKING_SCHEMA = "result struct<records: array<struct<poiID: long, time: string>>>"


def parking_features(df: DataFrame, payload: str = "payload") -> DataFrame:
    """API JSON ``result.records[]`` -> [poiID, day, month, year, hour, minute] int64;
    a ``'None'`` time means now."""
    recs = df.select("*", F.explode(F.from_json(F.col(payload), PARKING_SCHEMA)["result"]["records"]).alias("r"))
    ts = F.when(F.col("r.time") == "None", F.current_timestamp()).otherwise(F.to_timestamp("r.time"))
    return recs.withColumn("_t", ts).withColumn("features", F.array(
        F.col("r.poiID").cast("long"), F.dayofmonth("_t").cast("long"), F.month("_t").cast("long"),
        F.year("_t").cast("long"), F.hour("_t").cast("long"), F.minute("_t").cast("long"))).drop("r", "_t")


def export_run(df: DataFrame, path: str) -> None:
    """Run results (ids, times, per-round metrics, series) as JSON lines."""
    df.write.mode("overwrite").json(path)
