"""Session helpers: one place for the conf a job expects."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def scale_conf(input_bytes: int, target_partition_bytes: int = 256 << 20, executors: int | None = None,
               cores_per_executor: int = 4) -> dict[str, str]:
    """Partition sizing for a cluster run: enough initial shuffle partitions that
    each holds about ``target_partition_bytes`` (AQE coalesces small ones and
    splits skewed ones), scan splits of the same size, and at least two waves
    of tasks per core.  For 100 TB this gives ~400k initial shuffle partitions."""
    parts = max(1, input_bytes // target_partition_bytes)
    if executors:
        parts = max(parts, 2 * executors * cores_per_executor)
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }


def _default_driver_memory() -> str:
    """Local mode runs everything in the driver JVM: give it about half the RAM
    (at most 16 GB, at least 2 GB)."""
    try:
        total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
    except (ValueError, OSError, AttributeError):
        return "4g"
    gb = max(2, min(16, int(total / 2 ** 30 * 0.5)))
    return f"{gb}g"


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "kelpie", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench; a cluster passes its own conf."""
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("KELPIE_DRIVER_MEMORY", _default_driver_memory())
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster must name a shared (HDFS/S3/...) folder there; in local mode (one
    machine) a private scratch folder is created when it is unset.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="kelpie-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists in its own file system."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_SHIPPED: set[int] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``kelpie`` importable in the Python workers (what ``--py-files``
    does for a submitted job): zip the installed package once per
    SparkContext and add it with ``addPyFile``; Spark distributes it."""
    import zipfile

    sc = spark.sparkContext
    key = id(sc._jsc)
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="kelpie-pyfiles-"), "kelpie.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.join("kelpie", os.path.relpath(full, pkg)))
    sc.addPyFile(out)
    _SHIPPED.add(key)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
