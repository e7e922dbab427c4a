"""Session defaults and durable intermediate tables."""

from __future__ import annotations

import functools
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
FEW_SPLITS = 8


def local_session(cores: int | str = "*", app: str = "codecorpus", memory: str = "8g") -> SparkSession:
    """A session for one machine (tests, bench). A cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


@functools.cache
def _local_root(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"codecorpus-{application}-")


def staging_root(spark: SparkSession) -> str:
    """The shared folder for staged tables: the cluster's checkpoint folder.

    Only a session whose driver and executors are one process gets a temporary
    folder, one for the session; elsewhere that folder would be lost with its
    machine, so a missing setting is an error.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if root:
        return root.rstrip("/")
    if re.fullmatch(r"local(\[[^]]*\])?", spark.conf.get("spark.master", "")):
        return _local_root(spark.sparkContext.applicationId)
    raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share")


class Staging:
    """Tables of one job, written below the shared folder and read back.

    A staged table cuts lineage and survives the loss of executors. ``put`` with
    a name used before overwrites that table, so a loop that alternates between
    two names keeps two copies at most.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.base = f"{staging_root(spark)}/staged/{uuid.uuid4().hex}"

    def put(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.base}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def remove(self) -> None:
        """Delete this job's tables, once nothing reads them any more."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.base)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def spread(scan: DataFrame, few: int = FEW_SPLITS) -> DataFrame:
    """A fresh scan of a handful of splits, over more cores.

    That is a table of about a gigabyte at most; every larger one is left as it
    is, however many cores there are: no shuffle.
    """
    cores = min(few, scan.sparkSession.sparkContext.defaultParallelism)
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)
