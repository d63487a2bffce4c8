"""Session helpers: the confs the engine relies on, and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Confs whose values change results (not just speed).
SEMANTIC_CONF = {
    # JSON.parse keeps the last of duplicate keys; Spark rejects them by default.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Zone-less dates are read as UTC; timestamps are compared in UTC.
    "spark.sql.session.timeZone": "UTC",
}


def ensure_conf(spark: SparkSession) -> SparkSession:
    for k, v in SEMANTIC_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def build_session(master: str | None = None, app: str = "innkeeper",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """Local/test session. On a cluster, use the cluster's session and call ensure_conf."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (b.config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.driver.memory", "16g"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in SEMANTIC_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return ensure_conf(spark)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir.

    On a cluster it must be set (a shared filesystem / object store): a folder of the
    driver's machine would not be seen by executors, so a missing setting is an error
    there. Only a local master gets a fresh local folder (tests, local runs).
    """
    d = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="innkeeper-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under the shared folder and read back: later uses share one evaluation."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
