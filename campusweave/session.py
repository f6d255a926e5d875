"""Session helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(app: str = "campusweave", cores: str = "8", **conf: str) -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.files.minPartitionNum", cores)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        # call-site capture doubles the time it takes to build long expressions
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names; a local one only where none is named.

    The local fallback is for single-machine sessions: on a cluster an executor
    could not read what another one wrote there, so it is refused.
    """
    named = spark.conf.get(CHECKPOINT_CONF, None)
    if named:
        return named
    if spark.conf.get("spark.master", "").split("[")[0] != "local":
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder every executor can reach")
    return tempfile.mkdtemp(prefix="campusweave-")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: made once, and there whichever executors are lost."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
