"""Session settings the operators rely on, and the one place that cuts lineage."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution splits skewed join partitions, merges small shuffle partitions and turns a
# shuffled join into a broadcast one only after it has measured the side it would broadcast.
# No operator in this package hints a broadcast of a table whose size it has not bounded.
CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cpus: int | str = 8, partitions: int | None = None) -> SparkSession:
    """A local session for tests and benches; on a cluster use the session the cluster gives you."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("tenurelake")
    for key, value in CONF.items():
        builder = builder.config(key, value)
    spark = (
        builder.config("spark.sql.shuffle.partitions", str(partitions or cpus))
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the session's ``spark.checkpoint.dir``.

    Where it is unset, a folder set by ``setCheckpointDir`` is used. A session of one process that
    has neither gets a temporary folder; any other is refused, because files on one machine would be
    lost with it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not re.fullmatch(r"local(\[[^\[\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="tenurelake-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder, so later steps survive the loss of executors."""
    spark = df.sparkSession
    folder = shared_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint()
