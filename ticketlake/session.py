"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import types as T

# AQE splits skewed shuffle joins and merges small shuffle partitions at run time.
# Cleaning projects many columns; a generated method above 8000 bytes of bytecode is
# never compiled by the JVM, so such a stage is better run operator by operator.
RECOMMENDED_CONF = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the recommended settings to a session."""
    for key, value in RECOMMENDED_CONF.items():
        spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for written intermediates: the session's checkpoint folder.

    Only a local session without that setting falls back to a temporary folder;
    on a cluster a machine-local folder would be lost with its machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="ticketlake-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared scratch folder."""
    return f"{scratch_root(spark)}/ticketlake/{name}-{uuid.uuid4().hex}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder this package wrote, on whatever file system it is."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def read_rows(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Parquet rows of a folder, none if it is absent."""
    if exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def materialize(df: DataFrame, name: str, scratch: "Scratch | None" = None) -> DataFrame:
    """Write a frame below the shared scratch folder and read it back.

    Used where several jobs need the same rows, or where a value such as a
    partition number must not change when a lost executor's work is redone.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    if scratch is not None:
        scratch.paths.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_observed(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), **metrics: Column) -> dict[str, Any]:
    """Write a frame and return metrics of the rows that passed, counted by the write itself."""
    seen = Observation()
    observed = df.observe(seen, *[c.alias(name) for name, c in metrics.items()])
    observed.write.partitionBy(*partition_by).parquet(path)
    return seen.get


def materialize_observed(
    df: DataFrame, name: str, scratch: "Scratch", **metrics: Column
) -> tuple[DataFrame, dict[str, Any]]:
    """As ``materialize``, with metrics of the written rows."""
    path = scratch_path(df.sparkSession, name)
    scratch.paths.append(path)
    found = write_observed(df, path, **metrics)
    return df.sparkSession.read.schema(df.schema).parquet(path), found


class Scratch:
    """Written intermediates of one job, removed once the job has stored its results."""

    def __init__(self) -> None:
        self.paths: list[str] = []

    def clear(self, spark: SparkSession) -> None:
        while self.paths:
            remove_path(spark, self.paths.pop())
