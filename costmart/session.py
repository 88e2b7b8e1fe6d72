"""Session settings the operators rely on, and the shared folder for cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution does the run-time work the plans count on: joining small sides by broadcast
# once their size is measured, splitting skewed join partitions, balancing writes.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # Call-site capture doubles the number of driver round trips while a plan is put together.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "costmart", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only where none is named and all is one machine."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    known = spark.sparkContext.getCheckpointDir()
    if known:
        return known.rstrip("/")
    require_local(spark.sparkContext.master)
    root = tempfile.mkdtemp(prefix="costmart-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def require_local(master: str) -> None:
    """Executors on other machines can't see the driver's temporary folder, so a cluster must name one."""
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"set spark.checkpoint.dir to a folder that all executors share (master is {master})")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; never reused, so retries cannot read stale files."""
    return f"{shared_dir(spark)}/costmart/{name}-{uuid.uuid4().hex}"


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write a frame that several plans read as a parquet table in the shared folder.

    Later plans scan the stored columns instead of recomputing the inputs, and a lost executor costs
    a re-read, not a re-run.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    shared_dir(df.sparkSession)
    return df.checkpoint()
