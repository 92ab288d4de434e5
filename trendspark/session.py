"""Session defaults and shared-storage materialisation."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def get_session(app: str = "trendspark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every operator assumes: UTC, AQE, skew handling."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Else every column expression looks up its caller's line, which takes longer than planning a query.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def c(name: str) -> Column:
    """Column by exact name; dots in the name are not field access."""
    return F.col("`" + name.replace("`", "``") + "`")


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``; an error without one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    root = spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/trendspark-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def durable(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` to shared storage once and read it back.

    Cuts lineage, survives executor loss, and gives the planner a true byte
    size, so a small table is broadcast and a large one is not.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
