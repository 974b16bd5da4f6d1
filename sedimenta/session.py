"""Session settings the operators are designed for, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Adaptive execution picks join strategies from measured sizes, splits hot
#: partitions of lookup joins and merges small ones.  Everything else
#: (partition counts, memory) belongs to the cluster.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables that must outlive an executor.

    This is the cluster's ``spark.checkpoint.dir``.  Only a local-mode session
    without one (tests) gets a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="sedimenta-"))
    return context.getCheckpointDir().rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and read it back.

    Cuts lineage: a lost executor re-reads files instead of re-running a plan
    whose row placement is not repeatable.  Being columnar, later narrow reads
    cost only the columns they use.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
