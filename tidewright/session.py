"""Session settings and the shared folder for written intermediate tables."""
from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A join whose left side has a hot key is split even when the split costs
    # another exchange further up.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def tune(spark: SparkSession) -> SparkSession:
    """Put the run-time settings the jobs count on into a session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder; on a local master without one, a folder of its own."""
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tidewright-"))
    return context.getCheckpointDir().rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table that several later jobs read, and read it back."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a written table that nothing reads any more."""
    context = spark.sparkContext
    where = context._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(context._jsc.hadoopConfiguration()).delete(where, True)
