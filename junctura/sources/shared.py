"""The folder that the whole cluster shares, for files that a query writes and reads again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path in the folder of ``spark.checkpoint.dir``, or else the context's checkpoint folder; only a local session may have neither.

    What is written there is deleted when the driver's JVM ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = "file:///tmp/checkpoints"
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return path.toString()


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: its plan is run once, whatever reads it."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
