"""Tables that cut lineage, written to the folder that the whole cluster shares.

The folder is the one the session names in ``spark.checkpoint.dir``; only where none is set and the session is local (tests, a laptop) a
default is chosen.  Everything is written and read by Spark, so the folder may be in any file system Spark knows.
"""

from __future__ import annotations

import re
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULT_DIR = "file:///tmp/checkpoints"
#: While an intermediate table is written: shuffle files go as soon as the write ends, so that peaks don't add up, and Arrow batches are
#: small, since both the JVM and the Python worker hold one outside the heap.
_WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}


def shared_dir(spark: SparkSession) -> str:
    """The shared folder's URI, with its scheme: ``spark.checkpoint.dir``, or else the context's checkpoint folder.

    Only a local session may have neither; it gets a default.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        named = DEFAULT_DIR
    path = spark._jvm.org.apache.hadoop.fs.Path(named)
    whole = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString().rstrip("/")
    return re.sub("^file:/+", "file:///", whole)


_lock, _within, _before = threading.Lock(), {}, {}


@contextmanager
def writing(spark: SparkSession):
    """Settings for the write of an intermediate table; put back when the last of the session's concurrent writes ends."""
    key = spark._jsparkSession.sessionUUID()
    with _lock:
        if not _within.get(key):
            _before[key] = {k: spark.conf.get(k, None) for k in _WRITING}
            for k, v in _WRITING.items():
                spark.conf.set(k, v)
        _within[key] = _within.get(key, 0) + 1
    try:
        yield
    finally:
        with _lock:
            _within[key] -= 1
            if not _within[key]:
                for k, v in _before.pop(key).items():
                    spark.conf.unset(k) if v is None else spark.conf.set(k, v)


class Scratch:
    """One operator run's folder of intermediate tables, deleted when the driver's JVM ends: results are read from it until then."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        path = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        system = path.getFileSystem(spark._jsc.hadoopConfiguration())
        system.mkdirs(path)
        system.deleteOnExit(path)

    def at(self, name: str) -> str:
        return f"{self.path}/{name}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Materialise ``df`` and return it as read back."""
        with writing(self.spark):
            df.write.mode("overwrite").option("compression", "zstd").parquet(self.at(name))
        return self.spark.read.schema(df.schema).parquet(self.at(name))

    def drop(self, *names: str) -> None:
        """Delete intermediate tables that no later step reads."""
        jvm = self.spark._jvm
        conf = self.spark._jsc.hadoopConfiguration()
        for name in names:
            p = jvm.org.apache.hadoop.fs.Path(self.at(name))
            p.getFileSystem(conf).delete(p, True)
