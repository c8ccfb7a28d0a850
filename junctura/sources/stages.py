"""Stages that resume by sample: what is finished is recorded, and a later run works on the other samples alone.

A stage's folder has, for each run, a folder with the result by sample, one with the list of the run's samples, and a mark that is put in its place, whole and once only, when both are
complete; it holds the result's schema.  Readers list marks; a run without one, killed or failed, is as if it had never been, and its samples are worked on again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SAMPLE = "sample"


class Stages:
    """Finished results under ``folder``, in any file system that Spark knows."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.folder, *parts)))

    def _system(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def runs(self, stage: str) -> list[str]:
        """The finished runs of a stage, in no order that matters: no sample is in two."""
        at, system = self._path(stage, "marks"), self._system()
        return sorted(s.getPath().getName() for s in system.listStatus(at)) if system.exists(at) else []

    def done(self, stage: str) -> DataFrame:
        """(sample): those that the stage has finished, also without a row."""
        runs = self.runs(stage)
        at = [f"{self.folder}/{stage}/samples/{r}" for r in runs]
        return self.spark.read.schema(f"{SAMPLE} string").parquet(*at) if runs else self.spark.createDataFrame([], f"{SAMPLE} string")

    def result(self, stage: str) -> DataFrame:
        """All finished rows of a stage."""
        runs = self.runs(stage)
        if not runs:
            raise ValueError(f"no run of {stage} is finished")
        kept = [T.StructType.fromJson(json.loads(self.spark.read.text(self._path(stage, "marks", r).toString()).first()[0])) for r in runs]
        return reduce(DataFrame.unionByName, (self.spark.read.schema(s).parquet(f"{self.folder}/{stage}/rows/{r}").select(*s.names) for r, s in zip(runs, kept, strict=True)))

    def left(self, stage: str, inputs: DataFrame) -> DataFrame:
        """The rows of inputs (with a column sample) whose sample the stage has not finished; rows without sample are never finished and left out."""
        named = inputs.where(F.col(SAMPLE).isNotNull())
        done = self.done(stage).withColumnRenamed(SAMPLE, "__sample")
        return named.join(done, named[SAMPLE].cast("string") == done["__sample"], "left_anti")

    def run(self, stage: str, inputs: DataFrame, work: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """``work`` applied to the rows of samples that are left, and the stage's whole result.

        ``work`` gives rows with their sample; it sees whole samples, but not all of them, so nothing may depend on the number or content of others.
        """
        todo = self.left(stage, inputs)
        samples = todo.select(F.col(SAMPLE).cast("string").alias(SAMPLE)).distinct()
        # the list first: rows of a sample that comes in later belong to a later run
        name = uuid.uuid4().hex
        samples.write.parquet(f"{self.folder}/{stage}/samples/{name}")
        held = self.spark.read.schema(samples.schema).parquet(f"{self.folder}/{stage}/samples/{name}")
        if held.isEmpty() and self.runs(stage):
            self._system().delete(self._path(stage, "samples", name), True)
            return self.result(stage)
        mine = todo.join(held.withColumnRenamed(SAMPLE, "__sample"), todo[SAMPLE].cast("string") == F.col("__sample"), "left_semi")
        made = work(mine)
        made.withColumn("of", F.col(SAMPLE)).write.partitionBy("of").parquet(f"{self.folder}/{stage}/rows/{name}")
        self._commit(stage, name, made.schema.json())
        return self.result(stage)

    def _commit(self, stage: str, name: str, schema: str) -> None:
        draft, mark = self._path(stage, "drafts", name), self._path(stage, "marks", name)
        out = self._system().create(draft, False)
        out.write(bytearray(schema.encode()))
        out.close()
        self._system().mkdirs(mark.getParent())
        if not self._system().rename(draft, mark):
            raise RuntimeError(f"the mark of {stage} could not be made")

    def clean(self, stage: str) -> int:
        """Delete what unfinished runs left behind; only while none is going on.  Returns their number."""
        system, known, dead = self._system(), set(self.runs(stage)), set()
        for kind in ("samples", "rows", "drafts"):
            at = self._path(stage, kind)
            for s in system.listStatus(at) if system.exists(at) else []:
                if s.getPath().getName() not in known:
                    dead.add(s.getPath().getName())
                    system.delete(s.getPath(), True)
        return len(dead)
