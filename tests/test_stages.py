"""Stages resume by sample."""

import pytest
from pyspark.sql import functions as F

from junctura.sources.stages import Stages


def inputs(spark, names):
    return spark.createDataFrame([(s, i) for s in names for i in range(5)], "sample string, x int")


def test_later_runs_see_new_samples_only(spark, tmp_path):
    stages, seen = Stages(spark, f"file://{tmp_path}/s"), []

    def work(d):
        seen.append({r.sample for r in d.select("sample").distinct().collect()})
        return d.where("sample <> 'silent'").groupBy("sample").agg(F.sum("x").alias("n"))

    first = stages.run("count", inputs(spark, ["a", "b", "silent"]), work)
    assert {r.sample: r.n for r in first.collect()} == {"a": 10, "b": 10}
    files = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}
    second = stages.run("count", inputs(spark, ["a", "b", "silent", "c"]), work)
    assert {r.sample: r.n for r in second.collect()} == {"a": 10, "b": 10, "c": 10}
    # nothing old was touched, and what is new belongs to the new sample
    after = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}
    assert files.items() <= after.items()
    new = after.keys() - files.keys()
    assert {p.parent.name for p in new if "rows" in p.parts} == {"of=c"} and all("rows" in p.parts or "samples" in p.parts for p in new)
    assert seen == [{"a", "b", "silent"}, {"c"}]
    stages.run("count", inputs(spark, ["a", "c"]), work)
    assert len(seen) == 2 and len(stages.runs("count")) == 2
    assert {r.sample for r in stages.done("count").collect()} == {"a", "b", "c", "silent"}


def test_killed_runs_leave_nothing(spark, tmp_path):
    stages = Stages(spark, f"file://{tmp_path}/s")
    stages.run("count", inputs(spark, ["a"]), lambda d: d)

    def fails(d):
        # some partitions are written before one fails
        return d.withColumn("x", F.when((F.col("sample") == "c") & (F.col("x") == 4), F.raise_error(F.lit("lost")).cast("int")).otherwise(F.col("x")))

    with pytest.raises(Exception, match="lost"):
        stages.run("count", inputs(spark, ["a", "b", "c"]), fails)
    killed = stages._commit
    stages._commit = lambda *a: (_ for _ in ()).throw(KeyboardInterrupt)  # killed between the rows and the mark
    with pytest.raises(KeyboardInterrupt):
        stages.run("count", inputs(spark, ["b"]), lambda d: d)
    stages._commit = killed
    assert {r.sample for r in stages.result("count").collect()} == {"a"} and stages.done("count").count() == 1
    assert stages.clean("count") == 2
    stages.run("count", inputs(spark, ["a", "b", "c"]), lambda d: d)
    assert stages.result("count").groupBy("sample").count().where("count = 5").count() == 3


def test_samples_without_name_and_empty_inputs(spark, tmp_path):
    stages = Stages(spark, f"file://{tmp_path}/s")
    with pytest.raises(ValueError, match="no run"):
        stages.result("count")
    assert stages.run("count", inputs(spark, []), lambda d: d).collect() == []
    assert stages.run("count", inputs(spark, [None, "z"]), lambda d: d).select("sample").distinct().collect() == [("z",)]
