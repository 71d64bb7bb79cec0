"""Runs become visible by their manifest only; the newest is read from its own files."""

import json

from pyspark.sql import functions as F

from regionledger.sources import writers


def test_manifest_publishes_a_run(spark, tmp_path):
    path = str(tmp_path / "runs")
    df = spark.range(100).withColumn("v", F.col("id") % 7)
    writers.append_run(df, path, "a")
    writers.append_run(df.where("id < 10"), path, "b")
    published = writers.manifests(spark, path)
    assert [m["run_id"] for m in published] == ["a", "b"] and [m["rows"] for m in published] == [100, 10]
    newest = writers.latest_run(spark, path)
    assert newest.count() == 10 and {r.run_id for r in newest.select("run_id").distinct().collect()} == {"b"}
    # Only the newest run's files are read.
    assert newest.inputFiles() and all(f"run={published[-1]['run']}/" in f for f in newest.inputFiles())
    assert writers.runs(spark, path).count() == 110


def test_digest_does_not_depend_on_partitioning(spark, tmp_path):
    df = spark.range(1000).withColumn("v", F.col("id") * 3)
    writers.append_run(df.repartition(1), str(tmp_path / "one"), "x")
    writers.append_run(df.repartition(13), str(tmp_path / "many"), "x")
    one, many = writers.manifests(spark, str(tmp_path / "one"))[0], writers.manifests(spark, str(tmp_path / "many"))[0]
    assert one["digest"] == many["digest"] and one["rows"] == many["rows"] == 1000


def test_a_run_without_manifest_is_never_seen(spark, tmp_path):
    path = str(tmp_path / "runs")
    writers.append_run(spark.range(5), path, "old")
    # A newer run whose write stopped before its manifest: files, no manifest.
    spark.range(50).withColumns({"run_ts": F.current_timestamp(), "run_id": F.lit("zzz")}).write.parquet(f"{path}/run=99991231T000000000000Z_zzz")
    assert writers.latest_run(spark, path).count() == 5
    assert writers.runs(spark, path).count() == 5
    assert json.loads((tmp_path / "runs" / "_manifests").iterdir().__next__().read_text())["rows"] == 5
