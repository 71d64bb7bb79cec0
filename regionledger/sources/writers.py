"""Sinks."""

from __future__ import annotations

import datetime
import functools
import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from regionledger.operators import quality
from regionledger.sources import scratch


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_years(df: DataFrame, path: str, keys: list[str]) -> None:
    """One directory per year; a repeated key stops the write.

    Only the years in ``df`` are replaced: a rerun of one year leaves the others. The rows
    are staged once; the key check and the write both read the staged copy
    instead of deriving the table twice.
    """
    staged = scratch.materialise(df)
    quality.fail_on_duplicates(staged, keys, "stacked output")
    staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year_num").parquet(path)


def replace_table(df: DataFrame, name: str, path: str | None = None) -> None:
    writer = df.write.mode("overwrite").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)


_MANIFESTS = "_manifests"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file written whole under a temporary name, then renamed into place."""
    fs, target = _fs(spark, path)
    tmp = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(tmp, False)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    if not fs.rename(tmp, target):
        fs.delete(tmp, False)
        raise OSError(f"could not publish {path}")


def _read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def append_run(df: DataFrame, path: str, run_id: str | None = None) -> str:
    """Append results as a run of their own, named by run time and id, and publish it.

    The rows go to ``path/run=<stamp>_<id>``; row count and an order-independent digest
    are observed in the same pass that writes them. Only then is a manifest written
    (``path/_manifests/<run>.json``: files, schema, rows, digest) by one rename, so a run
    whose write failed or is still going is never seen by `runs` or `latest_run`.
    """
    spark = df.sparkSession
    run_id = run_id or str(uuid.uuid4())
    now = datetime.datetime.now(datetime.timezone.utc)
    name = f"{now.strftime('%Y%m%dT%H%M%S%fZ')}_{run_id}"
    stamped = df.withColumns({"run_ts": F.lit(now), "run_id": F.lit(run_id)})
    seen = Observation(f"run_{uuid.uuid4().hex}")
    digest = F.sum(F.xxhash64(*[F.col(c) for c in stamped.columns if c not in ("run_ts", "run_id")] or [F.lit(0)]).cast("decimal(38,0)"))
    folder = f"{path.rstrip('/')}/run={name}"
    stamped.observe(seen, F.count(F.lit(1)).alias("rows"), F.coalesce(digest, F.lit(0).cast("decimal(38,0)")).alias("digest")).write.parquet(folder)
    fs, p = _fs(spark, folder)
    files = sorted(str(f.getPath().toString()) for f in fs.listStatus(p) if f.getPath().getName().endswith(".parquet"))
    metrics = seen.get
    manifest = {
        "run": name, "run_id": run_id, "run_ts": now.isoformat(), "files": files,
        "schema": stamped.schema.json(), "rows": int(metrics["rows"]), "digest": str(metrics["digest"]),
    }
    _write_text(spark, f"{path.rstrip('/')}/{_MANIFESTS}/{name}.json", json.dumps(manifest))
    return run_id


def manifests(spark: SparkSession, path: str) -> list[dict]:
    """Published runs of a result table, oldest first."""
    fs, p = _fs(spark, f"{path.rstrip('/')}/{_MANIFESTS}")
    if not fs.exists(p):
        return []
    names = sorted(str(f.getPath().toString()) for f in fs.listStatus(p) if f.getPath().getName().endswith(".json"))
    return [json.loads(_read_text(spark, n)) for n in names]


def _read(spark: SparkSession, manifest: dict) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(manifest["schema"]))
    if not manifest["files"]:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*manifest["files"])


def runs(spark: SparkSession, path: str) -> DataFrame:
    """Rows of every published run, read from exactly the files their manifests list."""
    found = [_read(spark, m) for m in manifests(spark, path)]
    return functools.reduce(DataFrame.unionByName, found) if found else spark.read.parquet(path)


def latest_run(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the newest published run of an appended result table.

    The newest manifest names the run (names sort by time; of one instant the larger id
    counts), and only the files it lists are read. Runs without a manifest are never seen.
    """
    published = manifests(spark, path)
    if not published:
        raise FileNotFoundError(f"no published run in {path}")
    return _read(spark, published[-1])


def publish_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def write_failures(failing: DataFrame, path: str) -> None:
    write_csv(failing, path)


def write_report(checks: DataFrame, path: str) -> None:
    """Machine-readable check report, one JSON object per check."""
    checks.write.mode("overwrite").json(path)
