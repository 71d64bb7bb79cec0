"""Shared working folder for tables a job writes and reads back."""

from __future__ import annotations

import contextlib
import functools
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_WAREHOUSE = "spark.sql.warehouse.dir"
#: Removes an execution's shuffle files when it ends; versions of Spark without it ignore it.
_RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@functools.cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="regionledger-")


def root(spark: SparkSession) -> str:
    """The folder all executors share.

    That is the cluster's checkpoint folder, or else a warehouse folder that was set. A
    session that runs in one process (a laptop, a test) may use a temporary folder; any
    other session without a shared folder is refused, since each executor would write to
    its own disk and the read back would miss rows without an error.
    """
    conf = spark.sparkContext.getConf()
    shared = spark.conf.get(_SETTING, None) or conf.get(_SETTING) or conf.get(_WAREHOUSE)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError(f"set {_SETTING} to a folder that driver and executors share")
    return _local_root()


def _own(spark: SparkSession) -> str:
    """This application's working folder: other jobs under the same root have their own."""
    return f"{root(spark)}/regionledger/{spark.sparkContext.applicationId}"


def folder(spark: SparkSession) -> str:
    """A fresh folder below this application's working folder."""
    return f"{_own(spark)}/{uuid.uuid4().hex}"


@contextlib.contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the executions inside go when these end, not when the driver next collects garbage."""
    before = spark.conf.get(_RELEASE, None)
    spark.conf.set(_RELEASE, "true")
    try:
        yield
    finally:
        spark.conf.unset(_RELEASE) if before is None else spark.conf.set(_RELEASE, before)


def materialise(df: DataFrame) -> DataFrame:
    """Write once as Parquet and continue from the files (cuts lineage, survives losses)."""
    spark = df.sparkSession
    path = folder(spark)
    with released(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def drop(*tables: DataFrame) -> None:
    """Remove materialised tables before the job ends; frames that still read one fail afterwards."""
    for t in tables:
        own = f"/regionledger/{t.sparkSession.sparkContext.applicationId}/"
        for path in {f.rpartition("/")[0] for f in t.inputFiles()}:
            if own not in path:
                raise ValueError(f"not a working table: {path}")
            _remove(t.sparkSession, path)


def cleanup(spark: SparkSession) -> None:
    """Remove this application's working tables; those of other jobs under the same root stay.

    For the end of a job, once its results are written elsewhere; frames that still read
    a working table fail afterwards.
    """
    _remove(spark, _own(spark))
