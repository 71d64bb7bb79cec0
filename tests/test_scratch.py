"""Working folders: one per application, and cleanup removes only its own."""

import os

from regionledger.sources import scratch


def test_cleanup_leaves_other_jobs(spark):
    mine = scratch.materialise(spark.range(3))
    path = scratch.folder(spark)
    other = f"{scratch.root(spark)}/regionledger/another-application/table"
    spark.range(2).write.parquet(other)
    assert path.startswith(f"{scratch.root(spark)}/regionledger/{spark.sparkContext.applicationId}/")
    assert mine.count() == 3
    scratch.cleanup(spark)
    local = lambda p: p.replace("file:", "")
    assert spark.read.parquet(other).count() == 2
    assert not os.path.exists(local(f"{scratch.root(spark)}/regionledger/{spark.sparkContext.applicationId}"))
