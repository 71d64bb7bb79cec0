"""The positional-byte index is never broadcast."""

import pytest

from regionledger.llm import simhash
from regionledger.sources import scratch


@pytest.mark.parametrize("threshold", ["10MB", "1GB"])
def test_the_exploded_index_meets_by_shuffle(spark, threshold):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, threshold)
    try:
        # 70 keys for each of few fingerprints: Spark takes the index for as small as the fingerprints.
        pairs = simhash.links(scratch.materialise(spark.createDataFrame([(0,), (1,), (3,), (1 << 40,), (-1,)], "fp long")))
        got = sorted(map(tuple, pairs.collect()))
        plan = pairs._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, before)
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert got == [(0, 1), (0, 3), (0, 1 << 40), (1, 3), (1, 1 << 40), (3, 1 << 40)]
