"""Short literal tables."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_ARROW = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}


def literal(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """Rows as a local relation.

    Through Arrow, because plain Python rows become an RDD of unknown size, which
    the planner would shuffle where it could send a few rows along.
    """
    fields = [f.strip().split(" ") for f in ddl.split(",")]
    arrays = [pa.array([r[i] for r in rows], type=_ARROW[t]) for i, (_, t) in enumerate(fields)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, names=[n for n, _ in fields]))
