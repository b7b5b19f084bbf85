"""Run statistics: one line per run, appended to a CSV folder."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("started_at", T.StringType()),
        T.StructField("seconds", T.DoubleType()),
        T.StructField("input_type", T.StringType()),
        T.StructField("shard_key", T.StringType()),
        T.StructField("chunks", T.LongType()),
        T.StructField("placement", T.StringType()),
        T.StructField("rows_in", T.LongType()),
        T.StructField("rows_out", T.LongType()),
        T.StructField("rows_quarantined", T.LongType()),
        T.StructField("note", T.StringType()),
    ]
)


def append_stats(spark: SparkSession, path: str, **values) -> None:
    """Appends one run; names not in the schema are refused."""
    unknown = set(values) - set(SCHEMA.names)
    if unknown:
        raise ValueError(f"unknown statistics: {', '.join(sorted(unknown))}")
    row = tuple(values.get(name) for name in SCHEMA.names)
    run = spark.createDataFrame([row], SCHEMA)
    run.coalesce(1).write.mode("append").option("header", "true").csv(path)


def read_stats(spark: SparkSession, path: str):
    """All recorded runs."""
    return spark.read.schema(SCHEMA).option("header", "true").csv(path)
