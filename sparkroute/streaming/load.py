"""Stateless streaming load: route each micro-batch and append it to its chunks."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sparkroute.functions.keys import HASH_COLUMN, ShardKey, require_key
from sparkroute.operators.routing import route
from sparkroute.plans.chunks import chunk_ranges, hash_chunks
from sparkroute.sinks.manifest import commit, layout_table, read_manifest, run_folder, write_layout_table
from sparkroute.sinks.tables import has_data, placed, write_chunks

STREAM_SHARD = "shard0"


def read_file_stream(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", files: int = 100
) -> DataFrame:
    """New files of a folder as a stream; ``files`` per batch is the back-pressure."""
    reader = spark.readStream.schema(schema).format(fmt)
    return reader.option("maxFilesPerTrigger", files).load(path)


def stream_load(
    stream: DataFrame,
    target: str,
    key: ShardKey | str | dict,
    checkpoint: str,
    n_chunks: int | None = None,
    chunks: DataFrame | None = None,
) -> StreamingQuery:
    """Starts a load of all that is available now, into the versions of a chunked table.

    A target that was loaded before keeps its key and its chunks; a new one gets ``chunks``, or ``n_chunks`` of
    a hashed key. Routing works on the stream itself (no join, no state). Each batch is a run of its own, named by
    the checkpoint and the batch, and is added to the table when it is written: a batch that is retried after a
    failure overwrites its own folder, so rows are neither lost nor doubled.
    """
    spark = stream.sparkSession
    key = ShardKey.parse(key)
    spec = json.dumps(list(key.fields))
    stored = read_manifest(spark, target)
    if stored and stored.key != spec:
        raise ValueError(f"{target} has the key {stored.key}, not {spec}")
    if not stored and has_data(spark, target):
        raise ValueError(f"{target} has data of unknown key and chunks")
    if stored:
        chunks, layout = layout_table(spark, target, stored), stored.layout
    else:
        chunks = chunks if chunks is not None else _new_chunks(spark, stream, key, n_chunks or 1)
        layout = write_layout_table(chunks, target)
    rows, fields = key.routed(require_key(stream, key))
    rows = route(rows, chunks, fields).drop(HASH_COLUMN)
    name = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]

    def write(batch: DataFrame, batch_id: int) -> None:
        run = f"{name}-{batch_id}"
        write_chunks(placed(batch), run_folder(target, run), "overwrite")
        commit(spark, target, run, spec, layout)

    return (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _new_chunks(spark: SparkSession, stream: DataFrame, key: ShardKey, n: int) -> DataFrame:
    """The chunk table of a stream's new target: uniform for a hashed key, else one open range."""
    if key.hashed:
        return hash_chunks(spark, n, [STREAM_SHARD])
    kinds = T.StructType([stream.schema[name] for name in key.names])
    dtype = kinds[0].dataType if len(key.names) == 1 else kinds
    return chunk_ranges(spark.range(1).select(F.lit(None).cast(dtype).alias("max_key"), F.lit(STREAM_SHARD).alias("shard")), list(key.fields))
