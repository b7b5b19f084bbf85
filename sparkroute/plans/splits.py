"""Split keys by size, and the policy that decides when to look for them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkroute.functions.keys import ShardKey, order_columns
from sparkroute.operators.routing import CHUNK, Fields, key_fields, route
from sparkroute.operators.small import BROADCAST_BYTES, broadcast_if_small, byte_size
from sparkroute.plans.chunks import (
    MAX_DOCS_PER_CHUNK,
    SPLIT_BYTES,
    chunk_ranges,
    oversized_shards,
    place_round_robin,
    refine_chunks,
)
from sparkroute.session import ensure_shipped, freeze

POLICIES = ("auto", "none", "force")


def key_sizes(
    df: DataFrame, fields: Fields, size: Column, groups: list[str] = (), partitions: int | None = None
) -> DataFrame:
    """Rows and bytes per key (and group), range-placed and sorted by key, written once, with their partition.

    The sums combine on the map side, so a hot key is one row. All that is planned from the sizes reads
    this narrow table; the rows themselves are read once.
    """
    names = [name for name, _ in fields]
    sized = df.groupBy(*groups, *names).agg(F.sum(size).alias("__bytes"), F.count("*").alias("__rows"))
    return _placed_sizes(sized, fields, partitions)


def _placed_sizes(sizes: DataFrame, fields: Fields, partitions: int | None = None) -> DataFrame:
    order = order_columns(fields)
    ranged = sizes.repartitionByRange(partitions, *order) if partitions else sizes.repartitionByRange(*order)
    return freeze(ranged.sortWithinPartitions(*order).withColumn("__part", F.spark_partition_id()))


def running_bytes(sizes: DataFrame, group: str | None = None) -> DataFrame:
    """Adds ``__run``, the bytes before each row of its partition (and group), by position: no exchange, no sort."""

    def add(batches):
        totals: dict = {}
        for batch in batches:
            sizes_in = batch.column("__bytes").to_numpy(zero_copy_only=False).astype(np.int64)
            runs = np.empty(len(sizes_in), np.int64)
            if group is None:
                codes, found = np.zeros(len(sizes_in), np.int64), [None]
            else:
                coded = batch.column(group).dictionary_encode(null_encoding="encode")
                codes, found = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.to_pylist()
            for code, name in enumerate(found):
                at = codes == code
                upto = np.cumsum(sizes_in[at]) + totals.get(name, 0)
                runs[at] = upto - sizes_in[at]
                totals[name] = int(upto[-1]) if len(upto) else totals.get(name, 0)
            yield batch.append_column("__run", pa.array(runs))

    ensure_shipped(sizes.sparkSession)
    schema = T.StructType([*sizes.schema.fields, T.StructField("__run", T.LongType())])
    return sizes.mapInArrow(add, schema)


def splits_of(sizes: DataFrame, fields: Fields, max_bytes: int, group: str | None = None) -> DataFrame:
    """Split keys from placed key sizes: ``chunk_no`` and ``split_key`` (per ``group``).

    The running sum has two levels: within a placed partition, and over the totals of the
    partitions, of which there are few.
    """
    names = [name for name, _ in fields]
    groups = [group] if group else []
    sizes = sizes.withColumn("__bytes", F.coalesce(F.col("__bytes"), F.lit(0)).cast("bigint"))
    totals = sizes.groupBy(*groups, "__part").agg(F.sum("__bytes").alias("__total"))
    earlier = Window.partitionBy(*groups) if group else Window.partitionBy(F.lit(0))
    earlier = earlier.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *groups, "__part", F.coalesce(F.sum("__total").over(earlier), F.lit(0)).alias("__before")
    )
    start = F.col("__before") + F.col("__run")
    chunk = F.call_function("div", start, F.lit(max_bytes).cast("bigint"))
    key = F.col(names[0]) if len(names) == 1 else F.struct(*names)
    return (
        running_bytes(sizes, group).join(broadcast_if_small(offsets), [*groups, "__part"])
        .select(*groups, key.alias("__key"), start.alias("__start"), chunk.alias("chunk_no"))
        .where("chunk_no > 0")
        .groupBy(*groups, "chunk_no")
        .agg(F.min_by("__key", "__start").alias("split_key"))
    )


def size_splits(
    df: DataFrame,
    fields: Fields,
    size: Column,
    max_bytes: int = SPLIT_BYTES,
    group: str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Split keys such that the chunks between them hold about ``max_bytes``; with ``group`` in each on its own."""
    sizes = key_sizes(df, fields, size, [group] if group else [], partitions)
    return splits_of(sizes, fields, max_bytes, group)


def plan_source_chunks(
    df: DataFrame,
    chunks: DataFrame,
    key: ShardKey | Fields | str,
    size: Column,
    policy: str = "auto",
    max_docs: int = MAX_DOCS_PER_CHUNK,
    max_bytes: int = SPLIT_BYTES,
) -> DataFrame:
    """Chunk table to read ``df`` by: the known chunks, refined where a shard is oversized.

    ``none`` keeps the known chunks, ``auto`` refines shards with too many documents per
    chunk, ``force`` refines every shard and fails if no split key can be found at all. The rows are read
    once, for their sizes by chunk and key; counts and splits come from those.
    """
    if policy not in POLICIES:
        raise ValueError(f"bad split policy: {policy}; one of {', '.join(POLICIES)}")
    if policy == "none":
        return chunks
    fields = key_fields(key)
    sizes = key_sizes(route(df, chunks, fields), fields, size, [CHUNK])
    per_chunk = sizes.groupBy(CHUNK).agg(F.sum("__rows").alias("n_docs"))
    large = freeze(oversized_shards(per_chunk, chunks, max_docs, policy).select("shard"))
    if large.isEmpty():
        return chunks
    owner = chunks.join(broadcast_if_small(large), "shard").select(CHUNK, "shard")
    if byte_size(owner) <= BROADCAST_BYTES:  # keeps the rows in their places
        owned = sizes.join(F.broadcast(owner), CHUNK)
    else:
        owned = _placed_sizes(sizes.drop("__part").join(owner, CHUNK), fields)
    splits = freeze(splits_of(owned, fields, max_bytes, group="shard"))
    if splits.isEmpty() and policy == "force":
        raise ValueError("splits were requested but no split key was found")
    return refine_chunks(chunks, splits, fields)


def range_chunks(
    df: DataFrame,
    fields: Fields,
    size: Column,
    shards: list[str],
    max_bytes: int = SPLIT_BYTES,
) -> DataFrame:
    """Range presplit from the data itself: size splits, dealt out to the shards."""
    splits = size_splits(df, fields, size, max_bytes).select(F.col("split_key").alias("max_key"))
    spark = df.sparkSession
    top = spark.range(1).select(F.lit(None).cast(splits.schema["max_key"].dataType).alias("max_key"))
    bounds = splits.union(top).withColumn("shard", F.lit(shards[0]))
    return place_round_robin(freeze(chunk_ranges(bounds, fields)), shards)
