"""Chunk tables: presplits, ranges, refinement, placement and reports.

A chunk table has the columns ``chunk_id`` (0, 1, ... in key order), ``min_key`` and
``max_key`` (half-open range, NULL for an open end) and ``shard``. These tables hold one
row per chunk, not per document. A table of proven small size is numbered in one piece.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkroute.functions.hashing import INT64_MAX
from sparkroute.functions.keys import ASC, DESC
from sparkroute.operators.routing import CHUNK, Fields, bound_part, hash_shard, route
from sparkroute.operators.ordering import positioned
from sparkroute.operators.small import broadcast_if_small, is_small
from sparkroute.session import freeze

# Fixed values of the planning rules.
CHUNKS_PER_SHARD = 10
MAX_DOCS_PER_CHUNK = 250_000
SPLIT_BYTES = 65 * 1024 * 1024
FILE_BYTES = 64 * 1024 * 1024

COLUMNS = [CHUNK, "min_key", "max_key", "shard"]


def chunk_total(shards: list[str], chunks_per_shard: int = CHUNKS_PER_SHARD) -> int:
    """Chunks of a presplit: so many per shard."""
    if chunks_per_shard < 1 or not shards:
        raise ValueError("a presplit needs a shard and at least one chunk per shard")
    return chunks_per_shard * len(shards)


def hash_chunks(spark: SparkSession, n: int, shards: list[str]) -> DataFrame:
    """``n`` uniform chunks of the 64-bit hash range, placed on ``shards`` in turn."""
    half = F.lit(INT64_MAX // n)
    top = F.lit(INT64_MAX)
    chunk = F.col("id")

    def upper(below_top: Column) -> Column:
        # max - k * step in two halves, as k * step alone can exceed 63 bits
        return top - below_top * half - below_top * half

    below = F.lit(n - 1) - chunk
    return spark.range(n).select(
        chunk.alias(CHUNK),
        F.when(chunk > 0, upper(below + 1)).alias("min_key"),
        F.when(chunk < n - 1, upper(below)).alias("max_key"),
        hash_shard(chunk, n, shards).alias("shard"),
    )


def chunk_ranges(bounds: DataFrame, fields: Fields | None = None) -> DataFrame:
    """Chunk table from upper bounds: ``max_key`` (one NULL for the open top) and ``shard``.

    ``fields`` gives the key fields and directions; one ascending field if left out.
    """
    fields = fields or [("max_key", ASC)]
    parts = []
    for name, kind in fields:
        part = bound_part("max_key", fields, name)
        parts.append(part.desc() if kind == DESC else part.asc())
    order = [F.col("max_key").isNull().asc(), *parts]
    if is_small(bounds):
        by_key = Window.orderBy(*order)
        return bounds.select(
            (F.row_number().over(by_key) - 1).cast("bigint").alias(CHUNK),
            F.lag("max_key").over(by_key).alias("min_key"),
            "max_key",
            "shard",
        )
    placed = positioned(bounds, order, CHUNK)
    lower = placed.select((F.col(CHUNK) + 1).alias(CHUNK), F.col("max_key").alias("min_key"))
    return placed.join(lower, CHUNK, "left").select(*COLUMNS)


def unordered_bounds(chunks: DataFrame, fields: Fields | None = None) -> DataFrame:
    """Chunks that break the gap-free order of the key; empty for a sound chunk table.

    ``fields`` gives the key fields and directions; one ascending field if left out.
    """
    beyond = F.lit(False)
    for name, kind in reversed(fields or [("max_key", ASC)]):
        low, high = (bound_part(end, fields or [("", ASC)], name) for end in ("min_key", "max_key"))
        after = low < high if kind == DESC else low > high
        beyond = after | (low.eqNullSafe(high) & beyond)
    at_or_beyond = beyond | (F.col("min_key") == F.col("max_key"))
    previous = chunks.select(
        (F.col(CHUNK) + 1).alias(CHUNK),
        F.col("max_key").alias("previous_max"),
        F.lit(True).alias("follows"),
    )
    first = F.col("follows").isNull()
    broken = (
        (first & ((F.col(CHUNK) != 0) | F.col("min_key").isNotNull()))
        | (~first & ~F.col("min_key").eqNullSafe(F.col("previous_max")))
        | (~first & F.col("min_key").isNull())
        | at_or_beyond
    )
    return chunks.join(previous, CHUNK, "left").where(broken).select(*COLUMNS)


def chunks_from_splits(splits: DataFrame, key: str, shard: str) -> DataFrame:
    """Chunk table from explicit split keys, all on one shard, with an open top.

    The split keys are written once: routing, reports and placement each read them again.
    """
    spark = splits.sparkSession
    keys = splits.select(F.col(key).alias("max_key")).where("max_key IS NOT NULL")
    keys = freeze(keys.distinct())
    top = spark.range(1).select(F.lit(None).cast(keys.schema["max_key"].dataType).alias("max_key"))
    return chunk_ranges(keys.union(top).withColumn("shard", F.lit(shard)))


def place_round_robin(chunks: DataFrame, shards: list[str]) -> DataFrame:
    """The same chunks dealt out to ``shards``: top chunk first, then downwards in turn."""
    names = F.array(*[F.lit(s) for s in sorted(shards)])
    k = F.lit(chunks.count() - 1) - F.col(CHUNK)
    place = F.when(k == 0, F.lit(0)).otherwise(F.pmod(k - 1, F.lit(len(shards))))
    return chunks.withColumn("shard", F.get(names, place.cast("int"))).select(*COLUMNS)


def refine_chunks(
    chunks: DataFrame, splits: DataFrame, fields: Fields | None = None, key: str = "split_key"
) -> DataFrame:
    """Inserts split keys into the chunks of the shard they were found on.

    A split counts only if it lies inside (not on the lower edge of) a chunk of its own
    shard; keys that stray into another shard's range are ignored.
    """
    fields = fields or [("max_key", ASC)]
    parts = [bound_part(key, fields, name).alias(name) for name, _ in fields]
    keys = splits.select("shard", F.col(key).alias("__split"), *parts)
    located = route(keys, chunks, fields).select(CHUNK, "shard", "__split")
    owner = chunks.select(CHUNK, "min_key", F.col("shard").alias("owner"))
    inside = (F.col("owner") == F.col("shard")) & ~F.col("__split").eqNullSafe(F.col("min_key"))
    new = located.join(broadcast_if_small(owner), CHUNK).where(inside)
    new = new.select(F.col("__split").alias("max_key"), "shard")
    return chunk_ranges(chunks.select("max_key", "shard").union(new).distinct(), fields)


def chunk_counts(chunks: DataFrame) -> DataFrame:
    """Chunks per shard."""
    return chunks.groupBy("shard").agg(F.count("*").alias("n_chunks"))


def short_of_chunks(chunks: DataFrame, shards: DataFrame, minimum: int) -> DataFrame:
    """Shards with fewer than ``minimum`` chunks, those without any included."""
    counted = shards.select("shard").join(chunk_counts(chunks), "shard", "left")
    n = F.coalesce(F.col("n_chunks"), F.lit(0)).cast("bigint")
    return counted.select("shard", n.alias("n_chunks")).where(F.col("n_chunks") < minimum)


def docs_per_chunk(routed: DataFrame, size: Column | None = None) -> DataFrame:
    """Documents (and bytes) per chunk of routed rows; combines on the map side."""
    totals = [F.count("*").alias("n_docs")]
    if size is not None:
        totals.append(F.coalesce(F.sum(size), F.lit(0)).cast("bigint").alias("n_bytes"))
    return routed.groupBy(CHUNK).agg(*totals)


def shard_load(per_chunk: DataFrame, chunks: DataFrame) -> DataFrame:
    """Documents and chunks per shard, from the documents per chunk."""
    joined = chunks.join(per_chunk, CHUNK, "left")
    return joined.groupBy("shard").agg(
        F.coalesce(F.sum("n_docs"), F.lit(0)).cast("bigint").alias("n_docs"),
        F.count("*").alias("n_chunks"),
    )


def oversized_shards(
    per_chunk: DataFrame,
    chunks: DataFrame,
    max_docs: int = MAX_DOCS_PER_CHUNK,
    policy: str = "auto",
) -> DataFrame:
    """Shards that need more splits: too many documents per chunk, or all under ``force``."""
    load = shard_load(per_chunk, chunks)
    mean = F.call_function("div", F.col("n_docs"), F.col("n_chunks"))
    load = load.withColumn("docs_per_chunk", mean)
    if policy == "force":
        return load
    if policy == "none":
        return load.where(F.lit(False))
    return load.where(F.col("docs_per_chunk") > max_docs)


def oversized_chunks(per_chunk: DataFrame, max_docs: int = MAX_DOCS_PER_CHUNK) -> DataFrame:
    """Single chunks beyond the limit, where a shard's mean hides a hot one."""
    return per_chunk.where(F.col("n_docs") > max_docs)


def overlapping_ranges(ranges: DataFrame, fields: Fields | None = None) -> DataFrame:
    """Ranges that begin before the one ahead of them (by lower end) is over, with its ends.

    If any two ranges overlap, then so do two neighbours: whatever begins between them begins in the first one too.
    """
    fields = fields or [("min_key", ASC)]
    parts = []
    for name, kind in fields:
        part = bound_part("min_key", fields, name)
        parts.append(part.desc() if kind == DESC else part.asc())
    order = [F.col("min_key").isNull().desc(), *parts, F.col("max_key").isNull().asc()]
    if is_small(ranges):
        by_key = Window.orderBy(*order)
        pairs = ranges.withColumn("low_before", F.lag("min_key").over(by_key)).withColumn(
            "high_before", F.lag("max_key").over(by_key)).withColumn("first", F.row_number().over(by_key) == 1)
    else:
        placed = positioned(ranges, order, "__no")
        ahead = placed.select((F.col("__no") + 1).alias("__no"), F.col("min_key").alias("low_before"),
                              F.col("max_key").alias("high_before"), F.lit(False).alias("first"))
        pairs = placed.join(ahead, "__no", "left").drop("__no").withColumn("first", F.coalesce("first", F.lit(True)))
    inside = F.lit(False)
    for name, kind in reversed(fields):
        low, high = bound_part("min_key", fields, name), bound_part("high_before", fields, name)
        inside = (low > high if kind == DESC else low < high) | (low.eqNullSafe(high) & inside)
    begins_open = F.col("min_key").isNull() | F.col("high_before").isNull()
    return pairs.where(~F.col("first") & (begins_open | inside)).drop("first")


def tag_violations(
    chunks: DataFrame, tag_ranges: DataFrame, shards: DataFrame, fields: Fields | None = None
) -> DataFrame:
    """Chunks that overlap a tag range without lying on one of the tag's shards.

    ``fields`` gives the key fields and directions; one ascending field if left out. Tag ranges that
    overlap are refused. All bounds of both tables cut the key axis into pieces; each piece lies in one chunk
    and at most one tag range, so two look-ups of its lower end find both.
    """
    spark = chunks.sparkSession
    fields = fields or [("piece", ASC)]
    if tag_ranges.groupBy("min_key").count().where("count > 1").take(1):
        raise ValueError("two tag ranges begin at the same key")
    twice = overlapping_ranges(tag_ranges, fields).limit(1).collect()
    if twice:
        raise ValueError(f"tag range from {twice[0].min_key} begins before the one from {twice[0].low_before} is over")
    dtype = chunks.schema["min_key"].dataType
    ends = (
        chunks.select(F.col("min_key").alias("piece"))
        .union(tag_ranges.select("min_key"))
        .union(tag_ranges.select("max_key").where("max_key IS NOT NULL"))
        .distinct()
    )
    # every tag range and every gap beside one, as a gap-free table of its own
    edges = (
        tag_ranges.select("min_key", "tag")
        .union(tag_ranges.where("max_key IS NOT NULL").select("max_key", F.lit(None).cast("string")))
        .union(spark.range(1).select(F.lit(None).cast(dtype), F.lit(None).cast("string")))
        .groupBy("min_key")
        .agg(F.max("tag").alias("tag"))
    )
    edges = freeze(edges)
    tops = edges.where("min_key IS NOT NULL").select(F.col("min_key").alias("max_key"))
    tops = tops.union(spark.range(1).select(F.lit(None).cast(dtype))).withColumn("shard", F.lit(""))
    zones = chunk_ranges(tops, fields)
    tags = edges.select(F.col("min_key").alias("__edge"), "tag")
    zones = zones.join(tags, F.col("min_key").eqNullSafe(F.col("__edge")), "left")
    keys = [bound_part("piece", fields, name).alias(name) for name, _ in fields]
    pieces = route(ends.select(*keys), chunks, fields, "owner")
    pieces = route(pieces, zones, fields, "zone")
    zone_tags = zones.select(F.col(CHUNK).alias("zone"), "tag").where("tag IS NOT NULL")
    touched = (
        pieces.join(zone_tags, "zone")
        .join(chunks.withColumnRenamed(CHUNK, "owner"), "owner")
        .select(F.col("owner").alias(CHUNK), "min_key", "max_key", "shard", "tag")
        .distinct()
    )
    allowed = shards.select("shard", "tag")
    return touched.join(allowed, ["shard", "tag"], "left_anti").select(*COLUMNS, "tag")


def layout_report(chunks: DataFrame, shards: DataFrame, per_chunk: DataFrame) -> DataFrame:
    """Every chunk with its range, shard, the shard's tag, and what was routed to it."""
    zero = F.lit(0).cast("bigint")
    columns = [c for c in per_chunk.columns if c != CHUNK]
    return (
        chunks.join(shards.select("shard", "tag"), "shard", "left")
        .join(per_chunk, CHUNK, "left")
        .select(*COLUMNS, "tag", *[F.coalesce(F.col(c), zero).alias(c) for c in columns])
    )
