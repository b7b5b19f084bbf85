"""Routing, placement and batching queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkroute.functions.hashing import hash_column
from sparkroute.operators.ordering import batches, file_plan, packed_files, ranked
from sparkroute.operators.routing import hash_shard, lookup, route, route_hash
from sparkroute.plans.chunks import chunks_from_splits, place_round_robin
from sparkroute.queries.registry import (
    REGIONS_SQL,
    SHARDS_SQL,
    hash_shard_sql,
    in_chunk_sql,
    names,
    query,
    ranges_sql,
    routed_sql,
    shard_table,
    table,
)
from sparkroute.sinks.tables import one_partition_per_chunk

HASH_CHUNKS = 20

# chunks of part keys: the first key of each brand and type is a split, dealt out to the regions
SPLITS_SQL = "SELECT min(p_partkey) AS max_key FROM part GROUP BY p_brand, p_type"
BOUNDS_SQL = f"(SELECT DISTINCT max_key, '' AS shard FROM ({SPLITS_SQL}) UNION ALL SELECT NULL, '')"
PART_CHUNKS_SQL = f"""(
  SELECT chunk_id, min_key, max_key,
    {REGIONS_SQL}[CASE WHEN k = 0 THEN 1 ELSE (k - 1) % len({REGIONS_SQL}) + 1 END] AS shard
  FROM (SELECT *, max(chunk_id) OVER () - chunk_id AS k FROM {ranges_sql(BOUNDS_SQL)}))"""


def part_chunks(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    splits = part.groupBy("p_brand", "p_type").agg(F.min("p_partkey").alias("p_partkey"))
    regions = names(table(spark, sf_dir, "region"), "r_name")
    return place_round_robin(chunks_from_splits(splits, "p_partkey", ""), regions)


def hashed(df, key):
    return df.withColumn("key_hash", hash_column(df, key))


@query(
    "route_hash",
    sql=f"""
SELECT chunk_id, {hash_shard_sql('chunk_id', HASH_CHUNKS, SHARDS_SQL)} AS shard,
  count(*) AS n_rows, min(key_hash) AS min_hash, max(key_hash) AS max_hash
FROM {routed_sql('lineitem', 'l_orderkey', HASH_CHUNKS)} GROUP BY chunk_id
"""
)
def route_by_hash(spark, sf_dir):
    lineitem = hashed(table(spark, sf_dir, "lineitem").select("l_orderkey"), "l_orderkey")
    shards = names(shard_table(spark, sf_dir))
    per_chunk = (
        route_hash(lineitem, HASH_CHUNKS, "key_hash")
        .groupBy("chunk_id")
        .agg(
            F.count("*").alias("n_rows"),
            F.min("key_hash").alias("min_hash"),
            F.max("key_hash").alias("max_hash"),
        )
    )
    return per_chunk.withColumn("shard", hash_shard(F.col("chunk_id"), HASH_CHUNKS, shards))


@query(
    "route_range",
    sql=f"""
SELECT l_orderkey, l_partkey, l_linenumber, c.chunk_id
FROM lineitem JOIN {PART_CHUNKS_SQL} c ON {in_chunk_sql('l_partkey')}
"""
)
def route_by_range(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    return route(lineitem, part_chunks(spark, sf_dir), "l_partkey")


@query(
    sql=f"""
SELECT l_orderkey, l_partkey, l_linenumber, c.chunk_id
FROM lineitem ASOF JOIN (
  SELECT chunk_id, coalesce(min_key, -9223372036854775808) AS low
  FROM {ranges_sql('''(SELECT p_partkey AS max_key, '' AS shard FROM part
  UNION ALL SELECT NULL, '')''')}) c ON l_partkey >= c.low
"""
)
def route_many_chunks(spark, sf_dir):
    """Every part key is a split: more chunks than one constant array takes."""
    lineitem = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    chunks = chunks_from_splits(table(spark, sf_dir, "part"), "p_partkey", "")
    return route(lineitem, chunks, "l_partkey")


@query(
    sql=f"""
SELECT page_id, c.chunk_id FROM pages JOIN {ranges_sql('''(
  SELECT min(url) AS max_key, '' AS shard FROM pages GROUP BY length(url)
  UNION ALL SELECT NULL, '')''')} c ON {in_chunk_sql('url')}
"""
)
def route_by_text(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    splits = pages.groupBy(F.length("url").alias("n")).agg(F.min("url").alias("url"))
    return route(pages, chunks_from_splits(splits, "url", ""), "url").select("page_id", "chunk_id")


@query(
    sql=f"""
SELECT p_partkey, c.chunk_id, c.shard FROM part
LEFT JOIN {PART_CHUNKS_SQL} c ON p_partkey = c.max_key
"""
)
def chunk_lookup(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey")
    found, unknown = lookup(part, part_chunks(spark, sf_dir), "p_partkey")
    none = unknown.select(
        "p_partkey", F.lit(None).cast("bigint").alias("chunk_id"), F.lit(None).cast("string").alias("shard")
    )
    return found.select("p_partkey", "chunk_id", "shard").union(none)


@query(
    sql=f"""
SELECT chunk_id, chunk_id AS partition_no, count(*) AS n_rows
FROM {routed_sql('orders', 'o_orderkey', HASH_CHUNKS)} GROUP BY chunk_id
"""
)
def partition_layout(spark, sf_dir):
    orders = hashed(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey")
    placed = one_partition_per_chunk(route_hash(orders, HASH_CHUNKS, "key_hash"), HASH_CHUNKS)
    numbered = placed.withColumn("partition_no", F.spark_partition_id().cast("bigint"))
    return numbered.groupBy("chunk_id", "partition_no").agg(F.count("*").alias("n_rows"))


@query(
    sql=f"""
SELECT o_orderkey, chunk_id,
  row_number() OVER (PARTITION BY chunk_id ORDER BY key_hash, o_orderkey) AS row_no
FROM {routed_sql('orders', 'o_custkey', HASH_CHUNKS)}
"""
)
def chunk_sort(spark, sf_dir):
    orders = hashed(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "o_custkey")
    routed = route_hash(orders, HASH_CHUNKS, "key_hash")
    order = [F.col("key_hash").asc(), F.col("o_orderkey").asc()]
    return ranked(routed, order).select("o_orderkey", "chunk_id", "row_no")


SLOTS = 4
SLOT_SQL = f"(key_hash % {SLOTS} + {SLOTS}) % {SLOTS}"
BATCH_ROWS = 100


@query(
    "batches",
    sql=f"""
SELECT o_orderkey, chunk_id, (row_no - 1) // {BATCH_ROWS} AS batch_no FROM (
  SELECT *, row_number() OVER (PARTITION BY chunk_id ORDER BY {SLOT_SQL}, o_orderkey) AS row_no
  FROM {routed_sql('orders', 'o_orderkey', HASH_CHUNKS)})
"""
)
def row_batches(spark, sf_dir):
    orders = hashed(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey")
    routed = route_hash(orders, HASH_CHUNKS, "key_hash")
    made = batches(routed, [F.col("o_orderkey")], F.col("key_hash"), SLOTS, BATCH_ROWS)
    return made.select("o_orderkey", "chunk_id", "batch_no")


FILE_LIMIT = 256 * 1024
FILE_CHUNKS = 2


@query(
    "file_plan",
    sql=f"""
SELECT doc_id, chunk_id, (greatest(upto - 1, 0) // ({FILE_LIMIT} - largest))::BIGINT AS file_no FROM (
  SELECT *, max(octet_length(encode(text))) OVER () AS largest,
    sum(octet_length(encode(text))) OVER (PARTITION BY chunk_id ORDER BY {SLOT_SQL}, doc_id) AS upto
  FROM {routed_sql('documents', 'doc_id', FILE_CHUNKS)})
"""
)
def size_bounded_files(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select(
        "doc_id", F.octet_length("text").cast("bigint").alias("n_bytes")
    )
    routed = route_hash(hashed(documents, "doc_id"), FILE_CHUNKS, "key_hash")
    order, size = [F.col("doc_id")], F.col("n_bytes")
    planned = file_plan(routed, order, F.col("key_hash"), SLOTS, size, FILE_LIMIT)
    return planned.select("doc_id", "chunk_id", "file_no")


PACK_LIMIT = 120_000
SIZE_SQL = "octet_length(encode(text))"


@query(
    sql=f"""
SELECT chunk_id, count(*) AS n_docs, sum({SIZE_SQL})::BIGINT AS n_bytes, true AS fits, true AS numbered, true AS full,
  count(*) FILTER ({SIZE_SQL} > {PACK_LIMIT} // 2) AS alone,
  (ceil(count(*) FILTER ({SIZE_SQL} BETWEEN {PACK_LIMIT} // 4 + 1 AND {PACK_LIMIT} // 2) / 2.0))::BIGINT AS pairs
FROM {routed_sql('documents', 'doc_id', FILE_CHUNKS)} GROUP BY chunk_id
"""
)
def file_plan_packed(spark, sf_dir):
    """Files of bounded size where a few long documents do not make the files of the others small."""
    documents = table(spark, sf_dir, "documents").select("doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"))
    routed = route_hash(hashed(documents, "doc_id"), FILE_CHUNKS, "key_hash")
    planned = packed_files(routed, [F.col("doc_id")], F.col("key_hash"), F.col("n_bytes"), PACK_LIMIT, rows_per_slot=300, beyond="alone")
    files = planned.groupBy("chunk_id", "file_no").agg(
        F.count("*").alias("n_docs"), F.sum("n_bytes").alias("n_bytes"), F.max("n_bytes").alias("longest"))
    small = F.col("longest") <= PACK_LIMIT >> 4
    loose = F.count_if(small & (F.col("n_bytes") < PACK_LIMIT - (PACK_LIMIT >> 3)))  # the last file of a chunk may be
    half = F.col("longest") > PACK_LIMIT // 2
    fits = (F.col("n_bytes") <= PACK_LIMIT) | (F.col("n_docs") == 1)  # a document beyond the limit is a file by itself
    return files.groupBy("chunk_id").agg(
        F.sum("n_docs").alias("n_docs"), F.sum("n_bytes").alias("n_bytes"), F.every(fits).alias("fits"),
        (F.max("file_no") + 1 == F.count("*")).alias("numbered"), (loose <= 1).alias("full"),
        F.count_if(half).alias("alone"), F.count_if(~half & (F.col("longest") > PACK_LIMIT // 4)).alias("pairs"))
