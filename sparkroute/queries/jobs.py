"""Whole jobs, and the streaming load."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkroute.operators.routing import CHUNK
from sparkroute.plans.jobs import dump, load, load_folder, reshard, restore
from sparkroute.queries.chunks import RANGE_BYTES
from sparkroute.queries.registry import (
    in_chunk_sql,
    names,
    query,
    ranges_sql,
    routed_sql,
    shard_table,
    table,
)
from sparkroute.queries.sinks import N_CHUNKS, ORDERS_SQL, PER_SHARD, orders_of
from sparkroute.session import scratch_dir
from sparkroute.sinks.tables import read_chunk_table
from sparkroute.sources.collection import read_dump
from sparkroute.streaming.load import read_file_stream
from sparkroute.streaming.load import stream_load as start_stream

DUMP_CHUNKS = 16


def chunked(df):
    return df.withColumn(CHUNK, F.col(CHUNK).cast("bigint"))


@query(
    sql=f"""
SELECT _id, lang, octet_length(encode(text))::BIGINT AS n_bytes, chunk_id
FROM {routed_sql('(SELECT doc_id AS _id, lang, text FROM documents)', '_id', N_CHUNKS)}
"""
)
def job_load(spark, sf_dir):
    """JSON-lines files to a chunked table."""
    folder, target = scratch_dir(spark, "json"), scratch_dir(spark, "loaded")
    documents = table(spark, sf_dir, "documents")
    documents.select(F.col("doc_id").alias("_id"), "lang", "text").write.json(folder)
    schema = T.StructType.fromDDL("_id bigint, lang string, text string")
    shards = names(shard_table(spark, sf_dir))
    load_folder(
        spark, folder, target, schema, {"_id": "hashed"}, shards=shards, chunks_per_shard=PER_SHARD
    )
    size = F.octet_length("text").cast("bigint").alias("n_bytes")
    return chunked(read_chunk_table(spark, target)).select("_id", "lang", size, CHUNK)


@query(
    sql=f"SELECT {ORDERS_SQL}, chunk_id FROM {routed_sql('orders', 'o_custkey', N_CHUNKS)}"
)
def job_reshard(spark, sf_dir):
    first, second = scratch_dir(spark, "by-order"), scratch_dir(spark, "by-customer")
    shards = names(shard_table(spark, sf_dir))
    load(orders_of(spark, sf_dir), first, {"o_orderkey": "hashed"}, shards, PER_SHARD)
    source = read_chunk_table(spark, first)
    options = {"shards": shards, "chunks_per_shard": PER_SHARD}
    reshard(source, second, {"o_custkey": "hashed"}, sort=True, tiebreak=["o_orderkey"], **options)
    return chunked(read_chunk_table(spark, second))


@query(
    sql=f"""
SELECT vec_id, label, len(embedding)::BIGINT AS n, list_sum(embedding::DOUBLE[]) > 0 AS positive,
  chunk_id
FROM {routed_sql('embeddings', 'vec_id', DUMP_CHUNKS)}
"""
)
def job_dump(spark, sf_dir):
    path = scratch_dir(spark, "dump")
    dump(table(spark, sf_dir, "embeddings"), path, {"vec_id": "hashed"}, DUMP_CHUNKS)
    total = F.aggregate("embedding", F.lit(0.0), lambda a, v: a + v.cast("double"))
    return chunked(read_dump(spark, path)).select(
        "vec_id",
        "label",
        F.size("embedding").cast("bigint").alias("n"),
        (total > 0).alias("positive"),
        CHUNK,
    )


@query(
    "dump",
    sql=f"""
SELECT doc_id, octet_length(encode(text))::BIGINT AS n_bytes, chunk_id
FROM {routed_sql('documents', 'doc_id', 4)}
"""
)
def dump_sized_files(spark, sf_dir):
    """A dump whose files are bounded by the documents' bytes."""
    path = scratch_dir(spark, "dump")
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    size = F.octet_length("text").cast("bigint")
    dump(documents, path, {"doc_id": "hashed"}, 4, size, 256 * 1024, rows_per_slot=500)
    return chunked(read_dump(spark, path)).select("doc_id", size.alias("n_bytes"), CHUNK)


@query(
    sql=f"SELECT {ORDERS_SQL}, chunk_id FROM {routed_sql('orders', 'o_custkey', N_CHUNKS)}"
)
def job_restore(spark, sf_dir):
    """A dump by order key, restored by customer key."""
    path, target = scratch_dir(spark, "dump"), scratch_dir(spark, "restored")
    dump(orders_of(spark, sf_dir), path, {"o_orderkey": "hashed"}, DUMP_CHUNKS)
    shards = names(shard_table(spark, sf_dir))
    key = {"o_custkey": "hashed"}
    restore(spark, path, target, key, shards=shards, chunks_per_shard=PER_SHARD)
    return chunked(read_chunk_table(spark, target))


@query(
    sql=f"""
SELECT c.chunk_id, count(*) AS n_rows, min(o_custkey) AS min_key, max(o_custkey) AS max_key
FROM (SELECT o_custkey, o_orderkey FROM orders) JOIN {ranges_sql(f'''(
    SELECT min(o_custkey) AS max_key, '' AS shard FROM (
      SELECT o_custkey, (sum(n) OVER (ORDER BY o_custkey) - n)::BIGINT // {RANGE_BYTES} AS no
      FROM (SELECT o_custkey, sum(length('{{"o_orderkey":' || o_orderkey || ',"o_custkey":' || o_custkey || '}}')) AS n
            FROM orders GROUP BY o_custkey))
    WHERE no > 0 GROUP BY no UNION ALL SELECT NULL, '')''')} c ON {in_chunk_sql('o_custkey')}
GROUP BY c.chunk_id
"""
)
def load_range_key(spark, sf_dir):
    """A load by a range key: the chunks come from the sizes of the rows themselves."""
    target = scratch_dir(spark, "by-range")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    regions = names(table(spark, sf_dir, "region"), "r_name")
    key = {"o_custkey": 1}
    load(orders, target, key, regions, sort=True, tiebreak=["o_orderkey"], max_bytes=RANGE_BYTES)
    return chunked(read_chunk_table(spark, target)).groupBy(CHUNK).agg(
        F.count("*").alias("n_rows"),
        F.min("o_custkey").alias("min_key"),
        F.max("o_custkey").alias("max_key"),
    )


@query(
    sql=f"SELECT event_id, user_id, chunk_id FROM {routed_sql('events', 'user_id', 10)}"
)
def stream_load(spark, sf_dir):
    target, checkpoint = scratch_dir(spark, "stream"), scratch_dir(spark, "stream-checkpoint")
    source = f"{sf_dir}/events*.parquet"
    schema = table(spark, sf_dir, "events").schema
    stream = read_file_stream(spark, source, schema).select("event_id", "user_id")
    started = start_stream(stream, target, {"user_id": "hashed"}, checkpoint, n_chunks=10)
    started.awaitTermination()
    return chunked(read_chunk_table(spark, target)).select("event_id", "user_id", CHUNK)
