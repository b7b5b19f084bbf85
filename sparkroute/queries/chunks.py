"""Chunk planning queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkroute.operators.routing import CHUNK, route, route_hash
from sparkroute.plans.chunks import (
    chunk_counts,
    chunk_ranges,
    docs_per_chunk,
    hash_chunks,
    layout_report,
    oversized_chunks,
    oversized_shards,
    refine_chunks,
    short_of_chunks,
    tag_violations,
)
from sparkroute.plans.chunks import chunks_from_splits as from_splits
from sparkroute.plans.splits import plan_source_chunks, range_chunks
from sparkroute.plans.splits import size_splits as splits_by_size
from sparkroute.queries.registry import (
    MAX_SQL,
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
from sparkroute.queries.routing import PART_CHUNKS_SQL, hashed, part_chunks

DOCS_PER_CHUNK = 1000
N_SQL = f"""(SELECT len({SHARDS_SQL}) * greatest(1,
  (count(*) + len({SHARDS_SQL}) * {DOCS_PER_CHUNK} - 1) // (len({SHARDS_SQL}) * {DOCS_PER_CHUNK}))
  FROM lineitem)"""
STEP_SQL = f"(2 * ({MAX_SQL}::HUGEINT // n))"


@query(
    sql=f"""
SELECT i AS chunk_id,
  CASE WHEN i > 0 THEN ({MAX_SQL} - (n - i) * {STEP_SQL})::BIGINT END AS min_key,
  CASE WHEN i < n - 1 THEN ({MAX_SQL} - (n - 1 - i) * {STEP_SQL})::BIGINT END AS max_key,
  {hash_shard_sql('i', 'n', SHARDS_SQL)} AS shard
FROM (SELECT n, unnest(range(n)) AS i FROM (SELECT {N_SQL} AS n))
"""
)
def presplit(spark, sf_dir):
    """As many chunks as lineitem needs, evenly over the shards."""
    shards = names(shard_table(spark, sf_dir))
    rows = table(spark, sf_dir, "lineitem").count()
    per_shard = max(1, -(-rows // (len(shards) * DOCS_PER_CHUNK)))
    return hash_chunks(spark, per_shard * len(shards), shards)


@query(
    sql=ranges_sql(
        "(SELECT DISTINCT p_partkey AS max_key, 's1' AS shard FROM part UNION ALL SELECT NULL, 's1')"
    )[1:-1]
)
def chunks_from_splits(spark, sf_dir):
    return from_splits(table(spark, sf_dir, "part"), "p_partkey", "s1")


NATION_BOUNDS_SQL = """(
  SELECT max(s_suppkey) + 1 AS max_key, n_name AS shard
  FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name
  UNION ALL SELECT NULL, (SELECT min(n_name) FROM nation))"""


def nation_bounds(spark, sf_dir):
    supplier, nation = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    joined = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
    bounds = joined.groupBy(F.col("n_name").alias("shard")).agg(
        (F.max("s_suppkey") + 1).alias("max_key")
    )
    top = nation.agg(F.min("n_name").alias("shard"))
    top = top.withColumn("max_key", F.lit(None).cast("bigint"))
    return bounds.unionByName(top)


@query("chunk_ranges", sql=ranges_sql(NATION_BOUNDS_SQL)[1:-1])
def bounds_to_ranges(spark, sf_dir):
    return chunk_ranges(nation_bounds(spark, sf_dir))


SPLIT_SIZE = 100_000


@query(
    sql=f"""
SELECT chunk_no, min(doc_id) AS split_key FROM (
  SELECT doc_id, (sum(n) OVER (ORDER BY doc_id) - n)::BIGINT // {SPLIT_SIZE} AS chunk_no
  FROM (SELECT doc_id, sum(octet_length(encode(text))) AS n FROM documents GROUP BY doc_id))
WHERE chunk_no > 0 GROUP BY chunk_no
"""
)
def size_splits(spark, sf_dir):
    size = F.octet_length("text").cast("bigint")
    documents = table(spark, sf_dir, "documents")
    return splits_by_size(documents, [("doc_id", "asc")], size, SPLIT_SIZE)


MAX_DOCS = 400
PER_CHUNK_SQL = f"""(
  SELECT c.chunk_id, count(*) AS n_docs
  FROM lineitem JOIN {PART_CHUNKS_SQL} c ON {in_chunk_sql('l_partkey')} GROUP BY c.chunk_id)"""


def lineitem_per_chunk(spark, sf_dir, chunks):
    lineitem = table(spark, sf_dir, "lineitem").select("l_partkey")
    return docs_per_chunk(route(lineitem, chunks, "l_partkey"))


@query(
    sql=f"""
SELECT shard, n_docs, n_chunks, n_docs // n_chunks AS docs_per_chunk FROM (
  SELECT shard, coalesce(sum(n_docs), 0)::BIGINT AS n_docs, count(*) AS n_chunks
  FROM {PART_CHUNKS_SQL} c LEFT JOIN {PER_CHUNK_SQL} USING (chunk_id) GROUP BY shard)
WHERE n_docs // n_chunks > {MAX_DOCS}
"""
)
def oversized(spark, sf_dir):
    chunks = part_chunks(spark, sf_dir)
    return oversized_shards(lineitem_per_chunk(spark, sf_dir, chunks), chunks, MAX_DOCS)


@query(sql=f"SELECT chunk_id, n_docs FROM {PER_CHUNK_SQL} WHERE n_docs > {MAX_DOCS}")
def hot_chunks(spark, sf_dir):
    chunks = part_chunks(spark, sf_dir)
    return oversized_chunks(lineitem_per_chunk(spark, sf_dir, chunks), MAX_DOCS)


SUPPLIER_SPLITS_SQL = """
  SELECT r_name AS shard, s_suppkey AS split_key FROM supplier
  JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""


def refined_sql(splits: str) -> str:
    bounds = f"""(
  SELECT max_key, shard FROM {PART_CHUNKS_SQL}
  UNION
  SELECT s.split_key, s.shard FROM ({splits}) s
  JOIN {PART_CHUNKS_SQL} c ON s.shard = c.shard AND {in_chunk_sql('s.split_key')}
    AND (c.min_key IS NULL OR s.split_key > c.min_key))"""
    return ranges_sql(bounds)[1:-1]


@query("refine_chunks", sql=refined_sql(SUPPLIER_SPLITS_SQL))
def chunk_refinement(spark, sf_dir):
    supplier = table(spark, sf_dir, "supplier")
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    splits = (
        supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .select(F.col("r_name").alias("shard"), F.col("s_suppkey").alias("split_key"))
    )
    return refine_chunks(part_chunks(spark, sf_dir), splits)


ROW_BYTES = 100
REFINE_BYTES = 200_000
POLICY_SPLITS_SQL = f"""
  SELECT shard, min(l_partkey) AS split_key FROM (
    SELECT shard, l_partkey,
      (sum(n) OVER (PARTITION BY shard ORDER BY l_partkey) - n)::BIGINT // {REFINE_BYTES} AS no
    FROM (
      SELECT c.shard, l_partkey, count(*) * {ROW_BYTES} AS n
      FROM lineitem JOIN {PART_CHUNKS_SQL} c ON {in_chunk_sql('l_partkey')}
      WHERE c.shard IN (
        SELECT shard FROM {PART_CHUNKS_SQL} p LEFT JOIN {PER_CHUNK_SQL} USING (chunk_id)
        GROUP BY shard HAVING coalesce(sum(n_docs), 0)::BIGINT // count(*) > {MAX_DOCS})
      GROUP BY c.shard, l_partkey))
  WHERE no > 0 GROUP BY shard, no"""


@query(sql=refined_sql(POLICY_SPLITS_SQL))
def split_policy_auto(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem").select("l_partkey")
    size = F.lit(ROW_BYTES).cast("bigint")
    chunks = part_chunks(spark, sf_dir)
    return plan_source_chunks(lineitem, chunks, "l_partkey", size, "auto", MAX_DOCS, REFINE_BYTES)


@query("chunk_counts", sql=f"SELECT shard, count(*) AS n_chunks FROM {PART_CHUNKS_SQL} GROUP BY shard")
def chunks_per_shard(spark, sf_dir):
    return chunk_counts(part_chunks(spark, sf_dir))


MINIMUM = 2


@query(
    sql=f"""
SELECT n_name AS shard, count(chunk_id) AS n_chunks
FROM nation LEFT JOIN {ranges_sql(NATION_BOUNDS_SQL)} c ON n_name = c.shard
GROUP BY n_name HAVING count(chunk_id) < {MINIMUM}
"""
)
def min_chunks(spark, sf_dir):
    chunks = chunk_ranges(nation_bounds(spark, sf_dir))
    return short_of_chunks(chunks, shard_table(spark, sf_dir), MINIMUM)


TAG_RANGES_SQL = """(
  SELECT r_name AS tag, min_key, CASE WHEN next_key IS NOT NULL THEN next_key - 1 END AS max_key
  FROM (SELECT r_name, min_key, lead(min_key) OVER (ORDER BY min_key) AS next_key FROM (
    SELECT r_name, min(s_suppkey) AS min_key FROM supplier
    JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    GROUP BY r_name))
  WHERE next_key IS NULL OR next_key - 1 > min_key)"""


def tag_ranges(spark, sf_dir):
    """A range per region, from its first supplier to just below the next region's first."""
    from pyspark.sql import Window

    supplier = table(spark, sf_dir, "supplier")
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    first = (
        supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .groupBy(F.col("r_name").alias("tag"))
        .agg(F.min("s_suppkey").alias("min_key"))
    )
    following = F.lead("min_key").over(Window.orderBy("min_key"))
    ranges = first.select("tag", "min_key", (following - 1).alias("max_key"))
    return ranges.where("max_key IS NULL OR max_key > min_key")


@query(
    "tag_violations",
    sql=f"""
SELECT DISTINCT c.chunk_id, c.min_key, c.max_key, c.shard, t.tag
FROM {ranges_sql(NATION_BOUNDS_SQL)} c JOIN {TAG_RANGES_SQL} t
  ON (c.max_key IS NULL OR t.min_key < c.max_key)
 AND (t.max_key IS NULL OR c.min_key IS NULL OR c.min_key < t.max_key)
WHERE NOT EXISTS (
  SELECT 1 FROM nation JOIN region ON n_regionkey = r_regionkey
  WHERE n_name = c.shard AND r_name = t.tag)
"""
)
def misplaced_by_tag(spark, sf_dir):
    chunks = chunk_ranges(nation_bounds(spark, sf_dir))
    return tag_violations(chunks, tag_ranges(spark, sf_dir), shard_table(spark, sf_dir))


@query(
    "layout_report",
    sql=f"""
SELECT c.chunk_id, c.min_key, c.max_key, c.shard, r_name AS tag,
  coalesce(n_docs, 0) AS n_docs, coalesce(n_bytes, 0) AS n_bytes
FROM {ranges_sql(NATION_BOUNDS_SQL)} c
LEFT JOIN nation ON n_name = c.shard LEFT JOIN region ON n_regionkey = r_regionkey
LEFT JOIN (
  SELECT d.chunk_id, count(*) AS n_docs, sum(octet_length(encode(text)))::BIGINT AS n_bytes
  FROM documents JOIN {ranges_sql(NATION_BOUNDS_SQL)} d ON {in_chunk_sql('doc_id', 'd')}
  GROUP BY d.chunk_id) USING (chunk_id)
"""
)
def cluster_report(spark, sf_dir):
    chunks = chunk_ranges(nation_bounds(spark, sf_dir))
    documents = table(spark, sf_dir, "documents").select("doc_id", F.octet_length("text").alias("n"))
    per_chunk = docs_per_chunk(route(documents, chunks, "doc_id"), F.col("n"))
    return layout_report(chunks, shard_table(spark, sf_dir), per_chunk)


RANGE_BYTES = 50_000
RANGE_CHUNKS_SQL = f"""(
  SELECT chunk_id, min_key, max_key,
    {REGIONS_SQL}[CASE WHEN k = 0 THEN 1 ELSE (k - 1) % len({REGIONS_SQL}) + 1 END] AS shard
  FROM (SELECT *, max(chunk_id) OVER () - chunk_id AS k FROM {ranges_sql(f'''(
    SELECT min(o_custkey) AS max_key, '' AS shard FROM (
      SELECT o_custkey, (sum(n) OVER (ORDER BY o_custkey) - n)::BIGINT // {RANGE_BYTES} AS no
      FROM (SELECT o_custkey, count(*) * {ROW_BYTES} AS n FROM orders GROUP BY o_custkey))
    WHERE no > 0 GROUP BY no UNION ALL SELECT NULL, '')''')}))"""


@query(sql=f"SELECT * FROM {RANGE_CHUNKS_SQL}")
def range_presplit(spark, sf_dir):
    regions = names(table(spark, sf_dir, "region"), "r_name")
    orders, size = table(spark, sf_dir, "orders").select("o_custkey"), F.lit(ROW_BYTES).cast("bigint")
    return range_chunks(orders, [("o_custkey", "asc")], size, regions, RANGE_BYTES)


@query(
    sql=f"""
SELECT shard, count(*) AS n_chunks, sum(n_docs)::BIGINT AS n_docs FROM (
  SELECT chunk_id, {hash_shard_sql('chunk_id', 50, SHARDS_SQL)} AS shard, count(*) AS n_docs
  FROM {routed_sql('events', 'user_id', 50)} GROUP BY chunk_id) GROUP BY shard
"""
)
def shard_load(spark, sf_dir):
    """Documents and non-empty chunks per shard for a skewed key."""
    shards = names(shard_table(spark, sf_dir))
    events = hashed(table(spark, sf_dir, "events").select("user_id"), "user_id")
    per_chunk = docs_per_chunk(route_hash(events, 50, "key_hash"))
    placed = per_chunk.join(hash_chunks(spark, 50, shards), CHUNK)
    return placed.groupBy("shard").agg(
        F.count("*").alias("n_chunks"), F.sum("n_docs").alias("n_docs")
    )
