"""Verification queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkroute.functions.fingerprint import fingerprint as content_of
from sparkroute.operators.routing import CHUNK, route_hash
from sparkroute.operators.verify import compare_counts, diff_rows
from sparkroute.operators.verify import reconcile as reconcile_counts
from sparkroute.plans.jobs import dump, load, reshard, restore
from sparkroute.queries.registry import names, query, routed_sql, shard_table, table
from sparkroute.queries.routing import hashed
from sparkroute.queries.sinks import PER_SHARD
from sparkroute.session import freeze, scratch_dir
from sparkroute.sinks.tables import read_chunk_table

CHUNKS = 10


def cents(spark, sf_dir):
    """Orders with money as whole cents, so that both engines print it alike."""
    orders = table(spark, sf_dir, "orders")
    whole = F.round(F.col("o_totalprice") * 100).cast("bigint")
    return orders.withColumn("o_totalprice", whole)


CENTS_SQL = """(SELECT o_orderkey, o_custkey, o_orderstatus,
  round(o_totalprice * 100)::BIGINT AS o_totalprice, o_orderdate, o_orderpriority FROM orders)"""
COLUMNS = ["o_custkey", "o_orderdate", "o_orderkey", "o_orderpriority", "o_orderstatus", "o_totalprice"]
TEXT_SQL = " || ".join(f"length({c}::VARCHAR) || ':' || {c}::VARCHAR" for c in COLUMNS)
CONTENT_SQL = f"sum(('0x' || substr(md5({TEXT_SQL}), 1, 15))::BIGINT)::VARCHAR"


@query(
    sql=f"""
SELECT chunk_id, count(*) AS n_rows, {CONTENT_SQL} AS content
FROM {routed_sql(CENTS_SQL, 'o_orderkey', CHUNKS)} GROUP BY chunk_id
"""
)
def fingerprint(spark, sf_dir):
    orders = cents(spark, sf_dir)
    routed = route_hash(hashed(orders, "o_orderkey"), CHUNKS, "key_hash")
    found = content_of(routed, [CHUNK], orders.columns)
    return found.withColumn("content", F.col("content").cast("string"))


@query(
    sql=f"""
SELECT chunk_id, count(*) AS n_source, count(*) FILTER (o_orderstatus <> 'P') AS n_copy,
  count(*) = count(*) FILTER (o_orderstatus <> 'P') AS equal
FROM {routed_sql('orders', 'o_custkey', CHUNKS)} GROUP BY chunk_id
"""
)
def verify_counts(spark, sf_dir):
    """Counts per chunk of a copy that lost some rows."""
    orders = hashed(table(spark, sf_dir, "orders"), "o_custkey")
    routed = route_hash(orders.select("o_orderstatus", "key_hash"), CHUNKS, "key_hash")
    return compare_counts(routed, routed.where("o_orderstatus <> 'P'"), [CHUNK])


@query(
    "diff_rows",
    sql="""
SELECT o_custkey, o_orderstatus, 'source only' AS side, count(*) AS n_rows
FROM orders WHERE o_orderstatus <> 'O' GROUP BY ALL
UNION ALL
SELECT o_custkey, 'F+', 'copy only', count(*) FROM orders WHERE o_orderstatus = 'F' GROUP BY ALL
"""
)
def changed_rows(spark, sf_dir):
    """Differences to a copy that lost one status and changed another."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus")
    status = F.when(F.col("o_orderstatus") == "F", F.lit("F+")).otherwise(F.col("o_orderstatus"))
    copy = orders.where("o_orderstatus <> 'P'").withColumn("o_orderstatus", status)
    return diff_rows(orders, copy)


@query(
    sql="""
SELECT count(*) AS rows_in, count(*) FILTER (o_orderstatus <> 'P') AS rows_out,
  count(*) FILTER (o_orderstatus = 'P') AS rows_quarantined, true AS complete FROM orders
"""
)
def reconcile(spark, sf_dir):
    """A load that puts rows without a key aside: in = out + quarantined, read back."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    keyed = orders.withColumn("o_custkey", F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")))
    target, aside = scratch_dir(spark, "loaded"), scratch_dir(spark, "quarantine")
    shards = names(shard_table(spark, sf_dir))
    load(keyed, target, {"o_custkey": "hashed"}, shards, PER_SHARD, quarantine=aside)
    return reconcile_counts(keyed, read_chunk_table(spark, target), spark.read.parquet(aside))


@query(
    "roundtrip",
    sql=f"""
WITH total AS (SELECT count(*) AS n_rows, {CONTENT_SQL} AS content FROM {CENTS_SQL})
SELECT step, n_rows, content, 0::BIGINT AS n_diff FROM total,
  (VALUES ('loaded'), ('resharded'), ('back'), ('restored')) AS steps(step)
"""
)
def round_trip(spark, sf_dir):
    """Reshard there and back, dump and restore: every copy has the source's content."""
    source = cents(spark, sf_dir)
    names_of = ("loaded", "resharded", "back", "dump", "restored")
    paths = {name: scratch_dir(spark, name) for name in names_of}
    shards = names(shard_table(spark, sf_dir))
    options = {"shards": shards, "chunks_per_shard": PER_SHARD}
    by_order, by_customer = {"o_orderkey": "hashed"}, {"o_custkey": "hashed"}

    load(source, paths["loaded"], by_order, **options)
    reshard(read_chunk_table(spark, paths["loaded"]), paths["resharded"], by_customer, **options)
    reshard(read_chunk_table(spark, paths["resharded"]), paths["back"], by_order, **options)
    dump(read_chunk_table(spark, paths["back"]), paths["dump"], by_order, 16)
    restore(spark, paths["dump"], paths["restored"], by_order, **options)

    columns, result = source.columns, None
    source = freeze(source)
    for name in ("loaded", "resharded", "back", "restored"):
        copy = read_chunk_table(spark, paths[name]).select(*columns)
        content = content_of(copy, columns=columns).withColumn("step", F.lit(name))
        diff = diff_rows(source, copy).agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_diff"))
        row = content.join(diff.withColumn("step", F.lit(name)), "step")
        result = row if result is None else result.union(row)
    return result.withColumn("content", F.col("content").cast("string"))
