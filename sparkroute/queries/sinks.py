"""Sink queries: write to a fresh folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkroute.operators.routing import CHUNK
from sparkroute.operators.small import broadcast_if_small
from sparkroute.operators.unique import duplicate_keys, keep_first, not_existing, set_aside
from sparkroute.plans.chunks import chunk_ranges
from sparkroute.plans.jobs import load
from sparkroute.queries.registry import names, query, routed_sql, shard_table, table
from sparkroute.session import scratch_dir
from sparkroute.sinks.stats import read_stats
from sparkroute.sinks.manifest import run_folder
from sparkroute.sinks.tables import catalog_report, read_chunk_table, read_layout, write_chunks
from sparkroute.streaming.load import read_file_stream, stream_load

PER_SHARD = 2
N_CHUNKS = 50  # two chunks on each of the 25 nations

ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]
ORDERS_SQL = ", ".join(ORDER_COLUMNS)


def orders_of(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(*ORDER_COLUMNS)


@query(
    sql=f"SELECT {ORDERS_SQL}, chunk_id FROM {routed_sql('orders', 'o_orderkey', N_CHUNKS)}"
)
def load_append(spark, sf_dir):
    """Open orders first, then the others, into the same table."""
    orders, target = orders_of(spark, sf_dir), scratch_dir(spark, "append")
    shards = names(shard_table(spark, sf_dir))
    key = {"o_orderkey": "hashed"}
    for part in (orders.where("o_orderstatus = 'O'"), orders.where("o_orderstatus <> 'O'")):
        load(part, target, key, shards, PER_SHARD)
    return read_chunk_table(spark, target).withColumn(CHUNK, F.col(CHUNK).cast("bigint"))


@query(
    sql=f"SELECT {ORDERS_SQL}, chunk_id FROM {routed_sql('orders', 'o_custkey', N_CHUNKS)}"
)
def load_overwrite(spark, sf_dir):
    orders, target = orders_of(spark, sf_dir), scratch_dir(spark, "overwrite")
    shards = names(shard_table(spark, sf_dir))
    load(orders, target, {"o_orderkey": "hashed"}, shards, PER_SHARD)
    load(orders, target, {"o_custkey": "hashed"}, shards, PER_SHARD, mode="overwrite")
    return read_chunk_table(spark, target).withColumn(CHUNK, F.col(CHUNK).cast("bigint"))


@query(
    sql="""
SELECT l_orderkey, l_linenumber, count(*) AS n_rows
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
"""
)
def dup_keys(spark, sf_dir):
    return duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_ORDER = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
FIRST_SQL = f"""row_number() OVER (PARTITION BY {', '.join(LINE_KEY)}
  ORDER BY {', '.join(LINE_ORDER)}, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate)"""


@query(
    sql=f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice
FROM (SELECT *, {FIRST_SQL} AS n FROM lineitem) WHERE n = 1
"""
)
def dedup_first(spark, sf_dir):
    first = keep_first(table(spark, sf_dir, "lineitem"), LINE_KEY, LINE_ORDER)
    return first.select(*LINE_KEY, *LINE_ORDER)


@query(
    sql=f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
  'duplicate key' AS reason, sum(n_rows)::BIGINT AS n_rows
FROM (
  SELECT * EXCLUDE (n), count(*) AS n_rows
  FROM (SELECT *, {FIRST_SQL} AS n FROM lineitem) WHERE n > 1 GROUP BY ALL)
GROUP BY ALL
"""
)
def dup_quarantine(spark, sf_dir):
    _, rest = set_aside(table(spark, sf_dir, "lineitem"), LINE_KEY, LINE_ORDER)
    few = rest.groupBy(*LINE_KEY, *LINE_ORDER, "reason")
    return few.agg(F.sum("n_rows").alias("n_rows"))


@query(sql="SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def anti_existing(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return not_existing(documents, table(spark, sf_dir, "labels"), ["doc_id"])


@query(
    sql=f"""
SELECT 'table' AS input_type, 'o_orderkey:hashed' AS shard_key, {N_CHUNKS}::BIGINT AS chunks,
  count(*) AS rows_in, count(*) AS rows_out, 'nightly' AS note FROM orders
"""
)
def run_stats(spark, sf_dir):
    target, stats = scratch_dir(spark, "stats-table"), scratch_dir(spark, "stats")
    shards = names(shard_table(spark, sf_dir))
    key = {"o_orderkey": "hashed"}
    load(orders_of(spark, sf_dir), target, key, shards, PER_SHARD, stats=stats, note="nightly")
    return read_stats(spark, stats).select(
        "input_type", "shard_key", "chunks", "rows_in", "rows_out", "note"
    )


@query(sql=f"SELECT {ORDERS_SQL}, true AS inside FROM orders")
def append_range_twice(spark, sf_dir):
    """Two appends under a range key: the second one obeys the chunks that the first one stored."""
    orders, target = orders_of(spark, sf_dir), scratch_dir(spark, "append-range")
    shards = names(shard_table(spark, sf_dir))
    for part in (orders.where("o_custkey % 2 = 0"), orders.where("o_custkey % 2 = 1")):
        load(part, target, {"o_custkey": 1}, shards, max_bytes=20_000)
    layout, _ = read_layout(spark, target)
    rows = read_chunk_table(spark, target).join(broadcast_if_small(layout.drop("shard")), CHUNK)
    inside = F.coalesce(F.expr("o_custkey >= min_key"), F.lit(True)) & F.coalesce(F.expr("o_custkey < max_key"), F.lit(True))
    return rows.select(*ORDER_COLUMNS, inside.alias("inside"))


@query(
    sql=f"""
SELECT {ORDERS_SQL}, NULL::VARCHAR AS reason FROM orders
UNION ALL SELECT {ORDERS_SQL}, 'key exists' FROM orders WHERE o_orderkey % 3 = 0
"""
)
def unique_existing_quarantine(spark, sf_dir):
    """Keys that the target has already are set aside, not doubled."""
    orders = orders_of(spark, sf_dir)
    target, aside = scratch_dir(spark, "unique"), scratch_dir(spark, "unique-aside")
    shards = names(shard_table(spark, sf_dir))
    for part in (orders.where("o_orderkey % 3 = 0"), orders):
        load(part, target, {"o_orderkey": 1}, shards, unique="quarantine", quarantine=aside)
    kept = read_chunk_table(spark, target).select(*ORDER_COLUMNS, F.lit(None).cast("string").alias("reason"))
    return kept.union(spark.read.parquet(aside).select(*ORDER_COLUMNS, "reason"))


@query(
    "catalog_report",
    sql=f"""
SELECT * FROM (VALUES ('by-customer', 3, '[["o_custkey", "asc"]]', 2), ('by-order', 2, '[["o_orderkey", "hashed"]]', 1))
  AS t(name, version, shard_key, runs)
  JOIN (SELECT 'by-order' AS name, {N_CHUNKS}::BIGINT AS chunks, count(*) AS shards FROM nation
    UNION ALL SELECT 'by-customer', 3, 2) USING (name)
"""
)
def catalog_of_tables(spark, sf_dir):
    """The versions of two tables: one that was appended to in parts, one that was loaded anew."""
    orders, folder = orders_of(spark, sf_dir), scratch_dir(spark, "catalog")
    shards = names(shard_table(spark, sf_dir))
    splits = spark.createDataFrame([(10, "a"), (100, "b"), (None, "a")], "max_key bigint, shard string")
    chunks = chunk_ranges(splits)
    halves = (orders.where("o_custkey % 2 = 0"), orders.where("o_custkey % 2 = 1"))
    load(halves[0], f"{folder}/by-customer", {"o_custkey": 1}, chunks=chunks)
    for run in ("first", "second", "second"):  # a run that is there already is not loaded again
        load(halves[1], f"{folder}/by-customer", {"o_custkey": 1}, run=run, mode="append" if run == "second" else "overwrite", chunks=chunks)
    for mode in ("append", "overwrite"):
        load(orders, f"{folder}/by-order", {"o_orderkey": "hashed"}, shards, PER_SHARD, mode=mode)
    report = catalog_report(spark, folder)
    return report.select("name", F.col("version").cast("int").alias("version"), "shard_key", F.col("runs").cast("int").alias("runs"), "chunks", "shards")


@query(
    sql="""
SELECT o_orderstatus, count(*) AS n_rows, sum(o_custkey)::BIGINT AS keys, true AS refused FROM orders
WHERE o_orderstatus <> 'P' GROUP BY o_orderstatus
"""
)
def append_unknown_refused(spark, sf_dir):
    """Rows whose key and chunks nobody knows are not mixed with others: the folder stays as it was."""
    orders, target = orders_of(spark, sf_dir), scratch_dir(spark, "foreign")
    write_chunks(orders.where("o_orderstatus <> 'P'").withColumn(CHUNK, F.lit(0)), target)
    refused = False
    try:
        load(orders.where("o_orderstatus = 'P'"), target, {"o_orderkey": "hashed"})
    except ValueError:
        refused = True
    kept = read_chunk_table(spark, target).groupBy("o_orderstatus")
    return kept.agg(F.count("*").alias("n_rows"), F.sum("o_custkey").alias("keys"), F.lit(refused).alias("refused"))


@query(sql="SELECT event_id, user_id, event_type, true AS inside FROM events WHERE event_type <> 'view'")
def stream_into_loaded(spark, sf_dir):
    """A stream into a table that was loaded before obeys its chunks; a run that was never committed is not read."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    target, source = scratch_dir(spark, "loaded"), scratch_dir(spark, "arriving")
    load(events.where("event_type = 'click'"), target, {"event_id": 1}, ["a", "b"], max_bytes=20_000)
    events.where("event_type NOT IN ('click', 'view')").write.parquet(source)
    stream = read_file_stream(spark, source, events.schema)
    stream_load(stream, target, {"event_id": 1}, scratch_dir(spark, "checkpoint")).awaitTermination()
    killed = events.where("event_type = 'view'").withColumn(CHUNK, F.lit(0))
    write_chunks(killed, run_folder(target, "killed"))
    layout, _ = read_layout(spark, target)
    rows = read_chunk_table(spark, target).join(broadcast_if_small(layout.drop("shard")), CHUNK)
    inside = F.coalesce(F.expr("event_id >= min_key"), F.lit(True)) & F.coalesce(F.expr("event_id < max_key"), F.lit(True))
    return rows.select("event_id", "user_id", "event_type", inside.alias("inside"))
