import bisect as py_bisect
import random
import re

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from sparkroute.functions.hashing import INT64_MAX, hash_column
from sparkroute.operators.routing import hash_shard, lookup, route, route_hash
from sparkroute.plans.chunks import chunk_ranges, chunks_from_splits, hash_chunks


def edge_hashes(n):
    step = INT64_MAX // n * 2
    bounds = [INT64_MAX - k * step for k in range(1, n)]
    near = [b + d for b in bounds for d in (-1, 0, 1)]
    return near + [INT64_MAX, INT64_MAX - 1, -(2**63), -(2**63) + 1, 0, -1, 1]


@pytest.mark.parametrize("n", [1, 2, 3, 7, 10, 64, 1000])
def test_closed_form_equals_bisection(spark, n):
    values = [(h,) for h in edge_hashes(n)]
    df = route_hash(spark.createDataFrame(values, "h bigint"), n, "h", "closed")
    df = route(df, hash_chunks(spark, n, ["a", "b", "c"]), "h", "searched")
    step = INT64_MAX // n * 2
    bounds = sorted(INT64_MAX - k * step for k in range(1, n))
    for r in df.collect():
        assert r.closed == r.searched == py_bisect.bisect_right(bounds, r.h)


def test_null_hash_has_no_chunk(spark):
    df = spark.createDataFrame([(None,)], "h bigint")
    for n in (1, 2, 10):
        assert route_hash(df, n, "h").first().chunk_id is None


@pytest.mark.parametrize("inline", [2, 4, 33, 100, 1024])
def test_many_chunks(spark, inline):
    random.seed(3)
    splits = random.sample(range(10_000), 100)
    keys = list(range(0, 10_000, 7))
    chunks = chunks_from_splits(spark.createDataFrame([(s,) for s in splits], "k int"), "k", "s")
    df = route(spark.createDataFrame([(k,) for k in keys], "k int"), chunks, "k", max_inline=inline)
    bounds = sorted(splits)
    got = {r.k: r.chunk_id for r in df.collect()}
    assert got == {k: py_bisect.bisect_right(bounds, k) for k in keys}


@pytest.mark.parametrize("inline", [2, 1024])
def test_compound_key_with_directions(spark, inline):
    fields = [("a", "desc"), ("b", "asc")]
    rows = [(a, b) for a in range(6) for b in range(6)]
    df = spark.createDataFrame(rows, "a int, b int")
    cut = [(4, 2), (4, 5), (1, 0)]
    bounds = spark.createDataFrame([((a, b), "s") for a, b in cut] + [(None, "s")], "max_key struct<a:int,b:int>, shard string")
    chunks = chunk_ranges(bounds, fields)
    order = sorted((-a, b) for a, b in cut)
    for r in route(df, chunks, fields, max_inline=inline).collect():
        assert r.chunk_id == py_bisect.bisect_right(order, (-r.a, r.b))


def test_text_and_date_keys(spark):
    words = ["", "a", "b'\"\\", "ä", "zz", "€,x"]
    splits = spark.createDataFrame([(w,) for w in words[1:]], "w string")
    chunks = chunks_from_splits(splits, "w", "s")
    bounds = sorted(words[1:], key=lambda w: w.encode())
    for r in route(splits, chunks, "w").collect():
        assert r.chunk_id == bounds.index(r.w) + 1
    days = spark.sql("SELECT explode(sequence(date'2020-01-01', date'2020-01-09')) AS d")
    chunks = chunks_from_splits(days.where("day(d) IN (3, 6)"), "d", "s")
    assert [r.chunk_id for r in route(days, chunks, "d").orderBy("d").collect()] == [0, 0, 1, 1, 1, 2, 2, 2, 2]


def test_routing_neither_joins_nor_shuffles(spark, load_table):
    orders = load_table("orders")
    hashed = orders.withColumn("h", hash_column(orders, "o_orderkey"))
    closed = plan_of(route_hash(hashed, 100, "h"))
    searched = plan_of(route(hashed, hash_chunks(spark, 100, ["a"]), "h").where("chunk_id = 7"))
    for plan in (closed, searched):
        assert "Join" not in plan and "Exchange" not in plan and "Python" not in plan


def test_millions_of_text_bounds(spark):
    """Three levels of fences; the rows are not exchanged, and every level is generated code."""
    n = 5_000_000
    text = lambda c: F.lpad(c.cast("string"), 12, "0")
    bounds = spark.range(n).select(F.col("id").alias("chunk_id"), text((F.col("id") + 1) * 10).alias("max_key"))
    chunks = bounds.union(spark.range(1).select(F.lit(n).cast("bigint"), F.lit(None).cast("string")))
    keys = [0, 9, 10, 11, 10_239, 10_240, 10_250, 24_999_995, 49_999_999, 50_000_000, 50_000_001]
    rows = spark.createDataFrame([(k,) for k in keys], "k bigint").withColumn("key", text(F.col("k")))
    routed = route(rows, chunks, "key")
    assert {r.k: r.chunk_id for r in routed.collect()} == {k: min(k // 10, n) for k in keys}
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # stages of generated code are marked before the run then
    try:
        plan = plan_of(routed.where("chunk_id > 5"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    rows_side = re.split(r"\n[ :]*\+- BroadcastExchange", plan)[0]
    lines = [line for line in rows_side.splitlines() if re.search(r"(Project|Generate|Filter|BroadcastHashJoin) ", line)]
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan and "lambda" not in rows_side
    assert len(lines) > 20 and all(re.search(r"\*\(\d+\) ", line) for line in lines)
    assert not re.search(r"^[ :]*\+?-? ?Exchange", rows_side, re.M)


def test_filter_on_a_searched_chunk(spark, load_table):
    orders = load_table("orders")
    chunks = chunks_from_splits(orders.where("o_orderkey < 100"), "o_orderkey", "s")
    routed = route(orders, chunks, "o_orderkey")
    assert routed.where("chunk_id = 100").count() == orders.where("o_orderkey >= 99").count()


def test_placement_and_lookup(spark):
    shards = ["b", "a", "c"]
    chunks = hash_chunks(spark, 7, shards)
    got = [r.shard for r in chunks.orderBy("chunk_id").collect()]
    # top chunk on the first shard, then downwards in turn from the first again
    assert got == ["c", "b", "a", "c", "b", "a", "a"]
    shard = hash_shard(F.col("chunk_id"), 7, shards)
    assert chunks.where(~shard.eqNullSafe(F.col("shard"))).count() == 0
    bounds = chunks.select(F.col("max_key").alias("bound")).union(spark.createDataFrame([(5,)], "bound bigint"))
    found, unknown = lookup(bounds, chunks, "bound")
    assert found.count() == 7 and [r.bound for r in unknown.collect()] == [5]
