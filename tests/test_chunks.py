import pytest
from pyspark.sql import functions as F

from sparkroute.functions.hashing import INT64_MAX
from sparkroute.operators.routing import route
from sparkroute.plans.chunks import (
    chunk_counts,
    chunk_ranges,
    chunk_total,
    chunks_from_splits,
    docs_per_chunk,
    hash_chunks,
    oversized_shards,
    place_round_robin,
    refine_chunks,
    short_of_chunks,
    tag_violations,
    unordered_bounds,
)
from sparkroute.plans.splits import plan_source_chunks, range_chunks, size_splits


@pytest.mark.parametrize("n", [1, 2, 10, 64, 1000])
def test_presplit_bounds(spark, n):
    chunks = hash_chunks(spark, n, ["a", "b"]).orderBy("chunk_id").collect()
    step = INT64_MAX // n * 2
    assert [c.max_key for c in chunks] == [INT64_MAX - k * step for k in range(n - 1, 0, -1)] + [None]
    assert [c.min_key for c in chunks] == [None] + [c.max_key for c in chunks[:-1]]


def test_chunk_total():
    assert chunk_total(["a", "b", "c"]) == 30
    with pytest.raises(ValueError):
        chunk_total(["a"], 0)


def test_broken_tables_are_found(spark):
    sound = hash_chunks(spark, 10, ["a"])
    assert unordered_bounds(sound).count() == 0
    gap = sound.withColumn("min_key", F.when(F.col("chunk_id") != 4, F.col("min_key")))
    assert [r.chunk_id for r in unordered_bounds(gap).collect()] == [4]
    bounds = spark.createDataFrame([(5, "s"), (5, "s"), (None, "s")], "max_key int, shard string")
    assert unordered_bounds(chunk_ranges(bounds)).count() == 1


def test_splits_with_copies(spark):
    splits = spark.createDataFrame([(5,), (2,), (5,), (None,)], "k int")
    rows = chunks_from_splits(splits, "k", "s").orderBy("chunk_id").collect()
    assert [(r.min_key, r.max_key) for r in rows] == [(None, 2), (2, 5), (5, None)]


def make_chunks(spark, bounds):
    return chunk_ranges(spark.createDataFrame(bounds, "max_key int, shard string"))


def test_refinement_ignores_edges_and_strays(spark):
    chunks = make_chunks(spark, [(10, "a"), (20, "b"), (None, "a")])
    splits = [("a", 5), ("a", 15), ("b", 10), ("b", 12), ("a", 20), ("a", 30), ("a", 5)]
    refined = refine_chunks(chunks, spark.createDataFrame(splits, "shard string, split_key int"))
    rows = refined.orderBy("chunk_id").collect()
    assert [(r.max_key, r.shard) for r in rows] == [
        (5, "a"), (10, "a"), (12, "b"), (20, "b"), (30, "a"), (None, "a"),
    ]
    assert unordered_bounds(refined).count() == 0


def test_counts_and_minimum(spark):
    chunks = make_chunks(spark, [(10, "a"), (20, "b"), (None, "a")])
    shards = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "y")], "shard string, tag string")
    assert {r.shard: r.n_chunks for r in chunk_counts(chunks).collect()} == {"a": 2, "b": 1}
    short = {r.shard: r.n_chunks for r in short_of_chunks(chunks, shards, 2).collect()}
    assert short == {"b": 1, "c": 0}


def test_tags(spark):
    chunks = make_chunks(spark, [(10, "a"), (20, "b"), (None, "c")])
    shards = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "y")], "shard string, tag string")
    ranges = spark.createDataFrame([(0, 15, "x"), (18, 25, "y")], "min_key int, max_key int, tag string")
    found = {(r.chunk_id, r.tag) for r in tag_violations(chunks, ranges, shards).collect()}
    assert found == {(1, "y")}


def brute_splits(sizes, limit):
    """First key of each stretch, from exact running sums over sorted (key, bytes)."""
    total, found = 0, {}
    for key in sorted(sizes):
        found.setdefault(total // limit, key)
        total += sizes[key]
    return {no: key for no, key in found.items() if no > 0}


@pytest.mark.parametrize("partitions", [1, 5])
def test_size_splits_with_a_hot_key(spark, partitions):
    rows = [(7, 10)] * 3000 + [(k, k % 13) for k in range(500)]
    df = spark.createDataFrame(rows, "k int, n bigint").repartition(6)
    splits = size_splits(df, [("k", "asc")], F.col("n"), 1000, partitions=partitions)
    sizes = {}
    for k, n in rows:
        sizes[k] = sizes.get(k, 0) + n
    assert {r.chunk_no: r.split_key for r in splits.collect()} == brute_splits(sizes, 1000)


def test_split_policies(spark):
    df = spark.createDataFrame([(k % 100,) for k in range(2000)], "k int")
    chunks = make_chunks(spark, [(90, "a"), (None, "b")])
    size = F.lit(1).cast("bigint")

    def plan(policy, max_docs, max_bytes=300):
        return plan_source_chunks(df, chunks, "k", size, policy, max_docs, max_bytes)

    assert plan("none", 1).count() == 2
    assert plan("auto", 10_000).count() == 2
    refined = plan("auto", 500).orderBy("chunk_id").collect()
    assert [r.shard for r in refined] == ["a"] * 6 + ["b"]
    assert plan("force", 10_000, 100).count() > 7
    with pytest.raises(ValueError, match="no split key"):
        plan("force", 1, 10**9)
    with pytest.raises(ValueError, match="bad split policy"):
        plan("sometimes", 1)


def test_oversized_uses_whole_division(spark):
    chunks = make_chunks(spark, [(10, "a"), (20, "b"), (None, "a")])
    df = spark.createDataFrame([(k,) for k in [1] * 7 + [11] * 4 + [25] * 4], "k int")
    per_chunk = docs_per_chunk(route(df, chunks, "k"))
    assert oversized_shards(per_chunk, chunks, 5).count() == 0
    assert sorted(r.shard for r in oversized_shards(per_chunk, chunks, 4).collect()) == ["a"]
    assert oversized_shards(per_chunk, chunks, 99, "force").count() == 2


def test_range_chunks_hold_about_the_limit(spark, load_table):
    orders = load_table("orders").select("o_custkey", "o_orderkey")
    fields = [("o_custkey", "desc"), ("o_orderkey", "asc")]
    chunks = range_chunks(orders, fields, F.lit(10).cast("bigint"), ["b", "a"], 1000)
    counts = [r.n_docs for r in docs_per_chunk(route(orders, chunks, fields)).collect()]
    assert sum(counts) == 1500 and max(counts) == 100
    top = chunks.orderBy(F.desc("chunk_id")).first()
    assert top.shard == "a" and top.max_key is None


def test_round_robin(spark):
    chunks = make_chunks(spark, [(1, "z"), (2, "z"), (3, "z"), (None, "z")])
    placed = place_round_robin(chunks, ["b", "a"]).orderBy("chunk_id").collect()
    assert [r.shard for r in placed] == ["a", "b", "a", "a"]


def test_a_large_table_is_numbered_alike(spark, monkeypatch):
    bounds = [(k * 3, "ab"[k % 2]) for k in range(500)] + [(None, "a")]
    small = make_chunks(spark, bounds)
    monkeypatch.setattr("sparkroute.plans.chunks.is_small", lambda df: False)
    large = make_chunks(spark, bounds)
    assert large.count() == 501 and large.exceptAll(small).count() == 0
    assert unordered_bounds(large).count() == 0


@pytest.mark.parametrize("partitions", [1, 5])
def test_size_splits_like_one_running_sum(spark, partitions):
    """Groups that lie scattered over the placed partitions, null keys and null sizes."""
    rows = [(f"g{(i * 7) % 3}" if i % 11 else None, (i * 37) % 101 or None, None if i % 13 == 0 else i % 50) for i in range(1000)]
    df = spark.createDataFrame(rows, "g string, k int, n long")
    got = {(r.g, r.chunk_no): r.split_key for r in size_splits(df, [("k", "asc")], F.col("n"), 900, "g", partitions).collect()}
    expected, totals = {}, {}
    for g, k, n in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
        totals.setdefault((g, k), 0)
        totals[g, k] += n or 0
    before = {}
    for (g, k), n in totals.items():
        at = before.get(g, 0)
        if at // 900 > 0:
            expected.setdefault((g, at // 900), k)
        before[g] = at + n
    assert {key: v for key, v in got.items() if key[0]} == {key: v for key, v in expected.items() if key[0]}


@pytest.mark.parametrize("limit", [32 << 20, 0])
def test_split_policy_reads_the_rows_once(spark, monkeypatch, limit):
    monkeypatch.setattr("sparkroute.plans.splits.BROADCAST_BYTES", limit)
    seen = spark.sparkContext.accumulator(0)

    def count(frames):
        for frame in frames:
            seen.add(len(frame))
            yield frame

    rows = spark.range(5000).select(F.col("id").alias("k")).mapInPandas(count, "k bigint")
    ends = spark.createDataFrame([(1000, "a"), (2000, "b"), (None, "a")], "max_key bigint, shard string")
    refined = plan_source_chunks(rows, chunk_ranges(ends), "k", F.lit(10).cast("bigint"), "auto", 1500, 10_000)
    assert refined.count() > 3 and seen.value == 5000
    assert {r.shard for r in refined.where("min_key >= 1000 AND max_key <= 2000").collect()} == {"b"}


@pytest.mark.parametrize("small", [True, False])
def test_overlapping_ranges(spark, monkeypatch, small):
    from sparkroute.plans.chunks import overlapping_ranges, tag_violations

    monkeypatch.setattr("sparkroute.plans.chunks.is_small", lambda df: small)

    def found(rows, fields=None, kind="int"):
        df = spark.createDataFrame([(*r, "t") for r in rows], f"min_key {kind}, max_key {kind}, tag string")
        return sorted((r.min_key for r in overlapping_ranges(df, fields).collect()), key=str)

    assert found([(0, 10), (10, 20), (30, None)]) == []
    assert found([(0, 100), (50, 60), (70, 80)]) == [50]
    assert found([(None, 5), (4, 9), (9, None), (20, 30)]) == [20, 4]
    assert found([(0, None), (5, 6)]) == [5] and found([(None, 5), (None, 3)]) == [None]
    pair = "struct<a: int, b: int>"
    fields = [("a", "desc"), ("b", "asc")]
    assert found([((9, 1), (9, 5)), ((9, 5), (3, 0)), ((3, 0), None)], fields, pair) == []
    assert len(found([((9, 1), (8, 5)), ((8, 4), (3, 0))], fields, pair)) == 1
    chunks = chunk_ranges(spark.createDataFrame([(100, "s"), (None, "s")], "max_key int, shard string"))
    tags = spark.createDataFrame([(0, 100, "A"), (50, 60, "B")], "min_key int, max_key int, tag string")
    with pytest.raises(ValueError, match="before the one from 0"):
        tag_violations(chunks, tags, spark.createDataFrame([("s", "A")], "shard string, tag string"))
