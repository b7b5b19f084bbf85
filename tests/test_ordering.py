from collections import defaultdict

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from sparkroute.operators.ordering import batches, file_plan, packed_files, ranked, sort_chunks, spread_slots
from sparkroute.sinks.tables import one_partition_per_chunk, placed, read_chunk_table, write_chunks
from sparkroute.session import scratch_dir


@pytest.fixture
def skewed(spark):
    """A third of all rows under one key of one chunk."""
    rows = [(0, 5, i) for i in range(1000)] + [(i % 7, i % 50, 1000 + i) for i in range(2000)]
    df = spark.createDataFrame(rows, "chunk_id bigint, k int, id int")
    return df.repartition(5)


def test_ranked_splits_a_hot_chunk(skewed):
    order = [F.col("k").asc(), F.col("id").asc()]
    placed_in = sort_chunks(skewed, order, 8).withColumn("p", F.spark_partition_id())
    assert placed_in.where("chunk_id = 0 AND k = 5").select("p").distinct().count() > 1
    groups = defaultdict(list)
    for r in ranked(skewed, order, 8).collect():
        groups[r.chunk_id].append((r.row_no, r.k, r.id))
    for rows in groups.values():
        rows.sort()
        assert [n for n, _, _ in rows] == list(range(1, len(rows) + 1))
        assert [(k, i) for _, k, i in rows] == sorted((k, i) for _, k, i in rows)


def test_batches_leave_one_short(skewed):
    spread = F.xxhash64("id")
    sizes = defaultdict(lambda: defaultdict(int))
    for r in batches(skewed, [F.col("id")], spread, 6, 100).collect():
        sizes[r.chunk_id][r.batch_no] += 1
    for chunk in sizes.values():
        counts = [chunk[b] for b in sorted(chunk)]
        assert sorted(chunk) == list(range(len(counts)))
        assert all(c == 100 for c in counts[:-1]) and 0 < counts[-1] <= 100


def test_batches_shuffle_rows_once(skewed):
    plan = plan_of(batches(skewed.select("chunk_id", "id"), [F.col("id")], F.xxhash64("id"), 6, 100))
    # one exchange of the rows for window and join; the rest move slot totals only
    assert plan.count("Exchange hashpartitioning(__chunk") == 4
    assert "SortMergeJoin" in plan and "Python" not in plan


def test_null_spread_loses_no_row(spark):
    df = spark.createDataFrame([(0, None), (0, 1), (None, 2)], "chunk_id bigint, id int")
    assert batches(df, [F.col("id")], F.col("id").cast("bigint"), 4, 10).count() == 3


@pytest.mark.parametrize("slots", [1, 5])
def test_files_keep_the_limit(spark, slots):
    rows = [(i % 2, i, (i * 37) % 90 + 1) for i in range(600)] + [(2, 1000, 0)]
    df = spark.createDataFrame(rows, "chunk_id bigint, id int, n bigint")
    planned = file_plan(df, [F.col("id")], F.xxhash64("id"), slots, F.col("n"), 1000)
    files = defaultdict(int)
    for r in planned.collect():
        files[r.chunk_id, r.file_no] += r.n
    assert max(files.values()) <= 1000
    for chunk in (0, 1, 2):
        numbers = sorted(f for c, f in files if c == chunk)
        assert numbers == list(range(len(numbers)))
    with pytest.raises(ValueError, match="does not fit"):
        file_plan(df, [F.col("id")], F.xxhash64("id"), 1, F.col("n"), 90)


def test_spread_slots(skewed):
    assert spread_slots(skewed, 1000) == 3 and spread_slots(skewed, 10**6) == 1


def test_one_partition_per_chunk(skewed):
    at = one_partition_per_chunk(skewed, 7).withColumn("p", F.spark_partition_id())
    assert at.where("p <> chunk_id").count() == 0


def test_written_chunks_are_sorted(spark, skewed):
    path = scratch_dir(spark, "sorted")
    write_chunks(placed(skewed, [F.col("k").asc(), F.col("id").asc()], 6), path)
    back = read_chunk_table(spark, path)
    assert back.count() == 3000
    files = defaultdict(list)
    for r in back.select("k", "id", F.input_file_name().alias("f")).collect():
        files[r.f].append((r.k, r.id))
    assert all(rows == sorted(rows) for rows in files.values())


def test_rebalance_keeps_rows(skewed):
    assert placed(skewed).exceptAll(skewed).count() == 0
    assert "REBALANCE" in plan_of(placed(skewed))


@pytest.mark.parametrize("per_slot", [1, 50, 10**6])
def test_large_documents_leave_other_files_full(spark, per_slot):
    limit = 1600
    sizes = [("a", i, 7 + i % 60) for i in range(900)] + [("a", 900, 1590)] + [("b", i, 300 + i % 90) for i in range(33)]
    sizes += [("b", 100 + i, 900) for i in range(3)] + [(None, i, 0) for i in range(5)]
    df = spark.createDataFrame(sizes, "c string, id int, n bigint").withColumn("chunk_id", F.expr("CASE c WHEN 'a' THEN 0 WHEN 'b' THEN 1 END").cast("bigint"))
    planned = packed_files(df, [F.col("id")], F.xxhash64("id"), F.col("n"), limit, per_slot).collect()
    assert sorted((r.c or "", r.id) for r in planned) == sorted((c or "", i) for c, i, _ in sizes)
    files = defaultdict(list)
    for r in planned:
        files[r.c, r.file_no].append(r.n)
    assert all(sum(f) <= limit for f in files.values())
    for chunk in ("a", "b", None):
        numbers = sorted(no for c, no in files if c == chunk)
        assert numbers == list(range(len(numbers)))
        full = [f for (c, _), f in files.items() if c == chunk and max(f) <= limit >> 4]
        assert sum(sum(f) < limit - limit // 8 for f in full) <= 1  # but for the last one
    assert [1590] in files.values() and sorted(len(f) for (c, _), f in files.items() if c == "b") == [1] * 4 + [4] * 8
    with pytest.raises(ValueError, match="does not fit"):
        packed_files(df, [F.col("id")], F.xxhash64("id"), F.col("n"), 1500)


def test_packing_plan_scales(spark, skewed):
    plan = plan_of(packed_files(skewed, [F.col("id")], F.xxhash64("id"), F.col("n") if "n" in skewed.columns else F.lit(5).cast("bigint"), 1000))
    assert "SinglePartition" not in plan and "CartesianProduct" not in plan and "Python" not in plan
