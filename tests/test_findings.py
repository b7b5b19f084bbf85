"""Inputs that the oracle tables do not have: nulls, other types, second appends, odd paths."""

import os
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from sparkroute.functions.keys import ASC, DESC
from sparkroute.operators.ids import add_id
from sparkroute.operators.routing import route
from sparkroute.plans.chunks import chunk_ranges, tag_violations, unordered_bounds
from sparkroute.plans.jobs import load
from sparkroute.sinks.tables import read_layout
from sparkroute.sources.collection import read_chunks
from sparkroute.sources.files import list_files
from sparkroute.sources.json_lines import read_lines


def bounds(spark, values, dtype, shard="s"):
    return spark.createDataFrame([(v, shard) for v in [*values, None]], f"max_key {dtype}, shard string")


@pytest.mark.parametrize("n", [3, 300])
def test_some_chunks_hold_their_null_keys(spark, n):
    chunks = chunk_ranges(bounds(spark, [10 * i for i in range(1, n)], "bigint"))
    df = spark.range(-5, 10 * n).union(spark.sql("SELECT CAST(NULL AS BIGINT) AS id")).withColumnRenamed("id", "k")
    whole = read_chunks(df, chunks, "k").where("chunk_id <> 1")
    some = read_chunks(df, chunks, "k", only=[i for i in range(n) if i != 1])
    assert sorted(map(str, some.collect())) == sorted(map(str, whole.collect()))
    assert some.where("k IS NULL").count() == 1


def test_many_wanted_chunks_are_no_constants_of_the_plan(spark):
    chunks = chunk_ranges(bounds(spark, [10 * i for i in range(1, 3000)], "bigint"))
    df = spark.range(-5, 30_000).union(spark.sql("SELECT CAST(NULL AS BIGINT) AS id")).withColumnRenamed("id", "k")
    whole = read_chunks(df, chunks, "k").where("chunk_id % 2 = 0")
    table = spark.range(0, 3000, 2).withColumnRenamed("id", "chunk_id")
    for only in (list(range(0, 3000, 2)), table, table.union(table)):
        some = read_chunks(df, chunks, "k", only=only)
        assert some.columns == whole.columns
        assert some.exceptAll(whole).count() == whole.exceptAll(some).count() == 0
        plan = some._jdf.queryExecution().optimizedPlan().toString()
        assert " IN (" not in plan and "INSET" not in plan
    few = spark.createDataFrame([(0,), (7,), (9999,)], "chunk_id bigint")
    assert sorted(str(r.k) for r in read_chunks(df, chunks, "k", only=few).collect()) == sorted(str(k) for k in [None, *range(-5, 10), *range(70, 80)])
    assert read_chunks(df, chunks, "k", only=few.where("chunk_id > 3000")).count() == 0


def test_binary_and_timestamp_bounds(spark):
    chunks = chunk_ranges(bounds(spark, [bytearray([0x80]), bytearray([0xE0])], "binary"))
    df = spark.createDataFrame([(bytearray([x]),) for x in (0x01, 0x90, 0xF0)], "k binary")
    assert [r[0] for r in route(df, chunks, "k").orderBy("k").select("chunk_id").collect()] == [0, 1, 2]
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        late = datetime(2021, 11, 7, 6, 30, tzinfo=timezone.utc)  # 01:30 for the second time
        chunks = chunk_ranges(bounds(spark, [late], "timestamp"))
        rows = spark.sql("SELECT timestamp_seconds(1636264800 + 600 * id) AS k FROM range(12)")
        wrong = route(rows, chunks, "k").where((F.col("k") >= F.timestamp_seconds(F.lit(int(late.timestamp())))) != (F.col("chunk_id") == 1))
        assert wrong.count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_descending_and_compound_tables_are_sound(spark):
    down = chunk_ranges(bounds(spark, [30, 20, 10], "bigint"), [("k", DESC)])
    assert unordered_bounds(down, [("k", DESC)]).count() == 0
    assert unordered_bounds(down).count() > 0
    fields = [("a", ASC), ("b", DESC)]
    kind = "struct<a: bigint, b: bigint>"
    both = chunk_ranges(bounds(spark, [(1, 9), (1, 3), (2, 5)], kind), fields)
    assert unordered_bounds(both, fields).count() == 0
    tags = spark.createDataFrame([((1, 3), (2, 5), "t")], f"min_key {kind}, max_key {kind}, tag string")
    shards = spark.createDataFrame([("s", "other")], "shard string, tag string")
    bad = tag_violations(both, tags, shards, fields).collect()
    assert [(r.chunk_id, r.tag) for r in bad] == [(2, "t")]
    with pytest.raises(ValueError, match="same key"):
        tag_violations(both, tags.union(tags), shards, fields)


def test_second_append_obeys_the_stored_chunks(spark, tmp_path):
    target = f"{tmp_path}/t"
    first = spark.range(1000).selectExpr("id AS k", "repeat('x', 50) AS v")
    load(first, target, {"k": 1}, max_bytes=20_000)
    load(spark.range(500, 6000, 7).selectExpr("id AS k", "'y' AS v"), target, {"k": 1}, max_bytes=500)
    chunks, _ = read_layout(spark, target)
    rows = spark.read.parquet(target)
    assert rows.count() == 1000 + len(range(500, 6000, 7)) and chunks.count() > 1
    astray = rows.join(chunks, "chunk_id").where("k < min_key OR k >= max_key")
    assert astray.count() == 0
    with pytest.raises(ValueError, match="has the key"):
        load(first, target, {"k": "hashed"})


@pytest.mark.parametrize("mode", ["fail", "first", "quarantine"])
def test_unique_against_the_target(spark, tmp_path, mode):
    target, aside = f"{tmp_path}/t", f"{tmp_path}/q"
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    more = spark.createDataFrame([(2, "c"), (3, "d")], "k long, v string")
    options = {"quarantine": aside} if mode == "quarantine" else {}
    load(rows, target, {"k": 1}, unique=mode, **options)
    if mode == "fail":
        with pytest.raises(ValueError, match="in the target"):
            load(more, target, {"k": 1}, unique=mode)
        return
    load(more, target, {"k": 1}, unique=mode, **options)
    assert sorted(r.k for r in spark.read.parquet(target).collect()) == [1, 2, 3]
    if options:
        assert [(r.k, r.reason) for r in spark.read.parquet(aside).collect()] == [(2, "key exists")]


def test_folders_are_resolved_as_spark_does(spark, tmp_path, monkeypatch):
    os.mkdir(f"{tmp_path}/in")
    for name in ("a%41.json", "b.json"):
        with open(f"{tmp_path}/in/{name}", "w") as out:
            out.write('{"a": 1}\n')
    for folder in (f"{tmp_path}/in", f"file:{tmp_path}/in", f"file://{tmp_path}/in/", f"{tmp_path}/./in"):
        assert read_lines(spark, folder).count() == 2
        assert [os.path.basename(r.path) for r in list_files(spark, folder).collect()] == ["a%41.json", "b.json"]
    open(f"{tmp_path}/in/_c.json", "w").close()
    with pytest.raises(ValueError, match="_c.json"):
        read_lines(spark, f"{tmp_path}/in").count()


def test_ids_keep_other_columns_apart(spark):
    rows = [(None, None, "x"), (None, "", "x"), (None, "", "y"), (None, "", "y"), ("z", "", "y")]
    out = add_id(spark.createDataFrame(rows, "_id string, text string, other string"), ["text"]).collect()
    assert len({r["_id"] for r in out}) == 5
    assert sorted(str((r.text, r.other)) for r in out) == sorted(str(r[1:]) for r in rows)
