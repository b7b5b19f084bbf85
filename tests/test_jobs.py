import json
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkroute.operators.ids import add_id
from sparkroute.operators.unique import duplicate_keys, enforce_unique, keep_first, not_existing, set_aside
from sparkroute.operators.verify import compare_counts, diff_rows, reconcile, same_content
from sparkroute.plans.jobs import dump, load, load_folder, reshard, restore
from sparkroute.session import scratch_dir
from sparkroute.sinks.stats import append_stats, read_stats
from sparkroute.sinks.tables import append_table, read_chunk_table, replace_chunks, write_chunks, write_external
from sparkroute.streaming.load import read_file_stream, stream_load

SHARDS = ["a", "b"]


@pytest.fixture
def orders(load_table):
    return load_table("orders").select("o_orderkey", "o_custkey", "o_orderstatus")


def test_round_trip(spark, orders):
    paths = [scratch_dir(spark, f"p{i}") for i in range(5)]
    by_order, by_customer = {"o_orderkey": "hashed"}, {"o_custkey": "hashed"}
    load(orders, paths[0], by_order, SHARDS, 5, check=True)
    reshard(spark.read.parquet(paths[0]), paths[1], by_customer, shards=SHARDS, sort=True)
    reshard(spark.read.parquet(paths[1]), paths[2], by_order, shards=SHARDS, chunks_per_shard=5)
    dump(spark.read.parquet(paths[2]), paths[3], by_order, 7)
    restore(spark, paths[3], paths[4], by_order, shards=SHARDS, chunks_per_shard=5)
    for path in paths:
        assert same_content(orders, read_chunk_table(spark, path))
    first, last = (read_chunk_table(spark, p) for p in (paths[0], paths[4]))
    assert compare_counts(first, last, ["chunk_id"]).where("NOT equal").count() == 0
    assert diff_rows(first, last).count() == 0


def test_differences_are_seen(spark, orders):
    lost = orders.where("o_orderkey <> 7")
    changed = orders.withColumn(
        "o_custkey", F.when(F.col("o_orderkey") == 7, F.lit(-1)).otherwise(F.col("o_custkey"))
    )
    assert not same_content(orders, lost) and not same_content(orders, changed)
    assert not same_content(lost.where("false"), lost.where("false"))
    assert same_content(orders, orders.orderBy(F.desc("o_custkey")))
    assert sorted((r.side, r.n_rows) for r in diff_rows(orders, changed).collect()) == [
        ("copy only", 1), ("source only", 1),
    ]
    twice = orders.union(orders.where("o_orderkey = 7")).union(orders.where("o_orderkey = 7"))
    assert [(r.side, r.n_rows) for r in diff_rows(orders, twice).collect()] == [("copy only", 2)]
    row = reconcile(orders, lost).first()
    assert (row.rows_in, row.rows_out, row.complete) == (1500, 1499, False)


def test_write_modes(spark, orders):
    path = scratch_dir(spark, "modes")
    key = {"o_orderkey": "hashed"}
    load(orders, path, key, SHARDS, 2, mode="errorifexists")
    with pytest.raises(Exception, match="(?i)exists"):
        load(orders, path, key, SHARDS, 2, mode="errorifexists")
    load(orders, path, key, SHARDS, 2, check=True)
    assert spark.read.parquet(path).count() == 3000
    load(orders, path, key, SHARDS, 2, mode="overwrite")
    assert spark.read.parquet(path).count() == 1500
    one = read_chunk_table(spark, path, [1])
    n = one.count()
    replace_chunks(orders.limit(3).withColumn("chunk_id", F.lit(1)), path)
    assert spark.read.parquet(path).count() == 1500 - n + 3
    with pytest.raises(ValueError, match="bad mode"):
        write_chunks(orders, path, "merge")


def test_key_must_be_complete(spark, orders):
    holes = orders.withColumn("o_custkey", F.when(F.col("o_orderkey") > 9, F.col("o_custkey")))
    with pytest.raises(Exception, match="without shard key"):
        load(holes, scratch_dir(spark, "t"), {"o_custkey": "hashed"}, SHARDS)
    target, aside = scratch_dir(spark, "t"), scratch_dir(spark, "q")
    report = load(holes, target, {"o_custkey": "hashed"}, SHARDS, quarantine=aside, check=True)
    assert (report.rows_in, report.rows_out, report.rows_quarantined) == (1500, 1490, 10)


def test_unsharded_and_given_chunks(spark, orders):
    target = scratch_dir(spark, "t")
    report = load(orders, target, {"o_orderkey": 1}, SHARDS, sharded=False)
    assert report.chunks.count() == 1
    assert spark.read.parquet(target).select("chunk_id").distinct().count() == 1
    from sparkroute.plans.chunks import chunks_from_splits

    chunks = chunks_from_splits(orders.where("o_orderkey IN (10, 700)"), "o_orderkey", "a")
    target = scratch_dir(spark, "t")
    load(orders, target, {"o_orderkey": 1}, SHARDS, chunks=chunks, sort=True)
    counts = {r.chunk_id: r["count"] for r in spark.read.parquet(target).groupBy("chunk_id").count().collect()}
    assert counts == {0: 10, 1: 690, 2: 800}


def test_unique_keys(spark):
    rows = [(1, 5, "b"), (1, 5, "a"), (1, 4, "z"), (2, 1, "x"), (3, 1, "y"), (3, 1, "y")]
    df = spark.createDataFrame(rows, "k int, o int, t string")
    assert {r.k: r.n_rows for r in duplicate_keys(df, ["k"]).collect()} == {1: 3, 3: 2}
    first = sorted(tuple(r) for r in keep_first(df, ["k"], ["o"]).collect())
    assert first == [(1, 4, "z"), (2, 1, "x"), (3, 1, "y")]
    kept, rest = set_aside(df, ["k"], ["o"])
    counts = Counter(tuple(r) for r in kept.collect())
    for r in rest.collect():
        counts[r.k, r.o, r.t] += r.n_rows
    assert counts == Counter(rows) and rest.count() == 3
    with pytest.raises(ValueError, match="not unique"):
        enforce_unique(df, ["k"], "fail", ["o"])
    known = spark.createDataFrame([(1,), (9,)], "k int")
    assert sorted(r.k for r in not_existing(df, known, ["k"]).collect()) == [2, 3, 3]


def test_load_unique(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (2, "x")], "k int, t string")
    target, aside = scratch_dir(spark, "t"), scratch_dir(spark, "q")
    load(df, target, {"k": "hashed"}, SHARDS, unique="quarantine", quarantine=aside, check=True)
    assert spark.read.parquet(target).count() == 2 and spark.read.parquet(aside).count() == 1
    target = scratch_dir(spark, "t")
    for _ in range(2):
        load(df, target, {"k": "hashed"}, SHARDS, unique="first")
    assert sorted((r.k, r.t) for r in spark.read.parquet(target).collect()) == [(1, "a"), (2, "x")]


@pytest.mark.parametrize("block", [1, 3, 1000])
def test_ids_are_stable_and_distinct(spark, block):
    rows = [("copy", "f1", None)] * 50 + [("copy", "f2", None), ("one", "f1", None), ("one", "f1", "kept")]
    df = spark.createDataFrame(rows, "value string, file string, _id string")
    first = {(r.value, r.file, r["_id"]) for r in add_id(df, ["value", "file"], block=block).collect()}
    again = add_id(df.repartition(7), ["value", "file"], block=block).collect()
    assert first == {(r.value, r.file, r["_id"]) for r in again} and len(first) == len(again) == 53
    made = [i for _, _, i in first if i != "kept"]
    assert len(set(made)) == 52 and all(len(i) == 24 for i in made)


SCHEMA = T.StructType([T.StructField("_id", T.StringType()), T.StructField("n", T.LongType())])


@pytest.fixture
def folder(tmp_path):
    docs = [{"_id": f"d{i}", "n": i} for i in range(20)] + [{"n": 5}] * 3 + [{"_id": "w", "n": "?"}]
    lines = [json.dumps(d) for d in docs] + ["", "{"]
    (tmp_path / "in.json").write_text("\n".join(lines) + "\n")
    return str(tmp_path)


def test_load_folder(spark, folder):
    target, aside = scratch_dir(spark, "t"), scratch_dir(spark, "q")
    load_folder(spark, folder, target, SCHEMA, quarantine=aside, shards=SHARDS, chunks_per_shard=2)
    rows = read_chunk_table(spark, target)
    assert rows.count() == 23 and rows.select("_id").distinct().count() == 23
    assert set(rows.columns) == {"_id", "n", "chunk_id"}
    bad = spark.read.parquet(f"{aside}/lines")
    assert sorted(r.reason for r in bad.collect()) == ["bad type: n", "blank", "malformed"]


def test_load_folder_without_quarantine_fails(spark, folder):
    with pytest.raises(Exception, match="bad type|blank|malformed"):
        load_folder(spark, folder, scratch_dir(spark, "t"), SCHEMA, shards=SHARDS)


def test_nothing_to_load_is_a_clean_end(spark, folder):
    assert load_folder(spark, folder, scratch_dir(spark, "t"), SCHEMA, file_regex="no") is None


def test_ids_only_where_the_key_needs_them(spark, folder):
    target, aside = scratch_dir(spark, "t"), scratch_dir(spark, "q")
    load_folder(spark, folder, target, SCHEMA, {"n": "hashed"}, quarantine=aside, shards=SHARDS)
    assert spark.read.parquet(target).where("_id IS NULL").count() == 3


def test_dump_refuses_an_existing_path(spark, orders):
    path = scratch_dir(spark, "d")
    dump(orders, path, {"o_orderkey": "hashed"}, 3)
    with pytest.raises(Exception, match="(?i)exists"):
        dump(orders, path, {"o_orderkey": "hashed"}, 3)


def test_sized_dump(spark, load_table):
    documents = load_table("documents").select("doc_id", "text")
    path = scratch_dir(spark, "d")
    size = F.octet_length("text").cast("bigint")
    dump(documents, path, {"doc_id": "hashed"}, 2, size, 100_000, rows_per_slot=40)
    back = spark.read.parquet(path)
    assert same_content(documents, back)
    largest = back.groupBy("chunk_id", "file_no").agg(F.sum(size).alias("n")).agg(F.max("n")).first()[0]
    assert largest <= 100_000


def test_stats(spark, orders):
    path = scratch_dir(spark, "s")
    for note in ("one", "two, with comma"):
        load(orders, scratch_dir(spark, "t"), {"o_orderkey": "hashed"}, SHARDS, stats=path, note=note)
    runs = read_stats(spark, path).orderBy("started_at").collect()
    assert [r.note for r in runs] == ["one", "two, with comma"]
    assert all((r.rows_in, r.rows_out, r.chunks) == (1500, 1500, 20) for r in runs)
    with pytest.raises(ValueError, match="unknown"):
        append_stats(spark, path, speed=1)


def test_stream_equals_batch(spark, load_table):
    events = load_table("events").select("event_id", "user_id")
    source, target = scratch_dir(spark, "in"), scratch_dir(spark, "out")
    checkpoint, batch = scratch_dir(spark, "cp"), scratch_dir(spark, "batch")
    key = {"user_id": "hashed"}

    def run():
        stream = read_file_stream(spark, source, events.schema, files=2)
        stream_load(stream, target, key, checkpoint, n_chunks=10).awaitTermination()

    events.where("event_id < 600").repartition(5).write.mode("append").parquet(source)
    run()
    run()  # nothing new
    events.where("event_id >= 600").write.mode("append").parquet(source)
    run()
    load(events, batch, key, ["s"], 10)
    streamed = spark.read.parquet(target)
    assert streamed.select("batch_id").distinct().count() == 4
    assert diff_rows(read_chunk_table(spark, batch), streamed.drop("batch_id")).count() == 0


def test_stream_by_range(spark, load_table):
    from sparkroute.plans.chunks import chunks_from_splits

    events = load_table("events").select("event_id", "user_id")
    source, target = scratch_dir(spark, "in"), scratch_dir(spark, "out")
    events.write.parquet(source)
    chunks = chunks_from_splits(events.where("event_id IN (10, 500)"), "event_id", "s")
    stream = read_file_stream(spark, source, events.schema)
    query = stream_load(stream, target, {"event_id": 1}, scratch_dir(spark, "cp"), chunks=chunks)
    query.awaitTermination()
    counts = spark.read.parquet(target).groupBy("chunk_id").count().collect()
    assert {r.chunk_id: r["count"] for r in counts} == {0: 10, 1: 490, 2: 500}


def test_other_targets(spark, orders):
    path = scratch_dir(spark, "json")
    write_external(orders, "json", path=path)
    assert spark.read.json(path).count() == 1500
    spark.sql("DROP TABLE IF EXISTS chunked_orders")
    rows = orders.withColumn("chunk_id", F.lit(1))
    append_table(rows, "chunked_orders")
    append_table(rows, "chunked_orders")
    assert spark.table("chunked_orders").count() == 3000
    spark.sql("DROP TABLE chunked_orders")


def test_files_of_bounded_rows(spark, orders):
    path = scratch_dir(spark, "d")
    dump(orders, path, {"o_orderkey": "hashed"}, 2, rows_per_file=100)
    files = spark.read.parquet(path).groupBy(F.input_file_name()).count()
    assert files.agg(F.max("count")).first()[0] <= 100


def test_stream_of_json_lines(spark, folder):
    """The scan, typing and routing of a folder load, as a stream."""
    from sparkroute.functions.extjson import normalize_ext_json
    from sparkroute.sources.json_lines import parse_documents

    lines = read_file_stream(spark, folder, T.StructType.fromDDL("value string"), "text")
    typed = normalize_ext_json(parse_documents(lines).where("reason IS NULL").select("doc"), SCHEMA)
    good = typed.where("size(bad_fields) = 0 AND _id IS NOT NULL").drop("bad_fields")
    target = scratch_dir(spark, "out")
    stream_load(good, target, {"_id": "hashed"}, scratch_dir(spark, "cp"), n_chunks=4).awaitTermination()
    assert sorted(r.n for r in spark.read.parquet(target).collect()) == list(range(20))
