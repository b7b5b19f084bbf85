"""Documents without a schema: kept whole, keyed and ordered whatever their fields hold."""

import json
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkroute.functions.dynamic import with_keys
from sparkroute.functions.hashing import KEY_TYPE, hash64
from sparkroute.functions.keys import ShardKey, doc_bytes
from sparkroute.operators.ordering import packed_files
from sparkroute.operators.routing import route
from sparkroute.operators.unique import keep_first, set_aside
from sparkroute.operators.verify import diff_rows
from sparkroute.plans.chunks import chunk_ranges
from sparkroute.plans.jobs import dump, load, load_dynamic, reshard, restore
from sparkroute.session import scratch_dir
from sparkroute.sinks.tables import read_chunk_table
from sparkroute.sources.json_lines import shows_field

KEYS = ['{"$minkey": 1}', "null", "-1e300", "-2", "-1.5", "0", "1", "1.25", '{"$numberLong": "7"}', "9007199254740992", "9007199254740993",
        "1e300", '""', '"NumberLng"', '"a"', '"é"', '{"a": 1}', '{"b": [1]}', "[1]", "[]", '{"$binary": "AAE=", "$type": "00"}',
        '{"$oid": "54320744335b5783110229ef"}', "false", "true", '{"$date": 5}', '{"$date": "2024-01-01T00:00:00Z"}', '{"$maxkey": 1}']


def docs(spark, lines):
    return spark.createDataFrame(list(enumerate(lines)), "i int, line string").select("i", F.parse_json("line").alias("doc"))


def lines_folder(spark, lines):
    folder = scratch_dir(spark, "lines")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(folder)
    return folder


def texts(df):
    return sorted(r[0] for r in df.select(F.to_json("doc")).collect())


def test_any_two_keys_have_an_order(spark):
    df = docs(spark, [f'{{"k": {k}}}' for k in KEYS] + ['{"other": 1}'])
    keyed = with_keys(df, {"k": 1})
    rows = keyed.where("k IS NOT NULL").orderBy("k").collect()
    assert [r.i for r in rows] == list(range(len(KEYS)))
    assert [r.i for r in keyed.where("k IS NULL").collect()] == [len(KEYS)]  # missing is not null
    bounds = keyed.where("i % 3 = 1 AND k IS NOT NULL").select(F.col("k").alias("max_key"))
    bounds = bounds.union(spark.range(1).select(F.lit(None).cast(bounds.schema[0].dataType))).withColumn("shard", F.lit("s"))
    for inline in (1024, 2):  # one constant array, and fences
        routed = route(keyed.where("k IS NOT NULL"), chunk_ranges(bounds), "k", max_inline=inline)
        assert [r.chunk_id for r in routed.orderBy("i").collect()] == [(i + 2) // 3 for i in range(len(KEYS))]


def test_hashes_are_those_of_typed_columns(spark):
    df = docs(spark, ['{"k": 42}', '{"k": {"$numberLong": "42"}}', '{"k": 42.9}', '{"k": "a"}', '{"k": true}', '{"k": null}', '{"k": {"a": 1}}', "{}",
                      '{"k": 1e300}', '{"k": {"$oid": "54320744335B5783110229EF"}}'])
    key = with_keys(df, {"k": "hashed"})
    got = [r[0] for r in key.orderBy("i").select(hash64(F.col("k"), key.schema["k"].dataType)).collect()]
    text = spark.range(1).select(hash64(F.lit("a"), T.StringType()), hash64(F.lit(True), T.BooleanType()), hash64(F.lit(2**63 - 1)),
                                 hash64(F.lit("54320744335b5783110229ef"), T.StringType())).first()
    assert got[:3] == [-944302157085130861] * 3 and got[3:5] == [text[0], text[1]] and got[8:] == [text[2], text[3]]
    assert got[7] is None and len(set(got[5:7] + got[3:5])) == 4


LINES = [json.dumps(d) for d in (
    [{"_id": i, "user": i % 7, f"only_{i % 3}": {"deep": [i, {"x": None}]}} for i in range(40)]
    + [{"_id": f"s{i}", "user": None, "big": 9007199254740993 + i} for i in range(5)]
    + [{"user": "u", "text": "no id"}, {"user": "u", "text": "no id"}, {}])]


@pytest.fixture(scope="module")
def loaded(spark):
    target, aside = scratch_dir(spark, "dynamic"), scratch_dir(spark, "dynamic-aside")
    folder = lines_folder(spark, [*LINES, "{bad", '{"a": 1, "a": 2}'])
    load_dynamic(spark, folder, target, {"_id": "hashed"}, quarantine=aside, shards=["a", "b"], check=True)
    return target, aside


def test_load_keeps_undeclared_fields(spark, loaded):
    table = read_chunk_table(spark, loaded[0])
    kept = texts(table)
    assert [t for t in kept if '"$oid"' not in t] == sorted(json.dumps(json.loads(x), separators=(",", ":"), sort_keys=True) for x in LINES[:45])
    made = [json.loads(t) for t in kept if '"$oid"' in t]
    assert len({d["_id"]["$oid"] for d in made}) == 3 and sorted(len(d) for d in made) == [1, 3, 3]
    assert table.where("_id IS NULL").isEmpty() and spark.read.parquet(f"{loaded[1]}/lines").count() == 2
    assert table.select("chunk_id").distinct().count() > 5
    assert load_dynamic(spark, scratch_dir(spark, "none").rsplit("/", 1)[0], loaded[0], file_regex="nothing") is None


def test_reshard_dump_and_restore_need_no_schema(spark, loaded):
    source = read_chunk_table(spark, loaded[0])
    by_user, path, back = (scratch_dir(spark, n) for n in ("by-user", "sized", "back"))
    with pytest.raises(Exception, match="without shard key"):
        reshard(source, by_user, {"user": 1}, shards=["a"])
    reshard(source, by_user, {"user": 1, "_id": -1}, shards=["a", "b"], max_bytes=400, sort=True, tiebreak=["doc"], quarantine=by_user + "-aside")
    chunks = read_chunk_table(spark, by_user)
    first = chunks.where("chunk_id = 0").collect()
    assert any(r["user"].rank == 5 for r in first)  # a null key is a key, and the lowest one
    assert chunks.count() == 47 and spark.read.parquet(by_user + "-aside").first().reason == "no key field: user"
    dump(source, path, {"_id": "hashed"}, 3, file_bytes=600, rows_per_slot=10)
    restore(spark, path, back, {"_id": "hashed"}, shards=["x"])
    assert texts(read_chunk_table(spark, back)) == texts(source)
    assert diff_rows(source.select("doc"), read_chunk_table(spark, back).select("doc")).isEmpty()
    assert diff_rows(source.select("doc"), chunks.select("doc")).count() == 1


def test_unique_keys_of_documents(spark):
    df = with_keys(docs(spark, ['{"k": 1, "v": "b"}', '{"k": 1, "v": "a"}', '{"k": 1.0, "v": "a"}', '{"k": "1"}', '{"k": null}', '{"k": null}']).drop("i"), {"k": 1})
    assert texts(keep_first(df, ["k"], ["doc"])) == ['{"k":"1"}', '{"k":1,"v":"a"}', '{"k":null}']
    _, rest = set_aside(df, ["k"], ["doc"])
    assert sorted((r.n_rows, r.reason) for r in rest.collect()) == [(1, "duplicate key")] * 3
    target = scratch_dir(spark, "unique")
    load(df, target, {"k": 1}, ["a"], unique="first")
    assert read_chunk_table(spark, target).count() == 3


def test_key_hash_is_computed_once(spark):
    """A hash in each branch, and twice in each, is what a whole load spent most of its time on."""
    lines = ["1", "-1", "0.5", "-0.5", "1e300", "-1e300", "9223372036854775807", "9223372036854775808", "-9223372036854775808", "-9223372036854775809",
             "12345678901234567890.75", '"a"', '""', '"\u00e9"', "null", "true", "false", "[1]", "[]", '{"a": 1}', '{"$date": 5}', '{"$numberLong": "7"}',
             '{"$oid": "0123456789abcdef01234567"}', '{"$timestamp": {"t": 3, "i": 4}}', '{"$minKey": 1}']
    df = spark.createDataFrame([(i, f'{{"k": {x}}}') for i, x in enumerate(lines)] + [(99, "{}")], "i int, line string")
    keyed = with_keys(df.select("i", F.parse_json("line").alias("doc")), {"k": "hashed"})
    hashed, _ = ShardKey.parse({"k": "hashed"}).routed(keyed)
    assert hashed._jdf.queryExecution().optimizedPlan().toString().count("md5(") == 1
    assert hashed.columns == [*keyed.columns, "key_hash"]
    assert hashed.where(~F.col("key_hash").eqNullSafe(hash64(F.col("k"), KEY_TYPE))).count() == 0
    hashes = {r.i: r.key_hash for r in hashed.collect()}
    plain = spark.createDataFrame([(0, 1), (1, -1), (2, 0), (3, 0), (4, 2**63 - 1), (5, -(2**63)), (6, 2**63 - 1), (7, 2**63 - 1), (8, -(2**63)), (9, -(2**63)),
                                   (10, 2**63 - 1), (21, 7)], "i int, n bigint")
    assert all(hashes[r.i] == r.h for r in plain.select("i", hash64(F.col("n")).alias("h")).collect())
    assert hashes[99] is None


def test_dump_sorts_by_hash_before_texts(spark):
    """A text of the whole document as the first sort column is made anew for each comparison."""
    df = spark.range(100).selectExpr("id", "id % 3 AS chunk_id", "id % 50 + 1 AS n")
    plan = packed_files(df, [F.col("n")], F.xxhash64("id"), F.col("n"), 1000)._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"\[__spread#\d+L ASC NULLS FIRST, n#\d+L ASC NULLS FIRST\]", plan)


def test_dump_measures_documents_as_before(spark, monkeypatch):
    sizes = []

    def planned(df, order, spread, size, *rest):
        sizes.extend(df.select(size.alias("n"), doc_bytes(df.select("doc", "k")).alias("whole")).collect())
        raise InterruptedError

    monkeypatch.setattr("sparkroute.plans.jobs.packed_files", planned)
    df = spark.createDataFrame([('{"k": 1, "v": "\u00e9\\n"}',), ('{"v": null, "k": [1, {"b": 2.50}]}',)], "line string").select(F.parse_json("line").alias("doc"))
    with pytest.raises(InterruptedError):
        dump(df, scratch_dir(spark, "measured"), {"k": "hashed"}, 3, file_bytes=1000)
    assert len(sizes) == 2 and all(r.n == r.whole for r in sizes)


SHOWN = ['{"_id": 1, "a": 2}', ' { "_id" : {"x": [1]}}', '{"a": {"_id": 3}, "_id": 2}', '{"a": 1, "_id": "x y"}', '{"a": 1,"_id":null }', '{"_id": 5}']
UNCLEAR = ['{"a": 1, "_id": "x\\"y"}', '{"a": 1, "_id": [1]}', '{"a": 1, "_id": 3, "b": {}}', '{"a": 1, "\\u005fid": 4}']
BARE = ['{"a": {"b": 1, "_id": 3}}', '{"a": "x, \\"_id\\": 3"}', '{"a": ", ", "x\\"_id": 3}', '{"a": [{"c": 0, "_id": 3}]}', "{}", '{"a": 1, "_id2": 3}',
        '{"a": 1, "x, \\"_id": 3}', '{"a": ",\\"_id\\":3}"}', '{"_id2": {"_id": 1}}']


def test_lines_that_show_their_id_are_parsed_once(spark):
    lines = spark.createDataFrame([(x,) for x in [*SHOWN, *UNCLEAR, *BARE]], "value string")
    assert {r.value for r in lines.where(shows_field(F.col("value"), "_id")).collect()} == set(SHOWN)
    target = scratch_dir(spark, "shown")
    load_dynamic(spark, lines_folder(spark, [*SHOWN, *UNCLEAR, *BARE, *BARE]), target, {"_id": "hashed"})
    loaded = [json.loads(x) for x in texts(read_chunk_table(spark, target))]
    made = [x["_id"]["$oid"] for x in loaded if isinstance(x["_id"], dict) and "$oid" in x["_id"]]
    assert len(loaded) == len(SHOWN) + len(UNCLEAR) + 2 * len(BARE) and len(set(made)) == 2 * len(BARE)
