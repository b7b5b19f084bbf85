"""One test per finding of round 3; each failed before its change."""

import re

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from sparkroute.functions.hashing import KEY_TYPE
from sparkroute.operators.ordering import packed_files
from sparkroute.operators.routing import route

BOUNDS = {
    "timestamp": ["timestamp'0001-01-01 00:00:00.000001'", "timestamp'1969-12-31 23:59:59.999999'", "timestamp'9999-12-31 23:59:59.999999'"],
    "binary": ["X''", "X'00'", f"X'{'4142' * 60}'"],
    KEY_TYPE.simpleString(): [
        f"cast(struct(10, -1.5D, -1.5, null) as {KEY_TYPE.simpleString()})", f"cast(struct(10, 7D, 7, null) as {KEY_TYPE.simpleString()})",
        f"cast(struct(15, null, null, 'a\"\\\\') as {KEY_TYPE.simpleString()})"],
}


@pytest.mark.parametrize("dtype", list(BOUNDS))
def test_bounds_are_constants_of_the_plan(spark, dtype):
    """bounds that were made anew for each row, by a function over the array, cost a round trip its time limit."""
    keys = spark.sql(" UNION ALL ".join(f"SELECT {i} AS i, {b} AS k" for i, b in enumerate(BOUNDS[dtype])))
    bounds = keys.selectExpr("cast(i as bigint) AS chunk_id", "k AS max_key")
    bounds = bounds.unionByName(spark.sql(f"SELECT 3L AS chunk_id, cast(null as {dtype}) AS max_key"))
    routed = route(keys, bounds, "k")
    last = routed.where("chunk_id >= 0")
    assert {r.i: r.chunk_id for r in routed.select("i", "chunk_id").collect()} == {0: 1, 1: 2, 2: 3}
    assert not re.search("lambda|from_json|unhex|timestamp_micros", plan_of(last))


def test_a_document_beyond_the_limit_is_a_file_by_itself(spark):
    """a text of 133719 bytes ended the plan of files of 120000 bytes."""
    sizes = [(0, i, n) for i, n in enumerate([1000, 5000, 12, 600, 1600, 1601, 900, *[30] * 40])] + [(1, 0, 1601)]
    df = spark.createDataFrame(sizes, "chunk_id bigint, id int, n bigint")
    files = {}
    for r in packed_files(df, [F.col("id")], F.xxhash64("id"), F.col("n"), 1600, beyond="alone").collect():
        files.setdefault((r.chunk_id, r.file_no), []).append(r.n)
    assert sorted(n for f in files.values() for n in f) == sorted(n for _, _, n in sizes)
    assert all(len(f) == 1 or sum(f) <= 1600 for f in files.values())
    assert [5000] in files.values() and [1601] in files.values() and files[1, 0] == [1601]
    assert sorted(no for c, no in files if c == 0) == list(range(len(files) - 1))
    with pytest.raises(ValueError, match="bad way"):
        packed_files(df, [F.col("id")], F.xxhash64("id"), F.col("n"), 1600, beyond="cut")


ROW = "a array<int>, g array<array<int>>, t array<struct<k: bigint, on: boolean, s: string>>, w array<struct<K: bigint>>"
ARRAYS = [
    ('{"a": [1, null, 2], "g": [[1], [], [7, -7]], "t": [{"k": 1, "on": true, "s": "x"}, {"s": null}, null]}', [], 4),
    ('{"a": [2147483648, 1], "g": [[1], [3000000000]], "t": [{"k": true, "on": true, "s": "x"}]}', ["a[0]", "g[1][0]", "t[0].k"], 3),
    ('{"a": [1.5], "g": [1, [2]], "t": [{"k": {"$numberLong": "5"}, "on": "true", "s": 1}], "w": [{"K": 1}]}', ["a[0]", "g[0]", "t[0].on"], 3),
    ('{"a": ["undefined", 1.0], "g": [], "t": {"k": 1}, "w": null}', ["t"], 2),
]


def test_arrays_are_read_at_once_or_walked(spark):
    """arrays of plain values are read in one step, to the same values and paths as by the walk."""
    from pyspark.sql import types as T

    from sparkroute.functions import extjson

    schema = T.StructType.fromDDL(ROW)
    df = spark.createDataFrame([(i, x) for i, (x, _, _) in enumerate(ARRAYS)], "i int, line string").select("i", F.parse_json("line").alias("doc"))
    typed = extjson.normalize_ext_json(df, schema).orderBy("i")
    assert [r.bad_fields for r in typed.collect()] == [bad for _, bad, _ in ARRAYS]
    for f in schema.fields:
        walked = extjson.walk(F.try_variant_get("doc", f'$["{f.name}"]', "variant"), f.dataType, F.lit(f.name))["value"]
        assert [r[0] for r in df.orderBy("i").select(walked).collect()] == [r[0] for r in typed.select(f.name).collect()]
    assert extjson.plain_kind(schema["t"].dataType) == "ARRAY<OBJECT<k: BIGINT, on: BOOLEAN, s: STRING>>"
    kept = extjson.Value(F.struct(F.col("v"), F.schema_of_variant("v").alias("kind"), F.lit("").alias("text")))
    at_once = df.select("i", F.try_variant_get("doc", "$.g", "variant").alias("v")).select(extjson.array_at_once(kept, schema["g"].dataType)).collect()
    assert at_once[0][0] == [[1], [], [7, -7]] and at_once[1][0] is None


def test_lines_are_typed_once(spark, tmp_path):
    """good rows and quarantine each parsed and typed every line."""
    from pyspark.sql import types as T

    from sparkroute.plans.jobs import read_documents
    from sparkroute.sources.json_lines import read_lines

    (tmp_path / "part.json").write_text('{"n": 1}\n{"n": "x"}\n{bad\n')
    good, bad = read_documents(read_lines(spark, str(tmp_path)), T.StructType.fromDDL("n bigint"), with_id=False)
    assert [r.n for r in good.collect()] == [1]
    assert sorted((r.value, r.reason) for r in bad.collect()) == [('{"n": "x"}', "bad type: n"), ("{bad", "malformed")]
    assert "parse_json" not in plan_of(good) and "parse_json" not in plan_of(bad)


def test_prefixes_are_written_before_they_are_read_thrice(spark, monkeypatch):
    """Pipeline: the boundary and both kinds of lists each shuffled the prefixes of all sets."""
    from sparkroute.llm import jaccard_join

    seen, made = [], jaccard_join._postings
    monkeypatch.setattr(jaccard_join, "_postings", lambda sets, *rest: seen.append(plan_of(sets)) or made(sets, *rest))
    words = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join(words)), (2, " ".join([*words[:-1], "x"])), (3, " ".join(words[::-1]))]
    out = jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.component_id for r in out.collect()} == {1: 1, 2: 1, 3: 3}
    assert "Exchange" not in seen[0] and "Join" not in seen[0]
