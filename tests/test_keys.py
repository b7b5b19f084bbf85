import pytest
from pyspark.sql import functions as F

from sparkroute.functions.keys import ShardKey, doc_bytes, require_key, split_by_key


def test_parse():
    assert ShardKey.parse('{"_id": "hashed"}').hashed
    key = ShardKey.parse({"a": 1, "b": -1})
    assert key.fields == (("a", "asc"), ("b", "desc")) and not key.hashed
    for bad in ({}, {"a": 2}, {"a": True}, {"a": "hashed", "b": 1}, {"a": "text"}):
        with pytest.raises(ValueError):
            ShardKey.parse(bad)


def test_split_and_require(spark):
    df = spark.createDataFrame([(1, 2), (None, 2), (1, None), (None, None)], "a int, b int")
    key = ShardKey.parse({"a": 1, "b": 1})
    good, bad = split_by_key(df, key)
    assert good.count() == 1
    reasons = sorted(r.reason for r in bad.collect())
    assert reasons == ["no key field: a", "no key field: a,b", "no key field: b"]
    assert require_key(good, key).count() == 1
    with pytest.raises(Exception, match="without shard key"):
        require_key(df, key).select("b").collect()


def test_order_puts_nulls_lowest(spark):
    df = spark.createDataFrame([(1,), (None,), (2,)], "a int")
    up = [r.a for r in df.orderBy(*ShardKey.parse({"a": 1}).order()).collect()]
    down = [r.a for r in df.orderBy(*ShardKey.parse({"a": -1}).order()).collect()]
    assert up == [None, 1, 2] and down == [2, 1, None]


def test_doc_bytes(spark):
    df = spark.createDataFrame([(1, "é")], "a int, t string")
    row = df.select(doc_bytes(df).alias("json"), doc_bytes(df, ["t"]).alias("text")).first()
    assert row.json == len('{"a":1,"t":"é"}'.encode()) and row.text == 2
    assert df.select(F.col("a")).count() == 1


def test_canonical_text_keeps_rows_apart(spark):
    from sparkroute.functions.fingerprint import canonical

    rows = [("a", "b:c"), ("a1:b", ":c"), (None, "-"), ("-", None), ("", None), (None, "")]
    df = spark.createDataFrame(rows, "x string, y string")
    assert df.select(canonical(df).alias("t")).distinct().count() == len(rows)
