"""The hash against a plain Python computation of the same definition."""

import hashlib
import random
import struct

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkroute.functions.hashing import hash64, hash_column, truncated


def int32(x):
    return struct.pack("<i", x)


def element(x, name=b""):
    if x is None:
        return int32(5) + name
    if isinstance(x, bool):
        return int32(40) + name + (b"\1" if x else b"\0")
    if isinstance(x, (int, float)):
        return int32(10) + name + struct.pack("<q", int(x))
    if isinstance(x, str):
        data = x.encode()
        return int32(15) + name + int32(len(data) + 1) + data + b"\0"
    if isinstance(x, (bytes, bytearray)):
        return int32(30) + name + int32(len(x)) + b"\0" + bytes(x)
    if isinstance(x, dict):
        inner = b"".join(element(v, k.encode() + b"\0") for k, v in x.items())
        return int32(20) + name + inner + int32(0)
    inner = b"".join(element(v, str(i).encode() + b"\0") for i, v in enumerate(x))
    return int32(25) + name + inner + int32(0)


def expected(x, seed=0):
    digest = hashlib.md5(int32(seed) + element(x)).digest()
    return struct.unpack("<q", digest[:8])[0]


def test_known_answer(spark):
    row = spark.range(42, 43).select(hash64(F.col("id")).alias("h")).first()
    assert row.h == -944302157085130861


def test_integers(spark):
    random.seed(1)
    values = [random.randrange(-(2**63), 2**63) for _ in range(500)]
    values += [0, 1, -1, 2**63 - 1, -(2**63)]
    df = spark.createDataFrame([(v,) for v in values], "x bigint")
    for x, h in df.select("x", hash64(F.col("x"))).collect():
        assert h == expected(x)


def test_widths_hash_alike(spark):
    df = spark.range(7, 8).select(
        *[F.col("id").cast(t).alias(t) for t in ("tinyint", "smallint", "int", "bigint", "double")],
        F.lit("7.9").cast("decimal(5,2)").alias("dec"),
    )
    row = df.select(*[hash_column(df, c) for c in df.columns]).first()
    assert set(row) == {expected(7)}


def test_doubles_truncate_and_saturate(spark):
    values = [1.9, -1.9, 0.0, -0.0, float("nan"), 1e300, -1e300, float("inf"), float("-inf")]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in df.select(truncated(F.col("x"))).collect()]
    top, low = 2**63 - 1, -(2**63)
    assert got == [1, -1, 0, 0, 0, top, low, top, low]


def test_null_is_not_hashable(spark):
    df = spark.createDataFrame([(None, None)], "a bigint, b string")
    assert list(df.select(hash_column(df, "a"), hash_column(df, "b")).first()) == [None, None]


def test_text_binary_boolean(spark):
    rows = [("", b"", True), ("abc", b"\0\xff", False), ("héé€", b"x" * 300, True)]
    df = spark.createDataFrame(rows, "s string, b binary, f boolean")
    got = df.select("s", "b", "f", *[hash_column(df, c).alias(f"h{c}") for c in df.columns]).collect()
    for r in got:
        assert (r.hs, r.hb, r.hf) == (expected(r.s), expected(bytes(r.b)), expected(r.f))


def test_nested(spark):
    schema = T.StructType.fromDDL("d struct<a: bigint, b: struct<c: string, e: array<bigint>>>")
    values = [
        {"a": 1, "b": {"c": "x", "e": [1, 2, 3]}},
        {"a": None, "b": {"c": "", "e": []}},
        {"a": -5, "b": {"c": None, "e": list(range(12))}},
    ]
    df = spark.createDataFrame([(v,) for v in values], schema)
    got = [r[0] for r in df.select(hash_column(df, "d")).collect()]
    assert got == [expected(v) for v in values]


def test_seed_changes_the_hash(spark):
    row = spark.range(42, 43).select(hash64(F.col("id"), seed=7).alias("h")).first()
    assert row.h == expected(42, seed=7)
