"""Routing of rows to the chunk that owns their key.

Uniform hash chunks use a closed form. Any other chunk table is searched by bisection over
its sorted bounds: about log2(chunks) comparisons per row in generated code, without a join and without a
shuffle, for keys of any orderable type. A chunk table too long for one constant array is
cut into fences of a bounded number of bounds. The fences are a chunk table themselves and are searched the same
way, level by level; a row then meets exactly one fence by an equi-join and bisects within it. The bounds
of a level are sent to all executors as long as their measured size allows.
"""

from __future__ import annotations

import base64
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkroute.functions.hashing import INT64_MAX, KEY_TYPE
from sparkroute.functions.keys import ASC, DESC, ShardKey
from sparkroute.operators.once import computed_once
from sparkroute.operators.small import broadcast_if_small, packed_bytes

CHUNK = "chunk_id"
MAX_INLINE = 1024
#: Bounds of a level up to this size in memory go to all executors; beyond, the rows are shuffled by fence.
FENCED_BROADCAST_BYTES = 512 << 20
LOW, FENCE, WITHIN = "__low", "__fence", "__within"

Fields = list[tuple[str, str]]


def hash_bounds(n: int) -> tuple[int, int]:
    """Lowest bound and half the step of ``n`` uniform hash chunks (n > 1)."""
    half = INT64_MAX // n
    return INT64_MAX - (n - 1) * 2 * half, half


def hash_chunk(h: Column, n: int) -> Column:
    """Chunk number of a 64-bit hash among ``n`` uniform chunks.

    The distance to the lowest bound can exceed 63 bits, so it is halved first; the step
    is even and the bound is odd, hence halving loses nothing.
    """
    if n < 1:
        raise ValueError("at least one chunk is needed")
    if n == 1:
        return F.when(h.isNotNull(), F.lit(0).cast("bigint"))
    first, half = hash_bounds(n)
    even = F.lit(1).cast("bigint") - h.bitwiseAND(F.lit(1).cast("bigint"))
    distance = F.shiftright(h, 1) - F.lit(first >> 1) - even
    above = F.least(_div(distance, half) + 1, F.lit(n - 1).cast("bigint"))
    low, high = h < F.lit(first), h >= F.lit(first)  # neither for a NULL hash, which has no chunk
    return F.when(low, F.lit(0).cast("bigint")).when(high, above)


def _div(a: Column, b: int) -> Column:
    return F.call_function("div", a, F.lit(b).cast("bigint"))


def route_hash(df: DataFrame, n: int, key_hash: str, out: str = CHUNK) -> DataFrame:
    """Adds the chunk of each row among ``n`` uniform hash chunks."""
    return df.withColumn(out, hash_chunk(F.col(key_hash), n))


def hash_shard(chunk: Column, n: int, shards: list[str]) -> Column:
    """Shard of a uniform hash chunk: the top chunk on the first shard, the rest in turn."""
    names = F.array(*[F.lit(s) for s in sorted(shards)])
    place = F.when(chunk == n - 1, F.lit(0)).otherwise(F.pmod(F.lit(n - 2) - chunk, len(shards)))
    return F.get(names, place.cast("int"))


def bound_part(bound: str, fields: Fields, name: str) -> Column:
    """One key field of a bound column, which is a scalar or a struct by key field."""
    return F.col(bound) if len(fields) == 1 else F.col(bound)[name]


def bisect(bounds: list[Column], size: int, fields: Fields) -> Column:
    """How many of the sorted ``bounds`` are at or below the key columns of ``fields``.

    ``bounds`` holds one array per key field; ``size`` is their greatest length. Each round
    adds a power of two if the bound there is reached; past the end of an array the
    comparison is NULL and the position stays. The key is bound to a lambda variable, so
    an expensive key expression is evaluated once per row, not once per round.
    """
    rounds = [1 << i for i in reversed(range(max(size, 1).bit_length()))]
    steps = F.array(*[F.lit(r) for r in rounds])

    def search(key: Column) -> Column:
        def advance(low: Column, step: Column) -> Column:
            at = low + step - 1
            reached = None
            for i, (_, kind) in reversed(list(enumerate(fields))):
                bound, value = F.get(bounds[i], at), key[f"k{i}"]
                if reached is None:
                    reached = bound >= value if kind == DESC else bound <= value
                else:
                    beyond = bound > value if kind == DESC else bound < value
                    reached = beyond | ((bound == value) & reached)
            return F.when(reached, low + step).otherwise(low)

        return F.aggregate(steps, F.lit(0), advance)

    key = F.struct(*[F.col(name).alias(f"k{i}") for i, (name, _) in enumerate(fields)])
    return F.get(F.transform(F.array(key), search), 0)


def search(df: DataFrame, bounds: list[Column], size: int, fields: Fields, out: str) -> DataFrame:
    """Adds how many of the sorted ``bounds`` are at or below the key, as ``bisect`` does, in generated code.

    Each round is a projection on the one before, which names its position twice, so the optimizer keeps
    them apart. The last step is computed once and lets no filter through, which would repeat all rounds.
    """
    low = F.col(LOW)
    df = df.withColumn(LOW, F.lit(0))
    for step in [1 << i for i in reversed(range(max(size, 1).bit_length()))]:
        at = low + step - 1
        reached = None
        for i, (name, kind) in reversed(list(enumerate(fields))):
            bound, value = F.get(bounds[i], at), F.col(name)
            if reached is None:
                reached = bound >= value if kind == DESC else bound <= value
            else:
                beyond = bound > value if kind == DESC else bound < value
                reached = beyond | ((bound == value) & reached)
        df = df.withColumn(LOW, F.when(reached, low + step).otherwise(low))
    others = [c for c in df.columns if c not in (LOW, out)]
    return computed_once(df, others, {out: low})


def _exact_text(bound: Column, dtype: T.DataType) -> Column:
    """A bound as text that gives exactly the same value back, in any session time zone."""
    if isinstance(dtype, T.BinaryType):
        return F.hex(bound)
    if isinstance(dtype, T.TimestampType):
        return (F.unix_micros(bound).cast("decimal(38,0)") / 1_000_000).cast("decimal(38,6)").cast("string")
    if dtype == KEY_TYPE:
        return F.to_json(F.struct(*[bound[n].cast("string").alias(n) for n in dtype.names]), {"ignoreNullFields": "false"})
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)):
        raise ValueError(f"a key field of type {dtype.simpleString()} has no bounds; name its fields")
    return bound.cast("string")


def _literal_bounds(rows: list, dtypes: list[T.DataType]) -> list[Column]:
    """Collected bounds as one constant array per key field (from their exact texts).

    Only parsing and casts of constants are folded before the run. A function over the elements would be called for
    each row, in each round of the search, on all bounds.
    """
    columns = []
    for i, dtype in enumerate(dtypes):
        values, parsed = [row[i] for row in rows], T.ArrayType(T.StringType())
        if isinstance(dtype, T.BinaryType):  # JSON holds bytes in base 64
            values, parsed = [None if x is None else base64.b64encode(bytes.fromhex(x)).decode() for x in values], T.ArrayType(dtype)
        elif dtype == KEY_TYPE:
            values = [None if x is None else json.loads(x) for x in values]
            parsed = T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in dtype.names]))
        constant = F.from_json(F.lit(json.dumps(values)), parsed)
        if isinstance(dtype, T.TimestampType):
            constant = constant.cast("array<decimal(38,6)>")  # seconds
        columns.append(constant.cast(T.ArrayType(dtype)))
    return columns


def route(
    df: DataFrame,
    chunks: DataFrame,
    key: ShardKey | Fields | str,
    out: str = CHUNK,
    max_inline: int = MAX_INLINE,
) -> DataFrame:
    """Adds the chunk whose half-open range ``[min_key, max_key)`` holds the row's key.

    ``chunks`` is a gap-free chunk table with chunk numbers 0, 1, ... in key order. Of more than ``max_inline``
    bounds, so many are a fence.
    """
    fields = key_fields(key)
    parts = [bound_part("max_key", fields, name).alias(f"b{i}") for i, (name, _) in enumerate(fields)]
    table = chunks.where(F.col("max_key").isNotNull()).select(CHUNK, *parts)
    dtypes = [table.schema[f"b{i}"].dataType for i in range(len(fields))]
    texts = [_exact_text(F.col(f"b{i}"), dtype) for i, dtype in enumerate(dtypes)]

    if max_inline < 2:
        raise ValueError("a fence needs at least two bounds")
    rows = table.orderBy(CHUNK).limit(max_inline + 1).select(*texts).collect()
    if len(rows) <= max_inline:
        return search(df, _literal_bounds(rows, dtypes), len(rows), fields, out).withColumn(out, F.col(out).cast("bigint"))
    return _route_fenced(df, table, fields, out, max_inline)


def _route_fenced(df: DataFrame, table: DataFrame, fields: Fields, out: str, rows: int) -> DataFrame:
    """Routes by bounds ``b0, b1, ...`` numbered by chunk: first to the fence of ``rows`` of them, then within it."""
    columns = [f"b{i}" for i in range(len(fields))]
    last = F.pmod(F.col(CHUNK) + 1, F.lit(rows)) == 0
    top = F.col("b0") if len(fields) == 1 else F.struct(*[F.col(b).alias(name) for b, (name, _) in zip(columns, fields, strict=True)])
    fences = table.where(last).select((_div(F.col(CHUNK) + 1, rows) - 1).alias(CHUNK), top.alias("max_key"))
    df = route(df, fences, fields, FENCE, rows)

    run = F.array_sort(F.collect_list(F.struct(CHUNK, *columns)))  # at most ``rows`` bounds
    runs = table.groupBy(_div(F.col(CHUNK), rows).alias("__of")).agg(run.alias("__run"))
    runs = runs.select("__of", *[F.col("__run")[c].alias(f"__{c}") for c in columns])
    if packed_bytes(table.select(*columns)) <= FENCED_BROADCAST_BYTES:
        runs = F.broadcast(runs)
    df = df.join(runs, F.col(FENCE) == F.col("__of"), "left")
    within = search(df, [F.col(f"__{c}") for c in columns], rows, fields, WITHIN)
    place = F.col(FENCE) * rows + F.coalesce(F.col(WITHIN), F.lit(0))
    used = (FENCE, WITHIN, "__of", out, *[f"__{c}" for c in columns])
    return within.withColumn("__place", place).drop(*used).withColumnRenamed("__place", out)


def key_fields(key: ShardKey | Fields | str) -> Fields:
    if isinstance(key, str):
        return [(key, ASC)]
    if isinstance(key, ShardKey):
        if key.hashed:
            raise ValueError("route a hashed key by its hash column")
        return list(key.fields)
    return list(key)


def add_shard(df: DataFrame, chunks: DataFrame) -> DataFrame:
    """Adds the shard of each row's chunk."""
    return df.join(broadcast_if_small(chunks.select(CHUNK, "shard")), CHUNK)


def lookup(df: DataFrame, chunks: DataFrame, bound: str) -> tuple[DataFrame, DataFrame]:
    """Exact look-up of chunks by upper bound: the found rows, and those with unknown bounds."""
    target = chunks.select(
        F.col("max_key").alias("__max"), CHUNK, F.col("shard")
    )
    target = broadcast_if_small(target)
    same = F.col(bound).eqNullSafe(F.col("__max"))
    found = df.join(target, same).drop("__max")
    return found, df.join(target, same, "left_anti")
