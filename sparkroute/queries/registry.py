"""Registry of queries and of the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkroute.functions.hashing import INT64_MAX
from sparkroute.operators.routing import hash_bounds

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

MAX_SHARDS = 10_000


def query(name: str | None = None, sql: str | None = None):
    """Registers a function ``(spark, sf_dir) -> DataFrame`` under ``name`` or its own name."""

    def register(fn):
        key = name or fn.__name__
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shard_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as shards, tagged by their region."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    joined = nation.join(region, nation.n_regionkey == region.r_regionkey)
    return joined.select(F.col("n_name").alias("shard"), F.col("r_name").alias("tag"))


def names(shards: DataFrame, column: str = "shard") -> list[str]:
    """Sorted shard names: a few nodes, refused if they are not."""
    rows = shards.select(column).distinct().limit(MAX_SHARDS + 1).collect()
    if len(rows) > MAX_SHARDS:
        raise ValueError(f"more than {MAX_SHARDS} shards")
    return sorted(r[0] for r in rows)


# ---- SQL fragments ---------------------------------------------------------------------


def le_hex(digits: str, size: int = 8) -> str:
    """Hex text ``digits`` of ``size`` bytes with its bytes reversed."""
    return " || ".join(f"substr({digits}, {2 * i - 1}, 2)" for i in range(size, 0, -1))


def unsigned_hex(x: str) -> str:
    """A bigint as 16 hex digits of its two's complement."""
    u = f"(CASE WHEN ({x}) < 0 THEN ({x})::HUGEINT + 18446744073709551616 ELSE ({x})::HUGEINT END)"
    return f"lpad(hex({u}), 16, '0')"


def digest_sql(hex_data: str) -> str:
    """Columns _m, _v and _hash from the hex text of the bytes to hash."""
    return (
        f"md5(unhex({hex_data})) AS _m, "
        f"('0x' || {le_hex('_m')})::HUGEINT AS _v, "
        "(CASE WHEN _v >= 9223372036854775808 THEN _v - 18446744073709551616 ELSE _v END)::BIGINT"
        " AS _hash"
    )


def hashed_sql(source: str, x: str, out: str = "key_hash") -> str:
    """``source`` with the 64-bit hash of the bigint expression ``x``."""
    return (
        f"(SELECT * EXCLUDE (_d, _m, _v, _hash), _hash AS {out} FROM (SELECT *, "
        f"{unsigned_hex(x)} AS _d, {digest_sql(f'''('000000000a000000' || {le_hex('_d')})''')} "
        f"FROM {source}))"
    )


def hash_chunk_sql(h: str, n: int) -> str:
    """Chunk of the hash ``h`` among ``n`` uniform chunks."""
    if n == 1:
        return "0::BIGINT"
    first, half = hash_bounds(n)
    return (
        f"(CASE WHEN {h} < {first} THEN 0 ELSE least(({h}::HUGEINT - ({first})) // {2 * half} + 1, "
        f"{n - 1}) END)::BIGINT"
    )


def routed_sql(source: str, x: str, n: int) -> str:
    """``source`` with ``key_hash`` and ``chunk_id`` among ``n`` uniform hash chunks."""
    hashed = hashed_sql(source, x)
    return f"(SELECT *, {hash_chunk_sql('key_hash', n)} AS chunk_id FROM {hashed})"


def hash_shard_sql(chunk: str, n: int, shards: str) -> str:
    """Shard of hash chunk ``chunk``; ``shards`` is a sorted list expression."""
    return (
        f"(CASE WHEN {chunk} = {n} - 1 THEN {shards}[1] "
        f"ELSE {shards}[(({n} - 2 - {chunk}) % len({shards})) + 1] END)"
    )


def ranges_sql(bounds: str) -> str:
    """Chunk table from ``bounds`` with max_key and shard."""
    return (
        "(SELECT (row_number() OVER (ORDER BY max_key NULLS LAST) - 1)::BIGINT AS chunk_id, "
        "lag(max_key) OVER (ORDER BY max_key NULLS LAST) AS min_key, max_key, shard "
        f"FROM {bounds})"
    )


def in_chunk_sql(key: str, chunk: str = "c") -> str:
    return (
        f"({chunk}.min_key IS NULL OR {key} >= {chunk}.min_key) "
        f"AND ({chunk}.max_key IS NULL OR {key} < {chunk}.max_key)"
    )


SHARDS_SQL = "(SELECT list(n_name ORDER BY n_name) FROM nation)"
REGIONS_SQL = "(SELECT list(r_name ORDER BY r_name) FROM region)"
MAX_SQL = str(INT64_MAX)
