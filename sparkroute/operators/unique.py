"""Unique keys: find, refuse, drop or set aside duplicates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkroute.functions.dynamic import comparable, has_variant

MODES = ("fail", "first", "quarantine")


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count. Combines on the map side."""
    return df.groupBy(*key).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def keep_first(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """One row per key: the lowest by ``order`` (ending in the whole row, so never a tie).

    A minimum over structs, not a numbering within the key: it combines on the map side,
    so the copies of a hot key never meet in one task.
    """
    rest = [c for c in df.columns if c not in key]
    lead = [c for c in order if c not in key]
    trail = [c for c in rest if c not in lead]
    columns = [*lead, *trail]
    row = F.min(F.struct(*columns))
    if has_variant(df.select(*columns).schema):
        row = F.min_by(F.struct(*columns), F.struct(*[comparable(df, c).alias(c) for c in columns]))
    first = df.groupBy(*key).agg(row.alias("__row"))
    return first.select(*[F.col(c) if c in key else F.col("__row")[c].alias(c) for c in df.columns])


def set_aside(df: DataFrame, key: list[str], order: list[str]) -> tuple[DataFrame, DataFrame]:
    """The first row of each key, and all the others as a quarantine with a reason.

    Equal rows are one row of the quarantine with their count ``n_rows``: they combine on
    the map side, so copies of a hot key stay few on the way.
    """
    first = keep_first(df, key, order)
    texts = F.struct(*[comparable(df, c).alias(c) for c in df.columns])
    if has_variant(df.schema):
        counted = df.groupBy(texts.alias("__row")).agg(F.count("*").alias("__n"), *[F.first(c).alias(c) for c in df.columns])
    else:
        counted = df.groupBy(*df.columns).agg(F.count("*").alias("__n"))
    kept = first.select(*[F.col(c).alias(f"__{c}") for c in key], texts.alias("__first"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in key])
    is_first = texts.eqNullSafe(F.col("__first"))
    left = (F.col("__n") - is_first.cast("bigint")).alias("n_rows")
    rest = counted.join(kept, same).select(*df.columns, left).where("n_rows > 0")
    return first, rest.withColumn("reason", F.lit("duplicate key"))


def enforce_unique(
    df: DataFrame, key: list[str], mode: str, order: list[str]
) -> tuple[DataFrame, DataFrame | None]:
    """Rows that may be written under a unique key, and the quarantine if there is one."""
    if mode not in MODES:
        raise ValueError(f"bad mode: {mode}; one of {', '.join(MODES)}")
    if mode == "first":
        return keep_first(df, key, order), None
    if mode == "quarantine":
        return set_aside(df, key, order)
    sample = duplicate_keys(df, key).limit(1).collect()
    if sample:
        raise ValueError(f"key is not unique: {sample[0].asDict()}")
    return df, None


def existing(df: DataFrame, known: DataFrame, key: list[str]) -> DataFrame:
    """Rows whose key is in ``known`` already. Adaptive execution splits a hot key."""
    there = known.select(*[F.col(k).alias(f"__{k}") for k in key])
    same = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"__{k}") for k in key])
    return df.join(there, same, "left_semi")


def not_existing(df: DataFrame, existing: DataFrame, key: list[str]) -> DataFrame:
    """Rows whose key is not in ``existing`` yet. Adaptive execution splits a hot key."""
    known = existing.select(*[F.col(k).alias(f"__{k}") for k in key])
    same = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"__{k}") for k in key])
    return df.join(known, same, "left_anti")
