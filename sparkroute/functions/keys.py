"""Shard keys: specification, completeness, order, document size."""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkroute.functions.hashing import KEY_TYPE, with_hash

HASHED = "hashed"
ASC = "asc"
DESC = "desc"

HASH_COLUMN = "key_hash"


@dataclass(frozen=True)
class ShardKey:
    """Ordered key fields, each ``asc``, ``desc`` or ``hashed``."""

    fields: tuple[tuple[str, str], ...]

    def __post_init__(self):
        if not self.fields:
            raise ValueError("a shard key needs at least one field")
        for name, kind in self.fields:
            if kind not in (ASC, DESC, HASHED):
                raise ValueError(f"bad kind for key field {name}: {kind}")
        if self.hashed and len(self.fields) > 1:
            raise ValueError("a hashed shard key has exactly one field")

    @classmethod
    def parse(cls, spec: str | dict | ShardKey) -> ShardKey:
        """From ``{"a": 1, "b": -1}`` or ``{"a": "hashed"}``, as JSON text or a dict."""
        if isinstance(spec, ShardKey):
            return spec
        if isinstance(spec, str):
            spec = json.loads(spec)
        kinds = {1: ASC, -1: DESC, HASHED: HASHED}
        fields = []
        for name, kind in spec.items():
            if isinstance(kind, bool) or kind not in kinds:
                raise ValueError(f"bad kind for key field {name}: {kind!r}")
            fields.append((name, kinds[kind]))
        return cls(tuple(fields))

    @property
    def names(self) -> list[str]:
        return [name for name, _ in self.fields]

    @property
    def hashed(self) -> bool:
        return any(kind == HASHED for _, kind in self.fields)

    def routed(self, df: DataFrame) -> tuple[DataFrame, list[tuple[str, str]]]:
        """``df`` with the columns that routing compares, and those columns with directions."""
        if self.hashed:
            return with_hash(df, self.names[0], HASH_COLUMN), [(HASH_COLUMN, ASC)]
        return df, list(self.fields)

    def order(self) -> list[Column]:
        """Sort columns of the key; a hashed key sorts by its hash."""
        if self.hashed:
            return [F.col(HASH_COLUMN).asc_nulls_first()]
        return order_columns(self.fields)

    def missing(self) -> Column:
        """True where a key field is missing, so the row cannot be routed."""
        return reduce(lambda a, b: a | b, [F.col(n).isNull() for n in self.names])


def order_columns(fields) -> list[Column]:
    """Per-field directions as sort columns; the lowest key sorts first, nulls below it."""
    return [
        F.col(name).desc_nulls_last() if kind == DESC else F.col(name).asc_nulls_first()
        for name, kind in fields
    ]


def split_by_key(df: DataFrame, key: ShardKey) -> tuple[DataFrame, DataFrame]:
    """Rows with a complete key, and the quarantine of the others with a reason."""
    absent = [F.when(F.col(n).isNull(), F.lit(n)) for n in key.names]
    reason = F.concat(F.lit("no key field: "), F.concat_ws(",", *absent))
    bad = key.missing()
    return df.where(~bad), df.where(bad).withColumn("reason", reason)


def fail_where(bad: Column, message: Column) -> Column:
    """A filter that keeps every row, and fails the job at the first ``bad`` one.

    As a filter it stays in the plan whichever columns are read later. It counts as not deterministic, so it
    is never merged with filters below it, whose rows it must not see.
    """
    passed = F.spark_partition_id() >= 0
    return F.when(bad, F.raise_error(message).cast("boolean")).otherwise(passed)


def require_key(df: DataFrame, key: ShardKey) -> DataFrame:
    """``df``, failing the job at the first row whose key is not complete."""
    message = F.lit(f"row without shard key ({', '.join(key.names)})")
    return df.where(fail_where(key.missing(), message))


def doc_bytes(df: DataFrame, columns: list[str] | None = None) -> Column:
    """Bytes of a document: of the given text columns, else of the whole row as JSON, without key parts."""
    if columns:
        sizes = [F.coalesce(F.octet_length(c), F.lit(0)) for c in columns]
        return reduce(lambda a, b: a + b, sizes).cast("bigint")
    own = [f.name for f in df.schema.fields if f.dataType != KEY_TYPE]
    return F.octet_length(F.to_json(F.struct(*own))).cast("bigint")
