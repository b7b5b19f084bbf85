"""Size checks before a table is sent to every executor."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 << 20
ROW_OVERHEAD = 32


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` has at most ``rows`` rows. Counted in each partition, nothing is gathered."""
    return df.count() <= rows


def byte_size(df: DataFrame) -> int:
    """About the bytes that ``df`` takes in memory: the JSON forms of its rows and a share for each."""
    row = F.octet_length(F.to_json(F.struct(*df.columns))) + ROW_OVERHEAD
    return df.select(F.sum(row)).first()[0] or 0


def packed_bytes(df: DataFrame) -> int:
    """Bytes that the columns of ``df`` take in arrays: 16 a value, and the text of those that are longer."""
    fixed = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)
    size = F.lit(0)
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(f.name), F.lit(0))
        elif not isinstance(f.dataType, fixed):
            size = size + F.octet_length(F.to_json(F.struct(f.name)))
        size = size + 16
    return df.select(F.sum(size.cast("bigint"))).first()[0] or 0


def broadcast_if_small(df: DataFrame, size: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if its measured size allows, else unchanged (shuffle join)."""
    return F.broadcast(df) if byte_size(df) <= size else df
