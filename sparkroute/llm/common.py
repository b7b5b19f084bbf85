"""Small helpers that the operators share: written intermediate tables, checked broadcasts, names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkroute.session import ensure_shipped, scratch_dir
from sparkroute.sinks.manifest import remove

WORD = r"[^\x20\x09-\x0D]+"
BROADCAST_BYTES = 8 << 20
ARROW_BYTES = 4 << 20
_ARROW = "spark.sql.execution.arrow.maxBytesPerBatch"


def text_of(name: str) -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(F.col(f"`{name}`"), F.lit(""))


def python_workers(spark: SparkSession) -> None:
    """Ready the session for Python functions on whole texts: code shipped, Arrow batches bounded in bytes.

    Spark bounds a batch by 10,000 rows first, which whole texts make large in both processes.
    A bound that the session sets itself stays; a longer text is a batch by itself.
    """
    ensure_shipped(spark)
    if spark.conf.get(_ARROW, None) is None:
        spark.conf.set(_ARROW, str(ARROW_BYTES))


def write_once(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder as Parquet, and the written table.

    Cuts the lineage: later steps read the files, which outlive any executor.
    """
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    written.written_at = path
    return written


def discard(*tables: DataFrame) -> None:
    """Removes tables of ``write_once`` that nothing will read again: all that was made from them is written too."""
    for table in tables:
        remove(table.sparkSession, table.written_at)


def sent_to_all(df: DataFrame, row_bytes: int | None = None, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` marked for broadcast if its counted size is at most ``limit`` bytes, else as it is.

    ``row_bytes`` bounds a row of fixed width; without it the rows' JSON forms are measured.
    Both plans give the same rows: beyond the limit the join shuffles both sides.
    """
    if row_bytes is None:
        size = df.select(F.sum(F.octet_length(F.to_json(F.struct(*df.columns))) + 32)).first()[0] or 0
    else:
        size = df.count() * row_bytes
    return F.broadcast(df) if size <= limit else df


def fresh(df: DataFrame, name: str) -> str:
    """A column name near ``name`` that ``df`` does not have, whatever the letter case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
