"""Writing routed rows as tables of chunk partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkroute.operators.ordering import sort_chunks
from sparkroute.operators.routing import CHUNK
from sparkroute.sinks.manifest import (
    RUN,
    commit,
    layout_table,
    names_in,
    new_run,
    read_manifest,
    remove,
    run_folder,
)

MODES = ("append", "overwrite", "errorifexists")


def placed(
    df: DataFrame, order: list | None = None, partitions: int | None = None
) -> DataFrame:
    """Rows brought together by chunk before a write.

    With ``order`` they are range-placed and sorted, large chunks over several partitions.
    Without, adaptive execution balances the partitions: it splits a large chunk and packs
    small ones, towards the advisory partition size.
    """
    if order is not None:
        return sort_chunks(df, order, partitions)
    if partitions:
        return df.hint("rebalance", partitions, CHUNK)
    return df.hint("rebalance", CHUNK)


def one_partition_per_chunk(df: DataFrame, chunks: int) -> DataFrame:
    """Exact placement: chunk number i is partition number i, without hash collisions."""
    return df.repartitionById(chunks, df[CHUNK].cast("int"))


def write_chunks(
    df: DataFrame, path: str, mode: str = "append", rows_per_file: int = 0
) -> None:
    """One folder per chunk, all or nothing per job; files of at most ``rows_per_file`` if set."""
    if mode not in MODES:
        raise ValueError(f"bad mode: {mode}; one of {', '.join(MODES)}")
    writer = df.write.mode(mode).option("maxRecordsPerFile", rows_per_file)
    writer.partitionBy(CHUNK).option("compression", "snappy").parquet(path)


def read_layout(spark: SparkSession, path: str) -> tuple[DataFrame, str] | None:
    """The chunk table and the key (as JSON text) of a table; None for a folder without versions."""
    manifest = read_manifest(spark, path)
    return (layout_table(spark, path, manifest), manifest.key) if manifest else None


def has_data(spark: SparkSession, path: str) -> bool:
    """Whether there is anything at ``path`` that a scan would read, other than what killed first loads left."""
    return any(not n.startswith(("_", ".", f"{RUN}=")) for n in names_in(spark, path))


def replace_chunks(df: DataFrame, path: str) -> None:
    """Replaces only the chunks that ``df`` has rows of; the others stay."""
    spark = df.sparkSession
    manifest = read_manifest(spark, path)
    if manifest is None:
        writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(CHUNK).option("compression", "snappy").parquet(path)
        return
    run = new_run()
    write_chunks(df, run_folder(path, run), "errorifexists")
    chunks = [int(n.split("=")[1]) for n in names_in(spark, run_folder(path, run)) if n.startswith(f"{CHUNK}=")]
    commit(spark, path, run, manifest.key, manifest.layout, without=chunks)
    for earlier in manifest.runs:
        for chunk in chunks:
            remove(spark, f"{run_folder(path, earlier)}/{CHUNK}={chunk}")


def append_table(df: DataFrame, table: str, mode: str = "append") -> None:
    """The same into a catalog table ``database.name``."""
    df.write.mode(mode).partitionBy(CHUNK).format("parquet").saveAsTable(table)


def read_chunk_table(spark: SparkSession, path: str, only: list[int] | None = None) -> DataFrame:
    """The rows of the newest version of a table, or of a plain folder of chunks.

    ``only`` prunes it to some chunks before any file is opened.
    """
    manifest = read_manifest(spark, path)
    if manifest is None:
        if any(n.startswith(f"{RUN}=") for n in names_in(spark, path)):
            raise ValueError(f"{path} has runs, but none that was committed")
        df = spark.read.parquet(path)
    else:
        runs = [run_folder(path, r) for r in manifest.runs]
        df = spark.read.option("basePath", path).parquet(*runs)
        for run, chunks in manifest.gone.items():
            df = df.where(~((F.col(RUN) == run) & F.col(CHUNK).isin(chunks)))
        df = df.drop(RUN)
    return df if only is None else df.where(df[CHUNK].isin(only))


def catalog_report(spark: SparkSession, folder: str) -> DataFrame:
    """The tables directly in a folder: name, version, key, runs, and how many chunks and shards their layout has."""
    found = []
    for name in names_in(spark, folder):
        manifest = read_manifest(spark, f"{folder}/{name}")
        if manifest:
            layout = layout_table(spark, f"{folder}/{name}", manifest)
            total = layout.agg(F.count("*").alias("n"), F.count_distinct("shard").alias("s")).first()
            found.append((name, manifest.version, manifest.key, len(manifest.runs), total.n, total.s))
    return spark.createDataFrame(found, "name string, version bigint, shard_key string, runs bigint, chunks bigint, shards bigint")


def write_external(df: DataFrame, fmt: str, mode: str = "append", **options) -> None:
    """The same rows through another connector; ``options`` (durability, batch size) are its own."""
    df.write.format(fmt).mode(mode).options(**options).save()
