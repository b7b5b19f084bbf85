"""Whole jobs: load, reshard, dump, restore."""

from __future__ import annotations

import json
import time
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkroute.functions.dynamic import DOC, comparable, with_id, with_keys
from sparkroute.functions.extjson import missing, normalize_ext_json
from sparkroute.functions.keys import (
    HASH_COLUMN,
    ShardKey,
    doc_bytes,
    fail_where,
    require_key,
    split_by_key,
)
from sparkroute.operators.ids import ID, add_id
from sparkroute.operators.ordering import packed_files
from sparkroute.operators.routing import CHUNK, route, route_hash
from sparkroute.operators.unique import enforce_unique, existing, not_existing
from sparkroute.plans.chunks import (
    CHUNKS_PER_SHARD,
    SPLIT_BYTES,
    chunk_ranges,
    chunk_total,
    hash_chunks,
)
from sparkroute.plans.splits import range_chunks
from sparkroute.session import written
from sparkroute.sinks.manifest import (
    RUN,
    clean,
    commit,
    layout_table,
    names_in,
    new_run,
    read_manifest,
    remove,
    run_folder,
    write_layout_table,
)
from sparkroute.sinks.stats import append_stats
from sparkroute.sinks.tables import MODES, has_data, placed, read_chunk_table, write_chunks
from sparkroute.sources.bson import read_bson
from sparkroute.sources.collection import read_dump
from sparkroute.sources.files import is_empty_source
from sparkroute.sources.json_lines import parse_documents, read_lines, shows_field

DEFAULT_KEY = {ID: "hashed"}
DUMP_SHARD = "dump"
#: The folder name that Spark gives to rows without a chunk.
NO_CHUNK = "__HIVE_DEFAULT_PARTITION__"


@dataclass
class Report:
    """What a job did: its chunk table, and rows by outcome (None if they were not counted)."""

    chunks: DataFrame
    rows_in: int | None = None
    rows_out: int | None = None
    rows_quarantined: int = 0
    seconds: float = 0.0


def single_chunk(spark: SparkSession, shard: str, dtype: str = "bigint") -> DataFrame:
    """The chunk table of an unsharded target: everything in one open range."""
    top = F.lit(None).cast(dtype)
    return chunk_ranges(spark.range(1).select(top.alias("max_key"), F.lit(shard).alias("shard")))


def plan_and_route(
    rows: DataFrame,
    key: ShardKey,
    shards: list[str],
    chunks_per_shard: int = CHUNKS_PER_SHARD,
    chunks: DataFrame | None = None,
    size: Column | None = None,
    max_bytes: int = SPLIT_BYTES,
    sharded: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Rows with their chunk (a hashed key leaves its hash column), and the chunk table.

    Hashed keys get a uniform presplit. Range keys use ``chunks`` if given, else split keys
    found by size in the rows themselves. An unsharded target has one chunk. Rows without a complete key have no chunk.
    """
    spark = rows.sparkSession
    keyed, fields = key.routed(rows)
    if not sharded:
        routed, chunks = keyed.withColumn(CHUNK, F.lit(0).cast("bigint")), single_chunk(spark, shards[0])
    elif key.hashed and chunks is None:
        n = chunk_total(shards, chunks_per_shard)
        routed, chunks = route_hash(keyed, n, HASH_COLUMN), hash_chunks(spark, n, shards)
    else:
        if chunks is None:
            bytes_of = size if size is not None else doc_bytes(rows)
            chunks = range_chunks(keyed.where(~key.missing()), fields, bytes_of, shards, max_bytes)
        routed = route(keyed, chunks, fields)
    return routed.withColumn(CHUNK, F.when(~key.missing(), F.col(CHUNK))), chunks


def load(
    rows: DataFrame,
    target: str,
    key: ShardKey | str | dict = DEFAULT_KEY,
    shards: list[str] = ("shard0",),
    chunks_per_shard: int = CHUNKS_PER_SHARD,
    chunks: DataFrame | None = None,
    sharded: bool = True,
    sort: bool = False,
    tiebreak: list[str] = (),
    mode: str = "append",
    unique: str | None = None,
    quarantine: str | None = None,
    max_bytes: int = SPLIT_BYTES,
    partitions: int | None = None,
    check: bool = False,
    stats: str | None = None,
    input_type: str = "table",
    note: str | None = None,
    run: str | None = None,
) -> Report:
    """Loads ``rows`` into the chunked Parquet table ``target``, as a new version of it.

    ``sort`` sorts each chunk by key (and ``tiebreak``); else rows are only brought to their
    chunk. Rows without a complete key fail the job, or go to the path ``quarantine``.
    ``unique`` is ``fail``, ``first`` or ``quarantine``, against the rows in the target too.
    The chunk table and the key are kept with the target; an append goes into those chunks, and
    is refused under another key, or into a folder with data of unknown key. ``check`` compares the counts of source and result
    and fails if a row is missing. ``stats`` appends a line on the run to that CSV folder.

    The table changes only when all is written and checked. ``run`` names the run for a retry: if the run is
    in the table already nothing is done, and what a killed attempt left behind is written anew.
    """
    if mode not in MODES:
        raise ValueError(f"bad mode: {mode}; one of {', '.join(MODES)}")
    if unique == "quarantine" and not quarantine:
        raise ValueError("unique='quarantine' needs a quarantine path")
    started = time.time()
    spark = rows.sparkSession
    key, spec = ShardKey.parse(key), json.dumps(list(ShardKey.parse(key).fields))
    shards = sorted(shards)
    stored = read_manifest(spark, target)
    if run and stored and run in stored.runs:
        return Report(layout_table(spark, target, stored))
    if mode == "errorifexists" and (stored or has_data(spark, target)):
        raise ValueError(f"{target} exists already")
    if mode == "append" and not stored and has_data(spark, target):
        raise ValueError(f"{target} has data of unknown key and chunks; overwrite it or load elsewhere")
    if mode == "append" and stored:
        known = layout_table(spark, target, stored)
        if stored.key != spec:
            raise ValueError(f"{target} has the key {stored.key}, not {spec}")
        if chunks is not None and chunks.select("max_key", "shard").exceptAll(known.select("max_key", "shard")).take(1):
            raise ValueError(f"{target} has other chunks; load it anew or leave the chunks out")
        chunks = known

    run = run or new_run()
    counted = Observation() if check or stats else None
    source = rows.observe(counted, F.count(F.lit(1)).alias("n")) if counted else rows
    aside = None
    good = source if quarantine else require_key(source, key)
    if unique:
        complete = good.where(~key.missing())
        good, aside = _unique(complete, rows, target, key, unique, [*tiebreak], mode == "append" and stored is not None)
        if quarantine:
            lacking = split_by_key(rows, key)[1].withColumn("n_rows", F.lit(1).cast("bigint"))
            aside = lacking if aside is None else lacking.unionByName(aside)

    routed, table = plan_and_route(good, key, shards, chunks_per_shard, chunks, None, max_bytes, sharded)
    tie = [comparable(rows, c).asc_nulls_first() for c in tiebreak]
    written = placed(routed, [*key.order(), *tie] if sort else None, partitions)
    folder = run_folder(target, run)
    write_chunks(written.drop(HASH_COLUMN), folder, "overwrite")

    report = Report(table)
    if quarantine:
        if aside is None:
            aside = _without_chunk(spark, folder, rows, key)
        report.rows_quarantined = _set_aside(aside, run_folder(quarantine, run), mode == "overwrite" and quarantine)
        remove(spark, f"{folder}/{CHUNK}={NO_CHUNK}")
    if counted:
        report.rows_in = counted.get["n"]
        report.rows_out = _rows_in(spark, folder)
        if check and unique != "first" and report.rows_in != report.rows_out + report.rows_quarantined:
            report.rows_in = rows.count()  # counts taken on the way are too high where an executor was lost
            if report.rows_in != report.rows_out + report.rows_quarantined:
                raise RuntimeError(f"rows are missing or doubled: {report}")
    if mode == "append" and stored:
        layout = stored.layout
    else:
        layout = write_layout_table(table, target)
    commit(spark, target, run, spec, layout, replace=mode == "overwrite")
    if mode == "overwrite":
        clean(spark, target)

    report.seconds = time.time() - started
    if stats:
        append_stats(
            spark,
            stats,
            started_at=datetime.fromtimestamp(started, timezone.utc).isoformat(),
            seconds=round(report.seconds, 3),
            input_type=input_type,
            shard_key=",".join(f"{n}:{k}" for n, k in key.fields),
            chunks=table.count(),
            placement="sorted" if sort else "direct",
            rows_in=report.rows_in,
            rows_out=report.rows_out,
            rows_quarantined=report.rows_quarantined,
            note=note,
        )
    return report


def _unique(
    good: DataFrame, rows: DataFrame, target: str, key: ShardKey, mode: str, tiebreak: list[str], against: bool
) -> tuple[DataFrame, DataFrame | None]:
    """The rows that may be written under a unique key, also ``against`` those in the target, and the others."""
    order = tiebreak or [c for c in rows.columns if c not in key.names]
    good, aside = enforce_unique(good, key.names, mode, order)
    if not against:
        return good, aside
    known = read_chunk_table(rows.sparkSession, target)
    if mode == "fail":
        taken = existing(good, known, key.names).limit(1).collect()
        if taken:
            raise ValueError(f"key is in the target already: {[taken[0][k] for k in key.names]}")
    if mode == "quarantine":
        taken = existing(good, known, key.names).withColumn("n_rows", F.lit(1).cast("bigint"))
        aside = aside.unionByName(taken.withColumn("reason", F.lit("key exists")))
    return not_existing(good, known, key.names), aside


def _without_chunk(spark: SparkSession, folder: str, rows: DataFrame, key: ShardKey) -> DataFrame:
    """The rows without a complete key, which were written with the others but to a folder of their own."""
    lost = spark.createDataFrame([], rows.schema)
    if f"{CHUNK}={NO_CHUNK}" in names_in(spark, folder):
        lost = spark.read.schema(rows.schema).parquet(f"{folder}/{CHUNK}={NO_CHUNK}")
    return split_by_key(lost, key)[1].withColumn("n_rows", F.lit(1).cast("bigint"))


def _set_aside(aside: DataFrame, folder: str, emptied: str | bool) -> int:
    """Writes a quarantine to its run's folder, anew if it is there; the rows it stands for."""
    spark = aside.sparkSession
    if emptied:
        remove(spark, emptied)
    aside.write.mode("overwrite").parquet(folder)
    return spark.read.schema(aside.schema).parquet(folder).agg(F.coalesce(F.sum("n_rows"), F.lit(0))).first()[0]


def _rows_in(spark: SparkSession, folder: str) -> int:
    """Rows of a run, from the files' footers."""
    return spark.read.parquet(folder).count() if names_in(spark, folder) != ["_SUCCESS"] else 0


def read_source(
    spark: SparkSession, folder: str, input_type: str = "json", file_regex: str | None = None
) -> DataFrame:
    """``value`` and ``file`` of every line of JSON, or of every BSON document as such a line."""
    if input_type == "json":
        return read_lines(spark, folder, file_regex)
    if input_type == "bson":
        return read_bson(spark, folder, file_regex).select("value", "file")
    raise ValueError(f"bad input type: {input_type}; json or bson")


def read_documents(
    lines: DataFrame, schema: T.StructType, with_id: bool = True, fail: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Typed rows of lines of extended JSON, and the quarantine of the rest.

    With ``with_id`` documents that lack ``_id`` get one made from their content. With
    ``fail`` the first line for the quarantine fails the job that reads the rows; else the lines are typed once,
    for good and bad rows together, and written to the shared folder.
    """
    typed = normalize_ext_json(parse_documents(lines), schema)
    odd = F.concat(F.lit("bad type: "), F.array_join("bad_fields", ","))
    reason = F.coalesce(F.col("reason"), F.when(F.size("bad_fields") > 0, odd))
    typed = typed.withColumn("reason", reason).drop("bad_fields")
    if fail:
        message = F.concat(F.col("reason"), F.lit(" in "), F.col("file"))
        good = typed.where(fail_where(F.col("reason").isNotNull(), message)).drop("reason")
    else:
        typed = written(typed, "typed")
        good = typed.where("reason IS NULL").drop("reason")
    if with_id and ID in schema.names:
        good = add_id(good, ["value", "file"], derived=[c for c in good.columns if c not in ("value", "file")])
    bad = typed.where("reason IS NOT NULL").select("file", "value", "reason")
    return good.drop("value", "file"), bad


def _lines_aside(bad: DataFrame, target: str, quarantine: str, options: dict) -> str:
    """Writes bad lines to the folder of the run that is to come, anew if a killed attempt wrote it; the run's name."""
    spark, run = bad.sparkSession, options.get("run") or new_run()
    stored = read_manifest(spark, target)
    if not (stored and run in stored.runs):
        if options.get("mode") == "overwrite":
            remove(spark, f"{quarantine}/lines")
        bad.write.mode("overwrite").parquet(run_folder(f"{quarantine}/lines", run))
    return run


def load_folder(
    spark: SparkSession,
    folder: str,
    target: str,
    schema: T.StructType,
    key: ShardKey | str | dict = DEFAULT_KEY,
    input_type: str = "json",
    file_regex: str | None = None,
    with_id: bool = True,
    quarantine: str | None = None,
    **options,
) -> Report | None:
    """Loads a folder of documents. Nothing to read is a clean end: None.

    Bad lines and badly typed documents go to ``quarantine``, or fail the job without it.
    Ids are made up only where ``_id`` is part of the key.
    """
    key = ShardKey.parse(key)
    make_id = with_id and ID in key.names
    lines = read_source(spark, folder, input_type, file_regex)
    if is_empty_source(lines):
        return None
    good, bad = read_documents(lines, schema, make_id, fail=quarantine is None)
    if quarantine:
        options["run"] = _lines_aside(bad, target, quarantine, options)
        options["quarantine"] = f"{quarantine}/rows"
    return load(good, target, key, input_type=input_type, **options)


def read_dynamic(
    lines: DataFrame, id_for: str | None = None, fail: bool = False, columns: list[str] = (DOC,)
) -> tuple[DataFrame, DataFrame]:
    """Whole documents of lines of extended JSON as the variant ``doc``, and the quarantine of the rest.

    With ``id_for`` a document without that field gets one made from its content, as its first field. With
    ``fail`` the first bad line fails the job that reads the documents.
    """
    parsed = parse_documents(lines)
    if fail:
        message = F.concat(F.col("reason"), F.lit(" line in "), F.col("file"))
        good = parsed.where(fail_where(F.col("reason").isNotNull(), message))
    else:
        good = parsed.where("reason IS NULL")
    if id_for:
        lacks = good.withColumn("__lacks", missing(F.col("doc"), f'$["{id_for}"]'))
        # only lines that do not show the field are parsed a second time
        unclear, _ = read_dynamic(lines.where(~shows_field(F.col("value"), id_for)), fail=fail, columns=["value", "file", DOC])
        bare = unclear.where(missing(F.col("doc"), f'$["{id_for}"]')).select("value", "file", F.lit(None).cast("string").alias("__id"))
        named = add_id(bare, ["value", "file"], "__id")
        named = parse_documents(named.select(with_id(F.col("value"), F.col("__id"), id_for).alias("value"), "file"))
        good = lacks.where("NOT __lacks").select(DOC).unionByName(named.select(DOC))
    return good.select(*columns), parsed.where("reason IS NOT NULL").select("file", "value", "reason")


def load_dynamic(
    spark: SparkSession,
    folder: str,
    target: str,
    key: ShardKey | str | dict = DEFAULT_KEY,
    input_type: str = "json",
    file_regex: str | None = None,
    make_id: bool = True,
    quarantine: str | None = None,
    **options,
) -> Report | None:
    """Loads a folder of documents whole, whatever their fields; nothing to read is a clean end: None.

    The target has the variant ``doc`` and the key fields as key parts. Bad lines and documents that lack a key
    field go to ``quarantine``, or fail the job without it; a null key field is a key. Ids are made up only
    where ``_id`` is part of the key.
    """
    key = ShardKey.parse(key)
    lines = read_source(spark, folder, input_type, file_regex)
    if is_empty_source(lines):
        return None
    good, bad = read_dynamic(lines, ID if make_id and ID in key.names else None, fail=quarantine is None)
    if quarantine:
        options["run"] = _lines_aside(bad, target, quarantine, options)
        options["quarantine"] = f"{quarantine}/rows"
    return load(with_keys(good, key), target, key, input_type=input_type, **options)


def rekeyed(rows: DataFrame, key: ShardKey | str | dict) -> DataFrame:
    """Whole documents under a key; rows of declared columns as they are."""
    return with_keys(rows.select(DOC), key) if dict(rows.dtypes).get(DOC) == "variant" else rows


def reshard(
    rows: DataFrame, target: str, key: ShardKey | str | dict, mode: str = "overwrite", **options
) -> Report:
    """The same rows under a new key and new chunks."""
    return load(rekeyed(rows.drop(CHUNK, RUN), key), target, key, mode=mode, **options)


def dump(
    rows: DataFrame,
    path: str,
    key: ShardKey | str | dict = DEFAULT_KEY,
    chunks: int = 2 * CHUNKS_PER_SHARD,
    size: Column | None = None,
    file_bytes: int | None = None,
    rows_per_file: int = 0,
    rows_per_slot: int = 1_000_000,
) -> Report:
    """Dumps rows to chunk folders of Snappy Parquet; an existing path is refused.

    By default adaptive execution sizes the files; ``rows_per_file`` bounds their rows. ``file_bytes`` bounds the documents'
    bytes in each numbered file instead (64 MiB is usual), with one folder per file.
    """
    key = ShardKey.parse(key)
    rows = rekeyed(rows.drop(CHUNK, RUN), key)
    spark, run = rows.sparkSession, new_run()
    if names_in(spark, path):
        raise ValueError(f"{path} exists already")
    folder, spec = run_folder(path, run), json.dumps(list(key.fields))
    n = chunks if key.hashed else 1
    routed, table = plan_and_route(
        require_key(rows, key), key, [DUMP_SHARD], n, sharded=key.hashed
    )
    if file_bytes is None:
        write_chunks(placed(routed).drop(HASH_COLUMN), folder, "errorifexists", rows_per_file)
        commit(spark, path, run, spec, write_layout_table(table, path))
        return Report(table)
    order = [comparable(rows, c).asc_nulls_first() for c in rows.columns]
    if size is None and dict(rows.dtypes).get(DOC) == "variant":  # the document's text is made once, for its bytes and its hash
        routed = routed.withColumn("__text", comparable(rows, DOC))
        own = F.coalesce(F.octet_length("__text") + len('{"doc":}'), F.lit(len("{}")))
        spread = F.xxhash64(*[F.col("__text") if c == DOC else F.col(c) for c in rows.columns])
        measured = {"__bytes_of": own.cast("bigint"), "__spread_of": spread}
        routed = routed.select(*[c for c in routed.columns if c != "__text"], *[x.alias(c) for c, x in measured.items()])
        bytes_of, spread = [F.col(c) for c in measured]
    else:
        spread = F.xxhash64(*[comparable(rows, c) for c in rows.columns])
        bytes_of, measured = size if size is not None else doc_bytes(rows), {}
    planned = packed_files(routed, order, spread, bytes_of, file_bytes, rows_per_slot).drop(HASH_COLUMN, *measured)
    planned.write.mode("errorifexists").partitionBy(CHUNK, "file_no").parquet(folder)
    commit(spark, path, run, spec, write_layout_table(table, path))
    return Report(table)


def restore(
    spark: SparkSession, path: str, target: str, key: ShardKey | str | dict = DEFAULT_KEY, **options
) -> Report:
    """Loads a dump again, under the same or another key."""
    rows = read_dump(spark, path).drop(CHUNK, "file_no")
    options.setdefault("mode", "overwrite")
    return load(rekeyed(rows, key), target, key, input_type="dump", **options)
