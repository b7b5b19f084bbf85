"""Versions of a chunked table: which job runs belong to it, under which key and chunks.

Every job writes its rows to a folder of its own, ``batch_id=<run>/chunk_id=<n>``, and its chunk table beside
the data. Then it commits: a small file with the next version number, which names the key, the chunk table and
all runs that belong to the table, is made in one step that fails if another job was faster. Readers take the runs of the
newest version only, so a job that is killed before its commit leaves the table as it was, and one
that commits late finds out and goes on from the version it missed.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

RUN = "batch_id"
VERSIONS = "_versions"
LAYOUT = "_layout"
ATTEMPTS = 20


@dataclass
class Manifest:
    """A version of a table. ``gone`` lists chunks of a run that a later run has replaced."""

    version: int
    key: str
    layout: str
    runs: list[str] = field(default_factory=list)
    gone: dict[str, list[int]] = field(default_factory=dict)


class Conflict(RuntimeError):
    """Another job has committed this version."""


def new_run() -> str:
    return uuid.uuid4().hex


def _path(spark: SparkSession, path: str):
    """The file system of a path, whatever store it is in, and the path there."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder; none if there is no such folder."""
    system, at = _path(spark, path)
    return sorted(f.getPath().getName() for f in system.listStatus(at)) if system.exists(at) else []


def remove(spark: SparkSession, path: str) -> None:
    system, at = _path(spark, path)
    system.delete(at, True)


def run_folder(target: str, run: str) -> str:
    return f"{target}/{RUN}={run}"


def _parsed(spark: SparkSession, path: str) -> Manifest | None:
    """A version, None if its file is not whole (a job died while it wrote the few bytes)."""
    system, at = _path(spark, path)
    stream = system.open(at)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    try:
        return Manifest(**json.loads(text))
    except (ValueError, TypeError):
        return None


def read_manifest(spark: SparkSession, target: str) -> Manifest | None:
    """The newest version of a table; None for a folder without versions."""
    names = [n for n in names_in(spark, f"{target}/{VERSIONS}") if n.endswith(".json")]
    for name in sorted(names, reverse=True):
        manifest = _parsed(spark, f"{target}/{VERSIONS}/{name}")
        if manifest:
            return manifest
    return None


def next_version(spark: SparkSession, target: str) -> int:
    names = [n for n in names_in(spark, f"{target}/{VERSIONS}") if n.endswith(".json")]
    return int(max(names).removesuffix(".json")) + 1 if names else 1


def write_layout_table(chunks: DataFrame, target: str) -> str:
    """Keeps a chunk table beside the data; the name it is kept under."""
    name = new_run()
    chunks.write.parquet(f"{target}/{LAYOUT}/{name}")
    return name


def layout_table(spark: SparkSession, target: str, manifest: Manifest) -> DataFrame:
    return spark.read.parquet(f"{target}/{LAYOUT}/{manifest.layout}")


def _create(spark: SparkSession, target: str, manifest: Manifest) -> None:
    system, at = _path(spark, f"{target}/{VERSIONS}/{manifest.version:012d}.json")
    try:
        stream = system.create(at, False)
    except Py4JJavaError as error:
        if "AlreadyExists" in str(error.java_exception) or "already exists" in str(error.java_exception):
            raise Conflict(f"{target} has a version {manifest.version} already") from error
        raise
    try:
        stream.write(bytearray(json.dumps(asdict(manifest)).encode()))
    finally:
        stream.close()


def commit(spark: SparkSession, target: str, run: str, key: str, layout: str, replace: bool = False,
           without: list[int] = ()) -> Manifest:
    """Adds a run to the table, or makes it the whole table (``replace``), as the next version.

    ``without`` names chunks whose earlier rows the run replaces. An append goes under the key and the chunks
    that it was planned with, or fails if another job has changed them meanwhile.
    """
    for _ in range(ATTEMPTS):
        now = read_manifest(spark, target)
        made = Manifest(next_version(spark, target), key, layout, [run])
        if now and not replace:
            if run in now.runs:
                return now
            if (now.key, now.layout) != (key, layout):
                raise Conflict(f"{target} was given another key or other chunks meanwhile")
            made.runs = [*now.runs, run]
            made.gone = {r: sorted({*now.gone.get(r, []), *without}) for r in now.runs if r in now.gone or without}
        try:
            _create(spark, target, made)
        except Conflict:
            continue
        return made
    raise Conflict(f"{target} is written by too many jobs at once")


def clean(spark: SparkSession, target: str) -> list[str]:
    """Removes what the newest version does not name: replaced runs and those of killed jobs. Not while jobs are running."""
    now = read_manifest(spark, target)
    if now is None:
        return []
    wanted = {f"{RUN}={run}" for run in now.runs}
    stray = [n for n in names_in(spark, target) if not n.startswith(("_", ".")) and n not in wanted]
    stray += [f"{LAYOUT}/{n}" for n in names_in(spark, f"{target}/{LAYOUT}") if n != now.layout]
    stray += [f"{RUN}={r}/chunk_id={c}" for r, chunks in now.gone.items() for c in chunks]
    for name in stray:
        remove(spark, f"{target}/{name}")
    return stray
