"""Versions of a table: what a job wrote belongs to it only once the job has committed."""

import json
import os

import pytest
from pyspark.sql import functions as F

from sparkroute.plans.jobs import dump, load, load_folder, restore
from sparkroute.session import scratch_dir
from sparkroute.sinks import manifest
from sparkroute.sinks.tables import catalog_report, read_chunk_table, read_layout, replace_chunks, write_chunks
from sparkroute.streaming.load import read_file_stream, stream_load

KEY = {"k": 1}


def numbers(spark, low, high):
    return spark.range(low, high).select(F.col("id").alias("k"), F.lit("x" * 40).alias("v"))


def keys(spark, target):
    return sorted(r.k for r in read_chunk_table(spark, target).collect())


def test_a_killed_job_leaves_the_old_table(spark, monkeypatch):
    target = scratch_dir(spark, "t")
    load(numbers(spark, 0, 100), target, KEY, max_bytes=1000)

    def killed(*args, **kwargs):
        raise KeyboardInterrupt

    for mode in ("append", "overwrite"):
        with monkeypatch.context() as m:
            m.setattr("sparkroute.plans.jobs.commit", killed)
            with pytest.raises(KeyboardInterrupt):
                load(numbers(spark, 100, 200), target, KEY, mode=mode, max_bytes=10_000, run="again")
        assert keys(spark, target) == list(range(100))
    for _ in range(2):  # the retry writes its folder anew, and once only
        load(numbers(spark, 100, 200), target, KEY, run="again")
    assert keys(spark, target) == list(range(200))
    assert len(manifest.clean(spark, target)) >= 1 and keys(spark, target) == list(range(200))


def test_two_jobs_at_once(spark, monkeypatch):
    target = scratch_dir(spark, "t")
    load(numbers(spark, 0, 10), target, KEY)
    real = manifest._create

    def slower(session, path, made, calls=[]):  # noqa: B006
        if not calls:
            calls.append(1)
            load(numbers(spark, 10, 20), target, KEY)  # another job commits first
        real(session, path, made)

    with monkeypatch.context() as m:
        m.setattr(manifest, "_create", slower)
        load(numbers(spark, 20, 30), target, KEY)
    assert keys(spark, target) == list(range(30)) and manifest.read_manifest(spark, target).version == 3
    now = manifest.read_manifest(spark, target)
    load(numbers(spark, 0, 5), target, {"k": "hashed"}, mode="overwrite")
    with pytest.raises(manifest.Conflict, match="another key"):
        manifest.commit(spark, target, "late", now.key, now.layout)


def test_half_written_version_is_passed_over(spark, tmp_path):
    target = f"{tmp_path}/t"
    load(numbers(spark, 0, 10), target, KEY)
    open(f"{target}/_versions/{2:012d}.json", "w").close()
    assert keys(spark, target) == list(range(10))
    load(numbers(spark, 10, 12), target, KEY)
    assert keys(spark, target) == list(range(12)) and manifest.read_manifest(spark, target).version == 3


def test_unknown_data_is_refused(spark):
    target = scratch_dir(spark, "t")
    write_chunks(numbers(spark, 0, 10).withColumn("chunk_id", F.lit(0)), target)
    with pytest.raises(ValueError, match="unknown key"):
        load(numbers(spark, 10, 20), target, KEY)
    with pytest.raises(ValueError, match="exists"):
        dump(numbers(spark, 10, 20), target, KEY)
    load(numbers(spark, 10, 20), target, KEY, mode="overwrite")
    assert keys(spark, target) == list(range(10, 20)) == sorted(r.k for r in spark.read.parquet(target).collect())


def test_a_dump_has_a_layout(spark):
    path, target = scratch_dir(spark, "d"), scratch_dir(spark, "t")
    dump(numbers(spark, 0, 50), path, {"k": "hashed"}, 4)
    layout, key = read_layout(spark, path)
    assert layout.count() == 4 and json.loads(key) == [["k", "hashed"]]
    load(numbers(spark, 50, 60), path, {"k": "hashed"})  # goes into the chunks of the dump
    restore(spark, path, target, KEY)
    assert keys(spark, target) == list(range(60))
    assert {r.chunk_id for r in read_chunk_table(spark, path).collect()} <= {0, 1, 2, 3}


def test_a_stream_obeys_the_stored_chunks(spark):
    target, source, checkpoint = (scratch_dir(spark, n) for n in ("t", "in", "cp"))
    load(numbers(spark, 0, 100), target, KEY, max_bytes=1000)
    before = read_layout(spark, target)[0].count()
    numbers(spark, 50, 150).repartition(3).write.parquet(source)
    for _ in range(2):
        stream = read_file_stream(spark, source, numbers(spark, 0, 1).schema, files=1)
        stream_load(stream, target, KEY, checkpoint).awaitTermination()
    assert keys(spark, target) == sorted([*range(100), *range(50, 150)])
    layout = read_layout(spark, target)[0]
    astray = read_chunk_table(spark, target).join(layout, "chunk_id").where("k < min_key OR k >= max_key")
    assert layout.count() == before > 3 and astray.isEmpty()
    with pytest.raises(ValueError, match="has the key"):
        stream_load(stream, target, {"k": "hashed"}, checkpoint)


def test_replaced_chunks(spark):
    target = scratch_dir(spark, "t")
    load(numbers(spark, 0, 100), target, KEY, max_bytes=1000)
    old = [r.k for r in read_chunk_table(spark, target, [1]).collect()]
    replace_chunks(numbers(spark, 1000, 1003).withColumn("chunk_id", F.lit(1)), target)
    assert keys(spark, target) == sorted({*range(100)} - {*old} | {1000, 1001, 1002})


def test_the_source_is_read_once(spark):
    target, aside, stats = (scratch_dir(spark, n) for n in ("t", "q", "s"))
    seen = spark.sparkContext.accumulator(0)

    def count(frames):
        for frame in frames:
            seen.add(len(frame))
            yield frame

    rows = numbers(spark, 0, 1000).select(F.when(F.col("k") % 10 > 0, F.col("k")).alias("k"), "v").mapInPandas(count, "k bigint, v string")
    report = load(rows, target, {"k": "hashed"}, ["a", "b"], quarantine=aside, check=True, stats=stats)
    assert (report.rows_in, report.rows_out, report.rows_quarantined) == (1000, 900, 100)
    assert seen.value == 1000
    assert spark.read.parquet(aside).groupBy("reason").count().collect()[0]["count"] == 100


def test_a_retry_does_not_double_the_quarantine(spark, tmp_path, monkeypatch):
    os.mkdir(f"{tmp_path}/in")
    with open(f"{tmp_path}/in/a.json", "w") as out:
        out.write('{"k": 1, "v": "a"}\n{"v": "b"}\n{bad\n')
    from pyspark.sql import types as T

    schema = T.StructType.fromDDL("k bigint, v string")
    target, aside = f"{tmp_path}/t", f"{tmp_path}/q"
    options = {"quarantine": aside, "run": "nightly", "check": True}
    with monkeypatch.context() as m:
        m.setattr("sparkroute.plans.jobs.commit", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            load_folder(spark, f"{tmp_path}/in", target, schema, KEY, **options)
    for _ in range(2):
        load_folder(spark, f"{tmp_path}/in", target, schema, KEY, **options)
    assert keys(spark, target) == [1]
    assert spark.read.parquet(f"{aside}/lines").count() == spark.read.parquet(f"{aside}/rows").count() == 1
    assert [(r.name, r.runs) for r in catalog_report(spark, str(tmp_path)).collect()] == [("t", 1)]
