"""Session settings and the shared scratch folder.

Frozen intermediate results and scratch outputs live under the folder that the
cluster names in ``spark.checkpoint.dir``, so any executor can read what another one
wrote and a lost executor costs only the tasks it was running.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(
    app: str = "sparkroute", master: str | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    """A session with the settings the operators are tuned for; ``conf`` overrides them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.showConsoleProgress": "false",
        **(conf or {}),
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def ensure_shipped(spark: SparkSession) -> None:
    """Give the package to the executors, once per Spark application.

    Python functions that run there import it, wherever the driver was started.
    """
    sc = spark.sparkContext
    if getattr(sc, "_sparkroute_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    top = os.path.dirname(package)
    path = os.path.join(tempfile.mkdtemp(prefix="sparkroute-code-"), "sparkroute_code.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, top))
    sc.addPyFile(path)
    sc._sparkroute_shipped = True


def shared_base(spark: SparkSession) -> str:
    """The shared folder of the session. Only a local master may fall back to a temporary one."""
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if base:
        return base.rstrip("/")
    if not spark.conf.get("spark.master", "local").startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    base = tempfile.mkdtemp(prefix="sparkroute-")
    spark.conf.set(CHECKPOINT_DIR, base)
    return base


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A path nobody has used yet below the shared folder. It is not created here."""
    return f"{shared_base(spark)}/{purpose}-{uuid.uuid4().hex}"


def freeze(df: DataFrame) -> DataFrame:
    """Write ``df`` once as a reliable checkpoint and go on from the written copy.

    Needed where later steps read the same rows twice and must see the same placement
    both times (range bounds are sampled, so a recomputation may place rows differently).
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_base(spark))
    return df.checkpoint(eager=True)


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once as Parquet to the shared folder, where several readers would each compute it."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
