"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "moodstream", master: str | None = None, **conf: str) -> SparkSession:
    """Session with adaptive execution on and times in UTC. Cluster settings win over these."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without the setting gets a temporary folder; on a cluster a missing
    setting is an error, because a machine-local folder would not survive a lost executor.
    """
    context = spark.sparkContext
    folder = (
        spark.conf.get("spark.checkpoint.dir", None)
        or context.getConf().get("spark.checkpoint.dir", None)
        or context.getCheckpointDir()
    )
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="moodstream-")
    context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, so runs never overwrite each other."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, which ends its lineage there.

    The written table outlives lost executors and is computed once, however often it is read.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers of the session, once, so that they need no installation.

    The archive is only what the driver hands to Spark; no worker reads it as a file of the driver's.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="moodstream-"), "moodstream_code.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(package):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                out.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
