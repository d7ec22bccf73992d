"""Session settings and the folder shared by driver and executors."""

from __future__ import annotations

import posixpath
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(
    cpus: int | str = "*", name: str = "stratiform", **settings: str
) -> SparkSession:
    """Session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", "8" if cpus == "*" else str(cpus))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="stratiform-wh-"))
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a temporary folder: there the
    driver and its executors are one process, so every task can read it.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="stratiform-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def is_shared(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` lies below the folder that the driver and all executors share."""

    def plain(name: str) -> str:
        return posixpath.normpath(re.sub("^file:/+", "/", name))

    return plain(path).startswith(f"{plain(shared_root(spark))}/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is created yet."""
    return f"{shared_root(spark)}/stratiform/{label}-{uuid.uuid4().hex}"


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder that this library created; missing ones are fine."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    where = hadoop.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
