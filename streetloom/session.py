"""Session settings and the shared scratch location."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from functools import cache

from pyspark.sql import DataFrame, SparkSession

import streetloom

_shipped: set[str] = set()


def build_session(master: str | None = None, shuffle_partitions: int | None = None, **extra: str) -> SparkSession:
    """Session with adaptive execution, skew splitting and UTC; ``extra`` wins."""
    builder = SparkSession.builder.appName("streetloom")
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",  # checkpoints go with their DataFrames
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update({key.replace("__", "."): value for key, value in extra.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting (tests) falls back to its own temporary folder; on a
    cluster a missing setting is an error, because executors could not see each other's files.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = _local_folder()
    return shared.rstrip("/")


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="streetloom-")


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows written to the shared folder once; runs when called."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def ship_sources(spark: SparkSession) -> None:
    """Hand this package's sources to the executors, once for each application; steps in Python need them there.

    The archive lies in the driver's own folder only until Spark's file server has taken it over; executors
    fetch it from the driver as they do with ``--py-files``.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(streetloom.__file__))
    folder = tempfile.mkdtemp(prefix="streetloom-py-")
    path = os.path.join(folder, "streetloom_sources.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for where, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(where, name)
                    archive.write(full, os.path.join("streetloom", os.path.relpath(full, root)))
    context.addPyFile(path)
    _shipped.add(context.applicationId)
