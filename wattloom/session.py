"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark.sql import SparkSession

# Settings every job needs. Sizes (memory, cores, shuffle partitions) belong to
# whoever submits the job; AQE coalesces and splits shuffle partitions at run time.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}

# Settings that results depend on.
PINNED = {key: DEFAULTS[key] for key in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled")}

# AQE otherwise packs up to a megabyte of rows into one task, and a table of many small
# partitions would be written folder after folder: that costs files, not bytes.
JOB_SETTINGS = {**PINNED, "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1b"}

_sessions: WeakKeyDictionary[SparkSession, SparkSession] = WeakKeyDictionary()


def build_session(app_name: str = "wattloom", master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def job_session(spark: SparkSession, settings: dict[str, str] | None = None) -> SparkSession:
    """A session beside ``spark`` with its settings, but all instants in UTC and values
    that do not fit their type failing. The caller's own session is left as it is, so
    jobs may also run at the same time."""
    settings = JOB_SETTINGS if settings is None else settings
    if all(spark.conf.get(key).lower() == value.lower() for key, value in settings.items()):
        return spark
    if spark not in _sessions:
        _sessions[spark] = spark.newSession()
    own = _sessions[spark]
    for key, value in {**spark.conf.getAll, **settings}.items():
        if key.startswith("spark.sql.") and own.conf.isModifiable(key) and own.conf.get(key, None) != value:
            own.conf.set(key, value)
    return own


def hadoop_path(spark: SparkSession, path: str):
    """The file system of a path, whatever its scheme, and the path itself."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def scratch_base(spark: SparkSession) -> str | None:
    """The folder that all executors share: ``spark.checkpoint.dir``, or where that is
    unset what ``SparkContext.setCheckpointDir`` was given."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder for a staged table in the shared folder, removed when the
    application ends."""
    base = scratch_base(spark)
    if not base:
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    path = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    fs, place = hadoop_path(spark, path)
    fs.mkdirs(place)
    fs.deleteOnExit(place)
    return path


def delete_path(spark: SparkSession, path: str) -> None:
    fs, place = hadoop_path(spark, path)
    fs.delete(place, True)


@contextmanager
def scratch(spark: SparkSession, label: str) -> Iterator[str]:
    """``scratch_path`` for the time of a block."""
    path = scratch_path(spark, label)
    try:
        yield path
    finally:
        delete_path(spark, path)
