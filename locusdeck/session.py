"""Session settings and the shared folder that written tables go to."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager
from typing import Any, TypeVar

from pyspark.sql import SparkSession

T = TypeVar("T")


def local_session(cores: int | str = 8, name: str = "locusdeck", **conf: str) -> SparkSession:
    """A single-machine session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", os.environ.get("LOCUSDECK_DRIVER_MEMORY", "12g"))
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session without any setting gets a temporary folder of its own.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="locusdeck-"))
    return context.getCheckpointDir().rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; nothing is created yet."""
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/locusdeck/{app}/{name}-{uuid.uuid4().hex[:12]}"


_made: dict[tuple, Any] = {}


def _state(spark: SparkSession, folder: str) -> tuple:
    """Names, sizes and times of what lies in a folder."""
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(place)
    return tuple(sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in found))


def once(spark: SparkSession, source: str, name: str, make: Callable[[str], T]) -> T:
    """What ``make`` gives for a fresh folder, made once per application, input and name.

    For written tables and files that several queries over the same input read. It is made again
    when a table of the input folder has changed in size or time.
    """
    key = (spark.sparkContext.applicationId, shared_folder(spark), source, _state(spark, source), name)
    if key not in _made:
        _made[key] = make(new_folder(spark, name))
    return _made[key]


def sibling(spark: SparkSession) -> SparkSession:
    """A session of the same application with the same settings, for settings of its own."""
    other = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            other.conf.set(key, value)
    return other


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Run one action under changed SQL settings and put the old ones back."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
