"""Session settings and the shared working folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import SparkSession


def build_session(app_name: str = "spindlewave", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the library expects; ``conf`` overrides them.

    Shuffle partitions are left to the cluster: adaptive execution merges small
    ones and splits skewed ones.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _own_folder() -> str:
    """A folder for this process, removed when it ends."""
    folder = tempfile.mkdtemp(prefix="spindlewave-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh path under the folder that all executors share.

    The folder is ``spark.checkpoint.dir``. Only a local session, where driver
    and executors are one process, may go without it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = _own_folder()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def path_exists(path: str) -> bool:
    """Whether there is a file or folder, in whatever store the path names."""
    spark = SparkSession.active()
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def make_folder(spark: SparkSession, path: str) -> None:
    """An empty folder, if there is none."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a working table that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Set session options for the length of a ``with`` block."""
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
