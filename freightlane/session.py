"""Session settings the jobs expect, and the shared folder for work files."""

from __future__ import annotations

import atexit
import contextlib
import uuid
from urllib.parse import urlsplit

from pyspark.sql import SparkSession

# AQE re-plans joins and splits skewed partitions at run time; UTC keeps time stamps comparable
# between engines. Call-site capture for every column expression doubles the driver's planning time for wide
# tables. Partition counts and memory are left to the cluster.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(name: str = "freightlane", master: str | None = None, **settings: str) -> SparkSession:
    """A session with SETTINGS; further settings are given with '_' or '.' names in a dict."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: spark.checkpoint.dir, else the warehouse.

    The warehouse defaults to a folder of the driver's machine. With executors elsewhere such a folder would be
    written piecemeal and read back empty, so that choice is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", "") or ""
    if named:
        return named.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    master = spark.conf.get("spark.master", "local")
    one_machine = master == "local" or master.startswith("local[")
    if not one_machine and urlsplit(warehouse).scheme in ("", "file"):
        raise ValueError(f"set spark.checkpoint.dir to a folder that all machines see; {warehouse} is local")
    return f"{warehouse}/work"


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder name for work files below the shared folder.

    Frames are read lazily, so a work folder may be needed as long as the application runs; it is removed when the
    driver ends.
    """
    if not _MADE:
        atexit.register(_remove_all)
    folder = f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"
    _MADE.append((spark, folder))
    return folder


#: The work folders of this driver, with the session that made them.
_MADE: list[tuple[SparkSession, str]] = []


def _remove_all() -> None:
    for spark, folder in _MADE:
        # At the end of the driver the JVM may be gone already; nothing else is left to do then.
        with contextlib.suppress(Exception):
            remove_folder(spark, folder)


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete a work folder that this code made, in whatever file system it lies."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
