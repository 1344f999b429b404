"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession

#: Settings the operators rely on, in any session.
REQUIRED = {
    # Message timestamps carry no zone: days and hours are cut in one fixed zone.
    "spark.sql.session.timeZone": "UTC",
    # Combine a hot user's sessions inside each map task before the shuffle.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}

#: Settings for sessions this package creates.
SETTINGS = {
    **REQUIRED,
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Keep window and dedup state off the heap, and save only its changes.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(
    app_name: str,
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or get) a session with the package's settings.

    ``shuffle_partitions`` also fixes the number of state-store partitions of new
    streaming checkpoints, which cannot change later: choose it for the cluster.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SETTINGS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def require_settings(spark: SparkSession) -> None:
    """Set what the operators rely on in a session created elsewhere."""
    for key, value in REQUIRED.items():
        spark.conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the session names in ``spark.checkpoint.dir``.

    A machine-local folder is used only when the setting is absent and Spark
    itself runs in this one process, as in tests.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return tempfile.gettempdir()


def new_scratch(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; nothing is created yet."""
    return f"{shared_dir(spark)}/pacefold/{label}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder this package wrote, in whatever store holds it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def workers_find_package(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package from its source folder.

    On a cluster it is installed there or sent along (``--py-files``).
    """
    root = str(Path(__file__).resolve().parents[1])
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, *paths]))
