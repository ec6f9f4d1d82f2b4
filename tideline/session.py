"""Session-level helpers: time zone and the shared working folder.

All checkpoints, staged replay files and sink outputs live under the folder the
cluster names in ``spark.checkpoint.dir``; it must be visible to the driver and
every executor (HDFS, object store, or a shared mount). Only a local-mode
session without that setting gets a private temporary folder, as in tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

_LOCAL_DIRS: dict[str, str] = {}
_SHIPPED: set[str] = set()


def pin_utc(spark: SparkSession) -> None:
    """Event times are epoch based; reports are UTC wall clock."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def _conf(spark: SparkSession, key: str) -> str | None:
    try:
        value = spark.conf.get(key, None)
    except Exception:  # noqa: BLE001 - absent core conf raises on some builds
        value = None
    return value or None


def shared_dir(spark: SparkSession) -> str:
    """Root folder for everything this library writes.

    Order: ``spark.checkpoint.dir``; the SparkContext checkpoint dir; else, on a
    local master only, a fresh temporary folder that is also installed as the
    context's checkpoint dir. A cluster session without the setting is an error:
    a machine-local folder would not be visible to executors.
    """
    root = _conf(spark, "spark.checkpoint.dir")
    sc = spark.sparkContext
    if not root:
        root = sc.getCheckpointDir()
    if not root:
        key = sc.applicationId
        if key not in _LOCAL_DIRS:
            if not sc.master.startswith("local"):
                raise RuntimeError(
                    "spark.checkpoint.dir is not set; point it at a folder shared by "
                    "the driver and all executors"
                )
            _LOCAL_DIRS[key] = tempfile.mkdtemp(prefix="tideline-")
            sc.setCheckpointDir(_LOCAL_DIRS[key])
        root = _LOCAL_DIRS[key]
    return root.rstrip("/")


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A new, unique folder path (not created) under the shared root."""
    return f"{shared_dir(spark)}/tideline/{kind}/{uuid.uuid4().hex}"


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once for each application.

    Not needed where their PYTHONPATH has it already.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    sc = spark.sparkContext
    if root in os.environ.get("PYTHONPATH", "").split(os.pathsep) or sc.applicationId in _SHIPPED:
        return
    _SHIPPED.add(sc.applicationId)
    archive = os.path.join(tempfile.mkdtemp(prefix="tideline-code-"), "tideline.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(os.path.join(root, "tideline")):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, root))
    sc.addPyFile(archive)
