"""Spark sessions, and sending this package to executors."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def session(master: str = "local[*]", partitions: int | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; partitions: of shuffles, where given."""
    builder = SparkSession.builder.master(master).appName("tidemark")
    settings = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", **conf}
    if partitions:
        settings["spark.sql.shuffle.partitions"] = str(partitions)
    for k, v in settings.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Send the package's source to the executors, once an application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    _shipped.add(app)
    top = Path(__file__).resolve().parent
    target = os.path.join(tempfile.mkdtemp(prefix="tidemark-"), "tidemark.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(top.rglob("*.py")):
            z.write(p, p.relative_to(top.parent).as_posix())
    spark.sparkContext.addPyFile(target)


def _remove(spark: SparkSession, folder: str) -> None:
    try:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    except Exception:  # noqa: BLE001  the session has ended before Python did
        pass


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors share, removed when Python ends: below spark.checkpoint.dir, or on a local master without one a temporary folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = f"file://{tempfile.mkdtemp(prefix='tidemark-')}"
    own = f"{folder}/{name}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, own)
    return own
