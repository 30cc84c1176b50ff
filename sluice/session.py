"""Session set-up and the shared folder for intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import SparkSession

_PACKAGE = Path(__file__).parent
_shipped: set[str] = set()
_scratch: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


def build_session(app: str = "sluice", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings this package is tuned for; ``conf`` overrides any of them.

    On a cluster the master and the memory come from ``spark-submit``.
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.execution.arrow.maxBytesPerBatch": "64m",
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**settings, **conf}.items():
        builder = builder.config(name, value)
    session = builder.getOrCreate()
    ship_package(session)
    return session


def ship_package(spark: SparkSession) -> None:
    """Lets Python workers import this package, as ``--py-files`` would."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="sluice-"), f"{_PACKAGE.name}.zip")
    with zipfile.ZipFile(archive, "w") as package:
        for module in sorted(_PACKAGE.rglob("*.py")):
            package.write(module, module.relative_to(_PACKAGE.parent))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(application)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Removes a folder that this package wrote, wherever Spark can write; nothing if it is not there."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def scratch_removed(spark: SparkSession) -> Iterator[None]:
    """At its end, the folders that :func:`scratch_path` gave in it are removed.

    What is computed from them has to be written before.
    """
    made: list[str] = []
    token = _scratch.set(made)
    try:
        yield
    finally:
        _scratch.reset(token)
        for path in made:
            remove_folder(spark, path)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused folder below the cluster's shared ``spark.checkpoint.dir``.

    Only a local master may fall back to the machine's temporary folder: tables
    written here are read by every executor and must survive the loss of one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = os.path.join(tempfile.gettempdir(), "sluice-scratch")
    path = f"{base.rstrip('/')}/sluice/{label}-{uuid.uuid4().hex}"
    made = _scratch.get()
    if made is not None:
        made.append(path)
    return path
