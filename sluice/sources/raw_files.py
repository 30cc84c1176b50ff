"""What becomes of raw files after they were read: they are archived or deleted."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime
from functools import partial

import pyarrow as pa
import pyarrow.fs as pafs
from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.records import NO_PERIOD, period_folder
from sluice.session import scratch_path
from sluice.sources.byte_ranges import filesystem, reachable

_log = logging.getLogger(__name__)

IMPORT_AREA = "/import/"
# Renames and deletions only wait for the file system.
_AT_ONCE = 16


@dataclass(frozen=True)
class Storage:
    """A dataset's settings for raw files. ``None`` for a block that is not there; a block
    that is there counts as enabled unless it says no."""

    storage: dict[str, bool | None] | None = None
    raw: dict[str, bool | None] | None = None


def run_folder(spark: SparkSession, run_time: datetime, pattern: str | None = None) -> str:
    """The folder of the period in which a run began; one for all if there is no period."""
    return spark.range(1).select(period_folder(F.lit(run_time), pattern)).first()[0]


def cleaning(
    folder: str,
    storage: Storage,
    archive: str | None = None,
    *,
    period: str = NO_PERIOD,
    area: str = IMPORT_AREA,
) -> dict[str, str]:
    """Options of the file source that clean up ``folder``: nothing outside the import area,
    else archiving where storage and raw storage are both enabled, else deletion. Archived
    files go to the run's folder ``period`` below ``archive``."""

    def enabled(block: dict[str, bool | None] | None) -> bool:
        return block is not None and block.get("enabled") is not False

    if area not in f"{folder.rstrip('/')}/":
        return {}
    if enabled(storage.storage) and enabled(storage.raw):
        if not archive:
            raise ValueError("an archive folder is needed")
        return {"cleanSource": "archive", "sourceArchiveDir": f"{archive}/{period}"}
    return {"cleanSource": "delete"}


def clean_files(
    spark: SparkSession,
    names: list[str] | DataFrame,
    storage: Storage,
    archive: str | None = None,
    *,
    period: str = NO_PERIOD,
    area: str = IMPORT_AREA,
) -> DataFrame:
    """Archives or deletes files as :func:`cleaning` says for their folders; a log of what was done.

    An archived file keeps its whole path below the run's folder; one that is there already is
    not replaced. ``names`` may be a frame of one column. The tasks of a job move and delete the files, and a task that runs
    again finds what it has done before. The log, ``(name, done)``, is a written table: ``done`` is
    ``archive``, ``delete``, ``kept`` for files that are none of the import area's, ``gone``, or ``failed: …``. A
    file that cannot be cleaned up stays; how many did is logged. In stores that tasks cannot reach themselves
    the driver does the same.
    """
    listed = spark.createDataFrame([(name,) for name in names], "name string") if isinstance(names, list) else names.toDF("name")
    if archive is None and not listed.where(F.col("name").contains(area)).isEmpty():
        cleaning(area, storage, archive, period=period, area=area)  # what is missing is said here and not in a task
    first = listed.first()
    if first is None or (reachable(first.name) and (archive is None or reachable(archive))):
        rules = partial(cleaning, storage=storage, archive=archive, period=period, area=area)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = batch.column(0).to_pylist()
                with ThreadPoolExecutor(_AT_ONCE) as pool:
                    done = list(pool.map(lambda name: _clean(name, rules(name.rpartition("/")[0])), found))
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array(done, pa.string())], ["name", "done"])

        tasks = max(1, min(spark.sparkContext.defaultParallelism * 4, listed.count() // _AT_ONCE))
        log = listed.repartition(tasks).mapInArrow(run, "name string, done string")
    else:
        done = _clean_from_driver(spark, [row.name for row in listed.collect()], storage, archive, period, area)
        log = spark.createDataFrame(done, "name string, done string")
    where = scratch_path(spark, "cleaned")
    log.write.parquet(where)
    log = spark.read.parquet(where)
    failed = log.where("done like 'failed%'")
    for row in failed.limit(20).collect():
        _log.warning("%s could not be cleaned up: %s", row.name, row.done)
    return log


def _clean(name: str, wanted: dict[str, str]) -> str:
    """Cleans up one file from within a task; what was done, also by an attempt before."""
    if not wanted:
        return "kept"
    try:
        system, path = filesystem(name)
        there = system.get_file_info(path).type != pafs.FileType.NotFound
        if wanted["cleanSource"] == "delete":
            if there:
                system.delete_file(path)
            return "delete" if there else "gone"
        _, root = filesystem(wanted["sourceArchiveDir"])
        # A name of its own, but the same for every attempt.
        kept, other = root + path, f"{root}/{uuid.uuid5(uuid.NAMESPACE_URL, name).hex}{path}"
        taken = [system.get_file_info(place).type != pafs.FileType.NotFound for place in (kept, other)]
        if not there:
            return "archive" if any(taken) else "gone"
        target = other if taken[0] else kept
        if taken[0] and taken[1]:
            target = f"{root}/{uuid.uuid4().hex}{path}"
        system.create_dir(target.rpartition("/")[0], recursive=True)
        system.move(path, target)
    except (OSError, pa.ArrowException) as error:
        return f"failed: {error}"
    return "archive"


def _clean_from_driver(
    spark: SparkSession, names: list[str], storage: Storage, archive: str | None, period: str, area: str
) -> list[tuple[str, str]]:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()

    def clean(name: str) -> tuple[str, str]:
        wanted = cleaning(name.rpartition("/")[0], storage, archive, period=period, area=area)
        if not wanted:
            return name, "kept"
        try:
            path = jvm.org.apache.hadoop.fs.Path(name)
            system = path.getFileSystem(conf)
            if wanted["cleanSource"] == "delete":
                done = system.delete(path, False)
            else:
                root, below = wanted["sourceArchiveDir"], path.toUri().getPath()
                kept = jvm.org.apache.hadoop.fs.Path(root + below)
                if system.exists(kept):
                    kept = jvm.org.apache.hadoop.fs.Path(f"{root}/{uuid.uuid4().hex}{below}")
                done = system.mkdirs(kept.getParent()) and system.rename(path, kept)
        except Py4JError as error:
            return name, f"failed: {error}"
        return name, wanted["cleanSource"] if done else "failed: refused"

    with ThreadPoolExecutor(_AT_ONCE) as pool:
        return list(pool.map(clean, names))
