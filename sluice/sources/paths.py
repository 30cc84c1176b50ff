"""Which files an input consists of."""

from __future__ import annotations

import logging
import re
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators.ordering import with_ordinals

_log = logging.getLogger(__name__)

# The scans' own file path; URL-encoded. Filters on it are applied while files are listed.
FILE_PATH = "_metadata.file_path"

BROADCAST_FILES = 200_000


def split_paths(paths: str | list[str]) -> list[str]:
    """A comma-separated list of globs; commas inside ``{}``, nested or never closed, do not separate."""
    if not isinstance(paths, str):
        return list(paths)
    found, depth = [""], 0
    for char in paths:
        depth += (char == "{") - (char == "}" and depth > 0)
        if char == "," and not depth:
            found.append("")
        else:
            found[-1] += char
    return [path.strip() for path in found if path.strip()]


_GLOB_CHARACTER = re.compile(r"([\\{}\[\]*?])")


def literal(path: str) -> str:
    """A listed path as a path to load, its glob characters escaped."""
    return _GLOB_CHARACTER.sub(r"\\\1", path)


def matching(path_filters: list[str] | None, path: str = FILE_PATH) -> Column:
    """Every one of the regular expressions is found in the file's path."""
    wanted = F.lit(True)
    for pattern in path_filters or []:
        wanted = wanted & F.col(path).rlike(pattern)
    return wanted


def list_files(
    spark: SparkSession, paths: str | list[str], *, path_filters: list[str] | None = None, **options: str
) -> DataFrame:
    """``(path, fileName, length)`` of the files of ``paths``, none of them opened.

    Directories are listed one level deep unless ``recursiveFileLookup`` is set; names that
    begin with ``_`` or ``.`` are left out. ``path`` is what the scans call a file,
    ``fileName`` is the same without URL encoding.
    """
    files = spark.read.format("binaryFile").options(**options).load(split_paths(paths))
    return files.where(matching(path_filters)).select(
        F.col(FILE_PATH).alias("path"), F.col("path").alias("fileName"), "length"
    )


def named_files(files: DataFrame) -> DataFrame:
    """``(path, fileName)``, as of :func:`list_files`, of all files of a scan, also of those of no
    bytes, which Spark's scans leave out. The names pass through the driver, which has listed them."""
    names = [(name.replace("file:///", "file:/", 1),) for name in files.inputFiles()]
    listed = files.sparkSession.createDataFrame(names, "path string")
    # A plus sign stands for itself in a path.
    return listed.withColumn("fileName", F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B"))))


def first_files(
    spark: SparkSession, paths: str | list[str], count: int, *, path_filters: list[str] | None = None, **options: str
) -> list[str]:
    """The first ``count`` files in path order, for trial runs over a bounded input."""
    listed = list_files(spark, paths, path_filters=path_filters, **options)
    first = listed.select("fileName").orderBy("fileName").limit(count)
    return [literal(row.fileName) for row in first.collect()]


def or_empty(spark: SparkSession, load: Callable[[], DataFrame], schema: str, missing_ok: bool) -> DataFrame:
    """The frame that ``load`` gives; with ``missing_ok`` an empty one if a path is absent, with a warning."""
    try:
        return load()
    except AnalysisException as error:
        if missing_ok and error.getCondition() == "PATH_NOT_FOUND":
            _log.warning("an input is empty, as a path of it is missing: %s", error.getMessageParameters())
            return spark.createDataFrame([], schema)
        raise


def with_file_index(records: DataFrame, files: DataFrame, column: str = "file_index") -> DataFrame:
    """Adds the ordinal of each record's file among the listed ``files``, from 0 in path order."""
    numbered = with_ordinals(files.select("path").distinct(), ["path"], column)
    numbered = numbered.withColumn(column, F.col(column) - 1)
    # A file can hold any share of the records, so they stay where they are if they can.
    return records.join(F.broadcast(numbered) if files.count() <= BROADCAST_FILES else numbered, "path")
