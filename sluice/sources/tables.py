"""Line-oriented files and any source that Spark itself can read."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from sluice.sources.paths import matching, split_paths


def scan_lines(
    spark: SparkSession,
    paths: str | list[str],
    schema: str | StructType | None = None,
    *,
    path_filters: list[str] | None = None,
    **options: str,
) -> DataFrame:
    """One JSON record per line, at any file size. Without a schema, it is inferred in an
    extra pass over the input."""
    reader = spark.read.options(**options)
    lines = (reader.schema(schema) if schema else reader).json(split_paths(paths))
    return lines.where(matching(path_filters)) if path_filters else lines


def scan_text(
    spark: SparkSession, paths: str | list[str], *, path_filters: list[str] | None = None, **options: str
) -> DataFrame:
    """One row ``value`` per line."""
    lines = spark.read.options(**options).text(split_paths(paths))
    return lines.where(matching(path_filters)) if path_filters else lines


def scan_service(
    spark: SparkSession, service: str, options: dict[str, str] | None = None, schema: str | StructType | None = None
) -> DataFrame | None:
    """What the data source ``service`` gives for ``options``; ``None`` if there is none of that name."""
    reader = spark.read.format(service).options(**(options or {}))
    try:
        return (reader.schema(schema) if schema else reader).load()
    except (PySparkException, Py4JJavaError) as error:
        # Spark raises this one as a Java error that PySpark does not convert.
        if "[DATA_SOURCE_NOT_FOUND]" in str(error):
            return None
        raise
