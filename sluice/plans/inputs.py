"""The inputs of a job and their union."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.sources.files import scan_files
from sluice.sources.paths import first_files, literal, matching, named_files, or_empty, split_paths
from sluice.sources.tables import scan_service

_log = logging.getLogger(__name__)

SOURCE_COLUMNS = ("path", "seq", "extension")

# A trial run looks at no more than this many files for each record that it wants.
FILES_PER_RECORD = 5


@dataclass(frozen=True)
class Input:
    """One input: files of ``paths``, or what the data source ``service`` gives for ``options``.

    ``schema`` types the records: of JSON objects for files, of the source for services.
    Records have the columns of their scan; ``path``, ``seq`` and ``extension``, which tell
    where a file's record comes from, only with ``source_columns``.
    ``scan(spark, paths, **options)`` replaces the choice of a scan by file extension, and
    gets the schema and the path filters too, if there are any;
    :func:`~sluice.sources.tables.scan_lines` is the one for files of one record per line.
    """

    name: str
    paths: str | list[str] | None = None
    service: str | None = None
    options: dict[str, str] = field(default_factory=dict)
    path_filters: list[str] = field(default_factory=list)
    schema: str | None = None
    source_columns: bool = False
    scan: Callable[..., DataFrame] | None = None
    enabled: bool | None = None
    limit: int | None = None
    order_by: tuple[str, ...] = ()
    missing_ok: bool = False

    def load(self, spark: SparkSession, trial_limit: int | None = None) -> DataFrame | None:
        """The records; ``None`` for a service that does not exist.

        Only a trial run, one with a ``trial_limit``, cuts anything: of a service input its own
        ``limit`` rows if it has one. It takes the first rows by ``order_by`` of the files that it
        looks at, or any rows without it, which reads no more than it takes to find them.
        """
        own = trial_limit is not None and self.service and self.limit is not None
        limit = self.limit if own else trial_limit
        if self.service:
            records = scan_service(spark, self.service, self.options, self.schema)
            if records is None:
                _log.warning("input %s: there is no data source %s", self.name, self.service)
                return None
        else:
            records = or_empty(spark, lambda: self._files(spark, limit), self._empty_schema(), self.missing_ok)
        if limit is None:
            return records
        return records.orderBy(*self.order_by).limit(limit) if self.order_by else records.limit(limit)

    def _files(self, spark: SparkSession, limit: int | None) -> DataFrame:
        paths = split_paths(self.paths or [])
        filters = {"path_filters": self.path_filters} if self.path_filters else {}
        if limit is not None:
            paths = first_files(spark, paths, FILES_PER_RECORD * limit, **filters, **self.options)
        if not paths and self.paths is not None:
            return spark.createDataFrame([], self._empty_schema())
        if self.scan:
            schema = {"schema": self.schema} if self.schema else {}
            return self.scan(spark, paths, **schema, **filters, **self.options)
        records = scan_files(spark, paths, **filters, **self.options)
        if not self.source_columns:
            records = records.drop(*SOURCE_COLUMNS)
        return typed(records, self.schema) if self.schema else records

    def taken(self, spark: SparkSession) -> tuple[Input, list[str]]:
        """The input of just the files that are there now, and their names, so that what is cleaned up is what was read."""

        def listed() -> DataFrame:
            files = spark.read.format("binaryFile").options(**self.options).load(split_paths(self.paths or []))
            return named_files(files).where(matching(self.path_filters, "path"))

        found = or_empty(spark, listed, "path string, fileName string", self.missing_ok)
        names = sorted(row.fileName for row in found.collect())
        return replace(self, paths=[literal(name) for name in names]), names

    def _empty_schema(self) -> str:
        source = "path string, seq bigint, extension string, " if self.source_columns else ""
        return f"{source}{self.schema or 'json string'}, fileName string, content binary"


def typed(records: DataFrame, schema: str, column: str = "json") -> DataFrame:
    """Replaces JSON text by its fields; a missing field is null. A field takes the place of
    a column of the same name."""
    parsed = records.withColumn("_record", F.from_json(column, schema))
    fields = parsed.schema["_record"].dataType.names
    others = [name for name in records.columns if name != column and name not in fields]
    return parsed.select(*others, "_record.*")


def is_on(enabled: bool | None) -> bool:
    return enabled is None or enabled


def load_inputs(spark: SparkSession, inputs: list[Input], trial_limit: int | None = None) -> DataFrame:
    """All records of all enabled inputs, duplicates kept; columns an input lacks are null.

    ``trial_limit`` is the number of records that a trial run takes of each input, unless a
    service input has a limit of its own.
    """
    frames = [item.load(spark, trial_limit) for item in inputs if is_on(item.enabled)]
    frames = [frame for frame in frames if frame is not None]
    if not frames:
        raise ValueError("no enabled input could be read")
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)
