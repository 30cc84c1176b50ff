"""Scans of whole files, and the choice of a scan by file extension."""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.records import file_extension
from sluice.sources.json_objects import WHOLE_FILE_BYTES, objects_of
from sluice.sources.paths import FILE_PATH, matching, named_files, split_paths

_ROWS_PER_BATCH = 10_000

def scan_binary(
    spark: SparkSession,
    paths: str | list[str],
    *,
    path_filters: list[str] | None = None,
    keep_empty: bool = True,
    **options: str,
) -> DataFrame:
    """One record per file: its name and all its bytes.

    Spark's scans leave out files of no bytes. ``keep_empty`` counts the files that are listed and scanned, and if
    there are empty ones adds records for them, by a join of their names; a file that vanished then
    counts as empty. Without it nothing is counted, and files of no bytes give no record.
    """
    files = _listed(spark, paths, {"ignoreMissingFiles": "true", **options})
    found = _whole(files, matching(path_filters))
    empty = _empty(files) if keep_empty else None
    return found if empty is None else found.unionByName(empty.where(matching(path_filters, "path")))


def _empty(files: DataFrame) -> DataFrame | None:
    """Records of the listed files of no bytes; ``None`` if as many files are scanned as are listed."""
    full, named = files.select(F.col(FILE_PATH).alias("path")), named_files(files)
    if full.count() == named.count():
        return None
    return named.join(full, "path", "left_anti").withColumn("content", F.lit(b""))


def _listed(spark: SparkSession, paths: str | list[str], options: dict[str, str]) -> DataFrame:
    return spark.read.format("binaryFile").options(**options).load(split_paths(paths))


def _whole(files: DataFrame, wanted: Column) -> DataFrame:
    # A filter on the metadata column is applied to the listing, so other files stay closed.
    return files.where(wanted).select(F.col(FILE_PATH).alias("path"), F.col("path").alias("fileName"), "content")


@dataclass(frozen=True)
class Parser:
    """Turns one file into rows: ``parse(name, content)`` gives tuples in schema order."""

    parse: Callable[[str, bytes], Iterable[tuple]]
    schema: str


def scan_parsed(
    spark: SparkSession,
    paths: str | list[str],
    parser: Parser,
    *,
    path_filters: list[str] | None = None,
    **options: str,
) -> DataFrame:
    """The rows that ``parser`` makes of each file, after the column ``path``."""
    files = _listed(spark, paths, {"ignoreMissingFiles": "true", **options})
    return _parsed(_whole(files, matching(path_filters)), parser)


def _parsed(files: DataFrame, parser: Parser) -> DataFrame:
    schema = f"path string, {parser.schema}"
    names = files.sparkSession.createDataFrame([], schema).columns

    def parsed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = (
            (path, *row)
            for batch in batches
            for path, name, content in batch.itertuples(index=False)
            for row in parser.parse(name, bytes(content))
        )
        while found := list(itertools.islice(rows, _ROWS_PER_BATCH)):
            yield pd.DataFrame(found, columns=names, dtype=object)

    return files.mapInPandas(parsed, schema)


def scan_files(
    spark: SparkSession,
    paths: str | list[str],
    *,
    parsers: dict[str, Parser] | None = None,
    path_filters: list[str] | None = None,
    keep_empty: bool = True,
    **options: str,
) -> DataFrame:
    """Every file by the scan its extension asks for.

    ``JSON`` files give their objects, all others one record with their bytes; ``parsers``
    adds or replaces extensions (in upper case). All records have ``path`` and
    ``extension``; ``seq`` and ``json`` are set for JSON objects, ``fileName`` and
    ``content`` for whole files, and the columns of ``parsers`` for the files they read.
    ``keep_empty`` is that of :func:`scan_binary`; empty files have no JSON objects.
    """
    parsers = parsers or {}
    options = {"ignoreMissingFiles": "true", **options}
    files = _listed(spark, paths, options)
    allowed = matching(path_filters)
    known = sorted({*parsers, "JSON"})

    def other(path: str) -> Column:
        return F.coalesce(~file_extension(F.col(path)).isin(known), F.lit(True))

    records = _whole(files, allowed & other(FILE_PATH))
    empty = _empty(files) if keep_empty else None
    if empty is not None:
        records = records.unionByName(empty.where(matching(path_filters, "path") & other("path")))
    records = records.withColumn("extension", file_extension(F.col("path")))
    extension = file_extension(F.col(FILE_PATH))
    for name in known:
        wanted = allowed & (extension == name)
        if name in parsers:
            found = _parsed(_whole(files, wanted), parsers[name])
        else:
            found = objects_of(files, wanted, WHOLE_FILE_BYTES)
        records = records.unionByName(found.withColumn("extension", F.lit(name)), allowMissingColumns=True)
    return records
