"""Row streams in Arrow batches, and the files that operators write and read back."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from sluice.session import scratch_path

FLUSH_ROWS = 2_000
FLUSH_BYTES = 8 << 20
_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def map_rows(
    df: DataFrame, work: Callable[[Iterator[tuple]], Iterable[tuple]], schema: str, *, every: int = FLUSH_ROWS
) -> DataFrame:
    """``work`` gets the rows of a partition as tuples, lazily, and yields those of the result.

    Rows travel in Arrow batches. A batch of the result is sent when it holds ``every`` rows or
    8 MB, so memory does not depend on the size of a partition.
    """
    kinds = [to_arrow_type(field.dataType) for field in StructType.fromDDL(schema).fields]
    names = StructType.fromDDL(schema).fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def given() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(values, kind) for values, kind in zip(columns, kinds, strict=True)], names=names
            )

        rows: list[tuple] = []
        held = 0
        for row in work(given()):
            rows.append(row)
            held += sum(len(value) for value in row if isinstance(value, (str, bytes)))
            if len(rows) >= every or held >= FLUSH_BYTES:
                yield batch(rows)
                rows, held = [], 0
        if rows:
            yield batch(rows)

    return df.mapInArrow(run, schema)


def staged(df: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared folder and read back: cuts lineage, survives lost executors.

    The shuffle files of the write go with its end; otherwise they stay until the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    where = scratch_path(spark, label)
    before = spark.conf.get(_FREED, None)
    spark.conf.set(_FREED, "true")
    try:
        df.write.parquet(where)
    finally:
        if before is None:
            spark.conf.unset(_FREED)
        else:
            spark.conf.set(_FREED, before)
    return spark.read.schema(df.schema).parquet(where)


def limited_broadcast(df: DataFrame, rows: int = 1_000_000) -> DataFrame:
    """Marks a frame of a few narrow columns for broadcast if it is counted to be small; else it is joined by key."""
    return F.broadcast(df) if df.count() <= rows else df


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def filesystem(where: str) -> tuple[pafs.FileSystem, str]:
    """A path or URI of the shared folder (``file:``, ``hdfs:``, ``s3:`` and so on) for use inside tasks."""
    if "://" not in where:
        where = where.removeprefix("file:")
        return pafs.LocalFileSystem(), where
    return pafs.FileSystem.from_uri(where)


def utf8(text: str | None) -> bytes:
    """A text's bytes; a null is empty, a lone surrogate keeps its own three bytes."""
    return (text or "").encode("utf-8", "surrogatepass")
