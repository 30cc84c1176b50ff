"""Where records go."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from pyspark.sql.types import StringType, StructField, StructType

from sluice.functions.records import period_folder


def write_dataset(df: DataFrame, path: str, *, format: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Adds the records to the dataset at ``path``; each partition is committed once."""
    df.write.mode("append").format(format).partitionBy(*(partition_by or [])).save(path)


def write_routed(
    df: DataFrame, root: str, *, target: str = "target", format: str = "parquet", compact: bool = False
) -> None:
    """Adds each record to the dataset that its ``target`` column names, below ``root``.

    Tasks write what they hold, without a shuffle. ``compact`` first gathers the records of
    a target to have fewer files; targets that are large are spread over several tasks.
    """
    if compact:
        df = df.hint("rebalance", F.col(target))
    df.write.mode("append").format(format).partitionBy(target).save(root)


def read_routed(spark: SparkSession, root: str, *, target: str = "target", format: str = "parquet") -> DataFrame:
    """All that :func:`write_routed` has written below ``root``, with the targets as the texts they were."""
    found = spark.read.format(format).load(root).schema
    texts = [StructField(field.name, StringType()) if field.name == target else field for field in found]
    return spark.read.format(format).schema(StructType(texts)).load(root)


def archive_raw(
    df: DataFrame, root: str, run_time: Column, pattern: str | None = None, *, format: str = "parquet"
) -> None:
    """Keeps raw records below ``root`` in the folder of the period of the run."""
    write_routed(df.withColumn("period", period_folder(run_time, pattern)), root, target="period", format=format)


def preview(df: DataFrame, rows: int = 20) -> list[Row]:
    """The first few records, for a look at them."""
    return df.limit(rows).collect()
