"""Shared by the registered queries: tables, and files written from them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_number(hundredths: Column) -> Column:
    """An amount in hundredths, as sums of doubles depend on their order."""
    return F.round(hundredths * 100).cast("bigint")


def json_of(*columns: str, **options: str) -> Column:
    return F.to_json(F.struct(*columns), options)


def write_texts(df: DataFrame, path: str, *, rows_per_file: int = 0, separator: str = "\n") -> None:
    """Writes a frame of one text column as files of at most ``rows_per_file`` rows."""
    df.write.option("maxRecordsPerFile", rows_per_file).option("lineSep", separator).text(path)


def row_count() -> Column:
    return F.count(F.lit(1)).alias("n")


def total_cents(column: str) -> Column:
    return F.sum(whole_number(F.col(column))).alias("cents")
