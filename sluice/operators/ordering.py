"""Order of groups and numbering along an order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.session import scratch_path


def groups_in_key_order(df: DataFrame, key: str = "group_key", partitions: int | None = None) -> DataFrame:
    """Rows hash-partitioned by key, the keys of each partition in byte order.

    All rows of a key meet in one partition, so this is for groups that are combined already.
    """
    split = df.repartition(partitions, key) if partitions else df.repartition(key)
    return split.sortWithinPartitions(key)


def with_ordinals(df: DataFrame, by: list[str], column: str = "ordinal") -> DataFrame:
    """Numbers rows from 1 along an order, without bringing them into one task.

    The rows are range-partitioned, sorted and written; a row's number is its place in its
    file plus the rows of the files before. Only one row per file takes part in the sum.
    Rows that the order does not tell apart can be any share of all rows, so their other
    columns spread them over partitions. A hash does so and not an id, which could send a row
    elsewhere when a lost task runs again.
    """
    spark = df.sparkSession
    where = scratch_path(spark, "ordered")
    order = [*by, "_rest"]
    hashed = [field.name for field in df.schema if "map<" not in field.dataType.simpleString()]
    ordered = df.withColumn("_rest", F.xxhash64(*hashed)).repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.drop("_rest").write.parquet(where)
    written = spark.read.schema(df.schema).parquet(where)
    placed = written.select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_place")
    )
    # Part files are named by the number of the range, of at least five digits.
    before = Window.orderBy(F.length("_file"), "_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_file")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_file", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    )
    # One row per range, so at most spark.sql.shuffle.partitions of them.
    return (
        placed.join(F.broadcast(offsets), "_file")
        .withColumn(column, F.col("_before") + F.col("_place") + 1)
        .select(*df.columns, column)
    )
