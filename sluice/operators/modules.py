"""User code over batches of rows, and the changes it makes to records."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class BatchModule:
    """User code over one partition's rows, batch by batch.

    Each task works on its own copy. ``start`` runs before the first batch and ``end``
    after the last; rows that ``end`` gives are part of the result.
    """

    def start(self) -> None:
        pass

    def batch(self, rows: pd.DataFrame) -> pd.DataFrame | Iterable[pd.DataFrame]:
        return rows

    def end(self) -> Iterable[pd.DataFrame]:
        return ()


def map_batches(
    df: DataFrame,
    module: BatchModule | Callable[[pd.DataFrame], pd.DataFrame | Iterable[pd.DataFrame]],
    schema: str,
    batch_size: int | None = None,
) -> DataFrame:
    """Any number of rows for each batch of rows.

    Batches have exactly ``batch_size`` rows, but for a partition's last one; unset, they
    are as large as Arrow's transfer limits make them, which is faster. Column functions
    are faster still; select the needed columns first, as nothing is pruned through this.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hooks = isinstance(module, BatchModule)
        step = module.batch if hooks else module
        if hooks:
            module.start()
        for rows in _resized(batches, batch_size) if batch_size else batches:
            result = step(rows)
            yield from (result,) if isinstance(result, pd.DataFrame) else result
        if hooks:
            yield from module.end()

    return df.mapInPandas(run, schema)


def _resized(batches: Iterator[pd.DataFrame], size: int) -> Iterator[pd.DataFrame]:
    rest: pd.DataFrame | None = None
    for rows in batches:
        rows = rows if rest is None else pd.concat([rest, rows], ignore_index=True)
        full = len(rows) - len(rows) % size
        for begin in range(0, full, size):
            yield rows.iloc[begin : begin + size].reset_index(drop=True)
        rest = rows.iloc[full:]
    if rest is not None and len(rest):
        yield rest.reset_index(drop=True)


def passthrough(df: DataFrame) -> DataFrame:
    """The records as they came, without raw bytes: those live for one stage only."""
    return df.drop("content")


def merge_fields(df: DataFrame, changes: dict[str, Column]) -> DataFrame:
    """Sets top-level fields: in place if they exist, at the end if not. Nested objects are
    replaced whole and null is a value."""
    return df.withColumns(changes)


def with_record_id(df: DataFrame, column: str = "record_id") -> DataFrame:
    """Adds an id that is unique in the frame, counted up within each partition.

    A frame that is computed again can have other ids; write it before relying on them.
    """
    return df.withColumn(column, F.monotonically_increasing_id())
