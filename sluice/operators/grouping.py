"""Grouping by record fields, and user code over groups.

One key may hold a large part of all rows, so no operator here sends a group's raw rows to
one task unless the caller states how large a group can be. Native aggregates are combined
map-side by Spark; grouped modules are combined map-side by a partial step of the same kind
as the module's input, on salted keys if asked for, and see only what is left of a group.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from sluice.functions.records import json_group_key, key_of

KEY = "group_key"

_HELD_BYTES = 16 * 1024 * 1024
_ROWS_OUT = 2000
#: Fewer rows of a key cost less as they are than a call.
_FEW_ROWS = 16

GroupModule = Callable[[str, Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]
Partial = Callable[[pd.DataFrame], pd.DataFrame]


def with_group_key(
    df: DataFrame, fields: list[str], *, given: str | None = None, json: str | None = None
) -> DataFrame:
    """Adds the group key: the key in column ``given`` where a stage set one, else the
    object of ``fields``, taken from typed columns or from the JSON text column ``json``."""
    if not fields and not given:
        raise ValueError("a grouped stage needs grouping fields or a given key")
    key = F.lit("{}")
    if fields:
        key = json_group_key(F.col(json), *fields) if json else key_of(*[_zeros_alike(df, name) for name in fields])
    return df.withColumn(KEY, F.coalesce(F.col(given), key) if given else key)


def _zeros_alike(df: DataFrame, name: str) -> Column:
    """A field, named by its path; negative zeros become zeros, as in grouping by columns."""
    column = F.col(name)
    if isinstance(df.select(column).schema[0].dataType, (DoubleType, FloatType)):
        column = F.when(column == 0, F.abs(column)).otherwise(column)
    return column.alias(name)


def group_agg(df: DataFrame, *aggregates: Column, partitions: int | None = None) -> DataFrame:
    """Native aggregates per group of a frame that has the group key."""
    result = df.groupBy(KEY).agg(*aggregates)
    return result.repartition(partitions, KEY) if partitions else result


def group_fields(
    df: DataFrame, fields: list[str], *aggregates: Column, partitions: int | None = None
) -> DataFrame:
    """As :func:`group_agg` after :func:`with_group_key`, for typed columns.

    Rows are grouped by the columns themselves and the key is written once per group, not
    once per row. Equal values have the same key, for which 0.0 and -0.0 count as equal.
    """
    places = [f"_key_{place}" for place in range(len(fields))]
    groups = df.groupBy(*[F.col(name).alias(place) for name, place in zip(fields, places, strict=True)])
    result = groups.agg(*aggregates)
    named = [F.col(place).alias(name) for name, place in zip(fields, places, strict=True)]
    keyed = result.select(key_of(*named).alias(KEY), *[name for name in result.columns if name not in places])
    return keyed.repartition(partitions, KEY) if partitions else keyed


def group_apply(
    df: DataFrame,
    module: GroupModule,
    schema: str,
    *,
    partial: Partial | None = None,
    use_combiner: bool = True,
    max_group_rows: int | None = None,
    salts: int = 0,
    partitions: int | None = None,
) -> DataFrame:
    """Runs ``module(key, batches)`` once per group; it yields any number of rows.

    Before that, groups are made small map-side:

    * ``partial(rows)`` combines rows of many groups at once. It must keep the columns of
      ``df``, group key included, and be associative: its output is its own next input.
    * Without ``partial``, the module itself is the combiner, so the same holds for it; a
      key that it sets while combining is replaced by the key of its input. Keys of which a
      task holds a few rows only are passed on as they are.
    * ``use_combiner=False`` is for modules that must see every row of a group in one call.
      A group is then one task's work, so ``max_group_rows`` must say how many rows a group
      can have; the job fails, rather than giving a partial answer, if there are more.

    ``salts`` adds a round that combines each key in that many tasks, for partial steps that
    leave many rows of a group. ``partitions`` is the number of tasks that work on groups.

    Where the module can work on many groups at once, :func:`group_frames` is faster.
    """
    if partial is None and use_combiner:
        partial = _as_partial(df, module, schema)
    if partial is None and max_group_rows is None:
        raise ValueError("a module without a partial step needs max_group_rows: the size a group can have")
    limit = max_group_rows if partial is None else None
    has_key = KEY in df.sparkSession.createDataFrame([], schema).columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        results, keys = [], []
        for key, rows in _groups(batches):
            for result in module(key, rows if limit is None else _checked(key, rows, limit)):
                results.append(result)
                keys += [key] * len(result)
                if len(keys) >= _ROWS_OUT or len(results) >= _ROWS_OUT:
                    yield _with_keys(results, keys) if has_key else pd.concat(results)
                    results, keys = [], []
        if results:
            yield _with_keys(results, keys) if has_key else pd.concat(results)

    return _by_key(df, partial, salts, partitions).sortWithinPartitions(KEY).mapInPandas(run, schema)


def _groups(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[str, Iterator[pd.DataFrame]]]:
    """The groups of rows in key order, each as a stream of frames."""

    def stretches() -> Iterator[tuple[str, pd.DataFrame]]:
        for rows in batches:
            keys = rows[KEY].to_numpy()
            edges = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
            for begin, end in itertools.pairwise(edges):
                if begin < end:
                    yield keys[begin], rows.iloc[begin:end].reset_index(drop=True)

    for key, group in itertools.groupby(stretches(), key=lambda stretch: stretch[0]):
        yield key, (rows for _, rows in group)


def _with_keys(results: list[pd.DataFrame], keys: list[str]) -> pd.DataFrame:
    return pd.concat(results, ignore_index=True).assign(**{KEY: keys})


def group_frames(
    df: DataFrame, finish: Partial, schema: str, *, partial: Partial, salts: int = 0, partitions: int | None = None
) -> DataFrame:
    """Runs ``finish(rows)`` on the rows that ``partial`` leaves of many whole groups at once.

    The groups of a call are in key order. Cheaper than :func:`group_apply` by the cost of a
    call per group.
    """
    ordered = _by_key(df, partial, salts, partitions).sortWithinPartitions(KEY)
    return ordered.mapInPandas(_whole_groups(finish, partial), schema)


def _by_key(df: DataFrame, partial: Partial | None, salts: int, partitions: int | None) -> DataFrame:
    if partial is not None:
        df = df.mapInPandas(_combined(partial), df.schema)
        if salts > 1:
            df = _salted(df, partial, salts)
    # A given number of partitions is kept, while others are merged by their bytes, of which
    # there are few after the partial step, however long the user code takes.
    return df.repartition(partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), KEY)


def _whole_groups(finish: Partial, partial: Partial) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: pd.DataFrame | None = None
        for rows in batches:
            if rows.empty:
                continue
            rows = rows if held is None else pd.concat([held, rows], ignore_index=True)
            last = int((rows[KEY] == rows[KEY].iloc[-1]).argmax())
            if last:
                yield finish(rows.iloc[:last].reset_index(drop=True))
            held = partial(rows.iloc[last:])  # may go on in the next batch
        if held is not None:
            yield finish(held.reset_index(drop=True))

    return run


def _checked(key: str, batches: Iterator[pd.DataFrame], limit: int) -> Iterator[pd.DataFrame]:
    seen = 0
    for rows in batches:
        seen += len(rows)
        if seen > limit:
            raise RuntimeError(f"group {key} has more than max_group_rows={limit} rows; give a partial step")
        yield rows


def _as_partial(df: DataFrame, module: GroupModule, schema: str) -> Partial:
    def types(of):
        return {field.name: field.dataType for field in of.schema if field.name != KEY}

    if types(df) != types(df.sparkSession.createDataFrame([], schema)):
        raise ValueError(
            "the module's rows differ from its input's, so it cannot be its own combiner: "
            "give a partial step, or use_combiner=False and max_group_rows"
        )
    columns = df.columns

    def partial(rows: pd.DataFrame) -> pd.DataFrame:
        numbers, _ = pd.factorize(rows[KEY])
        order = np.argsort(numbers, kind="stable")
        order = order[numbers[order] >= 0]
        sizes = np.bincount(numbers[order])
        few = np.repeat(sizes < _FEW_ROWS, sizes)
        done, results, keys = [rows.take(order[few])[columns]], [], []
        rows, sizes = rows.take(order[~few]), sizes[sizes >= _FEW_ROWS]
        for begin, end in itertools.pairwise(np.cumsum([0, *sizes]).tolist()):
            group = rows.iloc[begin:end]
            key = group[KEY].iloc[0]
            for result in module(key, iter([group])):
                results.append(result)
                keys += [key] * len(result)
            # A frame takes kilobytes, so one per key would take many times what its rows do.
            if len(results) >= _ROWS_OUT:
                done.append(_with_keys(results, keys)[columns])
                results, keys = [], []
        if keys:
            done.append(_with_keys(results, keys)[columns])
        done = [part for part in done if len(part)] or done[:1]
        return pd.concat(done, ignore_index=True) if len(done) > 1 else done[0]

    return partial


def _combined(partial: Partial) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Combines a partition's rows, holding a bounded amount of them."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        held_bytes = 0
        for rows in batches:
            held.append(rows)
            held_bytes += _bytes(rows)
            if held_bytes < _HELD_BYTES:
                continue
            held = [partial(pd.concat(held, ignore_index=True))]
            held_bytes = _bytes(held[0])
            if held_bytes > _HELD_BYTES // 2:  # mostly different keys: holding on gains nothing
                yield held.pop()
                held_bytes = 0
        if held:
            yield partial(pd.concat(held, ignore_index=True) if len(held) > 1 else held[0])

    return run


def _bytes(rows: pd.DataFrame) -> int:
    return int(rows.memory_usage(index=False, deep=True).sum())


def _salted(df: DataFrame, partial: Partial, salts: int) -> DataFrame:
    combine = _combined(partial)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from combine(rows.drop(columns="_salt") for rows in batches)

    # The same for every run of a task, so a repeated task sends its rows to the same place.
    salted = df.withColumn("_salt", F.spark_partition_id() % salts)
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return salted.repartition(tasks, KEY, "_salt").mapInPandas(run, df.schema)
