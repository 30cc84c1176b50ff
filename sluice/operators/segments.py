"""User code that has to see the rows of a group one after the other, for groups of any size.

Rows are dealt out by ranges of key and order, written, and cut into segments of a bounded number of rows by their
place in the files. A first pass sums up what each segment holds of the groups at its borders; these few rows, merged
in order, tell what was before a segment. A second pass runs the code on all segments at once, each with the state
that it begins with. So a group, whatever its size, is the work of as many tasks as it has segments. The groups
that a batch of rows holds whole go to the code in one call, so small groups cost no call each.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, IntegerType, IntegralType, StructField, StructType

from sluice.operators.grouping import KEY
from sluice.session import scratch_path

SEGMENT_ROWS = 50_000
_ROWS_OUT = 2000
State = tuple[Any, ...]


class GroupScan:
    """Code over the ordered rows of each group.

    ``state`` names the fields of a state, as in a schema. ``summary`` gives the state of consecutive rows,
    ``merge`` that of two stretches of rows, the first before the second. ``run`` gets the rows of a
    segment in frames, the state of all rows of the group before them (``None`` at its beginning) and whether
    the group ends with them, and yields any number of rows.

    ``whole`` does what ``run`` does for many groups at once, of each of which it gets all rows. Code that can work
    on many groups at once should have its own, which is faster by the cost of a call per group.
    """

    state: str

    def summary(self, rows: pd.DataFrame) -> State:
        raise NotImplementedError

    def merge(self, first: State, second: State) -> State:
        raise NotImplementedError

    def run(
        self, key: str, before: State | None, rows: Iterator[pd.DataFrame], last: bool
    ) -> Iterable[pd.DataFrame]:
        raise NotImplementedError

    def whole(self, rows: pd.DataFrame) -> Iterable[pd.DataFrame]:
        """The rows of many whole groups, in key order, with their keys; so are the results."""
        results: list[pd.DataFrame] = []
        held = 0
        for begin, end in itertools.pairwise(_edges(rows[KEY].to_numpy())):
            key = rows[KEY].iloc[begin]
            for result in self.run(key, None, iter([rows.iloc[begin:end].reset_index(drop=True)]), True):
                result = result.assign(**{KEY: key})
                # Of one kind, as whole numbers beside nulls would become floats.
                if results and (held >= _ROWS_OUT or not result.dtypes.equals(results[0].dtypes)):
                    yield pd.concat(results, ignore_index=True)
                    results, held = [], 0
                results.append(result)
                held += max(len(result), 1)
        if results:
            yield pd.concat(results, ignore_index=True)


def _edges(values: np.ndarray) -> list[int]:
    """Where a value differs from the one before, and both ends."""
    return [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)]


def _filler(kind: DataType) -> Column:
    value = 0 if isinstance(kind, IntegralType) else False if isinstance(kind, BooleanType) else None
    return F.lit(value).cast(kind)


def _pieces(batches: Iterable[pd.DataFrame]) -> Iterator[tuple[int, pd.DataFrame]]:
    """A segment's rows, a batch's at a time."""
    for rows in batches:
        if rows.empty:
            continue
        segments = rows["_segment"].to_numpy()
        for begin, end in itertools.pairwise(_edges(segments)):
            yield int(segments[begin]), rows.iloc[begin:end]


def group_scan(
    df: DataFrame, scan: GroupScan, schema: str, order: list[str | Column], *, segment_rows: int = SEGMENT_ROWS
) -> DataFrame:
    """Runs ``scan`` over the rows of each group of a frame that has the group key, in ``order``.

    Rows that the order does not tell apart come in the order of a hash of all their columns. The result's rows
    are in no order; its column ``group_key``, if it has one, is set to the group's key. The rows are written,
    and written in order, when this is called. A task holds a batch of rows; a group of any size, also of
    equal rows, is split.
    """
    spark = df.sparkSession
    names = df.columns
    state_types = spark.createDataFrame([], scan.state).dtypes
    states = ", ".join(f"`_s_{name}` {kind}" for name, kind in state_types)
    summed = [f"_s_{name}" for name, _ in state_types]
    has_key = KEY in spark.createDataFrame([], schema).columns

    def own_rows(piece: pd.DataFrame, begin: int, end: int) -> pd.DataFrame:
        return piece.iloc[begin:end][names].reset_index(drop=True)

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The states of each segment's first and last group, which may be the same group."""
        columns = [KEY, "_segment", "_place", *summed]
        current, borders, out = None, [], []
        for segment, piece in _pieces(batches):
            if segment != current:
                out += [[key, current, place, *state] for key, place, state in borders]
                current, borders = segment, []
                if len(out) >= _ROWS_OUT:
                    yield pd.DataFrame(out, columns=columns, dtype=object)
                    out = []
            edges = _edges(piece[KEY].to_numpy())
            # Groups between a batch's first and last are inside of the segment.
            for begin, end in dict.fromkeys([(0, edges[1]), (edges[-2], edges[-1])]):
                key, state = piece[KEY].iloc[begin], scan.summary(own_rows(piece, begin, end))
                if borders and borders[-1][0] == key:
                    borders[-1][2] = scan.merge(borders[-1][2], state)
                else:
                    borders = [*borders[:1], [key, int(piece["_place"].iloc[begin]), state]]
        out += [[key, current, place, *state] for key, place, state in borders]
        if out:
            yield pd.DataFrame(out, columns=columns, dtype=object)

    def carry(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """What each segment's border groups had before it, and whether they end in it; of a group, in order."""
        columns = [KEY, "_segment", *summed, "_goes_on", "_ends"]
        held = None  # key, segment, the state before it and the state at its end

        def known(ends: bool) -> list:
            key, segment, before, _ = held
            return [key, segment, *(before or [None] * len(summed)), before is not None, ends]

        for rows in batches:
            out = []
            for key, segment, *values in rows[[KEY, "_segment", *summed]].itertuples(index=False, name=None):
                state = tuple(values)
                same = held is not None and held[0] == key
                if same and held[1] == segment:  # which several tasks have read
                    held = [*held[:-1], scan.merge(held[-1], state)]
                    continue
                if held is not None:
                    out.append(known(not same))
                before = held[-1] if same else None
                held = [key, segment, before, state if before is None else scan.merge(before, state)]
            if out:
                yield pd.DataFrame(out, columns=columns, dtype=object)
        if held is not None:
            yield pd.DataFrame([known(True)], columns=columns, dtype=object)

    def stretches(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[tuple, pd.DataFrame]]:
        """Of each piece, what is known of its borders, its first group, those inside, its last group."""
        for segment, piece in _pieces(batches):
            at = int(piece["_state"].sum())
            if at:
                yield (segment, "borders", None), piece.iloc[:at]
                piece = piece.iloc[at:]
            if piece.empty:
                continue
            keys = piece[KEY].to_numpy()
            edges = _edges(keys)
            yield (segment, "group", keys[0]), own_rows(piece, 0, edges[1])
            if len(edges) > 3:
                yield (segment, "whole", None), own_rows(piece, edges[1], edges[-2])
            if len(edges) > 2:
                yield (segment, "group", keys[-1]), own_rows(piece, edges[-2], edges[-1])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        borders: dict[str, tuple[State | None, bool]] = {}
        current = None
        for (segment, kind, key), found in itertools.groupby(stretches(batches), key=lambda one: one[0]):
            if segment != current:
                borders, current = {}, segment
            frames = (rows for _, rows in found)
            if kind == "borders":
                for row in itertools.chain.from_iterable(rows.to_dict("records") for rows in frames):
                    before = tuple(row[name] for name in summed) if row["_goes_on"] else None
                    borders[row[KEY]] = before, bool(row["_ends"])
            elif kind == "whole":
                for result in itertools.chain.from_iterable(map(scan.whole, frames)):
                    yield result if has_key else result.drop(columns=KEY, errors="ignore")
            else:
                before, last = borders.get(key, (None, True))
                for result in scan.run(key, before, frames, last):
                    yield result.assign(**{KEY: key}) if has_key else result

    by = [KEY, *order, "_hash", "_row"]
    hashed = [field.name for field in df.schema if "map<" not in field.dataType.simpleString()]
    given = scratch_path(spark, "segment-rows")
    df.write.parquet(given)
    # Equal rows differ by their place in a written file, which is the same for every attempt of a task.
    row = F.xxhash64("_metadata.file_name", "_metadata.row_index").alias("_row")
    rows = spark.read.schema(df.schema).parquet(given).select("*", F.xxhash64(*hashed).alias("_hash"), row)
    ordered = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    ordered = ordered.select(*names, F.spark_partition_id().alias("_range"))
    where = scratch_path(spark, "segments")
    # One file per range, so a row's place in its file is its place in the range.
    ordered.write.option("maxRecordsPerFile", 0).parquet(where)
    segment = F.expr(f"(bigint(_range) << 32) + _metadata.row_index div {segment_rows} AS _segment")
    written = spark.read.schema(StructType([*df.schema, StructField("_range", IntegerType())])).parquet(where)
    written = written.select(*names, segment, F.col("_metadata.row_index").alias("_place"))
    borders = written.mapInPandas(sums, f"{KEY} string, _segment bigint, _place bigint, {states}")
    dealt = borders.repartition(KEY).sortWithinPartitions(KEY, "_segment", "_place")
    known = dealt.mapInPandas(carry, f"{KEY} string, _segment bigint, {states}, _goes_on boolean, _ends boolean")
    # Before the rows of their segment, with values where nulls would turn a batch's whole numbers into floats.
    filled = {field.name: _filler(field.dataType) for field in df.schema if field.name != KEY}
    known = known.withColumns({**filled, "_place": F.lit(-1).cast("bigint"), "_state": F.lit(True)})
    every = written.withColumn("_state", F.lit(False)).unionByName(known, allowMissingColumns=True)
    return every.repartition("_segment").sortWithinPartitions("_segment", "_place").mapInPandas(run, schema)
