"""Column functions on records: keys, merges, paths, names."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from sluice.functions import json_text

# To the very end: a last line break is no part of a name.
NAME_PATTERN = r"^[0-9a-zA-Z_]+\z"
NO_PERIOD = "all_time"

_KEY_OPTIONS = {
    "ignoreNullFields": "true",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def file_extension(path: Column) -> Column:
    """Upper-cased text after the last dot of the whole path; null if there is no dot."""
    return F.when(F.contains(path, F.lit(".")), F.upper(F.substring_index(path, ".", -1)))


def valid_name(name: Column) -> Column:
    return name.rlike(NAME_PATTERN)


def field(path: str) -> Column:
    """A record field by dotted path."""
    return F.col(path)


def group_key(*paths: str) -> Column:
    """Group key of typed columns: a compact JSON object of the fields that are not null.

    The declared column types decide the text, so ``1``, ``1.0`` and ``"1"`` are told
    apart by type. For records kept as JSON text use :func:`json_group_key`.
    """
    return key_of(*[F.col(path).alias(path) for path in paths])


def key_of(*fields: Column) -> Column:
    """The group key of named columns; times are written to the microsecond, so that different ones differ."""
    return F.to_json(F.struct(*fields), _KEY_OPTIONS)


def json_group_key(record: Column, *paths: str) -> Column:
    """Group key of records kept as JSON text. Texts and numbers are written in one way
    (``1.00`` as ``1.0``), but a number that no double holds keeps its spelling."""
    wanted = list(paths)

    @pandas_udf("string")
    def keys(records: pd.Series) -> pd.Series:
        return records.map(lambda text: json_text.key_text(text, wanted))

    return keys(record)


def merge_json(record: Column, changes: Column) -> Column:
    """Shallow merge of two JSON object texts; ``changes`` wins, null is a value.
    Values keep their spelling."""

    @pandas_udf("string")
    def merged(records: pd.Series, changed: pd.Series) -> pd.Series:
        pairs = zip(records, changed, strict=True)
        return pd.Series([json_text.merged_text(r, c) for r, c in pairs], dtype=object)

    return merged(record, changes)


def merge_maps(record: Column, changes: Column) -> Column:
    """Shallow merge of two map columns; ``changes`` wins, whatever the session's
    policy for repeated map keys is."""
    changed = F.map_keys(changes)
    kept = F.map_filter(record, lambda name, _: ~F.array_contains(changed, name))
    return F.coalesce(F.map_concat(kept, changes), record)


def period_folder(run_time: Column, pattern: str | None) -> Column:
    """Folder suffix of the period that ``run_time`` lies in; fixed if there is no period."""
    return F.date_format(run_time, pattern) if pattern else F.lit(NO_PERIOD)
