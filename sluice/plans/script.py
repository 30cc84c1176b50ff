"""SQL scripts over loaded frames."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

# A statement ends with a semicolon at the end of a line.
_STATEMENT_END = re.compile(r";[ \t]*(?:\r?\n|$)")
_REMARK = re.compile(r"^\s*--.*$", re.MULTILINE)


def register_frames(frames: list[DataFrame], prefix: str = "testdata") -> list[str]:
    """Names the frames ``testdata_0``, ``testdata_1``, … for use in SQL."""
    names = [f"{prefix}_{place}" for place in range(len(frames))]
    for name, frame in zip(names, frames, strict=True):
        frame.createOrReplaceTempView(name)
    return names


def run_script(spark: SparkSession, script: str) -> DataFrame:
    """Runs the statements of a script in order; gives the last one's result, not yet computed."""
    statements = [part for part in _STATEMENT_END.split(script) if _REMARK.sub("", part).strip()]
    if not statements:
        raise ValueError("the script has no statement")
    for statement in statements[:-1]:
        spark.sql(statement)
    return spark.sql(statements[-1])
