"""Ordered chains of stages."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from sluice.operators.grouping import GroupModule, Partial, group_agg, group_apply, group_fields, with_group_key
from sluice.operators.modules import passthrough
from sluice.plans.inputs import is_on

PREVIOUS = "$previous"


@dataclass(frozen=True)
class Stage:
    """A step from frame to frame; without ``fn`` it passes records on.

    A stage with ``grouping_fields``, or with ``given_key`` (a column in which the stage
    before may set the key), groups: ``aggregates()`` gives the native aggregates of each
    group, ``module`` with its ``schema`` is called once per group, or ``fn`` gets its input
    with the column ``group_key`` and uses ``group_apply``, ``group_frames`` or ``group_agg``.
    ``key_json`` names the column of JSON text that the fields are taken from, where records
    are not typed.

    ``partitions`` is the number of tasks that work on groups. ``partial``, ``combiner`` and
    ``max_group_rows`` are those of ``group_apply``, for a module.

    ``emits`` picks records of the stage's input for other datasets, which their column
    ``target`` names. They are written by a job, which computes the stage's input once for both.
    """

    name: str
    fn: Callable[[DataFrame], DataFrame] | None = None
    enabled: bool | None = None
    grouping_fields: tuple[str, ...] = ()
    given_key: str | None = None
    key_json: str | None = None
    aggregates: Callable[[], list[Column]] | None = None
    dependencies: tuple[str, ...] = ()
    module: GroupModule | None = None
    schema: str | None = None
    partial: Partial | None = None
    combiner: bool = True
    max_group_rows: int | None = None
    partitions: int | None = None
    emits: Callable[[DataFrame], DataFrame] | None = None

    @property
    def grouped(self) -> bool:
        return bool(self.grouping_fields or self.given_key)

    def apply(self, df: DataFrame) -> DataFrame:
        fields = list(self.grouping_fields)
        if self.aggregates and not self.given_key and not self.key_json:
            return group_fields(df, fields, *self.aggregates(), partitions=self.partitions)
        if self.grouped:
            df = with_group_key(df, fields, given=self.given_key, json=self.key_json)
        if self.aggregates:
            return group_agg(df, *self.aggregates(), partitions=self.partitions)
        if self.module:
            return group_apply(
                df,
                self.module,
                self.schema,
                partial=self.partial,
                use_combiner=self.combiner,
                max_group_rows=self.max_group_rows,
                partitions=self.partitions,
            )
        return (self.fn or passthrough)(df)


def stage_errors(stages: list[Stage]) -> list[str]:
    """What is wrong with a chain: names, and dependencies that the order does not meet."""
    errors = []
    names = [stage.name for stage in stages]
    errors += [f"stage name {name} is used more than once" for name in sorted({n for n in names if names.count(n) > 1})]
    for place, stage in enumerate(stages):
        if not is_on(stage.enabled):
            continue
        if not re.fullmatch("[0-9a-zA-Z_]+", stage.name):
            errors.append(f"stage name {stage.name!r} has other characters than letters, digits and _")
        if stage.aggregates and not stage.grouped:
            errors.append(f"stage {stage.name} has aggregates, but nothing to group by")
        if stage.module and not (stage.grouped and stage.schema):
            errors.append(f"stage {stage.name} has a module, but no schema or nothing to group by")
        if [stage.fn, stage.aggregates, stage.module].count(None) < 2:
            errors.append(f"stage {stage.name} has more than one of fn, aggregates and module")
        for dependency in stage.dependencies:
            if dependency not in ("", PREVIOUS) and dependency not in names[:place]:
                errors.append(f"stage {stage.name} depends on {dependency}, which is not a stage before it")
    return errors


def run_stages(
    df: DataFrame,
    stages: list[Stage],
    counts: dict[str, Observation] | None = None,
    emitted: list[DataFrame] | None = None,
    stage_input: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Runs the enabled stages in list order, each on the result of the one before.

    Raw file bytes reach the first stage only. With ``counts``, each stage's number of
    records is observed while the result is computed and can be read from it afterwards;
    filters of later stages then stay above the stages that are counted. What stages emit to
    other datasets is added to ``emitted``; ``stage_input`` may write the input of such a stage, so that it is
    computed once for both.
    """
    enabled = [stage for stage in stages if is_on(stage.enabled)]
    if not enabled:
        return passthrough(df)
    for stage in enabled:
        if stage.emits:
            if emitted is None:
                raise ValueError(f"stage {stage.name} emits to other datasets, which only a job writes")
            df = stage_input(df) if stage_input else df
            emitted.append(stage.emits(df))
        df = passthrough(stage.apply(df))
        if counts is not None:
            counts[stage.name] = Observation(stage.name)
            df = df.observe(counts[stage.name], F.count(F.lit(1)).alias("records"))
    return df
