"""A whole enrichment job: inputs, stages, datasets, and what becomes of the files."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import DataFrame, Observation, SparkSession

from sluice.operators.runs import inputs_of, published, write_run
from sluice.operators.sinks import write_dataset, write_routed
from sluice.plans.inputs import Input, is_on, load_inputs
from sluice.plans.stages import Stage, run_stages, stage_errors
from sluice.session import scratch_path, scratch_removed
from sluice.sources.raw_files import Storage, clean_files, run_folder


# The dataset of a job's own records in the output of a run with an id.
RESULT = "result"


@dataclass(frozen=True)
class Job:
    """Reads the inputs, runs the stages on their union and gives or writes the result.

    With ``storage``, the files of its inputs that are in the import area are cleaned up after
    all output is written: moved to the folder of the run's ``period`` (a pattern) below
    ``archive`` where raw storage is enabled, else deleted. Trial runs clean up nothing.
    """

    inputs: list[Input]
    stages: list[Stage]
    trial_limit: int | None = None
    storage: Storage | None = None
    archive: str | None = None
    period: str | None = None

    def errors(self) -> list[str]:
        found = [
            f"input {item.name} is a stream: use the drop-folder ingest"
            for item in self.inputs
            if item.service == "streaming"
        ]
        if not any(is_on(item.enabled) for item in self.inputs):
            found.append("the job has no enabled input")
        return found + stage_errors(self.stages)

    def plan(self, spark: SparkSession, counts: dict[str, Observation] | None = None) -> DataFrame:
        """The result; what stages emit to other datasets is left to :meth:`run`."""
        return self._plan(spark, self.inputs, counts, [], None)

    def _plan(
        self,
        spark: SparkSession,
        inputs: list[Input],
        counts: dict[str, Observation] | None,
        emitted: list[DataFrame],
        stage_input: Callable[[DataFrame], DataFrame] | None,
    ) -> DataFrame:
        errors = self.errors()
        if errors:
            raise ValueError("; ".join(errors))
        records = load_inputs(spark, inputs, self.trial_limit)
        return run_stages(records, self.stages, counts, emitted, stage_input)

    def run(
        self,
        spark: SparkSession,
        dataset: str,
        *,
        count_stages: bool = False,
        others: str | None = None,
        run_time: datetime | None = None,
        run_id: str | None = None,
        **sink: object,
    ) -> dict[str, int]:
        """Adds the result to ``dataset``, and what stages emit to the datasets below ``others``.

        ``count_stages`` gives the number of records after each stage. Filters and column
        choices of later stages do not reach the input through a stage that is counted.
        Intermediate tables are removed after the result is written. ``run_time`` is now unless
        it is given. Clean-up comes last, so a run that fails before leaves all files in place.

        With ``run_id``, all output goes below ``dataset`` and is published at once, once under that id: the result
        as the dataset ``RESULT``, what stages emit as those that they name. A run that failed can be
        repeated under its id, and adds every record once; one that was published only finishes its clean-up of
        the files that it had read; see :mod:`~sluice.operators.runs`.
        """
        run_time = run_time or datetime.now(UTC)
        counts: dict[str, Observation] | None = {} if count_stages else None
        emitted: list[DataFrame] = []
        inputs, names = self.inputs, []
        cleans = self.storage is not None and self.trial_limit is None
        if cleans:
            taken = [item.taken(spark) if is_on(item.enabled) and not item.service else (item, []) for item in inputs]
            inputs, names = [item for item, _ in taken], [name for _, found in taken for name in found]
        emits = any(stage.emits and is_on(stage.enabled) for stage in self.stages)
        if emits and not others and run_id is None:
            raise ValueError("stages emit to other datasets: the job needs a folder for them")

        def written(df: DataFrame) -> DataFrame:
            where = scratch_path(spark, "stage-input")
            df.write.parquet(where)
            return spark.read.schema(df.schema).parquet(where)

        with scratch_removed(spark):
            if run_id is not None and run_id in published(dataset):
                names = inputs_of(dataset, run_id)
            else:
                result = self._plan(spark, inputs, counts, emitted, written)
                if run_id is not None:
                    write_run(dataset, run_id, whole={RESULT: result}, routed=emitted, inputs=names)
                else:
                    write_dataset(result, dataset, **sink)
                    for records in emitted:
                        write_routed(records, others)
        if cleans:
            period = run_folder(spark, run_time, self.period)
            with scratch_removed(spark):
                clean_files(spark, names, self.storage, self.archive, period=period)
        return {name: observed.get["records"] for name, observed in (counts or {}).items()}
