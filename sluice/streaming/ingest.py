"""Drop-folder ingest: take each new file once, then archive or delete it.

Both forms run as one streaming query that takes what is there, in bounded batches, and
stops. Spark cleans the files of a batch only after a later batch was committed, so output
is never lost to cleaning and the newest files may stay in the folder until the next run.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.plans.inputs import is_on
from sluice.plans.stages import Stage, run_stages
from sluice.session import remove_folder, scratch_path, scratch_removed
from sluice.sources.files import scan_files
from sluice.sources.paths import literal, or_empty
from sluice.sources.raw_files import IMPORT_AREA

_HELD = "held_batch"


def ingest_lines(
    spark: SparkSession,
    folder: str,
    schema: str,
    out: str,
    checkpoint: str,
    stages: list[Stage] | None = None,
    *,
    max_files: int = 1000,
    clean: dict[str, str] | None = None,
) -> None:
    """Ingests new files of one JSON record per line through stages that do not group.

    Reading, stages and the writing of Parquet are one streaming plan; its sink takes every
    batch exactly once.
    """
    if any(stage.grouped for stage in stages or []):
        raise ValueError("grouped stages need ingest_files, which runs them over the whole drop")
    source = (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).options(**(clean or {})).json(folder)
    )
    (
        run_stages(source, stages or [])
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def ingest_files(
    spark: SparkSession,
    folder: str,
    out: str,
    checkpoint: str,
    stages: list[Stage] | None = None,
    *,
    scan: Callable[[SparkSession, list[str]], DataFrame] = scan_files,
    max_files: int = 1000,
    clean: dict[str, str] | None = None,
) -> None:
    """Ingests new files with any scan and any stages.

    The stream carries only the names of new files, at most ``max_files`` at a time; each
    batch of them is read by ``scan`` as one job. A batch that is run again replaces its own
    output.

    Groups are those of the whole run, however many batches it has: the stages before the
    first grouped one run on each batch into a table beside ``checkpoint``, the others once over
    all of it after the last batch. The result is numbered by the run's first batch. A run that
    fails on the way is completed by the next one, in one set of groups with its files.
    """
    enabled = [stage for stage in stages or [] if is_on(stage.enabled)]
    plain = next((place for place, stage in enumerate(enabled) if stage.grouped), len(enabled))
    before, after = enabled[:plain], enabled[plain:]
    progress = checkpoint.rstrip("/")
    held = f"{progress}.held"
    batches_at = f"{held}/{_HELD}" if after else f"{out}/batch"
    done = _last_batch(spark, f"{progress}.runs") if after else -1
    arrived = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("maxFilesPerTrigger", max_files)
        .options(**(clean or {}))
        .load(folder)
        .select("path")
    )

    def take(batch: DataFrame, number: int) -> None:
        paths = [literal(row.path) for row in batch.collect()]
        if paths:
            with scratch_removed(spark):
                result = run_stages(scan(spark, paths), before)
                result.write.mode("overwrite").parquet(f"{batches_at}={number}")

    (
        arrived.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    if after:
        _finish_run(spark, held, done, after, out, f"{progress}.runs")


def _last_batch(spark: SparkSession, runs: str) -> int:
    """The last batch of the runs that are finished; -1 if there is none."""
    finished = or_empty(spark, lambda: spark.read.schema("last bigint").parquet(runs), "last bigint", True)
    last = finished.agg(F.max("last")).first()[0]
    return -1 if last is None else last


def _finish_run(spark: SparkSession, held: str, done: int, stages: list[Stage], out: str, runs: str) -> None:
    batches = or_empty(spark, lambda: spark.read.parquet(held), f"{_HELD} bigint", True).where(F.col(_HELD) > done)
    last = batches.agg(F.max(_HELD)).first()[0]
    if last is not None:
        with scratch_removed(spark):
            result = run_stages(batches.drop(_HELD), stages)
            result.write.mode("overwrite").parquet(f"{out}/batch={done + 1}")
        spark.range(1).select(F.lit(last).cast("bigint").alias("last")).write.mode("append").parquet(runs)
    remove_folder(spark, held)


def ingest_folders(spark: SparkSession, label: str) -> tuple[str, str, str]:
    """New folders for a drop-folder, its output and its progress, in the scratch folder."""
    root = scratch_path(spark, label)
    return f"{root}{IMPORT_AREA}files", f"{root}/out", f"{root}/progress"


def read_batches(spark: SparkSession, out: str) -> DataFrame:
    """What :func:`ingest_files` has written, with the number of the batch."""
    return spark.read.parquet(out).withColumn("batch", F.col("batch").cast("bigint"))
