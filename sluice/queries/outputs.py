"""Queries over sinks and drop-folders. Their results are what was written, read back."""

from __future__ import annotations

from datetime import UTC, datetime
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators.grouping import KEY
from sluice.operators.runs import read_run
from sluice.operators.sinks import archive_raw, read_routed, write_dataset, write_routed
from sluice.plans.inputs import Input, typed
from sluice.plans.job import RESULT, Job
from sluice.plans.stages import Stage
from sluice.queries.common import Query, row_count, table, total_cents, whole_number
from sluice.session import scratch_path
from sluice.sources.raw_files import Storage, cleaning
from sluice.streaming.ingest import ingest_files, ingest_folders, ingest_lines, read_batches

EVENT_FIELDS = ["event_id", "user_id", "event_type", "value"]
EVENT_SCHEMA = "event_id bigint, user_id bigint, event_type string, value double"


def dataset_emit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two jobs add to one dataset."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    where = scratch_path(spark, "dataset")
    write_dataset(orders.where("o_orderstatus = 'O'"), where, format="json")
    write_dataset(orders.where("o_orderstatus != 'O'"), where, format="json")
    return spark.read.schema("o_orderkey bigint, o_orderstatus string, o_totalprice double").json(where)


def routed_emit(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("target", F.col("event_type"))
    where = scratch_path(spark, "routed")
    write_routed(events, where)
    return read_routed(spark, where).groupBy("target", "event_type").agg(row_count(), total_cents("value"))


def routed_emit_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As above, with the records of a target gathered first."""
    events = table(spark, sf_dir, "events").withColumn("target", F.col("event_type"))
    where = scratch_path(spark, "routed")
    write_routed(events, where, compact=True)
    return read_routed(spark, where).groupBy("target", "event_type").agg(row_count(), total_cents("value"))


def archived_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    where = scratch_path(spark, "archive")
    archive_raw(events, where, F.col("ts"), "yyyy-MM-dd")
    return read_routed(spark, where, target="period").groupBy("period").agg(row_count(), total_cents("value"))


DROPS = ["event_type in ('click', 'view', 'error')", "event_type not in ('click', 'view', 'error')"]


def drop_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events arrive in two drops; each is ingested once, and the first one is archived."""
    events = table(spark, sf_dir, "events").select(EVENT_FIELDS)
    folder, out, progress = ingest_folders(spark, "drop")
    clean = cleaning(folder, Storage({}, {}), archive=scratch_path(spark, "drop-archive"))
    stages = [Stage("cents", lambda df: df.withColumn("cents", whole_number(F.col("value"))))]
    for drop in DROPS:
        write_dataset(events.where(drop), folder, format="json")
        ingest_lines(spark, folder, EVENT_SCHEMA, out, progress, stages, clean=clean)
    return spark.read.parquet(out).select("event_id", "event_type", "cents")


def drop_folder_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two drops of several files, a few files at a time: the groups are those of a whole drop."""
    events = table(spark, sf_dir, "events").select(EVENT_FIELDS)
    folder, out, progress = ingest_folders(spark, "drop")
    stages = [
        Stage("typed", lambda df: typed(df.select("json"), EVENT_SCHEMA)),
        Stage("totals", aggregates=lambda: [row_count(), total_cents("value")], grouping_fields=("user_id",)),
    ]
    for drop in DROPS:
        write_dataset(events.where(drop).repartition(6, "event_id"), folder, format="json")
        ingest_files(spark, folder, out, progress, stages, max_files=2, clean=cleaning(folder, Storage()))
    return read_batches(spark, out).select(KEY, "n", "cents")


def job_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job with a side output, which archives the files that it read; all that is then where."""
    events = table(spark, sf_dir, "events").select(EVENT_FIELDS)
    folder, out, _ = ingest_folders(spark, "job")
    archive, others = scratch_path(spark, "job-archive"), scratch_path(spark, "job-others")
    write_dataset(events, folder, format="json")
    errors = Stage(
        "errors_out",
        lambda df: df.where("event_type != 'error'"),
        emits=lambda df: df.where("event_type = 'error'").withColumn("target", F.lit("errors")),
    )
    inputs = [Input("events", paths=folder, schema=EVENT_SCHEMA)]
    job = Job(inputs, [errors], storage=Storage({}, {}), archive=archive, period="yyyy")
    job.run(spark, out, others=others, run_time=datetime(2024, 5, 6, tzinfo=UTC))
    lines = spark.read.schema(EVENT_SCHEMA).option("recursiveFileLookup", "true")
    where = {
        "result": spark.read.parquet(out),
        "errors": read_routed(spark, others).where("target = 'errors'"),
        "archived": lines.json(f"{archive}/2024"),
        "left": lines.json(folder),
    }
    found = [df.select(F.lit(name).alias("dataset"), "event_type", "value") for name, df in where.items()]
    return reduce(DataFrame.unionAll, found).groupBy("dataset", "event_type").agg(row_count(), total_cents("value"))


def job_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job whose input files are deleted after it, but for those outside the import area: what is left."""
    events = table(spark, sf_dir, "events").select(EVENT_FIELDS)
    folder, out, _ = ingest_folders(spark, "delete")
    elsewhere = scratch_path(spark, "elsewhere")
    write_dataset(events.where(DROPS[0]), folder, format="json")
    write_dataset(events.where(DROPS[1]), elsewhere, format="json")
    inputs = [Input("events", paths=[folder, elsewhere], schema=EVENT_SCHEMA)]
    Job(inputs, [], storage=Storage({}, {"enabled": False})).run(spark, out)
    lines = spark.read.schema(EVENT_SCHEMA)
    where = {"result": spark.read.parquet(out), "import": lines.json(folder), "elsewhere": lines.json(elsewhere)}
    found = [df.select(F.lit(name).alias("dataset"), "event_type", "value") for name, df in where.items()]
    return reduce(DataFrame.unionAll, found).groupBy("dataset", "event_type").agg(row_count(), total_cents("value"))


def job_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job that fails when half its output is written, its second run under the same id, and a third one."""
    events = table(spark, sf_dir, "events").select(EVENT_FIELDS)
    folder, out = scratch_path(spark, "retry-in"), scratch_path(spark, "retry-out")
    write_dataset(events, folder, format="json")

    def job(fails: bool) -> Job:
        def others(df: DataFrame) -> DataFrame:
            some = df.where("event_type in ('error', 'view')").withColumn("target", F.col("event_type"))
            stops = F.when(F.lit(fails) & (F.col("event_id") % 100 == 7), F.raise_error(F.lit("stopped")).cast("string"))
            return some.withColumn("target", F.coalesce(stops, "target"))

        rest = Stage("rest", lambda df: df.where("event_type not in ('error', 'view')"), emits=others)
        return Job([Input("events", paths=folder, schema=EVENT_SCHEMA)], [rest])

    try:
        job(fails=True).run(spark, out, run_id="2024-05-06")
    except PySparkException as error:
        if "stopped" not in str(error):
            raise
    for run_id in ("2024-05-06", "2024-05-06"):
        job(fails=False).run(spark, out, run_id=run_id)
    found = [
        read_run(spark, out, name, EVENT_SCHEMA).withColumn("dataset", F.lit(name)) for name in (RESULT, "error", "view")
    ]
    every = reduce(DataFrame.unionByName, found)
    return every.groupBy("dataset", "event_type").agg(row_count(), total_cents("value"))


_CENTS_SQL = "sum(round(value * 100)::BIGINT)::BIGINT AS cents"
_ROUTED_SQL = f"SELECT event_type AS target, event_type, count(*) AS n, {_CENTS_SQL} FROM events GROUP BY ALL"

QUERIES = {
    "dataset_emit": Query(dataset_emit, "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders"),
    "routed_emit": Query(routed_emit, _ROUTED_SQL),
    "routed_emit_compact": Query(routed_emit_compact, _ROUTED_SQL),
    "archived_raw": Query(
        archived_raw, f"SELECT strftime(ts, '%Y-%m-%d') AS period, count(*) AS n, {_CENTS_SQL} FROM events GROUP BY 1"
    ),
    "job_archive": Query(
        job_archive,
        f"""
        WITH placed AS (
            SELECT CASE event_type WHEN 'error' THEN 'errors' ELSE 'result' END AS dataset, * FROM events
            UNION ALL SELECT 'archived', * FROM events
        )
        SELECT dataset, event_type, count(*) AS n, {_CENTS_SQL} FROM placed GROUP BY ALL
        """,
    ),
    "job_delete": Query(
        job_delete,
        f"""
        WITH placed AS (
            SELECT 'result' AS dataset, * FROM events
            UNION ALL SELECT 'elsewhere', * FROM events WHERE {DROPS[1]}
        )
        SELECT dataset, event_type, count(*) AS n, {_CENTS_SQL} FROM placed GROUP BY ALL
        """,
    ),
    "job_retry": Query(
        job_retry,
        f"""
        SELECT CASE WHEN event_type IN ('error', 'view') THEN event_type ELSE 'result' END AS dataset,
               event_type, count(*) AS n, {_CENTS_SQL}
        FROM events GROUP BY ALL
        """,
    ),
    "drop_folder": Query(
        drop_folder, "SELECT event_id, event_type, round(value * 100)::BIGINT AS cents FROM events"
    ),
    "drop_folder_groups": Query(
        drop_folder_groups,
        f"""
        SELECT '{{"user_id":' || user_id || '}}' AS group_key, count(*)::BIGINT AS n, {_CENTS_SQL}
        FROM events GROUP BY user_id, {DROPS[0]}
        """,
    ),
}
