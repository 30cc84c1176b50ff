"""Queries over stages, records, jobs and scripts."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sluice.functions.records import merge_json, merge_maps
from sluice.operators.modules import BatchModule, map_batches, merge_fields, with_record_id
from sluice.operators.sinks import write_dataset
from sluice.plans.inputs import Input, typed
from sluice.plans.job import Job
from sluice.plans.script import register_frames, run_script
from sluice.plans.stages import Stage, run_stages
from sluice.queries.common import Query, row_count, table, whole_number
from sluice.session import scratch_path

LARGE = "o_totalprice >= 250000"


def stage_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    stages = [
        Stage("large", lambda df: df.where(LARGE)),
        Stage("nothing", lambda df: df.where(F.lit(False)), enabled=False),
        Stage("price", lambda df: df.withColumn("cents", whole_number(F.col("o_totalprice"))), enabled=True),
        Stage("fields", lambda df: df.select("o_orderkey", "o_orderpriority", "cents"), dependencies=("price",)),
    ]
    return run_stages(table(spark, sf_dir, "orders"), stages)


def no_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_stages(table(spark, sf_dir, "customer"), [])


def passthrough_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw bytes go no further than the first stage."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", F.encode("text", "UTF-8").alias("content"))
    size = Stage("size", lambda df: df.withColumn("n_bytes", F.octet_length("content").cast("bigint")))
    return run_stages(documents, [size, Stage("rest")])


class Lines(BatchModule):
    """The lines of each text, numbered; none for a blank one."""

    def batch(self, rows: pd.DataFrame) -> pd.DataFrame:
        lines = rows.assign(line=rows["text"].str.split("\n")).explode("line", ignore_index=True)
        lines["line_no"] = lines.groupby("doc_id").cumcount()
        return lines.loc[lines["line"] != "", ["doc_id", "line_no", "line"]]


def batch_module(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return map_batches(documents, Lines(), "doc_id bigint, line_no bigint, line string")


def merged_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = {
        "c_mktsegment": F.lower("c_mktsegment"),
        "c_acctbal": F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")),
        "in_debt": F.col("c_acctbal") < 0,
    }
    return merge_fields(table(spark, sf_dir, "customer"), changes)


def merged_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    record = F.create_map(F.lit("status"), "o_orderstatus", F.lit("priority"), "o_orderpriority")
    changes = F.when(F.expr(LARGE), F.create_map(F.lit("priority"), F.lit("0-LARGE"), F.lit("clerk"), F.lit("x")))
    merged = table(spark, sf_dir, "orders").select("o_orderkey", merge_maps(record, changes).alias("record"))
    return merged.select("o_orderkey", "record.status", "record.priority", "record.clerk")


def merged_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested objects are replaced whole, and a null is a value."""
    record = F.concat(F.lit('{"k":1,"props":'), F.col("props"), F.lit(',"type":"'), F.col("event_type"), F.lit('"}'))
    changes = F.when(F.col("event_type") == "click", '{"type":null}').when(
        F.col("event_type") == "view", F.concat(F.lit('{"new":"'), F.col("event_id"), F.lit('","props":{"x":2}}'))
    )
    events = table(spark, sf_dir, "events").withColumn("record", merge_json(record, changes))
    fields = "k int, props struct<k: int, x: int>, type string, new string"
    found = typed(events.select("event_id", "record"), fields, "record")
    return found.select(
        "event_id", "k", F.col("props.k").alias("props_k"), F.col("props.x").alias("props_x"), "type", "new"
    )


def record_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many ids as records. Ids count up within a partition, so they need no shuffle."""
    ids = with_record_id(table(spark, sf_dir, "events")).groupBy("record_id").agg(row_count())
    return ids.agg(F.sum("n").alias("records"), F.count(F.lit(1)).alias("ids"))


def stage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts: dict[str, Observation] = {}
    stages = [
        Stage("all"),
        Stage("large", lambda df: df.where(LARGE)),
        Stage("urgent", lambda df: df.where("o_orderpriority = '1-URGENT'")),
    ]
    result = run_stages(table(spark, sf_dir, "orders"), stages, counts)
    write_dataset(result, scratch_path(spark, "counted"))
    rows = [(name, observed.get["records"]) for name, observed in counts.items()]
    return spark.createDataFrame(rows, "stage string, records bigint")


def sql_script(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_frames([table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")])
    return run_script(
        spark,
        """
        -- how much each segment has ordered; 'a;b' does not end a statement
        CREATE OR REPLACE TEMPORARY VIEW cents AS
        SELECT o_custkey, 'a;b' AS mark, CAST(round(o_totalprice * 100) AS bigint) AS cents
        FROM testdata_0;
        SELECT c_mktsegment, mark, count(*) AS n, sum(cents) AS cents
        FROM cents JOIN testdata_1 ON o_custkey = c_custkey
        GROUP BY c_mktsegment, mark;
        """,
    )


def enrichment_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files and a table, through plain and grouped stages, to a dataset."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", "props")
    where = scratch_path(spark, "job")
    is_file = F.col("event_type").isin("click", "view")
    fields = "event_id bigint, user_id bigint, event_type string, value double, props struct<k: int>"
    with_props = events.withColumn("props", F.from_json("props", "k int"))
    write_dataset(with_props.where(is_file), f"{where}/files", format="json")
    write_dataset(with_props.where(~is_file), f"{where}/rows")

    def totals() -> list[Column]:
        return [row_count(), F.sum("cents").alias("cents")]

    job = Job(
        [
            Input("files", paths=f"{where}/files", schema=fields),
            Input("rows", service="parquet", options={"path": f"{where}/rows"}),
        ],
        [
            Stage("cents", lambda df: merge_fields(df, {"cents": whole_number(F.col("value"))})),
            Stage("paid", lambda df: df.where("cents > 500")),
            Stage("by_kind", aggregates=totals, grouping_fields=("event_type", "props.k")),
            Stage("often", lambda df: df.where("n > 1").withColumn("mean", F.expr("cents div n"))),
        ],
    )
    job.run(spark, f"{where}/out")
    return spark.read.parquet(f"{where}/out")


ENRICHMENT_SQL = """
    SELECT '{"event_type":"' || event_type || '","props.k":' || json_extract_string(props, '$.k') || '}' AS group_key,
           count(*) AS n, sum(round(value * 100)::BIGINT)::BIGINT AS cents,
           sum(round(value * 100)::BIGINT)::BIGINT // count(*) AS mean
    FROM events WHERE round(value * 100) > 500
    GROUP BY 1 HAVING count(*) > 1
"""

CENTS_SQL = "round(o_totalprice * 100)::BIGINT"

QUERIES = {
    "enrichment_job": Query(enrichment_job, ENRICHMENT_SQL),
    "stage_chain": Query(
        stage_chain, f"SELECT o_orderkey, o_orderpriority, {CENTS_SQL} AS cents FROM orders WHERE o_totalprice >= 250000"
    ),
    "no_stages": Query(no_stages, "SELECT * FROM customer"),
    "passthrough_stage": Query(
        passthrough_stage, "SELECT doc_id, lang, octet_length(encode(text))::BIGINT AS n_bytes FROM documents"
    ),
    "batch_module": Query(
        batch_module,
        """
        SELECT doc_id, (place - 1)::BIGINT AS line_no, lines[place] AS line
        FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS place
              FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents))
        WHERE lines[place] <> ''
        """,
    ),
    "merged_fields": Query(
        merged_fields,
        """
        SELECT * REPLACE (lower(c_mktsegment) AS c_mktsegment,
                          CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS c_acctbal), c_acctbal < 0 AS in_debt
        FROM customer
        """,
    ),
    "merged_maps": Query(
        merged_maps,
        """
        SELECT o_orderkey, o_orderstatus AS status,
               CASE WHEN o_totalprice >= 250000 THEN '0-LARGE' ELSE o_orderpriority END AS priority,
               CASE WHEN o_totalprice >= 250000 THEN 'x' END AS clerk
        FROM orders
        """,
    ),
    "merged_json": Query(
        merged_json,
        """
        SELECT event_id, 1 AS k,
               CASE WHEN event_type <> 'view' THEN CAST(json_extract(props, '$.k') AS INTEGER) END AS props_k,
               CASE WHEN event_type = 'view' THEN 2 END AS props_x,
               CASE WHEN event_type <> 'click' THEN event_type END AS type,
               CASE WHEN event_type = 'view' THEN event_id::VARCHAR END AS "new"
        FROM events
        """,
    ),
    "record_ids": Query(record_ids, "SELECT count(*) AS records, count(*) AS ids FROM events"),
    "stage_counts": Query(
        stage_counts,
        """
        SELECT 'all' AS stage, count(*) AS records FROM orders
        UNION ALL SELECT 'large', count(*) FROM orders WHERE o_totalprice >= 250000
        UNION ALL SELECT 'urgent', count(*) FROM orders WHERE o_totalprice >= 250000 AND o_orderpriority = '1-URGENT'
        """,
    ),
    "sql_script": Query(
        sql_script,
        f"""
        SELECT c_mktsegment, 'a;b' AS mark, count(*) AS n, sum({CENTS_SQL})::BIGINT AS cents
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL
        """,
    ),
}
