"""Queries over sources and inputs. File scans read files that are written from the tables."""

from __future__ import annotations

import csv
import gzip
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.records import valid_name
from sluice.operators.sinks import preview
from sluice.plans.inputs import Input, load_inputs, typed
from sluice.queries.common import Query, json_of, row_count, table, write_texts
from sluice.session import scratch_path
from sluice.sources.files import Parser, scan_binary, scan_files, scan_parsed
from sluice.sources.json_objects import scan_json_objects
from sluice.sources.paths import list_files, with_file_index
from sluice.sources.tables import scan_lines, scan_service, scan_text

ORDER_FIELDS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
ORDER_SCHEMA = (
    "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderpriority string"
)
ORDERS_SQL = f"SELECT {', '.join(ORDER_FIELDS)} FROM orders"

EVENT_TYPES = ["click", "view", "purchase", "error", "signup", "none"]

# Order keys are unique, so this many of them are at most this many orders.
ORDERS_PER_TEXT = 2000


def write_free_form_orders(spark: SparkSession, sf_dir: str, texts_per_file: int) -> str:
    """Orders as arrays, as objects that follow each other, and as pretty-printed objects."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderstatus",
        F.floor(F.col("o_orderkey") / ORDERS_PER_TEXT).alias("keys"),
        F.when(F.col("o_orderstatus") == "P", json_of(*ORDER_FIELDS, pretty="true"))
        .otherwise(json_of(*ORDER_FIELDS))
        .alias("json"),
    )
    objects = F.collect_list("json")
    status = F.col("o_orderstatus")
    texts = orders.groupBy("o_orderstatus", "keys").agg(
        F.when(status == "F", F.concat(F.lit("[["), F.array_join(objects, " ,\n"), F.lit("], []]")))
        .when(status == "O", F.array_join(objects, ""))
        .otherwise(F.array_join(objects, "\n"))
        .alias("value")
    )
    where = scratch_path(spark, "free-form")
    write_texts(texts.select("value"), where, rows_per_file=texts_per_file)
    return where


def json_object_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_json_objects(spark, write_free_form_orders(spark, sf_dir, texts_per_file=8))
    return typed(found, ORDER_SCHEMA).select(ORDER_FIELDS)


def json_split_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scan for files that are too large for one task, which here may have any size."""
    where = write_free_form_orders(spark, sf_dir, texts_per_file=0)
    found = scan_json_objects(spark, where, whole_file_bytes=0)
    return typed(found, ORDER_SCHEMA).select(ORDER_FIELDS)


def _damaged_orders(spark: SparkSession, sf_dir: str) -> str:
    """Files in key order; every order above a price is followed by a stray brace."""
    orders = table(spark, sf_dir, "orders")
    damage = F.when(F.col("o_totalprice") > 499000, "}").otherwise("")
    entry = F.struct("o_orderkey", F.concat(json_of("o_orderkey", "o_totalprice"), damage).alias("json"))
    texts = (
        orders.groupBy(F.floor(F.col("o_orderkey") / ORDERS_PER_TEXT))
        .agg(F.array_sort(F.collect_list(entry)).alias("entries"))
        .select(F.array_join("entries.json", "\n").alias("value"))
    )
    where = scratch_path(spark, "damaged")
    write_texts(texts, where, rows_per_file=1)
    return where


def json_stop_at_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_json_objects(spark, _damaged_orders(spark, sf_dir))
    return typed(found, "o_orderkey bigint, o_totalprice double").select("o_orderkey", "o_totalprice")


def json_split_stop_at_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by the scan for large files: an error ends its file, also what other tasks have read of it."""
    found = scan_json_objects(spark, _damaged_orders(spark, sf_dir), whole_file_bytes=0)
    return typed(found, "o_orderkey bigint, o_totalprice double").select("o_orderkey", "o_totalprice")


def json_encodings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files in UTF-16 and UTF-8, the larger ones read by ranges and the smaller ones whole."""
    orders = table(spark, sf_dir, "orders").select(ORDER_FIELDS)
    where = scratch_path(spark, "encodings")
    codecs = {"F": "UTF-16LE", "O": "UTF-16BE", "P": "UTF-16LE"}
    for status, codec in codecs.items():
        some = orders.where(F.col("o_orderstatus") == status).coalesce(2)
        some.write.json(f"{where}/{status}", encoding=codec, lineSep="\n")
    orders.where("o_orderpriority = '1-URGENT'").write.json(f"{where}/again")
    largest = list_files(spark, f"{where}/*").agg(F.max("length")).first()[0]
    found = scan_json_objects(spark, f"{where}/*", whole_file_bytes=largest // 4)
    return typed(found, ORDER_SCHEMA).select(ORDER_FIELDS)


def line_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    where = scratch_path(spark, "lines")
    customers.write.json(where)
    return scan_lines(spark, where, customers.schema)


def binary_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts in files without a known extension, taken apart again from the files' bytes."""
    where = scratch_path(spark, "documents")
    documents = table(spark, sf_dir, "documents").select(json_of("doc_id", "text").alias("value"))
    write_texts(documents, where, rows_per_file=200)
    line = F.explode(F.split(F.decode("content", "UTF-8"), "\n")).alias("json")
    lines = scan_binary(spark, where).select(line).where("json != ''")
    found = typed(lines, "doc_id bigint, text string")
    return found.select(
        "doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"), F.md5("text").alias("text_md5")
    )


def empty_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in one file per type; of a type that no event has, the file is empty and a record like the others."""
    events = table(spark, sf_dir, "events")
    where = scratch_path(spark, "empty")
    for kind in EVENT_TYPES:
        write_texts(events.where(F.col("event_type") == kind).select("props").coalesce(1), f"{where}/{kind}")
    found = scan_binary(spark, f"{where}/*")
    kind = F.element_at(F.split("path", "/"), -2).alias("event_type")
    return found.groupBy(kind).agg(row_count(), F.sum(F.octet_length("content")).alias("n_bytes"))


def _inflated_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column("content"):
            lines = gzip.decompress(content.as_py()).decode().split("\n")
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], ["json"])


def route_by_extension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON files give records; compressed JSON and text are whole files."""
    events = table(spark, sf_dir, "events")
    where = scratch_path(spark, "mixed")
    fields = ["event_id", "event_type", "value"]
    events.where("event_type = 'click'").select(fields).write.json(f"{where}/a")
    events.where("event_type = 'view'").select(fields).write.json(f"{where}/b", compression="gzip")
    write_texts(events.where("event_type not in ('click', 'view')").select("event_type"), f"{where}/c")
    found = scan_files(spark, f"{where}/{{a,b,c}}")
    clicks = typed(found.where("extension = 'JSON'").select("json"), "event_type string")
    lines = F.explode(F.split(F.decode("content", "UTF-8"), "\n")).alias("event_type")
    rest = found.where("extension = 'TXT'").select(lines).where("event_type != ''")
    # Nothing inflates whole files, so their bytes still hold all records.
    inflated = found.where("extension = 'GZ' and json is null").select("content").mapInArrow(_inflated_lines, "json string")
    zipped = typed(inflated.where("json != ''"), "event_type string")
    return (
        clicks.withColumn("parser", F.lit("json"))
        .unionByName(rest.withColumn("parser", F.lit("binary")))
        .unionByName(zipped.withColumn("parser", F.lit("zipped")))
        .groupBy("parser", "event_type")
        .agg(row_count())
    )


def _csv_rows(_: str, content: bytes) -> Iterator[tuple]:
    for row in csv.DictReader(io.StringIO(content.decode())):
        yield int(row["event_id"]), row["event_type"], float(row["value"])


CSV_PARSER = Parser(_csv_rows, "event_id bigint, event_type string, value double")


def custom_parser(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One kind of events as CSV files with their own parser, the others as JSON."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    where = scratch_path(spark, "parsed")
    events.where("event_type = 'error'").write.option("maxRecordsPerFile", 50_000).csv(f"{where}/csv", header=True)
    events.where("event_type != 'error'").write.json(f"{where}/json")
    found = scan_files(spark, f"{where}/*", parsers={"CSV": CSV_PARSER})
    objects = typed(found.where("extension = 'JSON'").select("json"), "event_id bigint, event_type string, value double")
    return found.where("extension = 'CSV'").select("event_id", "event_type", "value").unionByName(objects)


def file_parser(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    where = scratch_path(spark, "parsed")
    events.write.option("maxRecordsPerFile", 50_000).csv(where, header=True)
    return scan_parsed(spark, where, CSV_PARSER).drop("path")


def text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    where = scratch_path(spark, "names")
    write_texts(table(spark, sf_dir, "part").select("p_name"), where)
    return scan_text(spark, where).groupBy("value").agg(row_count())


def path_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Globs, hidden folders, and folders below folders."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    where = scratch_path(spark, "paths")
    places = {"F": ["a", "_hidden", "a/.hidden"], "O": ["b,1"], "P": ["c/deep"]}
    for status, folders in places.items():
        for folder in folders:
            orders.where(F.col("o_orderstatus") == status).select("o_orderkey").write.json(f"{where}/{folder}")
    asked = {
        "listed": scan_files(spark, f"{where}/{{a,c}},{where}/b?1"),
        "recursive": scan_files(spark, where, recursiveFileLookup="true"),
        "filtered": scan_files(
            spark, where, recursiveFileLookup="true", path_filters=[r"\.json$", "/(a|c/deep)/"]
        ),
    }
    frames = [
        typed(found.select("json"), "o_orderkey bigint").withColumn("asked", F.lit(name))
        for name, found in asked.items()
    ]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


def _file_index(spark: SparkSession, sf_dir: str, **limits: int) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    texts = orders.groupBy(F.floor(F.col("o_orderkey") / ORDERS_PER_TEXT)).agg(
        F.array_join(F.collect_list(json_of("o_orderkey")), "").alias("value")
    )
    where = scratch_path(spark, "numbered")
    write_texts(texts.select("value"), where, rows_per_file=1)
    files = list_files(spark, where)
    found = with_file_index(scan_json_objects(spark, where, **limits), files)
    per_file = found.groupBy("file_index").agg(
        F.min("seq").alias("first_seq"),
        (F.max("seq") + 1 - F.count(F.lit(1))).alias("gaps"),
        F.count(F.lit(1)).alias("records"),
    )
    return per_file.agg(
        F.min("file_index").alias("first_index"),
        F.max("file_index").alias("last_index"),
        F.sum("records").alias("records"),
        F.sum(F.col("first_seq") + F.col("gaps")).alias("out_of_place"),
        F.lit(files.count()).alias("files"),
    )


def file_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _file_index(spark, sf_dir)


def file_index_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by the scan for large files, whose numbers have no gaps either."""
    return _file_index(spark, sf_dir, whole_file_bytes=0)


def service_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_size", "p_retailprice")
    where = scratch_path(spark, "service")
    parts.write.option("sep", "|").csv(where, header=True)
    return scan_service(
        spark,
        "csv",
        {"path": where, "sep": "|", "header": "true"},
        "p_partkey bigint, p_name string, p_brand string, p_size int, p_retailprice double",
    )


def multi_input_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    where = scratch_path(spark, "union")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    customers.write.json(where)
    inputs = [
        Input("customers", paths=where, schema="c_custkey bigint, c_name string, c_acctbal double"),
        Input("suppliers", service="parquet", options={"path": f"{sf_dir}/supplier.parquet"}),
        Input("parts", service="parquet", options={"path": f"{sf_dir}/part.parquet"}, enabled=False),
        Input("unknown", service="no_such_service"),
    ]
    columns = ["c_custkey", "c_name", "c_acctbal", "s_suppkey", "s_name", "s_nationkey", "s_acctbal"]
    return load_inputs(spark, inputs).select(columns)


def missing_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An input that may be absent adds nothing."""
    schema = "p_partkey bigint, p_brand string"
    where = scratch_path(spark, "present")
    table(spark, sf_dir, "part").select("p_partkey", "p_brand").write.json(where)
    inputs = [
        Input("present", paths=where, schema=schema, missing_ok=True),
        Input("absent", paths=[where, f"{where}-absent"], schema=schema, missing_ok=True),
    ]
    return load_inputs(spark, inputs).select("p_partkey", "p_brand")


def vanished_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that are replaced between listing and reading are skipped, and the others read."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    where = scratch_path(spark, "vanished")
    events.where("event_type != 'view'").write.json(f"{where}/kept")
    events.where("event_type = 'view'").write.json(f"{where}/replaced")
    found = scan_files(spark, f"{where}/*")
    events.where("event_type = 'click'").write.mode("overwrite").json(f"{where}/replaced")
    return typed(found.select("json"), "event_id bigint, event_type string")


def input_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A trial run's first records of each input, files and tables."""
    where = scratch_path(spark, "trial")
    table(spark, sf_dir, "part").select("p_partkey", "p_name").write.json(where)
    files = Input("part", paths=where, schema="p_partkey bigint, p_name string", order_by=("p_partkey",))

    def part(name: str, *columns: str, limit: int | None = None) -> Input:
        path = {"path": f"{sf_dir}/{name}.parquet"}
        return Input(name, service="parquet", options=path, order_by=columns, limit=limit)

    inputs = [part("orders", "o_orderkey"), part("customer", "c_custkey", limit=30), files]
    columns = ["o_orderkey", "o_custkey", "c_custkey", "c_name", "p_partkey", "p_name"]
    return load_inputs(spark, inputs, trial_limit=100).select(columns)


def trial_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A trial run for one record, of many files: it looks at the first five of them, of which each has one record."""
    where = scratch_path(spark, "trial-files")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    nations.repartitionByRange(25, "n_nationkey").sortWithinPartitions("n_nationkey").write.option(
        "maxRecordsPerFile", 1
    ).json(where)
    schema = "n_nationkey int, n_name string"
    # The last nation would be the record, if all files were looked at.
    last = lambda spark, paths, schema, **options: scan_lines(spark, paths, schema, **options).withColumn(
        "place", -F.col("n_nationkey")
    )
    item = Input("nation", paths=where, schema=schema, scan=last, order_by=("place",))
    return load_inputs(spark, [item], trial_limit=1).select("n_nationkey", "n_name")


def first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The largest orders, as a person would look at them."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    rows = preview(orders.orderBy(F.desc("o_totalprice"), "o_orderkey"), 20)
    return spark.createDataFrame(rows, orders.schema)


def name_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    names = parts.select(F.explode(F.array("p_name", "p_brand", "p_type")).alias("name"))
    return names.groupBy("name", valid_name(F.col("name")).alias("valid")).agg(row_count())


_STOP_SQL = f"""
    WITH damaged AS (
        SELECT o_orderkey // {ORDERS_PER_TEXT} AS keys, min(o_orderkey) AS last_key
        FROM orders WHERE o_totalprice > 499000 GROUP BY 1)
    SELECT o_orderkey, o_totalprice
    FROM orders LEFT JOIN damaged ON o_orderkey // {ORDERS_PER_TEXT} = keys
    WHERE last_key IS NULL OR o_orderkey <= last_key
    """
_INDEX_SQL = f"""
    SELECT 0::BIGINT AS first_index, count(DISTINCT o_orderkey // {ORDERS_PER_TEXT}) - 1 AS last_index,
           count(*) AS records, 0::BIGINT AS out_of_place,
           count(DISTINCT o_orderkey // {ORDERS_PER_TEXT}) AS files
    FROM orders
    """

QUERIES = {
    "json_object_scan": Query(json_object_scan, ORDERS_SQL),
    "json_split_scan": Query(json_split_scan, ORDERS_SQL),
    "json_stop_at_error": Query(json_stop_at_error, _STOP_SQL),
    "json_split_stop_at_error": Query(json_split_stop_at_error, _STOP_SQL),
    "json_encodings": Query(
        json_encodings, f"{ORDERS_SQL} UNION ALL {ORDERS_SQL} WHERE o_orderpriority = '1-URGENT'"
    ),
    "line_json": Query(line_json, "SELECT * FROM customer"),
    "binary_scan": Query(
        binary_scan,
        "SELECT doc_id, octet_length(encode(text))::BIGINT AS n_bytes, md5(text) AS text_md5 FROM documents",
    ),
    "route_by_extension": Query(
        route_by_extension,
        """
        SELECT CASE event_type WHEN 'click' THEN 'json' WHEN 'view' THEN 'zipped' ELSE 'binary' END AS parser,
               event_type, count(*) AS n
        FROM events GROUP BY ALL
        """,
    ),
    "custom_parser": Query(custom_parser, "SELECT event_id, event_type, value FROM events"),
    "file_parser": Query(file_parser, "SELECT event_id, event_type, value FROM events"),
    "text_lines": Query(text_lines, "SELECT p_name AS value, count(*) AS n FROM part GROUP BY ALL"),
    "path_rules": Query(
        path_rules,
        """
        SELECT o_orderkey, 'listed' AS asked FROM orders WHERE o_orderstatus IN ('F', 'O')
        UNION ALL SELECT o_orderkey, 'recursive' FROM orders
        UNION ALL SELECT o_orderkey, 'filtered' FROM orders WHERE o_orderstatus IN ('F', 'P')
        """,
    ),
    "file_index": Query(file_index, _INDEX_SQL),
    "file_index_split": Query(file_index_split, _INDEX_SQL),
    "empty_files": Query(
        empty_files,
        """
        SELECT event_type, 1::BIGINT AS n, sum(octet_length(encode(props)) + 1)::BIGINT AS n_bytes
        FROM events GROUP BY event_type
        UNION ALL SELECT 'none', 1, 0
        """,
    ),
    "trial_files": Query(
        trial_files,
        """
        SELECT n_nationkey, n_name FROM (SELECT * FROM nation ORDER BY n_nationkey LIMIT 5)
        ORDER BY n_nationkey DESC LIMIT 1
        """,
    ),
    "service_scan": Query(service_scan, "SELECT p_partkey, p_name, p_brand, p_size, p_retailprice FROM part"),
    "multi_input_union": Query(
        multi_input_union,
        """
        SELECT c_custkey, c_name, c_acctbal, NULL::BIGINT AS s_suppkey, NULL::VARCHAR AS s_name,
               NULL::INTEGER AS s_nationkey, NULL::DOUBLE AS s_acctbal FROM customer
        UNION ALL
        SELECT NULL, NULL, NULL, s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier
        """,
    ),
    "input_limit": Query(
        input_limit,
        """
        (SELECT o_orderkey, o_custkey, NULL::BIGINT AS c_custkey, NULL::VARCHAR AS c_name,
                NULL::BIGINT AS p_partkey, NULL::VARCHAR AS p_name
         FROM orders ORDER BY o_orderkey LIMIT 100)
        UNION ALL
        (SELECT NULL, NULL, c_custkey, c_name, NULL, NULL FROM customer ORDER BY c_custkey LIMIT 30)
        UNION ALL
        (SELECT NULL, NULL, NULL, NULL, p_partkey, p_name FROM part ORDER BY p_partkey LIMIT 100)
        """,
    ),
    "missing_input": Query(missing_input, "SELECT p_partkey, p_brand FROM part"),
    "vanished_files": Query(vanished_files, "SELECT event_id, event_type FROM events WHERE event_type <> 'view'"),
    "first_rows": Query(
        first_rows, "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20"
    ),
    "name_check": Query(
        name_check,
        """
        SELECT name, regexp_full_match(name, '[0-9a-zA-Z_]+') AS valid, count(*) AS n
        FROM (SELECT unnest([p_name, p_brand, p_type]) AS name FROM part) GROUP BY ALL
        """,
    ),
}
