import json
import os
from datetime import UTC, datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from sluice.operators.sinks import archive_raw, preview, read_routed, write_dataset, write_routed
from sluice.plans.inputs import Input, load_inputs
from sluice.plans.job import Job
from sluice.plans.script import register_frames, run_script
from sluice.plans.stages import Stage, run_stages, stage_errors
from sluice.sources.raw_files import Storage
from sluice.sources.tables import scan_lines, scan_text


def put(path, records):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(json.dumps(r) for r in records))
    return str(path)


def test_union_of_enabled_inputs(spark, tmp_path):
    a = put(tmp_path / "a.json", [{"a": 1}, {"a": 1}])
    b = put(tmp_path / "b.json", [{"b": "x"}])
    inputs = [
        Input("one", paths=a, schema="a int", enabled=True),
        Input("two", paths=b, schema="b string"),
        Input("off", paths=b, schema="a int", enabled=False),
        Input("absent", service="no_such_service"),
    ]
    found = load_inputs(spark, inputs).select("a", "b").collect()
    assert sorted(map(tuple, found), key=str) == [(1, None), (1, None), (None, "x")]
    with pytest.raises(ValueError):
        load_inputs(spark, inputs[2:])


def test_trial_limits(spark, tmp_path):
    put(tmp_path / "ten" / "a.json", [{"a": i} for i in range(10)])
    put(tmp_path / "three" / "a.json", [{"a": i} for i in range(3)])
    spark.range(10).write.parquet(str(tmp_path / "ids"))
    service = {"service": "parquet", "options": {"path": str(tmp_path / "ids")}}
    inputs = [Input(name, paths=str(tmp_path / name), schema="a int") for name in ("ten", "three")]
    assert load_inputs(spark, inputs, 5).count() == 8
    assert load_inputs(spark, inputs).count() == 13
    assert load_inputs(spark, [*inputs, Input("ids", **service)], 5).count() == 13
    assert load_inputs(spark, [*inputs, Input("ids", **service, limit=2)], 5).count() == 10
    ordered = Input("ids", **service, order_by=("id",), limit=3)
    assert sorted(r.id for r in load_inputs(spark, [ordered], 100).collect()) == [0, 1, 2]
    assert load_inputs(spark, [ordered]).count() == 10
    files = Input("ten", paths=str(tmp_path / "ten"), schema="a int", limit=1, order_by=("a",))
    assert load_inputs(spark, [files]).count() == 10


def test_trial_run_looks_at_few_files(spark, tmp_path):
    for i in range(100):
        put(tmp_path / "in" / f"{i:03}.json", [{"a": i}])
    seen = []

    def scan(spark, paths, **options):
        seen.extend(paths)
        return scan_lines(spark, paths, "a int")

    item = Input("many", paths=str(tmp_path / "in"), scan=scan, order_by=("a",))
    assert [r.a for r in load_inputs(spark, [item], 2).collect()] == [0, 1]
    assert [os.path.basename(path) for path in seen] == [f"{i:03}.json" for i in range(10)]


def test_missing_input(spark, tmp_path):
    absent = str(tmp_path / "absent")
    with pytest.raises(AnalysisException):
        load_inputs(spark, [Input("x", paths=absent)])
    for item in (Input("x", paths=absent, missing_ok=True), Input("x", paths=absent, schema="a int", missing_ok=True)):
        assert load_inputs(spark, [item]).count() == 0


def test_columns_of_file_inputs(spark, tmp_path):
    where = str(tmp_path / "in")
    put(tmp_path / "in" / "a.json", [{"a": 1, "path": "own"}])
    put(tmp_path / "in" / "b.json", [{"a": 2}])

    def load(**options):
        return load_inputs(spark, [Input("x", paths=where, **options)])

    assert load().columns == ["fileName", "content", "json"]
    assert load(schema="a int").columns == ["fileName", "content", "a"]
    full = load(schema="a int, path string", source_columns=True)
    assert set(full.columns) == {"fileName", "content", "a", "path", "seq", "extension"}
    assert sorted((r.a, r.path, r.seq, r.extension) for r in full.collect()) == [
        (1, "own", 0, "JSON"),
        (2, None, 0, "JSON"),
    ]
    assert [r.a for r in load(schema="a int", path_filters=["b.json$"]).collect()] == [2]
    assert [r.a for r in load(schema="a int", path_filters=["b.json$"], limit=1).collect()] == [2]


def test_inputs_with_their_own_scan(spark, tmp_path):
    where = str(tmp_path / "in")
    for name in "abc":
        put(tmp_path / "in" / f"{name}.json", [{"a": 1, "name": name}, {"a": 2, "name": name}])
    lines = Input("lines", paths=where, scan=scan_lines, schema="name string", path_filters=["[ab].json$"])
    assert sorted(r.name for r in load_inputs(spark, [lines]).collect()) == ["a", "a", "b", "b"]
    assert load_inputs(spark, [lines]).columns == ["name"]
    assert scan_text(spark, where, path_filters=["c.json$"]).count() == 2


def test_untyped_records_of_mixed_files(spark, tmp_path):
    put(tmp_path / "in" / "a.json", [{"a": 1}, {"a": {"b": 2}}])
    (tmp_path / "in" / "b.bin").write_bytes(b"123")
    size = Stage("size", lambda df: df.withColumn("size", F.length("content")))
    sizes = {"aggregates": lambda: [F.sum("size").alias("size")]}
    keyed = Stage("keys", **sizes, grouping_fields=("a",), key_json="json")
    found = run_stages(load_inputs(spark, [Input("mixed", paths=str(tmp_path / "in"))]), [size, keyed])
    assert sorted(map(tuple, found.collect()), key=str) == [('{"a":1}', None), ('{"a":{"b":2}}', None), ("{}", 3)]


def test_bytes_reach_the_first_stage_only(spark):
    frame = spark.createDataFrame([(b"ab",)], "content binary")
    with_size = Stage("size", lambda df: df.withColumn("size", F.length("content")))
    assert run_stages(frame, [Stage("off", enabled=False), with_size, Stage("rest")]).columns == ["size"]
    with pytest.raises(AnalysisException):
        run_stages(frame.withColumn("a", F.lit(1)), [Stage("first"), with_size])
    assert run_stages(frame.withColumn("a", F.lit(1)), []).columns == ["a"]


def test_stage_checks():
    assert stage_errors([Stage("a"), Stage("b", dependencies=("a", "$previous", ""))]) == []
    assert "more than once" in stage_errors([Stage("a"), Stage("a")])[0]
    assert "other characters" in stage_errors([Stage("a-b")])[0]
    assert "other characters" in stage_errors([Stage("a\n")])[0]
    assert "not a stage before" in stage_errors([Stage("a", dependencies=("b",)), Stage("b")])[0]
    assert stage_errors([Stage("a-b", enabled=False)]) == []
    assert "nothing to group by" in stage_errors([Stage("a", aggregates=list)])[0]
    stream = Job([Input("s", service="streaming")], [])
    assert "stream" in stream.errors()[0]
    assert "no enabled input" in Job([Input("s", service="csv", enabled=False)], []).errors()[0]


def test_job(spark, tmp_path):
    source = put(tmp_path / "in" / "a.json", [{"a": i} for i in range(10)])
    job = Job([Input("in", paths=source, schema="a int")], [Stage("all"), Stage("even", lambda df: df.where("a % 2 = 0"))])
    out = str(tmp_path / "out")
    assert job.run(spark, out, count_stages=True) == {"all": 10, "even": 5}
    assert job.run(spark, out) == {}
    assert spark.read.parquet(out).count() == 10
    with pytest.raises(ValueError, match="more than once"):
        Job(job.inputs, [Stage("x"), Stage("x")]).plan(spark)


def test_stages_are_planned_as_one(spark, tmp_path):
    spark.range(10).selectExpr("id AS a", "id AS b", "id AS c").write.parquet(str(tmp_path / "in"))
    stages = [
        Stage("sum", lambda df: df.withColumn("d", F.col("a") + F.col("b"))),
        Stage("some", lambda df: df.where("a > 5")),
        Stage("few", lambda df: df.select("d")),
    ]
    job = Job([Input("in", service="parquet", options={"path": str(tmp_path / "in")})], stages)
    plan = job.plan(spark)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(a,5)" in plan
    assert "ReadSchema: struct<a:bigint,b:bigint>" in plan


def test_sinks(spark, tmp_path):
    frame = spark.createDataFrame([(i, "ab"[i % 2]) for i in range(10)], "v int, target string")
    for compact in (False, True):
        write_routed(frame, str(tmp_path / "routed"), compact=compact, format="json")
    assert spark.read.json(str(tmp_path / "routed" / "target=a")).count() == 10
    write_dataset(frame, str(tmp_path / "parts"), partition_by=["target"])
    assert spark.read.parquet(str(tmp_path / "parts")).where("target = 'b'").count() == 5
    texts = frame.select(F.to_json(F.struct("v")).alias("json"), "target")
    write_routed(texts, str(tmp_path / "texts"), format="text")
    assert spark.read.json(str(tmp_path / "texts" / "target=b")).agg(F.sum("v")).first()[0] == 25
    run = F.to_timestamp(F.lit("2024-05-06 07:08:09"))
    archive_raw(frame, str(tmp_path / "raw"), run, "yyyyMMdd")
    archive_raw(frame, str(tmp_path / "raw"), run)
    assert {"period=20240506", "period=all_time"} <= set(os.listdir(tmp_path / "raw"))
    assert len(preview(frame, 3)) == 3


def test_scripts(spark):
    assert register_frames([spark.range(3), spark.range(5)]) == ["testdata_0", "testdata_1"]
    script = """
    CREATE OR REPLACE TEMP VIEW both_of_them AS
      SELECT id, ';' AS mark FROM testdata_0
      UNION ALL SELECT id, ';' FROM testdata_1;
    -- only a remark;
    SELECT count(*) AS n FROM both_of_them
    """
    assert run_script(spark, script).collect() == [(8,)]
    assert run_script(spark, "SELECT 1 AS a; \nSELECT 2 AS a;").collect() == [(2,)]
    with pytest.raises(ValueError):
        run_script(spark, " -- nothing\n")


def test_routed_names_stay_texts(spark, tmp_path):
    frame = spark.createDataFrame([("007", 1), ("7", 2)], "target string, a int")
    write_routed(frame, str(tmp_path / "routed"))
    found = read_routed(spark, str(tmp_path / "routed")).select("target", "a")
    assert sorted(map(tuple, found.collect())) == [("007", 1), ("7", 2)]


RUN = datetime(2024, 5, 6, tzinfo=UTC)


def left(folder):
    return sorted(
        os.path.relpath(os.path.join(at, name), folder)
        for at, _, names in os.walk(folder)
        for name in names
        if not name.endswith(".crc")
    )


def test_job_archives_what_it_read(spark, tmp_path):
    folder = tmp_path / "import" / "ready"
    put(folder / "a b+c%20{d}.json", [{"a": 1}, {"a": 2}])
    put(folder / "e.json", [])
    put(folder / "not.txt", [{"a": 9}])
    put(tmp_path / "elsewhere" / "x.json", [{"a": 3}])
    inputs = [
        Input("ready", paths=str(folder), path_filters=["json$"], schema="a int"),
        Input("other", paths=str(tmp_path / "elsewhere"), schema="a int"),
        Input("off", paths=str(tmp_path / "absent"), enabled=False),
    ]
    late = str(folder / "late.json")

    def arrives(df):
        put(folder / "late.json", [{"a": 100}])
        return df

    job = Job(inputs, [Stage("arrives", arrives)], storage=Storage({}, {}), archive=str(tmp_path / "keep"), period="yyyy/MM")
    job.run(spark, str(tmp_path / "out"), run_time=RUN)
    assert sorted(row.a for row in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 2, 3]
    assert left(folder) == ["late.json", "not.txt"] and os.path.exists(late)
    assert left(tmp_path / "elsewhere") == ["x.json"]
    kept = tmp_path / "keep" / "2024" / "05"
    assert [os.path.basename(name) for name in left(kept)] == ["a b+c%20{d}.json", "e.json"]
    # A file of a name that is archived already replaces nothing.
    put(folder / "e.json", [{"a": 4}])
    job.run(spark, str(tmp_path / "out"), run_time=RUN)
    assert sorted(os.path.basename(name) for name in left(kept)) == ["a b+c%20{d}.json", "e.json", "e.json", "late.json"]
    assert sum(row.a for row in spark.read.parquet(str(tmp_path / "out")).collect()) == 6 + 100 + 4 + 3


def test_job_deletes_only_after_its_output(spark, tmp_path):
    folder = tmp_path / "import" / "ready"
    put(folder / "a.json", [{"a": 1}])
    inputs = [Input("ready", paths=str(folder), schema="a int")]

    def job(fn=None, **more):
        return Job(inputs, [Stage("s", fn)], **more)

    failing = job(lambda df: df.withColumn("a", F.raise_error(F.lit("no"))), storage=Storage({}))
    with pytest.raises(Exception, match="no"):
        failing.run(spark, str(tmp_path / "failed"))
    job().run(spark, str(tmp_path / "kept"))
    job(storage=Storage({}), trial_limit=5).run(spark, str(tmp_path / "trial"))
    with pytest.raises(ValueError, match="archive"):
        job(storage=Storage({}, {})).run(spark, str(tmp_path / "nowhere"))
    assert left(folder) == ["a.json"]
    for _ in range(2):  # the second time there is nothing to read
        job(storage=Storage({})).run(spark, str(tmp_path / "out"))
        assert left(folder) == []
    assert [row.a for row in spark.read.parquet(str(tmp_path / "out")).collect()] == [1]


def test_job_with_other_datasets(spark, tmp_path):
    where = put(tmp_path / "in" / "a.json", [{"a": i} for i in range(6)])
    odd = Stage(
        "odd",
        lambda df: df.where("a % 2 = 1"),
        emits=lambda df: df.where("a % 2 = 0").withColumn("target", F.when(F.col("a") > 2, "007").otherwise("7")),
    )
    job = Job([Input("in", paths=where, schema="a int")], [odd])
    out, others = str(tmp_path / "out"), str(tmp_path / "others")
    job.run(spark, out, others=others)
    assert sorted(row.a for row in spark.read.parquet(out).collect()) == [1, 3, 5]
    assert sorted(map(tuple, read_routed(spark, others).select("a", "target").collect())) == [(0, "7"), (2, "7"), (4, "007")]
    with pytest.raises(ValueError, match="folder"):
        job.run(spark, str(tmp_path / "more"))
    with pytest.raises(ValueError, match="only a job"):
        run_stages(job.plan(spark), [odd])
