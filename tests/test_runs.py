"""Output that is published once, and the clean-up of files in tasks."""

import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sluice.operators import runs
from sluice.operators.runs import published, read_run, write_run
from sluice.plans.inputs import Input
from sluice.plans.job import RESULT, Job
from sluice.plans.stages import Stage
from sluice.sources.raw_files import Storage, clean_files


def frame(spark, count, targets):
    rows = spark.range(count, numPartitions=4)
    return rows.withColumn("target", F.concat(F.lit("t "), (F.col("id") % targets).cast("string")))


def test_many_targets_in_one_pass(spark, tmp_path):
    root = str(tmp_path / "out")
    assert write_run(root, "r/1", routed=[frame(spark, 3000, 150)], whole={"all": spark.range(7)})
    assert read_run(spark, root, "t 149").count() == 20 and read_run(spark, root, "t 149").columns == ["id"]
    assert sorted(row.id for row in read_run(spark, root, "t 3").collect()) == list(range(3, 3000, 150))
    assert read_run(spark, root, "all").count() == 7
    assert read_run(spark, root, "none", "id bigint").collect() == []
    assert not write_run(root, "r/1", whole={"all": spark.range(7)})
    assert write_run(root, "2", whole={"all": spark.range(5)})
    assert published(root) == ["2", "r/1"] and read_run(spark, root, "all").count() == 12


def test_failed_runs_are_not_read(spark, tmp_path):
    root = str(tmp_path / "out")
    bad = frame(spark, 100, 3).withColumn("id", F.when(F.col("id") == 77, F.raise_error(F.lit("no")).cast("bigint")).otherwise(F.col("id")))
    with pytest.raises(PySparkException):
        write_run(root, "1", whole={"first": spark.range(10)}, routed=[bad])
    assert published(root) == []
    with pytest.raises(PySparkException, match="no target"):
        write_run(root, "1", routed=[spark.range(3).withColumn("target", F.lit(None).cast("string"))])
    assert write_run(root, "1", whole={"first": spark.range(10)}, routed=[frame(spark, 100, 3)])
    assert read_run(spark, root, "first").count() == 10 and read_run(spark, root, "t 1").count() == 33
    # What the failed run wrote of the same part is gone, not just unread.
    files = [name for _, _, names in os.walk(tmp_path / "out" / "data" / "first") for name in names]
    assert len(files) == len([name for name in files if name.startswith("1-whole-first")]) and files
    total = sum(spark.read.parquet(str(tmp_path / "out" / "data" / "first" / name)).count() for name in files)
    assert total == 10


def import_folder(spark, tmp_path, name):
    folder = str(tmp_path / "import" / name)
    spark.range(20).write.json(folder)
    return folder


def test_run_that_was_published_only_cleans_up(spark, tmp_path, monkeypatch):
    folder, out = import_folder(spark, tmp_path, "a"), str(tmp_path / "out")
    job = Job([Input("ids", paths=folder, schema="id bigint")], [], storage=Storage())
    with monkeypatch.context() as broken, pytest.raises(RuntimeError):
        broken.setattr("sluice.plans.job.clean_files", lambda *args, **options: (_ for _ in ()).throw(RuntimeError()))
        job.run(spark, out, run_id="1")
    # Another file comes before the run is repeated: it belongs to the next one.
    spark.range(3).coalesce(1).write.mode("append").json(folder)
    job.run(spark, out, run_id="1")
    assert read_run(spark, out, RESULT).count() == 20
    assert spark.read.json(folder).count() == 3
    job.run(spark, out, run_id="2")
    assert read_run(spark, out, RESULT).count() == 23
    assert not [name for name in os.listdir(folder) if name.startswith("part")]


def test_stage_input_is_computed_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(rows):
        seen.add(len(rows))
        return rows

    stages = [
        Stage("counted", lambda df: df.mapInPandas(lambda batches: map(count, batches), df.schema)),
        Stage("split", lambda df: df.where("id < 5"), emits=lambda df: df.where("id >= 5").withColumn("target", F.lit("rest"))),
    ]
    folder = import_folder(spark, tmp_path, "b")
    Job([Input("ids", paths=folder, schema="id bigint")], stages).run(spark, str(tmp_path / "o"), run_id="x")
    assert seen.value == 20
    assert read_run(spark, str(tmp_path / "o"), RESULT).count() == 5
    assert read_run(spark, str(tmp_path / "o"), "rest").count() == 15


def test_clean_up_in_tasks_can_be_repeated(spark, tmp_path):
    folder, archive = import_folder(spark, tmp_path, "c"), str(tmp_path / "archive")
    names = [f"file:{folder}/{name}" for name in sorted(os.listdir(folder)) if name.startswith("part")]
    other = tmp_path / "other.json"
    other.write_text("{}")
    every = [*names, f"file:{other}", f"file:{folder}/absent"]
    for _ in range(2):
        log = {row.name: row.done for row in clean_files(spark, every, Storage({}, {}), archive, period="2024").collect()}
        assert [log[name] for name in names] == ["archive"] * len(names)
        assert log[f"file:{other}"] == "kept" and log[f"file:{folder}/absent"] == "gone"
    assert spark.read.json(f"{archive}/2024{folder}").count() == 20
    # A new file of an old name does not replace the one that is kept.
    (tmp_path / "import" / "c" / names[0].rpartition("/")[2]).write_text('{"id":1}')
    assert clean_files(spark, names[:1], Storage({}, {}), archive, period="2024").first().done == "archive"
    assert spark.read.option("recursiveFileLookup", "true").json(archive).count() == 21
    assert clean_files(spark, [], Storage()).collect() == []


def test_stores_that_tasks_cannot_reach(spark):
    with pytest.raises(ValueError, match="cannot write"):
        write_run("viewfs://x/y", "1", whole={"a": spark.range(1)})
    assert runs.get("/no/such/file.json") is None
