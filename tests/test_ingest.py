import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sluice.operators.grouping import KEY, group_agg
from sluice.plans.inputs import typed
from sluice.plans.stages import Stage
from sluice.sources.raw_files import Storage, cleaning, run_folder
from sluice.streaming.ingest import ingest_files, ingest_lines, read_batches

FOLDER = "/data/set/import/ready"


def test_cleaning(spark):
    archive = {"cleanSource": "archive", "sourceArchiveDir": "/keep/all_time"}
    delete = {"cleanSource": "delete"}
    assert cleaning(FOLDER, Storage(), "/keep") == delete
    assert cleaning(FOLDER, Storage({}), "/keep") == delete
    assert cleaning(FOLDER, Storage({}, {"enabled": False}), "/keep") == delete
    assert cleaning(FOLDER, Storage({"enabled": False}, {}), "/keep") == delete
    assert cleaning(FOLDER, Storage({}, {}), "/keep") == archive
    assert cleaning(FOLDER, Storage({"enabled": True}, {"enabled": None}), "/keep") == archive
    day = run_folder(spark, datetime(2024, 5, 6, 7), "yyyy/MM/dd")
    assert cleaning(FOLDER, Storage({}, {}), "/keep", period=day)["sourceArchiveDir"] == "/keep/2024/05/06"
    assert run_folder(spark, datetime(2024, 5, 6)) == "all_time"
    assert cleaning("/data/elsewhere", Storage({}, {}), "/keep") == {}
    with pytest.raises(ValueError):
        cleaning(FOLDER, Storage({}, {}))


@pytest.fixture()
def drop(tmp_path):
    folder = tmp_path / "import" / "ready"
    folder.mkdir(parents=True)

    def put(**files):
        for name, records in files.items():
            (folder / f"{name}.json").write_text("\n".join(json.dumps(r) for r in records))

    return folder, put


@pytest.mark.parametrize("clean", ["archive", "delete", None])
def test_lines_of_two_drops(spark, tmp_path, drop, clean):
    folder, put = drop
    storage = Storage({}, {}) if clean == "archive" else Storage()
    options = cleaning(str(folder), storage, str(tmp_path / "kept")) if clean else {}
    stages = [Stage("twice", lambda df: df.withColumn("b", F.col("a") * 2))]
    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")
    for files in ({"f1": [{"a": 1}], "f2": [{"a": 2}]}, {"f3": [{"a": 3}], "f4": [{"a": 4}]}, {}):
        put(**files)
        ingest_lines(spark, str(folder), "a int", out, progress, stages, max_files=1, clean=options)
    assert sorted((r.a, r.b) for r in spark.read.parquet(out).collect()) == [(1, 2), (2, 4), (3, 6), (4, 8)]
    left = {name for name in os.listdir(folder) if name.endswith(".json")}
    if not clean:
        assert len(left) == 4
    else:
        assert not {"f1.json", "f2.json"} & left  # the newest may still be there
    kept = {name for _, _, names in os.walk(tmp_path / "kept") for name in names if name.endswith(".json")}
    assert ({"f1.json", "f2.json"} <= kept) == (clean == "archive")


def test_grouped_stages_need_whole_batches(spark):
    grouped = Stage("n", lambda df: df, grouping_fields=("a",))
    with pytest.raises(ValueError, match="ingest_files"):
        ingest_lines(spark, "x", "a int", "y", "z", [grouped])


def test_files_of_any_kind_in_groups(spark, tmp_path, drop):
    folder, put = drop
    (folder / "a[1].json").write_text('[{"k":1},{"k":2}] {"k":1}')
    (folder / "b.bin").write_bytes(b"xyz")
    stages = [
        Stage("typed", lambda df: typed(df.where("json is not null").select("json"), "k int")),
        Stage("n", lambda df: group_agg(df, F.count(F.lit(1)).alias("n")), grouping_fields=("k",)),
    ]
    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")
    ingest_files(spark, str(folder), out, progress, stages)
    put(c=[{"k": 1}])
    ingest_files(spark, str(folder), out, progress, stages)
    ingest_files(spark, str(folder), out, progress, stages)
    batches = read_batches(spark, out)
    assert sorted((r[KEY], r.n, r.batch) for r in batches.collect()) == [
        ('{"k":1}', 1, 1),
        ('{"k":1}', 2, 0),
        ('{"k":2}', 1, 0),
    ]
    assert batches.schema["batch"].dataType.simpleString() == "bigint"
    assert not os.path.exists(tmp_path / "progress.held")


def test_groups_are_those_of_the_whole_run(spark, tmp_path, drop):
    folder, put = drop
    stages = [
        Stage("typed", lambda df: typed(df.select("json"), "k int, batch int")),
        Stage("n", aggregates=lambda: [F.count("batch").alias("n")], grouping_fields=("k",)),
        Stage("several", lambda df: df.where("n > 1")),
    ]
    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")
    put(a=[{"k": 1, "batch": 7}], b=[{"k": 1, "batch": 7}, {"k": 2, "batch": 7}], c=[{"k": 1, "batch": 7}])
    ingest_files(spark, str(folder), out, progress, stages, max_files=1)
    assert [(r[KEY], r.n, r.batch) for r in read_batches(spark, out).collect()] == [('{"k":1}', 3, 0)]
    put(d=[{"k": 2, "batch": 7}], e=[{"k": 2, "batch": 7}])
    ingest_files(spark, str(folder), out, progress, stages, max_files=1)
    assert sorted((r[KEY], r.n, r.batch) for r in read_batches(spark, out).collect()) == [
        ('{"k":1}', 3, 0),
        ('{"k":2}', 2, 3),
    ]


def test_a_run_that_failed_is_completed_by_the_next(spark, tmp_path, drop):
    folder, put = drop

    def broken(df):
        raise RuntimeError("on purpose")

    def stages(last):
        return [
            Stage("typed", lambda df: typed(df.select("json"), "k int")),
            Stage("n", aggregates=lambda: [F.count(F.lit(1)).alias("n")], grouping_fields=("k",)),
            Stage("last", last),
        ]

    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")
    put(a=[{"k": 1}], b=[{"k": 1}])
    with pytest.raises(RuntimeError, match="on purpose"):
        ingest_files(spark, str(folder), out, progress, stages(broken), max_files=1)
    put(c=[{"k": 1}])
    ingest_files(spark, str(folder), out, progress, stages(None), max_files=1)
    assert [(r[KEY], r.n, r.batch) for r in read_batches(spark, out).collect()] == [('{"k":1}', 3, 0)]
