from contextlib import nullcontext
from pathlib import Path
from types import SimpleNamespace

import pytest

from sluice import Input, Job, Stage
from sluice.operators.ordering import with_ordinals
from sluice.session import scratch_path, ship_package


def session(master, checkpoint=None, directory=None):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: directory)
    return SimpleNamespace(conf={"spark.checkpoint.dir": checkpoint} if checkpoint else {}, sparkContext=context)


def test_scratch_folder():
    assert scratch_path(session("yarn", "hdfs:///shared/"), "x").startswith("hdfs:///shared/sluice/x-")
    assert scratch_path(session("yarn", None, "s3a://b/c"), "x").startswith("s3a://b/c/sluice/x-")
    assert scratch_path(session("local[2]"), "x") != scratch_path(session("local[2]"), "x")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_path(session("spark://host:7077"), "x")


def test_package_is_shipped_once(spark):
    before = len(spark.sparkContext._python_includes)
    ship_package(spark)
    ship_package(spark)
    assert len(spark.sparkContext._python_includes) == before
    assert any(name == "sluice.zip" for name in spark.sparkContext._python_includes)


@pytest.mark.parametrize("fails", [False, True])
def test_a_job_leaves_no_intermediate_tables(spark, tmp_path, fails):
    made = []

    def numbered(df):
        made.append(scratch_path(spark, "kept-by-the-stage"))
        df.write.parquet(made[0])
        found = with_ordinals(spark.read.parquet(made[0]), ["a"], "place")
        return found.where("raise_error('on purpose') is null") if fails else found

    spark.createDataFrame([(3,), (1,)], "a int").write.json(str(tmp_path / "in"))
    root = Path(scratch_path(spark, "x").removeprefix("file:")).parent
    before = set(root.glob("*"))
    job = Job([Input("a", service="json", options={"path": str(tmp_path / "in")})], [Stage("numbered", numbered)])
    with pytest.raises(Exception, match="on purpose") if fails else nullcontext():
        job.run(spark, str(tmp_path / "out"))
        assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect())) == [(1, 1), (3, 2)]
    assert made and set(root.glob("*")) <= before
