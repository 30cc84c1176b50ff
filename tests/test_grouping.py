import random
import weakref

import pandas as pd
import pytest
from pyspark.sql import functions as F

from sluice.operators import grouping
from sluice.operators.grouping import KEY, group_agg, group_apply, group_fields, group_frames, with_group_key
from sluice.operators.ordering import groups_in_key_order, with_ordinals
from sluice.plans.stages import Stage, run_stages, stage_errors
from sluice.queries.groups import grouped_whole


@pytest.fixture(scope="module")
def skewed(spark):
    """Half of the rows share a key, some have none."""
    rng = random.Random(3)
    rows = [(rng.choice([1, 1, 1, 1, None, *range(5, 9)]), rng.randrange(1000)) for _ in range(5000)]
    frame = spark.createDataFrame(rows, "k int, v bigint").repartition(6)
    expected = {}
    for k, v in rows:
        expected.setdefault("{}" if k is None else f'{{"k":{k}}}', []).append(v)
    return with_group_key(frame, ["k"]).select(KEY, "v"), expected


def test_whole_groups_of_any_size(spark, tmp_path):
    """Most orders are of one customer, on few days, some of them unknown."""
    orders = spark.range(30_000).selectExpr(
        "IF(id % 10 < 9, 1, id) AS o_custkey", "IF(id % 7 = 0, NULL, DATE'2000-01-01' + INT(id % 5) * INT(id % 5)) AS o_orderdate"
    )
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    got = {row.group_key: (row.orders, row.longest_gap) for row in grouped_whole(spark, str(tmp_path)).collect()}
    assert got['{"o_custkey":1}'] == (27_000, 7) and got['{"o_custkey":9}'] == (1, 0) and len(got) == 3001


def total(key, batches):
    yield pd.DataFrame({"v": [sum(int(rows["v"].sum()) for rows in batches)]})


def totals(rows):
    return rows.groupby(KEY, as_index=False)["v"].sum()


def pairs(frame):
    return sorted((row[KEY], row.v) for row in frame.collect())


SCHEMA = f"{KEY} string, v bigint"


def test_module_with_and_without_partial(spark, skewed, settings, monkeypatch):
    frame, groups = skewed
    expected = sorted((key, sum(values)) for key, values in groups.items())
    assert pairs(group_agg(frame, F.sum("v").alias("v"))) == expected
    settings(spark__sql__execution__arrow__maxRecordsPerBatch="37")
    for options in (
        {},
        {"partial": totals},
        {"partial": totals, "salts": 3},
        {"salts": 3, "partitions": 3},
        {"use_combiner": False, "max_group_rows": 5000},
    ):
        assert pairs(group_apply(frame, total, SCHEMA, **options)) == expected
    for options in ({}, {"salts": 4, "partitions": 2}):
        assert pairs(group_frames(frame, totals, SCHEMA, partial=totals, **options)) == expected


def test_groups_of_many_batches_reach_finish_once(spark, skewed, settings):
    frame, groups = skewed
    settings(spark__sql__execution__arrow__maxRecordsPerBatch="16")

    def finish(rows):
        assert rows[KEY].is_monotonic_increasing
        return rows.groupby(KEY, as_index=False).agg(v=("v", "nunique"))

    distinct = group_frames(frame, finish, SCHEMA, partial=lambda rows: rows.drop_duplicates(), partitions=2)
    assert pairs(distinct) == sorted((key, len(set(values))) for key, values in groups.items())


def test_combining_holds_a_bounded_amount(monkeypatch):
    monkeypatch.setattr(grouping, "_HELD_BYTES", 2000)
    sizes = []

    def partial(rows):
        sizes.append(len(rows))
        return totals(rows)

    same = [pd.DataFrame({KEY: ["a"] * 10, "v": [1] * 10}) for _ in range(50)]
    found = pd.concat(grouping._combined(partial)(iter(same)))
    assert (len(found), found["v"].sum()) == (1, 500)
    assert max(sizes) < 50
    other = [pd.DataFrame({KEY: [f"{i}-{j}" for j in range(10)], "v": [1] * 10}) for i in range(50)]
    chunks = list(grouping._combined(partial)(iter(other)))
    assert len(chunks) > 5 and sum(map(len, chunks)) == 500


def test_a_module_as_its_combiner_holds_few_frames(spark):
    """Of 6,000 keys, a bounded number of the module's frames is held; keys of few rows cost no call."""
    alive, most, called = 0, 0, []

    def gone():
        nonlocal alive
        alive -= 1

    def counted(key, batches):
        nonlocal alive, most
        for found in total(key, batches):
            weakref.finalize(found, gone)
            alive += 1
            most = max(most, alive)
            called.append(key)
            yield found

    values = [(f"k{i % 6000}", i) for i in range(120_000)] + [(f"few{i}", i) for i in range(50)]
    rows = pd.DataFrame(values, columns=[KEY, "v"]).sample(frac=1, random_state=1)
    partial = grouping._as_partial(spark.createDataFrame([], SCHEMA), counted, SCHEMA)
    found = partial(rows)
    assert found.groupby(KEY)["v"].sum().to_dict() == rows.groupby(KEY)["v"].sum().to_dict()
    assert len(found) == 6050 and list(found.columns) == [KEY, "v"] and found["v"].dtype == "int64"
    assert most < 3000 and not any(key.startswith("few") for key in called)
    again = partial(found)
    assert again.groupby(KEY)["v"].sum().to_dict() == rows.groupby(KEY)["v"].sum().to_dict()
    assert partial(rows.iloc[:0]).empty


def test_a_hot_group_is_small_when_it_reaches_the_module(spark, skewed):
    frame, groups = skewed

    def arrived(key, batches):
        yield pd.DataFrame({"v": [sum(map(len, batches))]})

    by_key = {len(values): key for key, values in groups.items()}
    assert max(by_key) > 2000
    assert max(row.v for row in group_apply(frame, arrived, SCHEMA, partial=totals).collect()) <= 6
    assert max(row.v for row in group_apply(frame, arrived, SCHEMA, partial=totals, salts=2).collect()) <= 2


def test_aggregates_are_combined_before_the_shuffle(spark, skewed):
    frame, _ = skewed
    for found in (group_agg(frame, F.sum("v")), group_fields(frame, ["v"], F.count("*"))):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.index("Exchange") < plan.index("partial_")


def test_module_sees_the_whole_group_as_a_stream(spark, skewed, settings):
    frame, groups = skewed
    settings(spark__sql__execution__arrow__maxRecordsPerBatch="100")

    def first_and_last(key, batches):
        values = [v for rows in batches for v in rows["v"]]
        if key != "{}":
            yield pd.DataFrame({"low": [min(values)], "high": [max(values)]})

    found = group_apply(frame, first_and_last, "low bigint, high bigint", use_combiner=False, max_group_rows=10_000)
    expected = sorted((min(v), max(v)) for key, v in groups.items() if key != "{}")
    assert sorted(map(tuple, found.collect())) == expected


def test_groups_larger_than_stated_fail(spark, skewed):
    frame, _ = skewed
    with pytest.raises(Exception, match="more than max_group_rows=50"):
        group_apply(frame, total, SCHEMA, use_combiner=False, max_group_rows=50).collect()


def test_unsafe_combiners_are_refused(spark, skewed):
    frame, _ = skewed
    with pytest.raises(ValueError, match="own combiner"):
        group_apply(frame, total, "total bigint")
    with pytest.raises(ValueError, match="max_group_rows"):
        group_apply(frame, total, "total bigint", use_combiner=False)
    with pytest.raises(ValueError, match="grouping fields"):
        with_group_key(frame, [])


def test_grouping_by_fields_gives_the_same_keys(spark):
    rows = [(i % 3 or None, (i % 2,), f"{i % 4}", float(i % 5)) for i in range(60)]
    frame = spark.createDataFrame(rows, "a int, s struct<b: int>, t string, d double")
    fields = ["t", "s.b", "a", "d"]
    by_text = group_agg(with_group_key(frame, fields), F.count(F.lit(1)).alias("v"))
    assert pairs(group_fields(frame, fields, F.count(F.lit(1)).alias("v"))) == pairs(by_text)


@pytest.mark.parametrize(
    "values",
    [
        "TIMESTAMP'2024-01-01 00:00:00.000001', TIMESTAMP'2024-01-01 00:00:00.000002'",
        "TIMESTAMP_NTZ'2024-01-01 00:00:00.000001', TIMESTAMP_NTZ'2024-01-01 00:00:00.000002'",
        "0.0D, -0.0D, double('NaN'), 1.5D",
        "float(0), float('-0.0'), float(2.5)",
        "1.10BD, 1.20BD",
        "DATE'2024-01-01', DATE'2024-01-02'",
        "true, false, null",
        "'a', 'é', ''",
        "X'00', X'FF'",
        "array(1, null), array(2)",
    ],
)
def test_both_ways_of_grouping_agree_on_every_type(spark, values):
    frame = spark.sql(f"SELECT explode(array({values})) AS k UNION ALL SELECT explode(array({values}))")
    count = F.count(F.lit(1)).alias("n")
    by_key = group_agg(with_group_key(frame, ["k"]), count)
    by_fields = group_fields(frame, ["k"], count, partitions=2)
    assert by_fields.rdd.getNumPartitions() == 2
    assert sorted(map(tuple, by_key.collect())) == sorted(map(tuple, by_fields.collect()))
    assert by_key.count() == frame.distinct().count()


def test_module_of_a_stage(spark):
    def spread(_, batches):
        a = pd.concat(batches)["a"]
        yield pd.DataFrame({"spread": [int(a.max() - a.min())]})

    frame = spark.createDataFrame([(1, 5), (1, 9), (2, 4)], "k int, a int")
    settings = {"schema": f"{KEY} string, spread int", "combiner": False, "max_group_rows": 2, "partitions": 3}
    stage = Stage("spread", grouping_fields=("k",), module=spread, **settings)
    assert sorted(map(tuple, run_stages(frame, [stage]).collect())) == [('{"k":1}', 4), ('{"k":2}', 0)]
    assert stage_errors([stage]) == []
    assert len(stage_errors([Stage("x", lambda df: df, module=spread)])) == 2


def test_given_key_wins(spark):
    frame = spark.createDataFrame([(1, None), (1, '{"x":1}'), (2, None)], "a int, given string")
    keyed = with_group_key(frame, ["a"], given="given")
    assert sorted(row[0] for row in keyed.select(KEY).collect()) == ['{"a":1}', '{"a":2}', '{"x":1}']
    only = with_group_key(frame, [], given="given")
    assert sorted(row[0] for row in only.select(KEY).collect()) == ['{"x":1}', "{}", "{}"]


@pytest.mark.parametrize("place", [0, 1, 2])
def test_grouped_stage_anywhere(spark, place):
    frame = spark.createDataFrame([(i % 3, i) for i in range(30)], "a int, v int")
    chain = [Stage("all"), Stage("some", lambda df: df.where("v >= 0"))]
    chain.insert(place, Stage("n", lambda df: df.groupBy(KEY).agg(F.sum("v").alias("v")), grouping_fields=("a",)))
    found = run_stages(frame, chain)
    assert pairs(found) == [('{"a":0}', 135), ('{"a":1}', 145), ('{"a":2}', 155)]


def test_several_grouped_stages(spark):
    frame = spark.createDataFrame([(i % 6, i % 2) for i in range(30)], "a int, b int")
    count = F.count(F.lit(1)).alias("n")
    first = Stage("a", lambda df: df.groupBy(KEY, "b").agg(count).drop(KEY), grouping_fields=("a",))
    for given in (None, "given"):
        total = Stage("b", aggregates=lambda: [F.sum("n").alias("v")], grouping_fields=("b",), given_key=given)
        no_key = Stage("none", lambda df: df.withColumn("given", F.lit(None).cast("string")))
        assert pairs(run_stages(frame, [first, no_key, total])) == [('{"b":0}', 15), ('{"b":1}', 15)]


def test_keys_in_byte_order(spark):
    texts = ["é", "z", "Z", "10", "9", "a"] * 9
    frame = spark.createDataFrame([(text, place) for place, text in enumerate(texts)], f"{KEY} string, v int")
    parts = groups_in_key_order(frame, partitions=3).select(KEY).rdd.glom().collect()
    for part in parts:
        keys = [row[0].encode() for row in part]
        assert keys == sorted(keys)
    assert len(parts) == 3


def test_ordinals(spark):
    rng = random.Random(1)
    values = list(range(2000))
    rng.shuffle(values)
    frame = spark.createDataFrame([(v, str(v)) for v in values], "v int, s string").repartition(5)
    numbered = with_ordinals(frame, ["v"], "nth")
    assert numbered.columns == ["v", "s", "nth"]
    assert sorted((row.nth, row.v) for row in numbered.collect()) == [(v + 1, v) for v in range(2000)]
    assert with_ordinals(frame.limit(0), ["v"]).collect() == []


def test_ordinals_of_rows_that_are_mostly_equal_in_order(spark, settings):
    values = [7] * 3000 + list(range(20))
    rows = [(v, place, {"a": place}) for place, v in enumerate(values)]
    frame = spark.createDataFrame(rows, "v int, place int, m map<string, int>").repartition(6)
    settings(spark__sql__adaptive__enabled="false")
    ordered = with_ordinals(frame, ["v"], "nth")
    assert len(ordered.inputFiles()) > 1
    numbered = ordered.collect()
    assert sorted(row.nth for row in numbered) == list(range(1, 3021))
    assert [row.v for row in sorted(numbered, key=lambda row: row.nth)] == sorted(values)
    assert all(row.m == {"a": row.place} for row in numbered)
