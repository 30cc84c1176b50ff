"""Code over whole groups in segments, against the same code over each group at once."""

import random

import pandas as pd
import pytest

from sluice.operators.grouping import KEY
from sluice.operators.segments import GroupScan, group_scan
from sluice.queries.groups import grouped_scan


class Trail(GroupScan):
    """Per row its place and the text of the last three values; per group their number at its end."""

    state = "n bigint, trail string"

    def summary(self, rows):
        return len(rows), "".join(rows["v"].fillna("-").tail(3))

    def merge(self, first, second):
        return first[0] + second[0], (first[1] + second[1])[-3:]

    def run(self, key, before, rows, last):
        n, trail = before or (0, "")
        for some in rows:
            nth, trails = [], []
            for value in some["v"].fillna("-"):
                n, trail = n + 1, (trail + value)[-3:]
                nth.append(n)
                trails.append(trail)
            yield pd.DataFrame({"kind": "row", "n": nth, "trail": trails})
        if last:
            yield pd.DataFrame({"kind": ["end"], "n": [n], "trail": [trail]})


def expected(rows):
    found, groups = [], {}
    for key, at, value in rows:
        groups.setdefault(key, []).append((at is not None, at or 0, value))
    for key, members in groups.items():
        # Of one place there is one value here.
        trail = ""
        for n, (_, _, value) in enumerate(sorted(members, key=lambda m: m[:2]), 1):
            trail = (trail + (value or "-"))[-3:]
            found.append((key, "row", n, trail))
        found.append((key, "end", n, trail))
    return sorted(found, key=repr)


SCHEMA = f"{KEY} string, kind string, n bigint, trail string"


@pytest.mark.parametrize("segment_rows", [1, 3, 50, 50_000])
def test_segments_give_what_whole_groups_give(spark, settings, segment_rows):
    settings(spark__sql__execution__arrow__maxRecordsPerBatch="17")
    rng = random.Random(segment_rows)
    rows = [("hot" if i % 3 == 0 else f"k{rng.randrange(30)}", i if i % 40 else None, rng.choice(["a", "b", None])) for i in range(300)]
    seen = {}
    # A null place is a place of its own, with one value per group.
    rows = [(k, a, seen.setdefault((k, a), v) if a is None else v) for k, a, v in rows]
    frame = spark.createDataFrame(rows, f"{KEY} string, at bigint, v string").repartition(5)
    found = group_scan(frame, Trail(), SCHEMA, ["at"], segment_rows=segment_rows).collect()
    assert sorted(map(tuple, found), key=repr) == expected(rows)


def test_one_group_of_equal_rows(spark):
    frame = spark.range(2000, numPartitions=7).selectExpr(f"'k' as {KEY}", "1L as at", "'x' as v")
    found = group_scan(frame, Trail(), SCHEMA, ["at"], segment_rows=100).collect()
    assert sorted(row.n for row in found if row.kind == "row") == list(range(1, 2001))
    assert [(row.n, row.trail) for row in found if row.kind == "end"] == [(2000, "xxx")]
    assert {row.trail for row in found if row.n > 2} == {"xxx"}


def test_no_rows(spark):
    frame = spark.createDataFrame([], f"{KEY} string, at bigint, v string")
    assert group_scan(frame, Trail(), SCHEMA, ["at"]).collect() == []


def test_a_hot_group_is_many_tasks_work(spark, settings):
    settings(spark__sql__adaptive__coalescePartitions__enabled="false")
    frame = spark.range(5000, numPartitions=4).selectExpr(f"'k' as {KEY}", "id as at", "'x' as v")
    found = group_scan(frame, Trail(), SCHEMA, ["at"], segment_rows=500)
    tasks = found.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert sum(tasks) == 5001 and max(tasks) < 3000


class Calls(Trail):
    """Of the groups that come together, their number, and what the greatest value is in them."""

    def whole(self, rows):
        yield rows.groupby(KEY, as_index=False).agg(n=("v", "max")).assign(kind="whole", trail=str(rows[KEY].nunique()))

    def summary(self, rows):
        return len(rows), ""

    def run(self, key, before, rows, last):
        yield from (pd.DataFrame({"kind": ["run"], "n": [some["v"].max()], "trail": "1"}) for some in rows)


def test_small_groups_come_together(spark, settings):
    """Of a batch of a segment, only the first and the last group are called for alone; whole numbers stay whole."""
    settings(spark__sql__execution__arrow__maxRecordsPerBatch="500")
    exact = 2**53 + 1
    frame = spark.range(4000, numPartitions=4).selectExpr(f"concat('k', id div 4) as {KEY}", "id as at", f"{exact}L + 2 * id as v")
    found = group_scan(frame, Calls(), SCHEMA, ["at"], segment_rows=1000).collect()
    values = {f"k{i}": exact + 2 * (4 * i + 3) for i in range(1000)}
    assert {row[KEY] for row in found} == set(values)
    assert all(row.n == values[row[KEY]] for row in found if row.kind == "whole")
    assert {row.n for row in found} >= set(values.values()) and all(row.n % 2 for row in found)
    assert sum(row.kind == "run" for row in found) < 100
    assert max(int(row.trail) for row in found) > 50


def test_segments_that_several_tasks_read(spark, settings):
    settings(parquet__block__size="4096", spark__sql__files__maxPartitionBytes="4096", spark__sql__files__openCostInBytes="1")
    settings(spark__sql__execution__arrow__maxRecordsPerBatch="150")
    rows = [("hot" if i % 3 else f"k{i % 700:03d}", (i * 7919) % 6007, "abc"[i % 3]) for i in range(6000)]
    frame = spark.createDataFrame(rows, f"{KEY} string, at bigint, v string").repartition(3)
    found = group_scan(frame, Trail(), SCHEMA, ["at"], segment_rows=700).collect()
    assert sorted(map(tuple, found), key=repr) == expected(rows)


def test_unknown_days_come_last(spark, tmp_path):
    """Places and gaps of single orders, as in the query's SQL; a third of the orders are one group."""
    rows = [(i, i % 40, None if i % 11 == 0 else f"2000-01-{i % 23 + 1:02d}") for i in range(3000)]
    frame = spark.createDataFrame(rows, "o_orderkey bigint, o_custkey bigint, o_orderdate string")
    frame.selectExpr("o_orderkey", "o_custkey", "date(o_orderdate) AS o_orderdate").write.parquet(f"{tmp_path}/orders.parquet")
    groups, want = {}, {}
    for key, customer, date in rows:
        groups.setdefault(-1 if key % 3 == 0 else customer, []).append((date is None, date and int(date[-2:]), key))
    for members in groups.values():
        day = None
        for nth, (unknown, now, key) in enumerate(sorted(members, key=lambda m: (m[0], m[1] or 0, m[2])), 1):
            want[key] = nth, 0 if unknown or day is None else now - day
            day = now
    assert {row.o_orderkey: (row.nth, row.gap) for row in grouped_scan(spark, str(tmp_path)).collect()} == want
