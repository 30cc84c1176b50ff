import datetime
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from sluice.functions import json_text
from sluice.functions.json_text import merged_text
from sluice.functions.records import (
    field,
    group_key,
    json_group_key,
    merge_json,
    merge_maps,
    period_folder,
    valid_name,
)
from sluice.operators.modules import BatchModule, map_batches, merge_fields, passthrough, with_record_id
from sluice.plans.inputs import typed


def one(frame):
    return [row[0] for row in frame.collect()]


def test_key_of_typed_columns(spark):
    frame = spark.sql("SELECT named_struct('b', 1) AS a, 2.0D AS d, CAST(null AS string) AS n, '1' AS s, 1 AS i")
    keys = frame.select(group_key("n"), group_key("i"), group_key("d"), group_key("s"), group_key("a.b", "n", "i"))
    assert list(keys.first()) == ["{}", '{"i":1}', '{"d":2.0}', '{"s":"1"}', '{"a.b":1,"i":1}']
    assert frame.select(field("a.b")).first()[0] == 1


def test_key_of_json_text(spark):
    texts = ["{}", '{"f":null}', '{"f":1}', '{"f":1.0}', '{"f":"1"}', '{ "a" : {"b": "é"} }', '{"f":[1, {}]}', None]
    frame = spark.createDataFrame([(t,) for t in texts], "json string")
    assert one(frame.select(json_group_key(F.col("json"), "f", "a.b"))) == [
        "{}", "{}", '{"f":1}', '{"f":1.0}', '{"f":"1"}', '{"a.b":"é"}', '{"f":[1,{}]}', "{}"
    ]


def test_json_merge(spark):
    pairs = [
        ('{"a":1,"o":{"x":1,"y":2}}', '{"o":{"x":9},"b":null}', '{"a":1,"o":{"x":9},"b":null}'),
        ('{"a":1.0}', None, '{"a":1.0}'),
        (None, '{"a":1}', None),
        ('{"a":1}', "{}", '{"a":1}'),
    ]
    frame = spark.createDataFrame(pairs, "record string, changes string, expected string")
    merged = frame.select(merge_json(F.col("record"), F.col("changes")), "expected").collect()
    assert all(row[0] == row[1] for row in merged)


def test_keys_of_long_numbers_and_lone_surrogates(spark):
    texts = ['{"f":0.1234567890123456789012}', '{"f":1e400}', '{"f":"\\ud800"}', '{"f":1.00}', '{"f":%s}' % ("9" * 5000)]
    frame = spark.createDataFrame([(t,) for t in texts], "json string")
    expected = [*texts[:3], '{"f":1.0}', texts[4]]
    assert one(frame.select(json_group_key(F.col("json"), "f"))) == expected


def test_merge_keeps_how_values_are_spelled(spark):
    record = '{"a" : 0.1234567890123456789012, "n":1e400, "t":"a  b\\" c", "s":"\\ud800", "l":[1.00, {}], "a":2}'
    frame = spark.createDataFrame([(record, ' {"z":1,"n":1.50} ')], "record string, changes string")
    merged = '{"a":2,"n":1.50,"t":"a  b\\" c","s":"\\ud800","l":[1.00,{}],"z":1}'
    assert one(frame.select(merge_json(F.col("record"), F.col("changes")))) == [merged]


@pytest.mark.parametrize("bad", ["{", '{"a"}', '{"a":1,}', "{} x", "[1]", '{"a":1 "b":2}', '{"a":' + "[" * 100_000])
def test_merge_refuses_what_is_no_object(bad):
    with pytest.raises(ValueError):
        merged_text(bad, "{}")


def test_map_merge(spark):
    frame = spark.sql(
        "SELECT map('a', 1, 'b', 2) AS m, map('b', 3, 'c', null) AS c UNION ALL SELECT map('a', 1), null"
    )
    assert one(frame.select(merge_maps(F.col("m"), F.col("c")))) == [{"a": 1, "b": 3, "c": None}, {"a": 1}]


def test_field_merge(spark):
    frame = typed(spark.createDataFrame([('{"a":1,"o":{"x":1,"y":2}}',)], "json string"), "a int, o struct<x:int,y:int>")
    changes = {"o": F.named_struct(F.lit("x"), F.lit(9)), "b": F.lit(None).cast("int")}
    merged = merge_fields(frame, changes)
    assert merged.columns == ["a", "o", "b"]
    assert merged.first().asDict(True) == {"a": 1, "o": {"x": 9}, "b": None}


def test_names_and_periods(spark):
    frame = spark.createDataFrame([("a_1",), ("a-1",), ("",), ("é",)], "name string")
    assert one(frame.select(valid_name(F.col("name")))) == [True, False, False, False]
    assert one(frame.select(valid_name(F.concat(F.lit("abc"), F.lit("\n"))))) == [False] * 4
    run = F.lit(datetime.datetime(2024, 5, 6, 7, 8))
    assert spark.range(1).select(period_folder(run, "yyyy-MM-dd_HH"), period_folder(run, None)).first()[:] == (
        "2024-05-06_07",
        "all_time",
    )


class Counting(BatchModule):
    def start(self):
        self.sizes = []

    def batch(self, rows):
        self.sizes.append(len(rows))
        return rows.assign(kind="row")[["id", "kind"]]

    def end(self):
        yield pd.DataFrame({"id": self.sizes, "kind": "size"})


def test_batch_sizes_and_hooks(spark):
    frame = spark.range(0, 250, 1, 1)
    found = map_batches(frame, Counting(), "id bigint, kind string", batch_size=100).collect()
    assert [row.id for row in found if row.kind == "size"] == [100, 100, 50]
    assert [row.id for row in found if row.kind == "row"] == list(range(250))


def test_rows_emitted_any_number_of_times(spark):
    frame = spark.createDataFrame([(0,), (1,), (3,)], "n int")
    for size in (None, 1, 2):
        found = map_batches(frame, lambda rows: rows.loc[rows.index.repeat(rows["n"])], "n int", batch_size=size)
        assert sorted(one(found)) == [1, 3, 3, 3]
    twice = map_batches(frame, lambda rows: iter([rows, rows]), "n int")
    assert sorted(one(twice)) == [0, 0, 1, 1, 3, 3]


def test_passthrough_and_ids(spark):
    frame = spark.createDataFrame([(1, b"x")] * 20, "a int, content binary").repartition(4)
    assert passthrough(frame).columns == ["a"]
    assert len(set(one(with_record_id(frame).select("record_id")))) == 20


def test_plain_records_are_read_as_others_are(monkeypatch):
    """The pattern for plain members against the reader of any JSON."""
    rng = random.Random(6)
    names = ["a", "b", "a b", "é", "n.x", "", "n"]
    values = ['"x"', '"é 😀"', "0", "-0", "1.0", "-2.50", "1e5", "12345678901234567890", "0.1234567890123456789", "1E400", "true", "null", '""']
    odd = ['{"a":1', '{"a":01}', '{"a":1,}', '{"a":.5}', '{"a" :1}', '{"a":"\\n"}', '{"a":{"b":1}}', '{"a":[1]}', "{}", "[]", '{"a":tru}']
    records = odd + ["{" + ",".join(f'"{rng.choice(names)}":{rng.choice(values)}' for _ in range(rng.randrange(6))) + "}" for _ in range(400)]
    paths = [["a"], ["n.x", "b"], ["é", "a b", ""], ["n", "a", "a"]]

    def outcome(work, *args):
        try:
            return work(*args)
        except ValueError:
            return ValueError

    def results():
        return [
            *[outcome(json_text.key_text, record, some) for record in records for some in paths],
            *[outcome(json_text.merged_text, record, records[i - 1]) for i, record in enumerate(records)],
        ]

    fast = results()
    monkeypatch.setattr(json_text, "_plain_members", lambda text: None)
    assert fast == results()
