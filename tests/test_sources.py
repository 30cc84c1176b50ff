import gzip
import json
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from sluice.functions.records import file_extension
from sluice.sources.files import Parser, scan_binary, scan_files, scan_parsed
from sluice.sources.json_objects import scan_json_objects
from sluice.sources.paths import first_files, list_files, or_empty, split_paths, with_file_index
from sluice.sources.tables import scan_lines, scan_service, scan_text


def put(root, files):
    for name, content in files.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content if isinstance(content, bytes) else content.encode())
    return str(root)


def names(frame, column="path"):
    return sorted(row[0].rsplit("/", 1)[1] for row in frame.select(column).distinct().collect())


def test_routes_by_extension(spark, tmp_path):
    where = put(
        tmp_path,
        {
            "x.json": '{"a":1}{"a":2}',
            "y.JSON": '[{"a":3}]',
            "z.json.gz": gzip.compress(b'{"a":4}'),
            "noext": "plain",
            "dir.json/inner": "plain",
            "u.txt": "text",
        },
    )
    found = scan_files(spark, [where, f"{where}/dir.json"])
    rows = [(r.path.rsplit("/", 1)[1], r.extension, r.json, r.content) for r in found.collect()]
    assert sorted(r for r in rows if r[2]) == [
        ("x.json", "JSON", '{"a":1}', None),
        ("x.json", "JSON", '{"a":2}', None),
        ("y.JSON", "JSON", '{"a":3}', None),
    ]
    whole = {r[0]: r[3] for r in rows if not r[2]}
    assert set(whole) == {"z.json.gz", "noext", "inner", "u.txt"}
    assert gzip.decompress(bytes(whole["z.json.gz"])) == b'{"a":4}'


def test_extension_of_the_whole_path(spark):
    paths = ["a/x.json", "a.b/noext", "noext", "x.json.GZ", "dot."]
    frame = spark.createDataFrame([(p,) for p in paths], "path string")
    found = [row[0] for row in frame.select(file_extension(F.col("path"))).collect()]
    assert found == ["JSON", "B/NOEXT", None, "GZ", ""]


def test_json_files_are_not_opened_as_whole_files(spark, tmp_path):
    where = put(tmp_path, {"x.json": "{}", "y.bin": "1"})
    found = scan_binary(spark, where, path_filters=[r"\.bin$"])
    assert found.rdd.getNumPartitions() == 1
    assert [bytes(row.content) for row in found.collect()] == [b"1"]


def test_binary_record(spark, tmp_path):
    where = put(tmp_path, {"a b.bin": b"\x00\xff", "no +bytes.bin": b"", "empty.json": b""})

    def contents(found):
        return {row.fileName: bytes(row.content) for row in found.select("fileName", "content").collect()}

    full = {f"file:{where}/a b.bin": b"\x00\xff"}
    empty = {f"file:{where}/no +bytes.bin": b"", f"file:{where}/empty.json": b""}
    assert contents(scan_binary(spark, where, keep_empty=False)) == full
    assert contents(scan_binary(spark, where)) == full | empty
    assert contents(scan_binary(spark, where, path_filters=["json$"])) == {
        f"file:{where}/empty.json": b""
    }
    del empty[f"file:{where}/empty.json"]
    assert contents(scan_files(spark, where)) == full | empty
    assert contents(scan_files(spark, where, keep_empty=False)) == full


def test_line_scan_keeps_what_the_object_scan_stops_at(spark, tmp_path):
    where = put(tmp_path, {"p.JSON": '{"a":1,"b":"x"}}\n{"a":2,"b":"y"}}\n{"a":3,"b":"z"}}'})
    assert scan_lines(spark, where).count() == 3
    assert scan_lines(spark, where, "a int").where("a > 1").count() == 2
    assert scan_json_objects(spark, where).count() == 1


def test_text(spark, tmp_path):
    where = put(tmp_path, {"t": "one\n\ntwo"})
    assert sorted(row.value for row in scan_text(spark, where).collect()) == ["", "one", "two"]


def test_services(spark, tmp_path):
    where = put(tmp_path, {"t.csv": "a;b\n1;x\n"})
    options = {"path": where, "sep": ";", "header": "true"}
    assert scan_service(spark, "csv", options, "a int, b string").collect() == [(1, "x")]
    assert scan_service(spark, "no_such_service") is None
    with pytest.raises(AnalysisException):
        scan_service(spark, "csv", {"path": f"{where}/absent"})


def test_split_paths():
    assert split_paths("p/{a,b}.json,p/c.json") == ["p/{a,b}.json", "p/c.json"]
    assert split_paths(" a , b{1,2}c{3,4} ,") == ["a", "b{1,2}c{3,4}"]
    assert split_paths(["a,b"]) == ["a,b"]


def test_hidden_files_recursion_and_globs(spark, tmp_path):
    files = ["a.json", "_b.json", ".c.json", "sub/d.json", "_sub/e.json"]
    where = put(tmp_path, dict.fromkeys(files, '{"a":1}'))
    assert names(list_files(spark, where)) == ["a.json"]
    assert names(list_files(spark, where, recursiveFileLookup="true")) == ["a.json", "d.json"]
    assert names(list_files(spark, f"{where}/{{a,sub/d}}.json")) == ["a.json", "d.json"]
    every = list_files(spark, where, recursiveFileLookup="true", path_filters=["json$", "/sub/"])
    assert names(every) == ["d.json"]
    assert names(scan_json_objects(spark, where, recursiveFileLookup="true", path_filters=["/sub/"])) == ["d.json"]


def test_missing_paths(spark, tmp_path, caplog):
    absent = str(tmp_path / "absent")
    for scan in (scan_json_objects, scan_files, scan_binary, scan_lines, scan_text):
        with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
            scan(spark, absent)
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        scan_files(spark, f"{tmp_path}/*.nothing")
    with caplog.at_level("WARNING"):
        assert or_empty(spark, lambda: scan_files(spark, absent), "a int", True).collect() == []
    assert "an input is empty" in caplog.text
    with pytest.raises(AnalysisException):
        or_empty(spark, lambda: spark.table("no_such_table"), "a int", True)


def test_vanished_files_are_skipped(spark, tmp_path):
    where = put(tmp_path, {"a.json": '{"a":1}', "b.json": '{"a":2}'})
    objects, whole = scan_json_objects(spark, where), scan_binary(spark, where)
    os.remove(tmp_path / "a.json")
    assert [json.loads(row.json) for row in objects.collect()] == [{"a": 2}]
    assert whole.count() == 1


def test_first_files(spark, tmp_path):
    where = put(tmp_path, {f"{i:03}[x].json": '{"a":1}' for i in range(100)})
    first = first_files(spark, where, 10)
    assert names(scan_json_objects(spark, first)) == [f"{i:03}%5Bx%5D.json" for i in range(10)]


def test_file_index(spark, tmp_path, monkeypatch):
    where = put(tmp_path, {f"{i:02}.json": '{"a":1}' * (i % 3) + " " for i in range(30)})
    for bound in (200_000, 0):
        monkeypatch.setattr("sluice.sources.paths.BROADCAST_FILES", bound)
        found = with_file_index(scan_json_objects(spark, where), list_files(spark, where))
        pairs = {(row.path[-7:-5], row.file_index) for row in found.collect()}
        assert pairs == {(f"{i:02}", i) for i in range(30) if i % 3}


def test_parsers(spark, tmp_path):
    where = put(tmp_path, {"a.kv": "x=1\ny=2\n", "b.KV": "", "c.json": '{"k":"z"}', "d.bin": "1"})

    def pairs(name, content):
        for line in content.decode().splitlines():
            key, value = line.split("=")
            yield key, int(value)

    parser = Parser(pairs, "k string, v bigint")
    found = scan_files(spark, where, parsers={"KV": parser})
    assert sorted((r.k, r.v) for r in found.where("extension = 'KV'").collect()) == [("x", 1), ("y", 2)]
    assert sorted(r.extension for r in found.collect()) == ["BIN", "JSON", "KV", "KV"]
    assert scan_parsed(spark, f"{where}/*.kv", parser).count() == 2
    replaced = scan_files(spark, where, parsers={"JSON": Parser(lambda name, content: [(len(content),)], "size int")})
    assert [r.size for r in replaced.where("extension = 'JSON'").collect()] == [9]
