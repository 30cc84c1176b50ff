import json
import os
import random
import subprocess
import sys

import pytest

from sluice.functions.json_text import ObjectReader, file_text, outer_objects
from sluice.sources import json_objects
from sluice.sources.json_objects import scan_json_objects

CASES = {
    "one_line": ('{"a":1}{"a":2}\n{\n  "a": 3\n}', [{"a": 1}, {"a": 2}, {"a": 3}]),
    "arrays": ('7 "x}{" [{"a":4},[{"a":5}]]', [{"a": 4}, {"a": 5}]),
    "outermost": ('{"a":{"b":{"c":1}}}', [{"a": {"b": {"c": 1}}}]),
    "cut_off": ('{"a":1}\n{"a":', [{"a": 1}]),
    "stray_brace": ('{"a":1}}\n{"a":2}', [{"a": 1}]),
    "garbage": ('[{"a":1},{"a":2},!', [{"a": 1}, {"a": 2}]),
    "repeated_field": ('{"a":1,"a":2}', [{"a": 2}]),
    "empty": ("", []),
    "empty_array": ("[]", []),
    "no_comma": ('[{"a":1} {"a":2}]', [{"a": 1}]),
    "root_comma": ('{"a":1},{"a":2}', [{"a": 1}]),
    "trailing_comma": ('[{"a":1},]{"a":2}', [{"a": 1}]),
    "stray_bracket": ('{"a":1}]{"a":2}', [{"a": 1}]),
    "constant": ('{"a":1}{"a":NaN}{"a":2}', [{"a": 1}]),
    "control_character": ('{"a":1}{"a":"x\ny"}{"a":2}', [{"a": 1}]),
    "number_then_object": ('1{"a":2}', []),
    "string_then_object": ('"x"{"a":2}', [{"a": 2}]),
    "mark": ('﻿{"a":1}', [{"a": 1}]),
    "escapes": ('{"a":"\\"}{\\\\"}{"b":2}', [{"a": '"}{\\'}, {"b": 2}]),
    "brace_string": ('"}}}{" {"a":1} "}" {"b":2} tru', [{"a": 1}, {"b": 2}]),
    "not_closed": ('{"a":1}{"b":{"c":2}', [{"a": 1}]),
    "blank_end": ('{"a":1}\n{"b":2}\n\n', [{"a": 1}, {"b": 2}]),
    "wrong_inside": ('{"a":1}{"b" 2}{"c":3}', [{"a": 1}]),
    "open_bracket_inside": ('[{"a":1},{"b":[2},{"c":3}]', [{"a": 1}]),
}


def read(frame):
    found = {}
    for row in frame.orderBy("path", "seq").collect():
        found.setdefault(row.path.rsplit("/", 1)[1], []).append(row.json)
    return found


@pytest.fixture()
def folder(tmp_path):
    def write(files):
        for name, content in files.items():
            data = content if isinstance(content, bytes) else content.encode()
            (tmp_path / f"{name}.json").write_bytes(data)
        return str(tmp_path)

    return write


SPLIT_BYTES = 600


@pytest.fixture()
def small_splits(monkeypatch):
    monkeypatch.setattr(json_objects, "_range_bytes", lambda spark, total: SPLIT_BYTES)


def test_ranges_follow_the_session_and_the_input(spark, settings):
    assert json_objects._range_bytes(spark, 1 << 40) == 16 << 20
    assert json_objects._range_bytes(spark, 80 << 20) == 10 << 20
    settings(spark__sql__files__maxPartitionBytes="603")
    assert json_objects._range_bytes(spark, 1 << 40) == 600


def test_cases(spark, folder):
    found = read(scan_json_objects(spark, folder({name: text for name, (text, _) in CASES.items()})))
    for name, (_, expected) in CASES.items():
        assert [json.loads(text) for text in found.get(f"{name}.json", [])] == expected, name


def test_cases_in_split_files(spark, small_splits, folder):
    """Blanks in front move the split border through every case."""
    files = {}
    for name, (text, _) in CASES.items():
        mark = "\ufeff" if name == "mark" else ""
        for part in range(1, 4):
            blanks = " " * (SPLIT_BYTES - len(text) * part // 4)
            files[f"{name}-{part}"] = mark + blanks + text.removeprefix(mark)
    found = read(scan_json_objects(spark, folder(files), whole_file_bytes=0))
    for file in files:
        expected = CASES[file.split("-")[0]][1]
        assert [json.loads(text) for text in found.get(f"{file}.json", [])] == expected, file


def test_undecodable_bytes_end_the_file(spark, folder):
    where = folder({"x": b'{"a":1}{"b":"\xff"}{"c":1}', "y": b'{"a":1} \xff {"c":1}'})
    for limits in ({}, {"whole_file_bytes": 0}):
        assert read(scan_json_objects(spark, where, **limits)) == {"x.json": ['{"a":1}'], "y.json": ['{"a":1}']}


def test_utf16(spark, folder):
    where = folder({"x": '{"a":"é"}[{"b":1}]'.encode("utf-16")})
    assert read(scan_json_objects(spark, where)) == {"x.json": ['{"a":"é"}', '{"b":1}']}


def random_value(rng, depth):
    kind = rng.randrange(6 if depth else 4)
    if kind == 0:
        return rng.choice(["", "}{", '"', "\\", "é]", "x[", "}"])
    if kind == 1:
        return rng.choice([0, -1, 2.5, True, None])
    if kind in (2, 3):
        return rng.randrange(100)
    if kind == 4:
        return [random_value(rng, depth - 1) for _ in range(rng.randrange(3))]
    return {str(i): random_value(rng, depth - 1) for i in range(rng.randrange(3))}


def random_text(rng, damaged):
    parts = []
    for _ in range(rng.randrange(5, 60)):
        value = random_value(rng, 4)
        parts.append(json.dumps(value, indent=rng.choice([None, None, 1]), ensure_ascii=False))
        parts.append(rng.choice([" ", "\n", "", " \n"]) if isinstance(value, dict | list) else " ")
    wide = {"wide": [random_value(rng, 3) for _ in range(rng.choice([1, 400]))]}
    parts.insert(rng.randrange(len(parts) // 2) * 2, json.dumps(wide))
    text = "".join(parts)
    if damaged:
        at = rng.randrange(len(text) // 3, len(text) + 1)
        text = text[:at] + rng.choice(["}", "{", '"', "]", ",", "\\", "x", "\x01"]) + text[at + rng.randrange(2) :]
    return text


@pytest.mark.parametrize(("seed", "broadcast"), [(1, True), (2, True), (3, False)])
def test_split_files_give_what_whole_files_give(spark, small_splits, folder, monkeypatch, seed, broadcast):
    rng = random.Random(seed)
    where = folder({f"f{i}": random_text(rng, damaged=i % 2 == 0) for i in range(24)})
    whole = read(scan_json_objects(spark, where))
    assert sum(map(len, whole.values())) > 100
    if not broadcast:
        monkeypatch.setattr("sluice.sources.json_objects.BROADCAST_SPLITS", 0)
    assert read(scan_json_objects(spark, where, whole_file_bytes=0)) == whole


def nested_text(rng):
    def value(depth):
        if depth == 0 or rng.random() < 0.3:
            return rng.choice([rng.randrange(10**6), "x" * rng.randrange(60), 'a "quoted" } { [ text', None, True])
        if rng.random() < 0.5:
            return [value(depth - 1) for _ in range(rng.randrange(4))]
        return {f"k{i}": value(depth - 1) for i in range(rng.randrange(5))}

    return "\n".join(json.dumps({"n": i, "v": value(4)}) for i in range(60))


@pytest.mark.parametrize("damage", ["stray }", "missing quote", "missing brace", "stray ]", "token"])
def test_damaged_split_files_keep_what_comes_before(spark, small_splits, folder, damage):
    rng = random.Random(damage)
    texts = {}
    for i in range(12):
        text = nested_text(rng)
        for _ in range(rng.randrange(1, 4)):
            at = rng.randrange(len(text))
            if damage == "missing quote":
                at = text.find('"', at)
                text = text[:at] + text[at + 1 :] if at >= 0 else text
            elif damage == "missing brace":
                at = text.find("}", at)
                text = text[:at] + text[at + 1 :] if at >= 0 else text
            else:
                text = text[:at] + {"stray }": "}", "stray ]": "]", "token": " nope "}[damage] + text[at:]
        texts[f"f{i}"] = text
    where = folder(texts)
    assert read(scan_json_objects(spark, where, whole_file_bytes=0)) == read(scan_json_objects(spark, where))


def test_only_large_files_are_split(spark, small_splits, folder):
    where = folder({"small": '{"a":1}', "large": '{"a":2}\n' * 500})
    found = read(scan_json_objects(spark, where, whole_file_bytes=1000))
    assert found == {"small.json": ['{"a":1}'], "large.json": ['{"a":2}'] * 500}


def test_the_session_keeps_its_settings(spark, small_splits, folder):
    before = dict(spark.conf.getAll)
    assert scan_json_objects(spark, folder({"large": '{"a":2}\n' * 500}), whole_file_bytes=0).count() == 500
    assert dict(spark.conf.getAll) == before


ENCODINGS = ["utf-8-sig", "utf-16", "utf-16-le", "utf-16-be", "utf-32", "utf-32-le", "utf-32-be"]


@pytest.mark.parametrize("seed", [11, 12])
def test_encodings_of_split_files(spark, small_splits, folder, seed):
    rng = random.Random(seed)
    texts = {f"{name}-{i}": random_text(rng, damaged=i == 1) for name in ENCODINGS for i in range(2)}
    # Characters of every width, at all borders.
    texts |= {f"{name}-wide": "".join(f'{{"{i}":"é漢😀{"😀" * (i % 7)}}}"}}' for i in range(200)) for name in ENCODINGS}
    for name, text in texts.items():
        codec = name.rsplit("-", 1)[0]
        # Detection looks at the zeros of the first two characters.
        text = text if ord(text[0]) < 128 and ord(text[1]) < 128 else "  " + text
        texts[name] = text.encode(codec, "surrogatepass")
    where = folder(texts)
    whole = read(scan_json_objects(spark, where))
    assert len(whole) >= len(texts) - 3 and all(len(whole[f"{name}-wide.json"]) == 200 for name in ENCODINGS)
    assert read(scan_json_objects(spark, where, whole_file_bytes=0)) == whole


def test_numbers_have_no_gaps_in_split_files(spark, small_splits, folder):
    text = "".join(f'{{"a":{i}}}{" " * (i % 50)}' for i in range(900))
    where = folder({"one": text, "two": text[:5000] + "!" + text[5000:], "three": '{"a":[' + text[:-1].replace("}{", "},{") + "]}" + text})
    for limits in ({}, {"whole_file_bytes": 0}):
        found = {}
        for row in scan_json_objects(spark, where, **limits).collect():
            found.setdefault(row.path[-8:], []).append(row.seq)
        assert all(sorted(seqs) == list(range(len(seqs))) for seqs in found.values())
        assert sorted(map(len, found.values()))[-1] == 900


def test_texts_without_closing_braces(spark, small_splits, folder):
    long = "x" * 5000
    texts = {
        "numbers": "[" + ",".join(map(str, range(3000))) + ',{"a":1}]{"b":2}',
        "string": f'"{long}" {{"a":"{long}"}} {{"b":2}}',
        "open": f'{{"a":1}}{{"b":"{long}',
        "escapes": '{"a":1}{"b":"' + "\\\\" * 2000 + '"}{"c":"' + '\\"' * 2000 + '"}{"d":1}',
        "words": "[" + "true," * 1000 + 'nul,{"a":1}]',
        "array": '{"a":1}[' + "[" * 900 + "]" * 900 + ',{"b":1}]',
    }
    where = folder(texts)
    whole = read(scan_json_objects(spark, where))
    assert [len(whole.get(f"{name}.json", [])) for name in texts] == [2, 2, 1, 4, 0, 2]
    assert read(scan_json_objects(spark, where, whole_file_bytes=0)) == whole


def test_wrong_assumptions_are_read_again(spark, small_splits, folder, monkeypatch):
    """Strings full of JSON, and objects within one large object, mislead the tasks that begin in them."""
    inner = json.dumps("".join(f'{{"a":"{i}"}}' for i in range(300)))
    nested = '{"all":[' + ",".join(f'{{"a":{{"n":{i}}}}}' for i in range(300)) + "]}"
    where = folder({"string": f'{{"s":{inner}}}{{"t":1}}', "object": nested + '{"t":1}', "lines": '[{"a":1},{"b":[]}]\n' * 200})
    again = []
    monkeypatch.setattr(json_objects.byte_ranges, "MOST_TASKS", 3)
    starts = json_objects._split_starts
    monkeypatch.setattr(json_objects, "_split_starts", lambda moves: again.append(starts(moves)) or again[-1])
    whole = read(scan_json_objects(spark, where))
    assert read(scan_json_objects(spark, where, whole_file_bytes=0)) == whole
    assert {row.path[-11:] for row in again[0].where("wrong").collect()} == {"string.json", "object.json"}


def test_files_that_vanish_are_skipped(spark, small_splits, folder, tmp_path, monkeypatch):
    where = folder({"kept": '{"a":1}' * 500, "gone": '{"b":1}' * 500, "part": '{"c":1}' * 500})
    listed = json_objects._range_bytes

    def remove(*args):
        (tmp_path / "gone.json").unlink()
        return listed(*args)

    monkeypatch.setattr(json_objects, "_range_bytes", remove)
    settled = json_objects._with_true_starts
    # As if one range of a file could not be found any more.
    lost = "not (path like '%part.json' and split = 2)"
    monkeypatch.setattr(json_objects, "_with_true_starts", lambda df, *rest: settled(df.where(lost), *rest))
    found = read(scan_json_objects(spark, where, whole_file_bytes=0))
    assert found["kept.json"] == ['{"a":1}'] * 500 and "gone.json" not in found
    assert "part.json" not in found


def test_reader_takes_a_text_in_any_pieces():
    rng = random.Random(4)
    for i in range(300):
        text = random_text(rng, damaged=i % 2 == 0)
        spans, stop = outer_objects(text)
        reader, parts, at = ObjectReader(), [], 0
        while at < len(text):
            end = at + rng.randrange(1, 60)
            while text[:end].endswith("\\"):
                end += 1
            parts += reader.feed(text[at:end], end < len(text))
            at = end
        found, held = [], None
        for part, piece in parts:
            if part == "whole":
                found.append(piece)
            elif part == "open":
                held = piece
            elif part in ("inner", "close"):
                held += piece
                if part == "close" and outer_objects(held) == ([(0, len(held))], len(held)):
                    found.append(held)
                elif part == "close" and held[0] == "{":
                    break
            else:
                break
        assert found == [text[b:e] for b, e in spans]


def test_worker_memory_does_not_follow_a_file(tmp_path):
    """A file without a closing brace for 200 MB is read within 300 MB."""
    file = tmp_path / "wide.json"
    with file.open("w") as out:
        out.write('{"a":1}{"b":"')
        for _ in range(200):
            out.write("0123456789abcdef" * (1 << 16))
        out.write('"}{"c":1}')
    script = (
        "import resource, sys\n"
        "from sluice.sources.byte_ranges import LargeFile, rows_of_range\n"
        "file = LargeFile(*[sys.argv[1]] * 2, int(sys.argv[2]), 'utf-8', 0)\n"
        "found = [(row[4], len(row[5] or '')) for i in range(file.ranges(16 << 20)) for row in rows_of_range(file, i, 16 << 20)]\n"
        "print([part for part, _ in found if part not in ('inner', 'moves')], sum(n for _, n in found))\n"
        "print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss)\n"
    )
    run = subprocess.run(
        [sys.executable, "-c", script, str(file), str(file.stat().st_size)],
        capture_output=True, text=True, env={**os.environ, "PYTHONPATH": os.getcwd()}, check=True,
    )
    parts, memory = run.stdout.strip().split("\n")[-2:]
    assert parts == f"['whole', 'open', 'close', 'whole'] {file.stat().st_size}"
    assert int(memory) < 300 * 1024


def test_text_helpers():
    assert outer_objects("[1, 2") == ([], 5)
    assert outer_objects(', {"a":1}]', arrays=1, after_value=True) == ([(2, 9)], 10)
    assert file_text(b"ab\xffcd") == ("ab", True)
