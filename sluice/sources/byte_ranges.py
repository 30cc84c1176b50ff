"""A data source that reads the JSON objects of large files by byte ranges.

Every file is divided into ranges of the same number of bytes. What a range answers for is its stretch: the
text from behind the first ``}`` in it to behind the first ``}`` of a later range, so a stretch never begins
within a number, a word or an escape sequence. A range without a ``}`` has no stretch. Reading on to
the end of a stretch goes piece by piece, so a task holds a range and a piece, whatever a file holds.

How deep in strings, objects and arrays a stretch begins is known only when all those before it have been read.
A task therefore reads its stretch as if it began where its own nesting makes most sense, and says what
it assumed along with the sums of what the stretch does to the nesting. Once the sums of all are known, the few
stretches that were read under a wrong assumption are read again.
"""

from __future__ import annotations

import codecs
import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from sluice.functions.json_text import ERROR, INNER, OPEN, WHOLE, ObjectReader

FORMAT = "json_byte_ranges"
RANGE_BYTES = 16 << 20
# A task reads ranges one after the other up to so many bytes, or more if there would be more tasks than this.
TASK_BYTES, MOST_TASKS = 1 << 20, 20_000
MOVES = "moves"
SCHEMA = "path string, split bigint, item bigint, nth bigint, part string, json string, moves array<bigint>"

_AHEAD = 64 << 10
_PIECE = 4 << 20
_STEP = 1 << 20
_ROWS, _CHARS = 10_000, 8 << 20
_QUOTE = ord('"')
# More arrays than any text opens: reading on from an unknown depth.
_ANY = 1 << 40
_SCHEMES = {"file": "file", "hdfs": "hdfs", "s3": "s3", "s3a": "s3", "gs": "gs", "gcs": "gs", "abfs": "abfs", "abfss": "abfss"}


def reachable(name: str) -> bool:
    """Whether tasks can read parts of this file themselves; only Spark's own scans read what other stores hold."""
    return "://" not in name or name.partition("://")[0] in _SCHEMES


def filesystem(name: str) -> tuple[pafs.FileSystem, str]:
    scheme, _, rest = name.partition(":/")
    if scheme in ("", "file") or not rest:
        return pafs.LocalFileSystem(), "/" + (rest if rest else name).lstrip("/")
    return pafs.FileSystem.from_uri(f"{_SCHEMES[scheme]}:/{rest}")


# Encodings


def encoding_of(head: bytes) -> tuple[str, int]:
    """The codec of a JSON file that begins with these bytes, without its mark, and the bytes of the mark."""
    name = json.detect_encoding(head.removeprefix(codecs.BOM_UTF8))
    if name.startswith("utf-8"):
        return "utf-8", len(codecs.BOM_UTF8) * head.startswith(codecs.BOM_UTF8)
    for order, mark16, mark32 in (("le", codecs.BOM_UTF16_LE, codecs.BOM_UTF32_LE), ("be", codecs.BOM_UTF16_BE, codecs.BOM_UTF32_BE)):
        if name == "utf-32" and head.startswith(mark32):
            return f"utf-32-{order}", len(mark32)
        if name == "utf-16" and head.startswith(mark16):
            return f"utf-16-{order}", len(mark16)
    return name, 0


def _units(codec: str) -> np.dtype:
    return np.dtype({"utf-8": "u1", "utf-16-le": "<u2", "utf-16-be": ">u2", "utf-32-le": "<u4", "utf-32-be": ">u4"}[codec])


def _behind_brace(data: bytes, codec: str) -> int:
    """Bytes up to and with the first closing brace; 0 if there is none."""
    if codec == "utf-8":
        return data.find(b"}") + 1
    units = _units(codec)
    found = np.flatnonzero(np.frombuffer(data[: len(data) // units.itemsize * units.itemsize], units) == ord("}"))
    return (int(found[0]) + 1) * units.itemsize if len(found) else 0


# A range's stretch


@dataclass(frozen=True)
class LargeFile:
    path: str
    name: str
    size: int
    codec: str
    mark: int

    def ranges(self, length: int) -> int:
        return -(-self.size // length)


def _bytes_of(file: LargeFile, source: pa.NativeFile, split: int, length: int) -> Iterator[tuple[bytes, bool]]:
    """The bytes of the stretch of range ``split`` in pieces, each with whether more follow; nothing if it has none."""

    def read(at: int, most: int) -> bytes:
        source.seek(at)
        return source.read(min(most, file.size - at))

    at = split * length
    data = read(at, length)
    begin = file.mark if split == 0 else _behind_brace(data, file.codec)
    if split and not begin:
        return
    data, at = data[begin:], at + len(data)
    # The end is most often near: one piece then.
    step = _AHEAD
    while at < file.size:
        ahead = read(at, step)
        if not ahead:
            raise OSError(f"{file.name} became shorter while it was read")
        end = _behind_brace(ahead, file.codec)
        if end:
            yield data + ahead[:end], False
            return
        yield data, True
        data, at, step = ahead, at + len(ahead), _PIECE
    yield data, False


def _texts(pieces: Iterable[tuple[bytes, bool]], codec: str) -> Iterator[tuple[str, bool, bool]]:
    """(text, more follows, undecodable bytes follow) of pieces; no text ends within a character or escape sequence."""
    decoder = codecs.getincrementaldecoder(codec)()
    held = ""
    for data, more in pieces:
        try:
            text = held + decoder.decode(data, not more)
        except UnicodeDecodeError as bad:
            yield held + bad.object[: bad.start].decode(codec, "ignore"), False, True
            return
        kept = len(text.rstrip("\\")) if more else len(text)
        text, held = text[:kept], text[kept:]
        yield text, more, False


def _steps(up: str, down: str) -> np.ndarray:
    depth = np.zeros(256, np.int8)
    depth[ord(up)], depth[ord(down)] = 1, -1
    return depth


_DEPTHS = _steps("{", "}"), _steps("[", "]")


class Moves:
    """What a stretch does to the nesting, for both ways in which it can begin: outside of a string and inside."""

    def __init__(self):
        self.quotes = 0
        self.change = [[0, 0], [0, 0]]  # by way: braces, arrays
        self.least = [0, 0]  # by way: the lowest that braces came to

    def add(self, text: str) -> None:
        data = text.encode("utf-8", "surrogatepass").replace(b"\\\\", b"").replace(b'\\"', b"")
        for at in range(0, len(data), _STEP):
            marks = np.frombuffer(data, np.uint8, min(_STEP, len(data) - at), at)
            quoted = (np.cumsum(marks == _QUOTE, dtype=np.uint8) + np.uint8(self.quotes & 1)) & 1
            for which, depth in enumerate(_DEPTHS):
                change = depth[marks]
                for way in (0, 1):
                    here = change * (quoted == way)
                    if which == 0:
                        low = self.change[way][0] + int(np.cumsum(here, dtype=np.int32).min())
                        self.least[way] = min(self.least[way], low)
                    self.change[way][which] += int(np.sum(here, dtype=np.int64))
            self.quotes += int(np.count_nonzero(marks == _QUOTE))

    def sums(self) -> list[int]:
        return [self.quotes % 2, *self.change[0], *self.change[1]]


@dataclass
class Start:
    """How a stretch begins. ``least``: of unknown arrays around it, how many there have to be at least."""

    in_string: bool = False
    braces: int = 0
    arrays: int = 0
    least: int = -1

    def reader(self, split: int) -> ObjectReader:
        return ObjectReader(self.in_string, self.braces, self.arrays, split > 0)


def _read(start: Start, split: int, text: str, more: bool, damaged: bool) -> tuple[ObjectReader, list]:
    reader = start.reader(split)
    return reader, list(_damaged(reader, reader.feed(text, more), damaged))


def _damaged(reader: ObjectReader, parts: Iterable[tuple], damaged: bool) -> Iterator[tuple]:
    """What a text gives, and the error behind it if bytes that cannot be decoded follow."""
    for part, text in parts:
        if damaged and part in (OPEN, INNER):
            break
        yield part, text
    if damaged and not reader.failed:
        reader.failed = True
        yield ERROR, None


def _assumed(moves: Moves, split: int, text: str, more: bool, damaged: bool) -> tuple[Start, ObjectReader, list]:
    """The beginning that a stretch's first piece speaks for, and the piece read so."""

    def tried(way: int) -> tuple[Start, ObjectReader, list]:
        start = Start(way == 1, -moves.least[way], _ANY)
        reader, parts = _read(start, split, text, more, damaged)
        # A value where a comma would be due within an array: there is none here, so the depth is known.
        if parts and parts[-1][0] == ERROR and reader.at.separator_due and not damaged:
            start = Start(start.in_string, start.braces, max(_ANY - reader.at.arrays, 0))
            reader, parts = _read(start, split, text, more, damaged)
        elif reader.at.fewest is not None:
            start.least = _ANY - reader.at.fewest + 1
        return start, reader, parts

    if split == 0:
        start = Start()
        return start, *_read(start, split, text, more, damaged)
    first = tried(0)
    if not first[2] or first[2][-1][0] != ERROR:
        return first
    second = tried(1)
    return second if second[2] and second[2][-1][0] != ERROR else first


def rows_of_range(file: LargeFile, split: int, length: int, start: Start | None = None) -> Iterator[tuple]:
    """What a range gives: a row for every object and fragment of its stretch, and one with its sums and what was
    assumed. ``start`` is how the stretch begins, where that is known. A file that is gone gives nothing."""
    moves = Moves()
    reader, item, nth, assumed = None, 0, 0, Start(least=-2)
    try:
        system, where = filesystem(file.name)
        source = system.open_input_file(where)
    except FileNotFoundError:
        return
    with source:
        for text, more, damaged in _texts(_bytes_of(file, source, split, length), file.codec):
            moves.add(text)
            if reader is None and start is not None:
                assumed, (reader, parts) = start, _read(start, split, text, more, damaged)
            elif reader is None:
                assumed, reader, parts = _assumed(moves, split, text, more, damaged)
            else:
                parts = _damaged(reader, reader.feed(text, more), damaged)
            for part, found in parts:
                yield file.path, split, item, nth, part, found, None
                item, nth = item + 1, nth + (part == WHOLE)
    told = [*moves.sums(), int(assumed.in_string), assumed.braces, assumed.arrays, assumed.least, file.ranges(length)]
    yield file.path, split, item, nth, MOVES, None, told


_TYPES = pa.schema(
    [
        ("path", pa.string()),
        ("split", pa.int64()),
        ("item", pa.int64()),
        ("nth", pa.int64()),
        ("part", pa.string()),
        ("json", pa.string()),
        ("moves", pa.list_(pa.int64())),
    ]
)


def batches(rows: Iterable[tuple]) -> Iterator[pa.RecordBatch]:
    """Record batches of bounded size."""

    def batch() -> pa.RecordBatch:
        columns = zip(*held, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _TYPES, strict=True)], schema=_TYPES)

    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += len(row[5] or "")
        if len(held) >= _ROWS or chars >= _CHARS:
            yield batch()
            held, chars = [], 0
    if held:
        yield batch()


# The data source


@dataclass(frozen=True)
class Ranges(InputPartition):
    """Ranges of one task: consecutive ones of each file."""

    runs: list[tuple[LargeFile, int, int]]


class RangeReader(DataSourceReader):
    def __init__(self, listing: str, length: int):
        self.listing, self.length = listing, length

    def partitions(self) -> list[InputPartition]:
        system, where = filesystem(self.listing)
        files = [LargeFile(**row) for row in pq.read_table(where, filesystem=system).to_pylist()]
        total = sum(file.ranges(self.length) for file in files)
        each = max(TASK_BYTES // self.length, -(-total // MOST_TASKS), 1)
        tasks: list[list[tuple[LargeFile, int, int]]] = [[]]
        room = each
        for file in files:
            first, end = 0, file.ranges(self.length)
            while first < end:
                if not room:
                    tasks.append([])
                    room = each
                count = min(room, end - first)
                tasks[-1].append((file, first, count))
                first, room = first + count, room - count
        return [Ranges(runs) for runs in tasks]

    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        for file, first, count in partition.runs:
            for split in range(first, first + count):
                yield from batches(rows_of_range(file, split, self.length))


class ByteRanges(DataSource):
    """``spark.read.format("json_byte_ranges")`` with the options ``listing``, a written table of
    ``path, name, size, codec, mark``, and ``range_bytes``, a multiple of 4."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return RangeReader(self.options["listing"], int(self.options.get("range_bytes", RANGE_BYTES)))
