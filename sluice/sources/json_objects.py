"""Scan of free-form JSON: every outermost object of a file is a record.

Objects may be pretty-printed, follow each other on one line, or sit in top-level arrays;
the first error ends the file and keeps what came before it. ``spark.read.json`` knows only
one record per line, or one document per file, so the objects are found in Python:

* files up to ``whole_file_bytes`` are decoded one by one, straight from ``binaryFile``;
* larger files are read by byte ranges, each by its own task, see :mod:`~sluice.sources.byte_ranges`.
  Running sums over one small row per range tell how each range begins; those that were read under a wrong
  assumption are read again. Only the objects that cross a border are put together by a shuffle.

Both give the same rows for a file, whatever its size and encoding.
"""

from __future__ import annotations

import logging
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.functions.json_text import CLOSE, ERROR, INNER, OPEN, WHOLE, file_text, outer_objects
from sluice.session import scratch_path
from sluice.sources import byte_ranges
from sluice.sources.byte_ranges import MOVES, RANGE_BYTES, LargeFile, Start
from sluice.sources.paths import FILE_PATH, matching, split_paths

_log = logging.getLogger(__name__)

WHOLE_FILE_BYTES = 64 * 1024 * 1024
BROADCAST_SPLITS = 200_000

RECORD_SCHEMA = "path string, seq bigint, json string"

_ROWS_PER_BATCH = 10_000
_CHARS_PER_BATCH = 16 * 1024 * 1024


def scan_json_objects(
    spark: SparkSession,
    paths: str | list[str],
    *,
    path_filters: list[str] | None = None,
    whole_file_bytes: int = WHOLE_FILE_BYTES,
    **options: str,
) -> DataFrame:
    """The outermost JSON objects of ``paths`` as ``(path, seq, json)``.

    ``json`` is the object's own text, ``path`` the URL-encoded path. ``seq`` counts the objects of one file
    from 0 without gaps. Files are UTF-8, UTF-16 or UTF-32, told by their first bytes. Files above
    ``whole_file_bytes`` are decoded when this is called, into a table in the scratch folder.
    """
    options = {"ignoreMissingFiles": "true", **options}
    paths = split_paths(paths)
    files = spark.read.format("binaryFile").options(**options).load(paths)
    return objects_of(files, matching(path_filters), whole_file_bytes)


def objects_of(files: DataFrame, wanted: Column, whole_file_bytes: int) -> DataFrame:
    """As :func:`scan_json_objects`, for the ``wanted`` ones of the listed ``files``."""

    def whole(some: Column) -> DataFrame:
        found = files.where(some).select(F.col(FILE_PATH).alias("path"), "content")
        return found.mapInArrow(_decode_files, RECORD_SCHEMA)

    total = F.sum(F.when(F.col("length") > whole_file_bytes, F.col("length"))).alias("total")
    sizes = files.where(wanted).agg(F.max(F.struct("length", "path")).alias("largest"), total).first()
    largest = sizes.largest
    if largest is None or largest.length <= whole_file_bytes:
        return whole(wanted)
    if not byte_ranges.reachable(largest.path):
        _log.warning("files of %s cannot be read in parts: each is decoded whole", largest.path)
        return whole(wanted)
    large = files.where(wanted & (F.col("length") > whole_file_bytes))
    listed = large.select(F.col(FILE_PATH).alias("path"), F.col("path").alias("name"), F.col("length").alias("size"))
    return whole(wanted & (F.col("length") <= whole_file_bytes)).unionByName(_scan_large(listed, sizes.total))


def _batches(rows: Iterable[tuple], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Record batches of bounded size; the last value of a row is its text or null."""

    def batch(held):
        *columns, texts = zip(*held, strict=True)
        return pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(texts, pa.string())], names)

    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += len(row[-1] or "")
        if len(held) >= _ROWS_PER_BATCH or chars >= _CHARS_PER_BATCH:
            yield batch(held)
            held, chars = [], 0
    if held:
        yield batch(held)


def _decode_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                text, _ = file_text(content.as_py())
                spans, _ = outer_objects(text)
                for seq, (begin, end) in enumerate(spans):
                    yield path.as_py(), seq, text[begin:end]

    return _batches(rows(), ["path", "seq", "json"])


# --- files of more than one range ---------------------------------------------------------

_FILE = "path string, name string, size bigint, codec string, mark int"
_HEAD_BYTES = 4


def _with_encodings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The encoding of each listed file, from its first bytes; files that are gone are left out."""
    for batch in batches:
        rows = []
        for path, name, size in zip(*(batch[n].to_pylist() for n in ("path", "name", "size")), strict=True):
            try:
                system, where = byte_ranges.filesystem(name)
                with system.open_input_file(where) as source:
                    head = source.read(_HEAD_BYTES)
            except FileNotFoundError:
                continue
            rows.append((path, name, size, *byte_ranges.encoding_of(head)))
        names = ["path", "name", "size", "codec", "mark"]
        types = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.int32()]
        columns = list(zip(*rows, strict=True)) or [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def _scan_large(listed: DataFrame, total: int) -> DataFrame:
    spark = listed.sparkSession
    listing = scratch_path(spark, "json-files")
    listed.mapInArrow(_with_encodings, _FILE).write.parquet(listing)
    length = _range_bytes(spark, total)
    spark.dataSource.register(byte_ranges.ByteRanges)
    ranges = spark.read.format(byte_ranges.FORMAT).option("listing", listing).option("range_bytes", length)
    decoded = _with_true_starts(_written(ranges.load(), "json-ranges"), listing, length)
    pieces = decoded.where(F.col("part") != MOVES).withColumn("place", F.shiftleft("split", 32) + F.col("item"))
    joined = _join_fragments(pieces.where(F.col("part").isin(OPEN, INNER, CLOSE)))
    found = pieces.select("path", "split", "nth", "place", "part", "json").where(F.col("part").isin(WHOLE, ERROR))
    return _numbered(found.unionByName(_written(joined, "json-joined")))


def _written(df: DataFrame, label: str) -> DataFrame:
    where = scratch_path(df.sparkSession, label)
    df.write.parquet(where)
    return df.sparkSession.read.schema(df.schema).parquet(where)


def _range_bytes(spark: SparkSession, total: int) -> int:
    """Ranges that give every core one, but no more than ``RANGE_BYTES`` and what the session asks for."""
    asked = int(spark.sql("SET spark.sql.files.maxPartitionBytes").first().value.removesuffix("b"))
    share = max(total // spark.sparkContext.defaultParallelism, byte_ranges.TASK_BYTES)
    # In whole characters of any encoding.
    return max(min(RANGE_BYTES, asked, share) // 4 * 4, 4)


def _numbered(found: DataFrame) -> DataFrame:
    """The objects before the first error of their file, their places as numbers without gaps: those of a range's
    objects are its own count and the counts of the ranges before."""
    error = F.col("part") == ERROR
    # An error is the last that a range gives, so as many objects stand before it as its own number says.
    counts = found.groupBy("path", "split").agg(
        F.coalesce(F.min(F.when(error, F.col("nth"))), F.count(F.when(~error, 1))).alias("objects"),
        F.max(error).alias("ends"),
    )
    before = Window.partitionBy("path").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    bounds = counts.select(
        "path",
        "split",
        "objects",
        F.coalesce(F.sum("objects").over(before), F.lit(0)).alias("offset"),
        F.coalesce(F.max("ends").over(before), F.lit(False)).alias("ended"),
    )
    bounds = _written(bounds, "json-counts")
    small = bounds.count() <= BROADCAST_SPLITS
    placed = found.where(~error).join(F.broadcast(bounds) if small else bounds, ["path", "split"])
    kept = placed.where(~F.col("ended") & (F.col("nth") < F.col("objects")))
    return kept.select("path", (F.col("offset") + F.col("nth")).alias("seq"), "json")


_SUMS = ["flips", "braces_out", "arrays_out", "braces_in", "arrays_in"]
_TOLD = ["took_string", "took_braces", "took_arrays", "took_least", "ranges"]


def _split_starts(moves: DataFrame) -> DataFrame:
    """How each range's stretch begins: inside a string or not, how deep in objects and arrays; and whether that is
    what it was read as. A file of which ranges are missing has vanished meanwhile."""
    named = moves.select("path", "split", *[F.col("moves")[i].alias(n) for i, n in enumerate([*_SUMS, *_TOLD])])
    file = Window.partitionBy("path")
    before = file.orderBy("split").rowsBetween(Window.unboundedPreceding, -1)

    def so_far(amount):
        return F.coalesce(F.sum(amount).over(before), F.lit(0))

    def when_begun(outside, inside):
        return F.when(F.col("in_string") == 0, F.col(outside)).otherwise(F.col(inside))

    enough = F.when(F.col("took_least") >= 0, F.col("arrays") >= F.col("took_least"))
    same = (
        (F.col("in_string") == F.col("took_string"))
        & (F.col("braces") == F.col("took_braces"))
        & F.coalesce(enough, F.col("arrays") == F.col("took_arrays"))
    )
    return (
        named.withColumn("in_string", so_far(F.col("flips")) % 2)
        .withColumn("braces", so_far(when_begun("braces_out", "braces_in")))
        .withColumn("arrays", so_far(when_begun("arrays_out", "arrays_in")))
        .withColumn("gone", F.count(F.lit(1)).over(file) < F.col("ranges"))
        # A range without a stretch has assumed nothing.
        .withColumn("wrong", (F.col("took_least") != -2) & ~same)
        .select("path", "split", "in_string", "braces", "arrays", "gone", "wrong")
    )


def _with_true_starts(decoded: DataFrame, listing: str, length: int) -> DataFrame:
    """Ranges that were read under a wrong assumption are replaced by what they give from their true beginning."""
    off = _split_starts(decoded.where(F.col("part") == MOVES)).where("gone or wrong")
    if off.isEmpty():
        return decoded
    off = _written(off, "json-starts")
    count = off.count()
    keys = off.select("path", "split")
    # Nesting that an error has thrown off has no beginning; the file ends before it.
    again = off.where("wrong and not gone").withColumn("braces", F.greatest("braces", F.lit(0)))
    again = again.withColumn("arrays", F.greatest("arrays", F.lit(0))).join(decoded.sparkSession.read.parquet(listing), "path")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                file = LargeFile(*(row[name] for name in ("path", "name", "size", "codec", "mark")))
                start = Start(row["in_string"] == 1, row["braces"], row["arrays"])
                yield from byte_ranges.batches(byte_ranges.rows_of_range(file, row["split"], length, start))

    tasks = min(count, byte_ranges.MOST_TASKS)
    again = again.repartition(tasks, "path", "split").mapInArrow(read, byte_ranges.SCHEMA)
    rest = decoded.join(F.broadcast(keys) if count <= BROADCAST_SPLITS else keys, ["path", "split"], "left_anti")
    return rest.unionByName(_written(again, "json-again"))


def _join_fragments(fragments: DataFrame) -> DataFrame:
    """Objects that cross split borders, put together and read; at the place they begin."""
    in_file = Window.partitionBy("path").orderBy("place")
    opening = F.when(F.col("part") == OPEN, F.struct("place", "split", "nth"))
    began = F.last(opening, ignorenulls=True).over(in_file)
    # The running place needs only the fragments' places, so their texts stay out of it.
    places = fragments.select("path", "place", "split", "nth", "part").withColumn("at", began)
    places = places.select("path", "place", "part", F.col("at.place").alias("began"), "at")
    # An object ends at its first closing fragment. What follows up to the next beginning comes
    # of an error in between, and belongs to nothing.
    in_run = Window.partitionBy("path", "began").orderBy("place")
    closes = (F.col("part") == CLOSE).cast("int")
    closed_before = F.coalesce(F.sum(closes).over(in_run.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    places = places.where("began is not null").withColumn("closed", closed_before).where("closed = 0")
    # An object that never ends is the file's error where it begins; its texts are not gathered.
    ends = F.max(closes).over(Window.partitionBy("path", "began")) == 1
    places = places.withColumn("ends", ends).drop("part", "closed")
    endless = places.where(~F.col("ends")).select("path", "at").distinct()
    endless = endless.select(
        "path", "at.split", "at.nth", "at.place", F.lit(ERROR).alias("part"), F.lit(None).cast("string").alias("json")
    )
    places = places.where("ends").drop("ends")
    ordered = F.array_sort(F.collect_list(F.struct("place", "json")))
    whole = F.array_join(F.transform(ordered, lambda fragment: fragment["json"]), "")
    joined = (
        fragments.select("path", "place", "json")
        .join(places, ["path", "place"])
        .groupBy("path", "at")
        .agg(whole.alias("json"))
        .select("path", "at.split", "at.nth", "at.place", "json")
        .mapInArrow(_read_joined, "path string, split bigint, nth bigint, place bigint, part string, json string")
    )
    return joined.unionByName(endless)


def _read_joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for batch in batches:
            for *at, text in zip(*(batch[n].to_pylist() for n in ("path", "split", "nth", "place", "json")), strict=True):
                spans, stop = outer_objects(text)
                if stop < len(text):
                    yield *at, ERROR, None
                elif spans:
                    yield *at, WHOLE, text

    return _batches(rows(), ["path", "split", "nth", "place", "part", "json"])
