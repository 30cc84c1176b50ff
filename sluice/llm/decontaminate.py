"""Benchmark decontamination by Wu-Manber search over words.

Patterns are the benchmark's windows of words. Windows of one length form a matcher: a shift
table over blocks of two words tells how far the search may jump, a bucket per suffix block
names the windows that may end here, and comparing their words confirms them. Items with
fewer words than a window are windows of their own length, each length with its own matcher.

The benchmark is small by nature, but not assumed so: its windows are counted and dealt into
slices of about ``slice_windows``. Each slice is broadcast and is a pass over the documents.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.rows import map_rows, staged, utf8

WINDOW = 13
SLICE_WINDOWS = 200_000

# Every byte that ends a word becomes a space; A-Z are lower-cased before.
_WORD_BYTES = bytes(
    b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def words(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z only) runs of ASCII letters, digits and all characters beyond ASCII."""
    return utf8(text).lower().translate(_WORD_BYTES).split()


def windows(item_words: Sequence[bytes], size: int = WINDOW) -> list[tuple[bytes, ...]]:
    """All runs of ``size`` words; a shorter item is one window, an item without words none."""
    if not item_words:
        return []
    if len(item_words) <= size:
        return [tuple(item_words)]
    return [tuple(item_words[i : i + size]) for i in range(len(item_words) - size + 1)]


class WuManber:
    """Finds all occurrences of word sequences of one length ``m``."""

    def __init__(self, patterns: dict[tuple[bytes, ...], list[str]]):
        self.length = m = len(next(iter(patterns)))
        self.block = min(2, m)
        self.default = m - self.block + 1
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.buckets: dict[tuple[bytes, ...], list[tuple[tuple[bytes, ...], list[str]]]] = defaultdict(list)
        for pattern, items in patterns.items():
            for end in range(self.block, m + 1):
                block = pattern[end - self.block : end]
                self.shift[block] = min(self.shift.get(block, self.default), m - end)
            self.buckets[pattern[m - self.block :]].append((pattern, items))

    def search(self, text: Sequence[bytes]) -> Iterator[tuple[int, list[str]]]:
        """Start of each occurrence, with the items that have the window."""
        m, size, default = self.length, self.block, self.default
        shift, buckets = self.shift.get, self.buckets
        end, total = m, len(text)
        while end <= total:
            block = tuple(text[end - size : end])
            jump = shift(block, default)
            if jump:
                end += jump
                continue
            found = tuple(text[end - m : end])
            for pattern, items in buckets[block]:
                if pattern == found:
                    yield end - m, items
            end += 1


def matchers(patterns: Sequence[tuple[str, Sequence[bytes]]]) -> list[WuManber]:
    """One matcher per window length, from pairs of an item and a window."""
    by_length: dict[int, dict[tuple[bytes, ...], list[str]]] = defaultdict(lambda: defaultdict(list))
    for item, window in patterns:
        holders = by_length[len(window)][tuple(window)]
        if item not in holders:
            holders.append(item)
    return [WuManber(found) for _, found in sorted(by_length.items())]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching spans as one, in order."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _slices(benchmark: DataFrame, item_id: str, text: str, window: int, slice_windows: int) -> list[DataFrame]:
    """The distinct (item, window) pairs, in slices small enough to be broadcast."""

    def cut(rows):
        for item, body in rows:
            for run in set(windows(words(body), window)):
                yield item, b" ".join(run)

    items = benchmark.select(F.col(item_id).cast("string"), F.col(text).cast("string"))
    pairs = map_rows(items, cut, "item string, run binary").distinct()
    count = pairs.count()
    number = -(-count // slice_windows)
    part = F.pmod(F.xxhash64("item", "run"), F.lit(max(1, number)))
    return [pairs.where(part == i) for i in range(number)]


def hits(
    documents: DataFrame,
    benchmark: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    slice_windows: int = SLICE_WINDOWS,
) -> DataFrame:
    """The columns of ``documents``, then ``n_words``, ``spans`` of hit words (start, end) and sorted ``items``.

    A null or wordless text has no words and no hits. An item without words or with a null text
    never occurs; one with a null id occurs without being named. Repeated documents are answered
    row by row, repeated items count once. An empty benchmark gives no hits, an empty table no
    rows. Columns of ``documents`` with the names of the new ones are replaced.
    """
    spark = documents.sparkSession
    new = ("n_words", "spans", "items")
    source = documents.drop(*new)
    names = source.columns
    at = names.index(text)
    fields = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in source.schema)
    schema = f"{fields}, n_words bigint, spans array<struct<start:int,end:int>>, items array<string>"

    def scan(table, first: bool):
        def work(rows):
            found = matchers([(item, run.split(b" ")) for item, run in table.value]) if table else []
            for row in rows:
                row, before = (row, None) if first else (row[:-3], row[-3:])
                text_words = words(row[at])
                spans = [] if first else [(span["start"], span["end"]) for span in before[1]]
                items = set() if first else set(before[2])
                for matcher in found:
                    for start, holders in matcher.search(text_words):
                        spans.append((start, start + matcher.length))
                        items.update(item for item in holders if item is not None)
                yield (*row, len(text_words), merged(spans), sorted(items))

        return work

    result = None
    for part in _slices(benchmark, item_id, item_text, window, slice_windows):
        table = spark.sparkContext.broadcast([(row[0], bytes(row[1])) for row in part.toLocalIterator()])
        # One slice at a time: what a pass found goes on with its documents to the next.
        result = map_rows(source if result is None else staged(result, "hits"), scan(table, result is None), schema)
    return map_rows(source, scan(None, True), schema) if result is None else result


def n_hit() -> Column:
    """Words of a document inside any occurrence, from the ``spans`` of ``hits``."""
    return F.aggregate("spans", F.lit(0).cast("bigint"), lambda total, span: total + span["end"] - span["start"])


def contaminated() -> Column:
    """A document with hits is contaminated if a twentieth of its words, or more, is hit."""
    return (n_hit() > 0) & (20 * n_hit() >= F.col("n_words"))


def report(found: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The digest columns of ``hits``: hit words, items and the contamination rule."""
    return found.select(
        F.col(doc_id).alias("doc_id"),
        "n_words",
        n_hit().alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )
