"""Near-duplicates by n-gram Jaccard similarity: a T-occurrence search over inverted lists.

Two sets are linked when their intersection is at least the threshold's share of their union. If
so they share at least T shingles, T from their sizes, and T of the query's lists hold the other.

1. Every text becomes its set of shingle hashes; equal sets are one class from here on.
2. All sets count their shingles in a table of 2^20 cells. The counts order the shingles, rare
   cells first: any fixed order is right, a good one is fast.
3. A set of n posts its first n - T + 1 shingles. Linked sets share a posting, which is among the
   first of the smaller set's, where T is that of two sets of its size. The sets of all lists of
   postings that have the same least class are a block; a set is in it once, so a group of near
   copies is not written as the pairs that each of their lists makes. In a block sets are compared by
   the histograms of their hashes, which bound their difference from below and rule out nearly all
   that merely share a passage, and a forest of edges connects those that may link. A very long list is
   sorted by size and broken where sizes cannot link. Either way no link leaves the groups that
   the edges make. Sets alone in their groups are done; most are.
4. A group's texts meet in a task, which builds inverted lists of their sets and searches them with
   DivideSkip: the longest lists are set aside, the short ones are merged with a heap that skips
   what cannot reach T, and survivors are looked up in the long ones by bisection. Counts are
   exact, so a survivor is a link. A group too large for a task is cut into chunks, and each
   pair of chunks is a task.
5. For components, sets already connected are not searched against each other, and a component
   is left at its first link. So a group of k near copies costs about k searches, not k^2 pairs.
   ``links`` searches on and gives every link.
"""

from __future__ import annotations

import heapq
import zlib
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.components import components
from sluice.llm.rows import limited_broadcast, map_rows, staged, utf8

WORDS = 5
THRESHOLD = 80  # hundredths
CELL_BITS = 20
BLOCKS = 64
CHUNK_SHINGLES = 400_000
SHORT_LIST = 4096
BLOCK_SETS = 4096
_PIECE = 1 << 20
_M = 1 << 64


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


class _Powers:
    """Powers of an odd number and of its inverse, as many as the longest piece so far needed."""

    base, inverse = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, _M)
    up = down = np.ones(1, np.uint64)

    @classmethod
    def of(cls, size: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < size:
            steps = np.full(size, cls.base, np.uint64), np.full(size, cls.inverse, np.uint64)
            for step in steps:
                step[0] = 1
            cls.up, cls.down = (np.cumprod(step, dtype=np.uint64) for step in steps)
        return cls.up, cls.down


_LETTERS = np.random.default_rng(5).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def word_hashes(text: str | None) -> np.ndarray:
    """A 64-bit hash per word: runs of anything but ASCII white space, A-Z lower-cased."""
    data = utf8(text).lower()
    parts, at = [], 0
    while at < len(data):
        end = at + _PIECE
        while end < len(data) and not _SPACE[data[end]]:
            end += 1
        parts.append(_hashes(np.frombuffer(data[at:end], np.uint8)))
        at = end
    return np.concatenate(parts) if parts else np.empty(0, np.uint64)


def _hashes(data: np.ndarray) -> np.ndarray:
    border = np.ones(len(data) + 2, bool)
    border[1:-1] = _SPACE[data]
    start = np.flatnonzero(border[:-1] & ~border[1:])
    start, end = start[: len(data)], np.flatnonzero(~border[:-1] & border[1:])
    up, down = _Powers.of(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_LETTERS[data] * up[: len(data)], out=sums[1:])
    return _mixed((sums[end] - sums[start]) * down[start])


_PLACES = [np.uint64(pow(0xD6E8FEB86659FD93, i, _M)) for i in range(64)]


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """The sorted distinct hashes of the runs of ``words`` words; a shorter text is one run, an empty one none."""
    found = word_hashes(text)
    if not len(found):
        return found
    size = min(words, len(found))
    count = len(found) - size + 1
    run = found[:count] + np.uint64(size)
    for i in range(1, size):
        run = run + found[i : i + count] * _PLACES[i]
    return np.unique(_mixed(run))


def class_of(found: np.ndarray) -> int:
    """A name for a set: a signed 64-bit hash of its members."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(found.tobytes())).astype(np.int64))


def required(size: int, other: int, threshold: int = THRESHOLD) -> int:
    """The least intersection of linked sets of these sizes: 100 i >= t (a + b - i)."""
    return -(-threshold * (size + other) // (100 + threshold))


def prefix_length(size: int, threshold: int = THRESHOLD) -> int:
    """How many shingles a set posts: a linked set has at least t % of its size in common with it."""
    return size - -(-threshold * size // 100) + 1


def first_length(size: int, threshold: int = THRESHOLD) -> int:
    """How many of them can be the first that a linked set of this size or a larger one has in common with it."""
    return size - required(size, size, threshold) + 1


class _Lists:
    """The inverted lists of one component: for each shingle the ascending numbers of the sets that have it."""

    def __init__(self):
        self.lists: dict[int, list[int]] = defaultdict(list)

    def add(self, number: int, members: list[int]) -> None:
        for member in members:
            self.lists[member].append(number)

    def absorb(self, other: _Lists) -> None:
        for member, numbers in other.lists.items():
            mine = self.lists[member]
            mine.extend(numbers)
            mine.sort()

    def search(self, members: list[int], least: int, needed) -> Iterator[int]:
        """Sets that share ``needed(number)`` of the members; that is ``least`` or more for any of them.

        DivideSkip: ``long`` lists are only probed, so a set has to turn up in
        ``least - len(long)`` of the short ones. Of those, the heap's ``least - len(long) - 1``
        smallest heads cannot make a set on their own and skip to the next one that could.
        """
        get = self.lists.get
        found = sorted((numbers for numbers in map(get, members) if numbers), key=len)
        if len(found) < least:
            return
        weight = 0.02 * (len(found[-1]).bit_length() + 1)
        aside = min(least - 1, int(least / (weight * 10 + 1)))
        long, short = found[len(found) - aside :], found[: len(found) - aside]
        least_short = least - aside
        heads = [(numbers[0], i, 0) for i, numbers in enumerate(short)]
        heapq.heapify(heads)
        while len(heads) >= least_short:
            number = heads[0][0]
            popped = []
            while heads and heads[0][0] == number:
                popped.append(heapq.heappop(heads))
            if len(popped) >= least_short:
                count = len(popped)
                need = needed(number)
                for i, numbers in enumerate(long):
                    if count + len(long) - i < need:
                        break
                    at = bisect_left(numbers, number)
                    count += at < len(numbers) and numbers[at] == number
                if count >= need:
                    yield number
                target = number + 1
            else:
                while heads and len(popped) < least_short - 1:
                    popped.append(heapq.heappop(heads))
                if not heads:
                    return
                target = heads[0][0]
            for _, i, at in popped:
                numbers = short[i]
                at = bisect_left(numbers, target, at)
                if at < len(numbers):
                    heapq.heappush(heads, (numbers[at], i, at))


def linked_components(sets: list[np.ndarray], threshold: int = THRESHOLD) -> list[int]:
    """The component of each set, named by the position of one of its members.

    Sets come in one after another, the smallest first, and each is searched in the lists of every component so
    far; one link joins it. Shingles that no other set has are only counted, in the sizes.
    """
    order = sorted(range(len(sets)), key=lambda i: len(sets[i]))
    times = Counter(member for found in sets for member in found.tolist())
    size = [len(sets[i]) for i in order]
    parts: dict[int, _Lists] = {}
    holders: dict[int, list[int]] = {}
    component = [0] * len(order)
    homes: dict[int, set[int]] = defaultdict(set)
    for number, place in enumerate(order):
        members = [member for member in sets[place].tolist() if times[member] > 1]
        own = size[number]
        # Smaller sets that could link have at least t % of this one's shingles.
        least = max(1, -(-threshold * own // 100))
        reach = Counter(name for member in members for name in homes.get(member, ())) if len(members) >= least else {}
        links = []
        for name in [name for name, shared in reach.items() if shared >= least]:
            hit = next(parts[name].search(members, least, lambda other: required(own, size[other], threshold)), None)
            if hit is not None:
                links.append(name)
        if links:
            links.sort(key=lambda name: len(holders[name]))
            name = links.pop()
        else:
            name = number
            parts[name], holders[name] = _Lists(), []
        for other in links:
            gone = parts.pop(other)
            parts[name].absorb(gone)
            for member in gone.lists:
                homes[member].discard(other)
                homes[member].add(name)
            holders[name] += holders.pop(other)
        parts[name].add(number, members)
        for member in members:
            homes[member].add(name)
        holders[name].append(number)
    for name, numbers in holders.items():
        for number in numbers:
            component[order[number]] = order[numbers[0]]
    return component


def linked_pairs(sets: list[np.ndarray], threshold: int = THRESHOLD) -> Iterator[tuple[int, int]]:
    """The positions of every two sets that link, each pair once."""
    order = sorted(range(len(sets)), key=lambda i: len(sets[i]))
    times = Counter(member for found in sets for member in found.tolist())
    size = [len(sets[i]) for i in order]
    lists = _Lists()
    for number, place in enumerate(order):
        members = [member for member in sets[place].tolist() if times[member] > 1]
        own = size[number]
        least = max(1, -(-threshold * own // 100))
        for other in lists.search(members, least, lambda other: required(own, size[other], threshold)):
            yield place, order[other]
        lists.add(number, members)


def _cells(found: np.ndarray) -> np.ndarray:
    return (found >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def _histogram(found: np.ndarray) -> np.ndarray:
    """How many hashes end in each of 2^k ways, up to 255: 64 ways, or an eighth of a larger set's size."""
    ways = 1 << max(6, (len(found) // 8).bit_length())
    return np.minimum(np.bincount((found & np.uint64(ways - 1)).astype(np.int64), minlength=ways), 255).astype(np.uint8)


def may_link(size: int, other: int, histogram: bytes, others: bytes, threshold: int = THRESHOLD) -> bool:
    """False only if the sets differ in more shingles than linked sets of these sizes can."""
    a, b = (np.frombuffer(data, np.uint8).astype(np.int32) for data in (histogram, others))
    while len(a) != len(b):
        # Fewer ways are the sums of more.
        a, b = (a, b) if len(a) > len(b) else (b, a)
        a = a[: len(a) // 2] + a[len(a) // 2 :]
    return np.abs(a - b).sum() <= size + other - 2 * required(size, other, threshold)


class _Window:
    """The sets of a block that later ones, which are larger, may link: at most ``BLOCK_SETS``."""

    def __init__(self):
        self.names = np.empty(BLOCK_SETS, np.int64)
        self.sizes = np.empty(BLOCK_SETS, np.int64)
        self.parts = np.empty(BLOCK_SETS, np.int64)
        self.sums = np.empty((BLOCK_SETS, 64), np.int32)
        self.whole: list[bytes] = []
        self.low = self.high = 0

    def clear(self) -> None:
        self.whole.clear()
        self.low = self.high = 0

    def drop_below(self, size: int) -> None:
        while self.low < self.high and self.sizes[self.low] < size:
            self.low += 1
        if self.low and self.high == BLOCK_SETS:
            kept = slice(self.low, self.high)
            self.high -= self.low
            for column in (self.names, self.sizes, self.parts, self.sums):
                column[: self.high] = column[kept].copy()
            del self.whole[: self.low]
            self.low = 0

    def add(self, name: int, size: int, histogram: bytes, threshold: int) -> Iterator[tuple[int, int]]:
        """Puts a set in; edges to one set of each part that it may link, which become one part with it."""
        sums = np.frombuffer(histogram, np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int32)
        at = self.high
        self.names[at], self.sizes[at], self.parts[at], self.sums[at] = name, size, at, sums
        self.whole.append(histogram)
        self.high += 1
        if self.low == at:
            return
        both = self.sizes[self.low : at] + size
        apart = np.abs(self.sums[self.low : at] - sums).sum(axis=1)
        hits = np.flatnonzero(apart <= both - 2 * -(-threshold * both // (100 + threshold))) + self.low
        joined: set[int] = set()
        for other, part in zip(hits.tolist(), self.parts[hits].tolist(), strict=True):
            if part not in joined and may_link(int(self.sizes[other]), size, self.whole[other], histogram, threshold):
                joined.add(part)
                yield int(self.names[other]), name
        for part in joined:
            parts = self.parts[self.low : at]
            parts[parts == part] = at


def block_edges(given, threshold: int = THRESHOLD) -> Iterator[tuple[int, int]]:
    """Edges that connect, in each block, all sets that ``may_link`` says may link; from ``block, class, n, histogram`` in
    order of block and size.

    A forest: sets already connected are not compared, so there are fewer edges than sets. Where more than
    ``BLOCK_SETS`` sets of a block have sizes that fit, they are connected without being compared.
    """
    held, block, last, full = _Window(), None, None, False
    for key, name, size, histogram in given:
        if key != block:
            held.clear()
            block, last, full = key, None, False
        if full and 100 * last[1] < threshold * size:
            # No set before this one is large enough.
            held.clear()
            full = False
        if not full:
            held.drop_below(-(-threshold * size // 100))
            if held.high == BLOCK_SETS:
                names = held.names[: held.high].tolist()
                yield from zip(names, names[1:], strict=False)
                full = True
        if full:
            yield last[0], name
        else:
            yield from held.add(name, size, histogram, threshold)
        last = name, size


def _shingle_counts(documents: DataFrame, words: int) -> tuple[DataFrame, np.ndarray]:
    """``id, class, n, histogram, mark`` of every row, written, the mark a hash of its text; and the cells' counts, 2^20 numbers whatever the input."""
    width = (1 << CELL_BITS) // BLOCKS

    def work(rows):
        counts = np.zeros(1 << CELL_BITS, np.int64)
        for key, text, mark in rows:
            found = shingles(text, words)
            counts[_cells(found)] += 1
            name = class_of(found) if len(found) else None
            yield key, name, len(found), _histogram(found).tobytes(), mark, None, None, None
        # A task's counts, a byte of each at a time; only the lowest is ever full.
        for block in range(BLOCKS):
            part = counts[block * width : (block + 1) * width]
            for shift in range(0, int(part.max()).bit_length(), 8):
                digits = ((part >> shift) & 255).astype(np.uint8)
                yield None, None, None, None, None, block, shift, zlib.compress(digits.tobytes(), 1)

    schema = "id bigint, class bigint, n bigint, histogram binary, mark bigint, block int, shift int, digits binary"
    every = staged(map_rows(documents.select("id", "text", F.xxhash64("text")), work, schema), "sets")

    def add(rows):
        held: dict[int, np.ndarray] = {}
        for block, shift, digits in rows:
            total = held.setdefault(block, np.zeros(width, np.int64))
            total += np.frombuffer(zlib.decompress(digits), np.uint8).astype(np.int64) << shift
        for block, total in held.items():
            yield block, total.astype("<i8").tobytes()

    parts = every.where("block is not null").select("block", "shift", "digits")
    summed = map_rows(parts.repartition("block"), add, "block int, total binary", every=1)
    table = np.zeros(1 << CELL_BITS, np.int64)
    for block, total in summed.toLocalIterator():
        table[block * width : (block + 1) * width] += np.frombuffer(total, "<i8")
    return every.where("block is null").select("id", "class", "n", "histogram", "mark"), table


def _candidate_groups(
    documents: DataFrame, rows: DataFrame, table: np.ndarray, words: int, threshold: int
) -> DataFrame:
    """``id, component`` of the classes that may have a link: no link leaves a component."""
    context = documents.sparkSession.sparkContext
    # Ranks instead of counts: as 32-bit numbers, 4 MB.
    shared = context.broadcast(np.unique(table, return_inverse=True)[1].astype(np.uint32))

    def work(given):
        rank = shared.value
        lately: set[int] = set()
        for (text,) in given:
            found = shingles(text, words)
            if not len(found):
                continue
            name = class_of(found)
            # Copies post the same; those of one task mostly meet here.
            if name in lately:
                continue
            if len(lately) >= 200_000:
                lately.clear()
            lately.add(name)
            n = len(found)
            order = np.lexsort((found, rank[_cells(found)]))[: prefix_length(n, threshold)]
            first = first_length(n, threshold)
            for place, member in enumerate(found[order].view(np.int64).tolist()):
                yield member, name, 2 * n + (place >= first)

    postings = map_rows(documents.select("text"), work, "shingle bigint, class bigint, size int", every=50_000)
    of = Window.partitionBy("shingle")
    least = F.min(F.when(F.col("size") % 2 == 0, F.col("size"))).over(of)
    lists = postings.select(
        "*",
        F.count(F.lit(1)).over(of).alias("times"),
        F.min("class").over(of).alias("block"),
        F.max("class").over(of).alias("last"),
        least.alias("least"),
    ).where("block != last and size >= least")
    n = F.shiftright("size", 1)
    run = of.orderBy("size", "class")
    before = F.lag(F.struct("class", n.alias("n"))).over(run).alias("other")
    chained = lists.where(F.col("times") > SHORT_LIST).select("class", n.alias("n"), before)
    chained = chained.where((F.col("class") != F.col("other.class")) & (100 * F.col("other.n") >= threshold * F.col("n")))
    chained = chained.select(F.col("class").alias("a"), F.col("other.class").alias("b")).distinct()
    known = rows.where("class is not null").groupBy("class").agg(F.first("n").alias("n"), F.first("histogram").alias("histogram"))
    # Each class once in a block, however many lists it shares with the others there.
    short = lists.where(F.col("times") <= SHORT_LIST).select("block", "class")
    placed = short.repartition("class").distinct().join(known, "class").select("block", "class", "n", "histogram")
    dealt = placed.repartition("block").sortWithinPartitions("block", "n", "class")
    edges = map_rows(dealt, lambda given: block_edges(given, threshold), "a bigint, b bigint", every=20_000)
    return components(edges.unionByName(chained), label="candidates")


def _dealt_sets(
    source: DataFrame, words: int, threshold: int, chunk_shingles: int
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``id, class, n, histogram`` of every row of ``id, text``; ``class, first, mark, n, copies`` of every class; and the
    texts of the candidate groups' sets, dealt by ``component, low, high``: a pair of chunks."""
    rows, table = _shingle_counts(source, words)
    groups = staged(_candidate_groups(source, rows, table, words, threshold), "groups")
    one = F.min(F.when(F.col("id").isNotNull(), F.struct("id", "mark"))).alias("one")
    sizes = rows.where("class is not null").groupBy("class").agg(
        one, F.max("n").alias("n"), F.count(F.lit(1)).alias("copies")
    )
    sizes = sizes.select("class", F.col("one.id").alias("first"), F.col("one.mark").alias("mark"), "n", "copies")
    # Each group in chunks of a bounded number of shingles; its members are spread by their hash.
    members = staged(groups.join(sizes, groups["id"] == sizes["class"]).select("class", "first", "mark", "n", "component"), "members")
    chunks = members.groupBy("component").agg(
        F.ceil(F.sum("n") / chunk_shingles).cast("int").alias("chunks"), F.sum("n").alias("weight")
    )
    placed = members.join(chunks, "component").withColumn("chunk", F.pmod(F.xxhash64("class"), F.col("chunks")).cast("int"))
    wanted = placed.select(F.col("first").alias("id"), "mark", F.col("class").alias("wanted"), "component", "chunks", "chunk")
    # By id and text: an id that many rows share finds each class's own rows only.
    marked = source.withColumn("mark", F.xxhash64("text"))
    texts = marked.join(limited_broadcast(wanted.where("id is not null")), ["id", "mark"])
    nameless = wanted.where("id is null")

    def classes(given):
        for (body,) in given:
            found = shingles(body, words)
            if len(found):
                yield class_of(found), body

    # Classes without any id are looked up by their hash, a text of each, among the rows without id.
    known = map_rows(source.where("id is null").select("text"), classes, "wanted bigint, text string")
    others = known.join(limited_broadcast(nameless), "wanted").dropDuplicates(["wanted"])
    place = ["text", "wanted", "component", "chunks", "chunk"]
    # Texts travel, not sets, which take twice their room.
    cells = texts.select(place).unionByName(others.select(place)).select(
        "*", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other")
    )
    cells = cells.select(
        "component",
        F.least("chunk", "other").alias("low"),
        F.greatest("chunk", "other").alias("high"),
        F.col("wanted").alias("class"),
        "chunk",
        "text",
    )
    dealt = cells.repartition("component", "low", "high").sortWithinPartitions("component", "low", "high", "class")
    return rows, sizes, dealt


def _per_cell(dealt: DataFrame, words: int, find) -> DataFrame:
    """``a, b`` of the classes that ``find`` pairs, from the cell's classes, their chunks and sets, and its chunks."""

    def search(given):
        held: list[tuple[int, int, np.ndarray]] = []
        current = None

        def pairs():
            if held:
                names, chunks, sets = zip(*held, strict=True)
                for a, b in find(list(sets), chunks, current[1:]):
                    yield names[a], names[b]

        for component, low, high, name, chunk, body in given:
            if (component, low, high) != current:
                yield from pairs()
                held, current = [], (component, low, high)
            if held and held[-1][0] == name:
                continue
            found = shingles(body, words)
            # A mark may stand for several texts; only the one that is meant is taken.
            if class_of(found) == name:
                held.append((name, chunk, found))
        yield from pairs()

    return map_rows(dealt, search, "a bigint, b bigint")


def _linked_classes(
    source: DataFrame, words: int, threshold: int, chunk_shingles: int
) -> tuple[DataFrame, DataFrame]:
    """``id, class, n, histogram`` of every row of ``id, text``; ``class, root, component_id`` of every class."""
    rows, sizes, dealt = _dealt_sets(source, words, threshold, chunk_shingles)

    def connect(sets, chunks, cell):
        return ((a, b) for a, b in enumerate(linked_components(sets, threshold)) if a != b)

    joined = components(_per_cell(dealt, words, connect), label="links")
    homes = joined.join(sizes, joined["id"] == sizes["class"]).select("class", "component", "first")
    least = homes.groupBy("component").agg(F.min("first").alias("least"))
    named = homes.join(least, "component").select("class", F.col("component").alias("home"), "least")
    found = sizes.join(named, "class", "left").select(
        "class", F.coalesce("home", "class").alias("root"), F.coalesce("least", "first").alias("component_id")
    )
    return rows, found


def join(
    documents: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    words: int = WORDS,
    threshold: int = THRESHOLD,
    chunk_shingles: int = CHUNK_SHINGLES,
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``documents``: components only.

    Most links inside a component are not looked for, and none is returned or counted; ``links`` does both.
    Exact up to 64-bit hashes. Null and wordless texts have no shingles, link with nothing and
    are their own component; repeated rows and equal sets link; a row with a null id takes part
    and names no component, so its component is null where nobody else does. No rows give no
    rows, other columns are ignored.
    """
    source = documents.select(F.col(doc_id).cast("bigint").alias("id"), F.col(text).cast("string").alias("text"))
    rows, found = _linked_classes(source, words, threshold, chunk_shingles)
    return rows.join(found, "class", "left").select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.when(F.col("class").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def links(
    documents: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    words: int = WORDS,
    threshold: int = THRESHOLD,
    chunk_shingles: int = CHUNK_SHINGLES,
) -> DataFrame:
    """``class, other, doc_id, other_id, n_links``: every two classes that link, once, and each class of several rows
    with itself.

    A class is the rows of one set, named by its hash; the ids are the smallest of each, null if it has none.
    ``n_links`` is how many pairs of rows the link stands for, so its sum is the number of links of the
    join. As many rows as linked pairs of sets: k near copies give up to k^2 / 2.
    """
    source = documents.select(F.col(doc_id).cast("bigint").alias("id"), F.col(text).cast("string").alias("text"))
    _, sizes, dealt = _dealt_sets(source, words, threshold, chunk_shingles)
    sizes = staged(sizes, "sizes")

    def pair(sets, chunks, cell):
        for a, b in linked_pairs(sets, threshold):
            # A pair of one chunk is in every cell of the chunk; it counts in the chunk's own.
            if (min(chunks[a], chunks[b]), max(chunks[a], chunks[b])) == cell:
                yield a, b

    found = _per_cell(dealt, words, pair).select(F.least("a", "b").alias("class"), F.greatest("a", "b").alias("other"))
    one = sizes.select("class", F.col("first").alias("doc_id"), "copies")
    two = sizes.select(F.col("class").alias("other"), F.col("first").alias("other_id"), F.col("copies").alias("others"))
    between = found.join(one, "class").join(two, "other").select(
        "class", "other", "doc_id", "other_id", (F.col("copies") * F.col("others")).alias("n_links")
    )
    copies = sizes.where("copies > 1").select(
        "class",
        F.col("class").alias("other"),
        F.col("first").alias("doc_id"),
        F.col("first").alias("other_id"),
        F.expr("copies * (copies - 1) div 2").alias("n_links"),
    )
    return between.unionByName(copies)


def representatives(
    documents: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    words: int = WORDS,
    threshold: int = THRESHOLD,
    chunk_shingles: int = CHUNK_SHINGLES,
) -> DataFrame:
    """``documents`` with one row of each component: that with the smallest id, null ids after all others.

    Rows without words stay. The texts are not shuffled: the ids that go are few and are joined
    by broadcast where they are counted to be, else by key. Rows whose id is null or repeated are
    told apart by their class.
    """
    source = documents.select(F.col(doc_id).cast("bigint").alias("id"), F.col(text).cast("string").alias("text"))
    rows, found = _linked_classes(source, words, threshold, chunk_shingles)
    found = staged(found, "classes")
    repeated = staged(rows.groupBy("id").count().where("id is not null and count > 1").select("id"), "repeated")
    gone = rows.join(found, "class").where("id != component_id").select("id").distinct()
    gone = staged(gone, "gone")
    key = F.col(f"`{doc_id}`").cast("bigint")

    def without(df: DataFrame, ids: DataFrame) -> DataFrame:
        return df.join(limited_broadcast(ids), key == ids["id"], "left_anti")

    single = without(without(documents.where(key.isNotNull()), repeated), gone)
    several = documents.join(limited_broadcast(repeated), key == repeated["id"], "left_semi")
    special = several.unionByName(documents.where(key.isNull()))
    at = documents.columns.index(text)
    fields = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in documents.schema)

    def name(given):
        for row in given:
            members = shingles(row[at], words)
            yield (*row, class_of(members) if len(members) else None)

    known = found.select(F.col("class").alias("_class"), F.col("root").alias("_root"), F.col("component_id").alias("_least"))
    named = map_rows(special, name, f"{fields}, `_class` bigint").join(known, "_class", "left")
    order = F.row_number().over(Window.partitionBy("_root", key).orderBy(F.lit(0)))
    kept = named.withColumn("_place", order).where(
        F.col("_class").isNull() | (key.eqNullSafe(F.col("_least")) & (F.col("_place") == 1))
    )
    return single.unionByName(kept.select([F.col(f"`{column}`") for column in documents.columns]))
