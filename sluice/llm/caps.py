"""Near-duplicate vectors by spherical-cap filters.

A vector is turned by a fixed rotation and cut into blocks. Each block has a small code of random
directions; a filter is one direction per block, so a few codes make millions of filters. There
are several such tables of filters. A
vector falls into the filters whose direction it exceeds a threshold with. They are list-decoded
block by block, and branches that cannot reach the threshold any more are cut. A vector that
exceeds it with fewer than ``LEAST`` filters of a table falls into its ``LEAST`` best. Vectors that share
a filter and a label are compared, so a pair is found if a filter holds both; see ``README`` for
the measured recall. Compared pairs are decided by their cosine in double precision.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.components import components
from sluice.llm.rows import limited_broadcast, map_rows, staged

COSINE = 0.93
BLOCKS = 3
TABLES = 6
LIST = 18
LEAST = 3
PER_FILTER = 64
CHUNK = 1_000
BATCH = 512


def code_size(vectors: int, blocks: int = BLOCKS) -> int:
    """Directions per block, so that filters hold about ``PER_FILTER`` vectors of a random cloud."""
    return int(min(400, max(16, np.ceil((vectors * LIST / TABLES / PER_FILTER) ** (1 / blocks)))))


def cap_threshold(dimension: int, share: float) -> float:
    """The inner product that a share of all unit vectors exceeds with a given one."""
    cosine = np.linspace(1, -1, 200_001)
    # The density of the inner product of two random directions, added up from 1 downwards.
    density = np.maximum(1 - cosine**2, 0) ** ((max(dimension, 3) - 3) / 2)
    above = np.cumsum(density)
    return float(cosine[np.searchsorted(above, min(share, 0.5) * above[-1])])


class Filters:
    """The filters of one dimension; the same in every task.

    A product code suits some vectors better than others, so there are several, each behind a
    rotation of its own.
    """

    def __init__(self, dimension: int, size: int):
        rng = np.random.default_rng([7, dimension, size])
        self.size, self.blocks = size, min(BLOCKS, dimension)
        self.parts = np.array_split(np.arange(dimension), self.blocks)
        self.tables = []
        for _ in range(TABLES):
            rotation = np.linalg.qr(rng.normal(size=(dimension, dimension)))[0]
            codes = []
            for part in self.parts:
                code = rng.normal(size=(size, len(part)))
                # Blocks share the length of a filter's direction by their dimensions.
                code *= np.sqrt(len(part) / dimension) / np.linalg.norm(code, axis=1, keepdims=True)
                codes.append(code)
            self.tables.append((rotation, codes))
        self.threshold = cap_threshold(dimension, LIST / TABLES / size**self.blocks)

    def decode(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, filter) pairs of unit vectors, by row and filter."""
        found = [self._decode(vectors, *table) for table in self.tables]
        row = np.concatenate([rows for rows, _ in found])
        name = np.concatenate([names + i * self.size**self.blocks for i, (_, names) in enumerate(found)])
        order = np.lexsort((name, row))
        return row[order], name[order]

    def _decode(self, vectors: np.ndarray, rotation: np.ndarray, codes: list) -> tuple[np.ndarray, np.ndarray]:
        turned = vectors @ rotation
        values = [turned[:, part] @ code.T for part, code in zip(self.parts, codes, strict=True)]
        most = [value.max(axis=1) for value in values]
        row = np.arange(len(vectors))
        name = np.zeros(len(vectors), np.int64)
        total = np.zeros(len(vectors))
        for block, value in enumerate(values):
            left = sum(most[block + 1 :], np.zeros(len(vectors)))
            sums = total[:, None] + value[row]
            at, choice = np.nonzero(sums >= (self.threshold - left[row])[:, None])
            total, name, row = sums[at, choice], name[at] * self.size + choice, row[at]
        few = np.flatnonzero(np.bincount(row, minlength=len(vectors)) < LEAST)
        if not len(few):
            return row, name
        best_row, best_name = self._best([value[few] for value in values])
        stay = ~np.isin(row, few)
        return np.concatenate([row[stay], few[best_row]]), np.concatenate([name[stay], best_name])

    def _best(self, values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The ``LEAST`` best filters of each row: they are made of the best directions of each block."""
        count = len(values[0])
        total, name = np.zeros((count, 1)), np.zeros((count, 1), np.int64)
        for value in values:
            choice = np.argsort(-value, axis=1)[:, :LEAST]
            sums = total[:, :, None] + np.take_along_axis(value, choice, axis=1)[:, None, :]
            names = name[:, :, None] * self.size + choice[:, None, :]
            sums, names = sums.reshape(count, -1), names.reshape(count, -1)
            top = np.argsort(-sums, axis=1)[:, :LEAST]
            total, name = np.take_along_axis(sums, top, axis=1), np.take_along_axis(names, top, axis=1)
        return np.repeat(np.arange(count), name.shape[1]), name.ravel()


@cache
def filters(dimension: int, size: int) -> Filters:
    return Filters(dimension, size)


def unit(vector) -> np.ndarray | None:
    """The vector with length 1 in double precision; None if it has no direction."""
    if not vector or any(x is None for x in vector):
        return None
    found = np.array(vector, np.float64)
    if not np.isfinite(found).all():
        return None
    found = found / (np.abs(found).max() or 1.0)
    length = np.linalg.norm(found)
    return found / length if length else None


def _linked(
    vectors: np.ndarray, lists: list[np.ndarray], here: int, chunks: np.ndarray, cross: bool, least: float
) -> tuple[np.ndarray, np.ndarray]:
    """Adjacency of the linked pairs of a filter, and the same without pairs that a smaller filter holds too."""
    near = vectors @ vectors.T >= least
    np.fill_diagonal(near, False)
    if cross:
        near &= chunks[:, None] != chunks[None, :]
    if not near.any():
        return near, near
    smaller = [found[found < here] for found in lists]
    names, column = np.unique(np.concatenate(smaller), return_inverse=True)
    own = near
    if len(names):
        holds = np.zeros((len(vectors), len(names)), np.float32)
        holds[np.repeat(np.arange(len(vectors)), list(map(len, smaller))), column] = 1
        holds = holds[:, holds.sum(axis=0) > 1]
        own = near & (holds @ holds.T == 0)
    return near, own


def _homes(near: np.ndarray) -> np.ndarray:
    """The smallest position reachable from each position."""
    label = np.arange(len(near))
    while True:
        around = np.where(near, label[None, :], len(near)).min(axis=1)
        new = np.minimum(label, around)
        new = np.minimum(new, new[new])
        if (new == label).all():
            return label
        label = new


def link(
    embeddings: DataFrame,
    *,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    cosine: float = COSINE,
    chunk: int = CHUNK,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row.

    Rows link if their labels are equal and their cosine is ``cosine`` or more. A null label, and a
    vector that is null, empty or zero or holds a null, NaN or infinity, link with nothing; so do
    vectors of different lengths. Equal vectors of a label are one class with its number of rows:
    they link, and a class that fills a third of the table is one row from then on. Repeated ids
    are rows of their own; a null id names no component, and its row is not kept. No rows, no result.
    """
    spark = embeddings.sparkSession
    source = embeddings.select(
        F.col(vec_id).cast("bigint"), F.col(embedding).cast("array<double>"), F.col(label).cast("string")
    )

    def classes(rows):
        for key, vector, mark in rows:
            found = None if mark is None else unit(vector)
            if found is None:
                yield key, None, None, None
                continue
            data = np.array(vector, "<f8").tobytes()
            name = xxhash.xxh3_64_intdigest(mark.encode() + b"\0" + data)
            yield key, int(np.uint64(name).astype(np.int64)), mark, found.astype("<f8").tobytes()

    named = staged(map_rows(source, classes, "id bigint, class bigint, mark string, unit binary"), "vectors")
    groups = staged(
        named.where("class is not null")
        .groupBy("class")
        .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("rows"), F.first("mark").alias("mark"), F.first("unit").alias("unit")),
        "vector-classes",
    )
    size = code_size(groups.count())

    def decode(rows):
        held: dict[int, list[tuple]] = {}

        def found(dimension):
            batch = held.pop(dimension)
            units = np.stack([np.frombuffer(data, "<f8") for *_, data in batch])
            row, name = filters(dimension, size).decode(units)
            ends = np.searchsorted(row, np.arange(len(batch) + 1))
            for i, (key, mark, rows_of, data) in enumerate(batch):
                mine = name[ends[i] : ends[i + 1]]
                listed = mine.astype("<i8").tobytes()
                for one in mine.tolist():
                    yield f"{dimension}:{mark}", one, key, rows_of, data, listed

        for key, mark, rows_of, data in rows:
            dimension = len(data) // 8
            held.setdefault(dimension, []).append((key, mark, rows_of, data))
            if len(held[dimension]) >= BATCH:
                yield from found(dimension)
        for dimension in list(held):
            yield from found(dimension)

    schema = "mark string, filter bigint, class bigint, rows bigint, unit binary, filters binary"
    posted = map_rows(groups.select("class", "mark", "rows", "unit"), decode, schema)
    # Filters with more vectors than a task should compare are cut into chunks; each pair of chunks is a cell.
    crowded = posted.groupBy("mark", "filter").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > chunk)
    crowded = staged(crowded.select("mark", "filter", F.ceil(F.col("n") / chunk).cast("int").alias("chunks")), "crowded")
    sized = posted.join(limited_broadcast(crowded, 100_000), ["mark", "filter"], "left")
    mine = F.when(F.col("chunks").isNull(), 0).otherwise(F.pmod(F.xxhash64("class"), F.col("chunks"))).cast("int")
    others = F.sequence(F.lit(0), F.coalesce("chunks", F.lit(1)) - 1)
    cells = sized.withColumn("chunk", mine).withColumn("other", F.explode(others))
    cells = cells.withColumn("low", F.least("chunk", "other")).withColumn("high", F.greatest("chunk", "other"))
    key = ["mark", "filter", "low", "high"]
    dealt = cells.select(*key, "class", "rows", "unit", "filters", "chunk").repartition(*key).sortWithinPartitions(*key, "class")

    def compare(given):
        def links(where, held):
            if len(held) < 2:
                return
            units = np.stack([np.frombuffer(data, "<f8") for _, _, data, _, _ in held])
            lists = [np.frombuffer(data, "<i8") for _, _, _, data, _ in held]
            weight = np.array([count for _, count, *_ in held], np.float64)
            chunks = np.array([part for *_, part in held])
            near, own = _linked(units, lists, where[1], chunks, where[2] != where[3], cosine)
            if not near.any():
                return
            counts = own @ weight
            for i, home in enumerate(_homes(near).tolist()):
                if near[i].any():
                    yield held[i][0], int(counts[i]), held[home][0]

        held: list[tuple] = []
        current = None
        for *where, name, count, data, listed, part in given:
            if where != current:
                yield from links(current, held)
                held, current = [], where
            held.append((name, count, data, listed, part))
        yield from links(current, held)

    found = staged(map_rows(dealt, compare, "class bigint, links bigint, home bigint"), "vector-links")
    counted = found.groupBy("class").agg(F.sum("links").alias("links"))
    joined = components(found.select("class", "home").distinct(), "class", "home", "vector-components")
    homes = joined.join(groups.select("class", "first"), joined["id"] == groups["class"]).select("class", "component", "first")
    least = homes.groupBy("component").agg(F.min("first").alias("least"))
    placed = homes.join(least, "component").select("class", "least")
    whole = (
        groups.select("class", "first", "rows")
        .join(counted, "class", "left")
        .join(placed, "class", "left")
        .select(
            "class",
            (F.coalesce("links", F.lit(0)) + F.col("rows") - 1).alias("n_links"),
            F.coalesce("least", "first").alias("component_id"),
        )
    )
    result = named.select("id", "class").join(whole, "class", "left")
    component = F.when(F.col("class").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return result.select(
        F.col("id").alias("vec_id"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )
