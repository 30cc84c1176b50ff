"""Merkle manifest of a dataset by time-forward processing.

Nodes are numbered so that children come before parents. A sweep in that order keeps a priority
queue of messages, each a child's digest addressed to its parent's label; when the sweep comes to
a parent, the head of the queue is what its children sent. A second sweep, in reversed order,
sends proof suffixes down: a node passes to each child the run that the child is in, followed by
the suffix that it has got itself.

The queue is external: what goes from one stretch of labels to another is a written table, which
Spark's sort deals out by label, and a task holds only the messages of the stretch that it is in.
A stretch is ``16 ** levels`` consecutive nodes of one source, so no task holds a whole source, and
the tops of all stretches, far fewer, are the nodes of the next pass.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.rows import limited_broadcast, map_rows, staged
from sluice.operators.ordering import with_ordinals

FANOUT = 16
# Levels that one pass goes up: stretches of leaves are kept small, so that a large source is many tasks' work.
LEAF_LEVELS, LEVELS = 2, 3
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_DIGEST = 64
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SUFFIX = "array<struct<place:int,run:string>>"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_digest(values: list[Column]) -> Column:
    """H of a row: ``-`` for a null, else the value's length in bytes, a colon and the value."""
    texts = [value.cast("string") for value in values]
    parts = [
        F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")) for text in texts
    ]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def lowered(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


# Sweeps over one stretch, in a task


@dataclass
class Inner:
    """A node above the leaves of a stretch: where it stands, and what its children sent."""

    level: int
    index: int
    first: int
    run: list[str] = field(default_factory=list)
    digest: str = ""


def forward(leaves: list[str], top: int) -> list[Inner]:
    """The inner nodes of a stretch up to level ``top``, in the order of their labels.

    A label is the place where a node's last leaf ends, then its level, so a node follows all that is below
    it. A message is taken from the queue once the sweep has come to the label it is addressed to.
    """
    queue: list[tuple[int, int, int, int, str]] = []
    nodes: list[Inner] = []

    def send(level: int, index: int, value: str) -> None:
        if level < top:
            parent = index // FANOUT
            ends = min((parent + 1) * FANOUT ** (level + 1), len(leaves))
            heapq.heappush(queue, (ends, level + 1, parent, index, value))

    for place, leaf in enumerate(leaves):
        send(0, place, leaf)
        while queue and queue[0][0] <= place + 1:
            _, level, index, first, _ = queue[0]
            node = Inner(level, index, first)
            while queue and queue[0][1:3] == (level, index):
                node.run.append(heapq.heappop(queue)[4])
            node.digest = digest("".join(node.run))
            nodes.append(node)
            send(level, index, node.digest)
    return nodes


def backward(nodes: list[Inner], count: int, top: int, suffix: tuple) -> Iterator[tuple[int, tuple]]:
    """(leaf, suffix) of every leaf of a stretch whose top has got ``suffix``.

    A suffix is a chain: (place in the run, the run, the suffix further up), empty at the root. Messages are
    taken by label, from the last one to the first; chains are shared, so a leaf costs one link.
    """
    if not top:
        yield 0, suffix
        return
    queue = [(-count, -top, 0, suffix)]
    for node in reversed(nodes):
        # Labels fall strictly, and each node has one parent: the head is this node's message.
        _, _, _, given = heapq.heappop(queue)
        run = "".join(node.run)
        for place in range(len(node.run)):
            link = (place, run, given)
            child = node.first + place
            if node.level == 1:
                yield child, link
            else:
                ends = min((child + 1) * FANOUT ** (node.level - 1), count)
                heapq.heappush(queue, (-ends, 1 - node.level, child, link))


def linked(items: list[dict] | None) -> tuple:
    """A suffix as a chain, from the form in which tables have it."""
    chain: tuple = ()
    for item in reversed(items or []):
        chain = (item["place"], item["run"], chain)
    return chain


def listed(chain: tuple) -> list[tuple[int, str]]:
    found = []
    while chain:
        place, run, chain = chain
        found.append((place, run))
    return found


def siblings(chain: tuple) -> str:
    """The digests that a proof is made of: the run's others, level by level, left to right."""
    parts = []
    while chain:
        place, run, chain = chain
        parts += (run[: place * _DIGEST], run[(place + 1) * _DIGEST :])
    return "".join(parts)


def folded(value: str, chain: tuple) -> str:
    """The root that a leaf's digest gives with the siblings of its proof."""
    while chain:
        place, run, chain = chain
        value = digest(run[: place * _DIGEST] + value + run[(place + 1) * _DIGEST :])
    return value


def height(count: int, most: int) -> int:
    """How many levels up, ``most`` at most, ``count`` nodes become one."""
    levels = 0
    while count > 1 and levels < most:
        count, levels = -(-count // FANOUT), levels + 1
    return levels


# Passes over all nodes

_NODES = "grp string, place bigint, total bigint, digest string"


def _dealt(nodes: DataFrame, levels: int) -> DataFrame:
    """Nodes by stretch, each stretch in order in one task."""
    stretch = F.floor(F.col("place") / FANOUT**levels).cast("bigint")
    return nodes.withColumn("stretch", stretch).repartition("grp", "stretch").sortWithinPartitions("grp", "stretch", "place")


def _up(nodes: DataFrame, levels: int) -> DataFrame:
    """The tops of all stretches as nodes of the next pass."""

    def work(rows):
        for (grp, stretch, total), found in groupby(rows, key=lambda row: row[:3]):
            leaves = [row[3] for row in found]
            top = height(total, levels)
            inner = forward(leaves, top)
            yield grp, stretch, -(-total // FANOUT**top), inner[-1].digest if top else leaves[0]

    return map_rows(_dealt(nodes, levels).select("grp", "stretch", "total", "digest"), work, _NODES)


def _down(nodes: DataFrame, given: DataFrame, levels: int) -> DataFrame:
    """The suffix of every node, from those of the stretches' tops; what else ``given`` has goes along."""
    messages = given.select(
        "grp", F.col("place").alias("stretch"), F.lit(-1).cast("bigint").alias("place"), "suffix", "subroot", "root"
    )
    stretch = F.floor(F.col("place") / FANOUT**levels).cast("bigint")
    every = nodes.withColumn("stretch", stretch).unionByName(messages, allowMissingColumns=True)
    order = ["grp", "stretch", "place"]
    dealt = every.repartition("grp", "stretch").sortWithinPartitions(*order)
    return dealt.select(*order, "total", "digest", "suffix", "subroot", "root")


def _swept(rows, levels: int):
    """(first message, leaves, their chains) of each stretch of rows that :func:`_down` dealt."""
    for _, found in groupby(rows, key=lambda row: row[:2]):
        message, *leaves = found
        top = height(leaves[0][3], levels)
        inner = forward([leaf[4] for leaf in leaves], top)
        for at, chain in backward(inner, len(leaves), top, linked(message[5])):
            yield message, leaves[at], chain


def _suffixes(nodes: DataFrame, given: DataFrame, levels: int) -> DataFrame:
    def work(rows):
        for message, leaf, chain in _swept(rows, levels):
            yield leaf[0], leaf[2], listed(chain), message[6], message[7]

    schema = f"grp string, place bigint, suffix {_SUFFIX}, subroot string, root string"
    return map_rows(_down(nodes, given, levels), work, schema)


@dataclass
class Tree:
    """The trees of all groups: their nodes by pass, the leaves first, and the tops, one per group."""

    passes: list[tuple[DataFrame, int]]
    tops: DataFrame

    def suffixes(self, tops: DataFrame) -> DataFrame:
        """``grp, place, suffix, subroot, root`` of the stretches of leaves, from those of the tops."""
        given = tops
        for nodes, levels in reversed(self.passes[1:]):
            given = staged(_suffixes(nodes, given, levels), "merkle-suffixes")
        return given


def _trees(leaves: DataFrame, first: int) -> Tree:
    """Passes up until every group is one node. Each pass is a written table, a small part of the one below."""
    nodes, levels, passes = leaves, first, []
    while True:
        passes.append((nodes, levels))
        nodes, levels = staged(_up(nodes, levels), "merkle-tops"), LEVELS
        # A group that is one node already stays one; the others go on.
        if nodes.agg(F.max("total")).first()[0] in (None, 1):
            return Tree(passes, nodes)


@dataclass
class Manifest:
    """``leaves`` (``grp, place, total, digest`` and the row's own columns), ``groups`` (``grp, source, n_leaves,
    subroot``), and the trees of the groups and of their subroots."""

    leaves: DataFrame
    groups: DataFrame
    below: Tree
    above: Tree

    @property
    def root(self) -> DataFrame:
        return self.above.tops.select(F.col("digest").alias("root"))


def build(
    documents: DataFrame,
    *,
    columns: tuple[str, ...] = COLUMNS,
    group: str = "source",
    order: str = "doc_id",
    presented: Column | None = None,
) -> Manifest:
    """The manifest of a table: a tree of the rows of each ``group`` in ``order``, then one of the subroots.

    ``presented`` is a digest per row to be verified against the manifest, by default the row's own.
    Groups are in bytewise order, the null one first; a null in ``order`` comes first. Rows of one order go
    by their digest; equal rows are leaves of their own. A null value is its own mark and differs from
    an empty text. Columns that are not named do not count, whatever their names. An empty table
    has no leaves, groups or root. Texts are digested where they are read and are not shuffled.
    """
    grp = F.coalesce(F.concat(F.lit("1"), F.col(group).cast("string")), F.lit("0"))
    leaf = leaf_digest([F.col(name) for name in columns])
    rows = documents.select(
        grp.alias("grp"),
        F.col(group).cast("string").alias("source"),
        F.col(order).alias("key"),
        leaf.alias("digest"),
        (F.lit(None).cast("string") if presented is None else presented).alias("presented"),
    )
    rows = staged(rows, "merkle-leaves")
    # The place in a written file tells equal rows apart, however many they are, so ranges split them too.
    meta = F.col("_metadata")
    rows = rows.withColumn("row", F.xxhash64(meta.file_name, meta.row_index))
    numbered = with_ordinals(rows, ["grp", "key", "digest", "row"], "n")
    groups = numbered.groupBy("grp", "source").agg(F.min("n").alias("first"), F.count(F.lit(1)).alias("total"))
    groups = staged(groups, "merkle-groups")
    placed = numbered.join(limited_broadcast(groups.drop("source")), "grp")
    leaves = placed.select("grp", (F.col("n") - F.col("first")).alias("place"), "total", "digest", "key", "presented")
    leaves = staged(leaves, "merkle-placed")
    below = _trees(leaves.select("grp", "place", "total", "digest"), LEAF_LEVELS)
    tops = below.tops.select(F.col("grp").alias("below"), "digest")
    count = tops.count()
    total = F.lit(count).cast("bigint").alias("total")
    ordered = with_ordinals(tops, ["below"], "n").select(
        F.lit("").alias("grp"), (F.col("n") - 1).alias("place"), total, "digest", "below"
    )
    ordered = staged(ordered, "merkle-subroots")
    above = _trees(ordered.drop("below"), LEVELS)
    named = ordered.select(F.col("below").alias("grp"), F.col("place").alias("nth"), F.col("digest").alias("subroot"))
    groups = groups.join(named, "grp").select("grp", "nth", "source", F.col("total").alias("n_leaves"), "subroot")
    return Manifest(leaves, groups, below, above)


def _stretch_suffixes(manifest: Manifest) -> DataFrame:
    """The suffix of every stretch of leaves: from the root to the subroots, and on to the stretches."""
    no_suffix = F.array().cast(_SUFFIX)
    subroot = F.lit(None).cast("string").alias("subroot")
    root = manifest.above.tops.select("grp", "place", no_suffix.alias("suffix"), subroot, F.col("digest").alias("root"))
    given = manifest.above.suffixes(root)
    nodes, levels = manifest.above.passes[0]
    of_subroots = staged(_suffixes(nodes, given, levels), "merkle-suffixes").drop("grp", "subroot")
    tops = manifest.groups.join(of_subroots.withColumnRenamed("place", "nth"), "nth").select(
        "grp", F.lit(0).cast("bigint").alias("place"), "suffix", "subroot", "root"
    )
    return manifest.below.suffixes(tops)


def verify(manifest: Manifest) -> DataFrame:
    """Per leaf ``key, leaf, subroot, root, proof_sha256, n_siblings, folded_root, verified``.

    ``folded_root`` comes of the presented digest, or of the leaf's own where none is presented, and
    the siblings of the proof.
    """
    _, levels = manifest.below.passes[0]
    kind = manifest.leaves.schema["key"].dataType.simpleString()
    whole = manifest.leaves.select("grp", "place", "total", F.struct("digest", "key", "presented").alias("digest"))
    dealt = _down(whole, _stretch_suffixes(manifest), levels)

    def work(rows):
        opened = ((*row[:4], (row[4] or {}).get("digest"), *row[5:], row[4]) for row in rows)
        for message, leaf, chain in _swept(opened, levels):
            proof, own = siblings(chain), leaf[8]
            end = folded(own["presented"] or own["digest"], chain)
            root = message[7]
            yield own["key"], own["digest"], message[6], root, digest(proof), len(proof) // _DIGEST, end, end == root

    return map_rows(
        dealt,
        work,
        f"key {kind}, leaf string, subroot string, root string, proof_sha256 string, n_siblings bigint, "
        "folded_root string, verified boolean",
    )


def nodes(manifest: Manifest) -> DataFrame:
    """``tree, level, place, digest`` of every inner node: the manifest as it is stored. The tree of subroots is ``""``."""

    def inner(found: DataFrame, levels: int, base: int) -> DataFrame:
        def work(rows):
            for (grp, stretch, total), leaves in groupby(rows, key=lambda row: row[:3]):
                leaves = [row[3] for row in leaves]
                for node in forward(leaves, height(total, levels)):
                    yield grp, base + node.level, stretch * FANOUT ** (levels - node.level) + node.index, node.digest

        dealt = _dealt(found, levels).select("grp", "stretch", "total", "digest")
        return map_rows(dealt, work, "tree string, level int, place bigint, digest string")

    every = []
    for tree in (manifest.below, manifest.above):
        base = 0
        for found, levels in tree.passes:
            every.append(inner(found, levels, base))
            base += levels
    return reduce(DataFrame.unionByName, every)


def tampering(doc_id: str = "doc_id", columns: tuple[str, ...] = COLUMNS, text: str = "text") -> Column:
    """The digest of a row whose text was lower-cased, for rows whose id's checksum 5 divides; else null."""
    hit = F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0
    changed = [lowered(F.col(name)) if name == text else F.col(name) for name in columns]
    return F.when(hit, leaf_digest(changed))


def audit(documents: DataFrame) -> DataFrame:
    """The manifest of ``documents``, every leaf's proof, and what becomes of tampered rows."""
    found = verify(build(documents, presented=tampering()))
    return found.withColumnRenamed("key", "doc_id")
