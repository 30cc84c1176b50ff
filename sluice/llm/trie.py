"""Prefix trie of conversations over padded matrices of turn ids.

A conversation is the sequence of its turns' hashes, 16 bytes each. Conversations are dealt out by ranges
of these sequences and sorted, so a node of the trie, which is a common prefix, is a run of rows. A task
takes its rows in blocks: a block becomes a matrix of turn ids padded with -1, ``lexsort`` orders its
rows, the masks of what changes from row to row, accumulated by OR along each row, mark where nodes start,
and ``reduceat`` sums every depth between the marks.

Nodes strictly inside a block are complete. Those on the path of its first or last row may go on in the
blocks beside it: the two paths are carried on, with what is known of each of their nodes, as rows of
the next pass, which is the same over far fewer rows, until one block holds them all.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.rows import limited_broadcast, map_rows, staged

HASH = 16
# A block has at most this many cells, but may always have a few rows, so that every pass leaves fewer.
CELLS, LEAST_ROWS = 400_000, 8
BYTES_PER_TASK = 32 << 20
SHARED = 6
_MOST = np.iinfo(np.int64).max
_NO_ENDS = hashlib.sha256().hexdigest()
_OUT_ROWS = 50_000

_SUMS = ("convs", "kids", "leaves", "saved")
_CARRIED = ("chars", *_SUMS, "least")
_CARRIED_ROW = "path binary, low bigint, " + ", ".join(f"{name} array<bigint>" for name in _CARRIED)
_NUMBERS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")
NODES = ", ".join(f"{name} bigint" for name in _NUMBERS) + ", ends_sha256 string"
_OUT = f"kind int, {NODES}, key binary, parent_key binary, {_CARRIED_ROW}, ids string"
_NODE, _CARRY, _ENDS = 0, 1, 2
_LISTS = pa.list_(pa.int64())
_TYPES = {
    "kind": pa.int32(),
    **dict.fromkeys(_NUMBERS, pa.int64()),
    "ends_sha256": pa.string(),
    "key": pa.binary(),
    "parent_key": pa.binary(),
    "path": pa.binary(),
    "low": pa.int64(),
    **dict.fromkeys(_CARRIED, _LISTS),
    "ids": pa.string(),
}


# Sequences


def sequences(
    conversations: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """``conv_id, turns`` with the hash and the text's code points of each turn, in order.

    Null turns come first; turns of one number go by their hash, and repeated rows are turns of their own.
    A null role or text is empty. Rows without a conversation's id belong to no conversation. Texts are
    hashed where they are read; only the hashes are shuffled. A conversation is one row of 40 bytes a turn.
    """
    body, spoken = F.coalesce(F.col(text), F.lit("")), F.coalesce(F.col(role), F.lit(""))
    named = F.concat(F.octet_length(spoken).cast("string"), F.lit(":"), spoken, body)
    turns = conversations.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("bigint").alias("conv_id"),
        F.struct(
            F.col(turn).alias("turn"),
            F.md5(named.cast("binary")).alias("hash"),
            F.char_length(body).cast("bigint").alias("chars"),
        ).alias("one"),
    )
    ordered = F.sort_array(F.collect_list("one"))
    return turns.groupBy("conv_id").agg(
        F.transform(ordered, lambda one: F.struct(one["hash"].alias("hash"), one["chars"].alias("chars"))).alias("turns")
    )


def rebuilt(found: DataFrame, every: int = 100) -> DataFrame:
    """Sequences that begin with turns of the conversation at the start of their hundred.

    Conversation c gets the first h turns of conversation c - c % 100 (all if it has fewer), then its own
    after its first h; h is the checksum of c as text, modulo 6. ``%`` keeps the sign of c.
    """
    heads = found.where(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("_head"), F.slice("turns", 1, SHARED - 1).alias("head")
    )
    joined = found.withColumn("_head", F.col("conv_id") - F.col("conv_id") % every).join(heads, "_head", "left")
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED).cast("int")
    none = F.array().cast("array<struct<hash:string,chars:bigint>>")
    shared = F.slice(F.coalesce("head", none), F.lit(1), h)
    own = F.slice("turns", h + 1, F.size("turns"))
    return joined.select("conv_id", F.concat(shared, own).alias("turns"))


def _rows(found: DataFrame) -> DataFrame:
    path = F.unhex(F.array_join(F.transform("turns", lambda one: one["hash"]), ""))
    chars = F.transform("turns", lambda one: one["chars"])
    return found.select(path.alias("path"), F.col("conv_id").alias("low"), chars.alias("chars"))


# One block, in a task


@dataclass
class Block:
    """Rows of a block in order: hashes of their turns, and by depth, from the root's 0, what is known of their nodes."""

    paths: list[bytes]
    low: np.ndarray
    values: dict[str, np.ndarray]

    @property
    def lengths(self) -> np.ndarray:
        return np.fromiter((len(path) // HASH for path in self.paths), np.int64, len(self.paths))


def _dense(hashes: np.ndarray) -> np.ndarray:
    """Hashes, as two columns of numbers, numbered in their order."""
    order = np.lexsort((hashes[:, 1], hashes[:, 0]))
    sorted_ = hashes[order]
    ids = np.empty(len(hashes), np.int64)
    ids[order] = np.concatenate([[0], np.cumsum((sorted_[1:] != sorted_[:-1]).any(axis=1))])[: len(hashes)]
    return ids


def _padded(values: np.ndarray, present: np.ndarray, blank: int) -> np.ndarray:
    matrix = np.full(present.shape, blank, np.int64)
    matrix[present] = values
    return matrix


def _keys(path: bytes) -> list[bytes]:
    """The key of every node on a path, the root's first."""
    running = hashlib.md5(usedforsecurity=False)
    keys = [running.digest()]
    for at in range(0, len(path), HASH):
        running.update(path[at : at + HASH])
        keys.append(running.digest())
    return keys


def solve(block: Block, *, first_pass: bool, last_pass: bool) -> Iterator[pa.RecordBatch]:
    """All nodes inside a block, and unless it holds all rows, the paths and ends that go on to the next pass.

    The rows of the first pass are conversations: a row's ``low`` is its id and it ends where its path does.
    """
    lengths = block.lengths
    width = int(lengths.max())
    hashes = np.frombuffer(bytearray().join(block.paths), ">u8").reshape(-1, 2).astype(np.uint64)
    present = np.arange(1, width + 1) <= lengths[:, None]
    ids = _padded(_dense(hashes), present, -1)
    order = np.lexsort((block.low, *ids.T[::-1]))
    ids, lengths, low = ids[order], lengths[order], block.low[order]
    paths = [block.paths[at] for at in order.tolist()]
    rows = len(paths)

    known = np.arange(width + 1) <= lengths[:, None]
    here = np.arange(width + 1) <= block.lengths[:, None]
    sums = {name: _padded(block.values[name], here, 0)[order] for name in (*_SUMS, "chars")}
    least = _padded(block.values["least"], here, _MOST)[order]

    changed = np.zeros((rows, width + 1), bool)
    changed[0] = True
    changed[1:, 1:] = ids[1:] != ids[:-1]
    changed = np.logical_or.accumulate(changed, axis=1)

    edges = ((0, _keys(paths[0])), (rows - 1, _keys(paths[-1])))
    carried = [{name: [_MOST if name == "least" else 0] * (int(lengths[at]) + 1) for name in _CARRIED} for at, _ in edges]
    below_leaves, below_saved = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
    inner_starts = np.zeros(rows, np.int64)
    waiting = np.empty(0, np.int64)
    found: list[dict] = []
    ends_out: list[tuple[bytes, int, str]] = []

    for depth in range(width, -1, -1):
        starts = np.flatnonzero(changed[:, depth])
        real = known[starts, depth]
        convs = np.add.reduceat(sums["convs"][:, depth], starts)
        smallest = np.minimum.reduceat(least[:, depth], starts)
        kids = np.add.reduceat(sums["kids"][:, depth] + inner_starts, starts)
        chars = sums["chars"][starts, depth]
        leaves = np.add.reduceat(sums["leaves"][:, depth] + below_leaves, starts)
        saved = np.add.reduceat(sums["saved"][:, depth] + below_saved, starts)
        ends = np.add.reduceat((lengths == depth).astype(np.int64), starts) if first_pass else np.zeros(len(starts), np.int64)

        if len(waiting):
            # The nodes one deeper have been found before their parents.
            parent = np.searchsorted(starts, waiting, "right") - 1
            above = found[-1]
            above["parent_conv_id"] = smallest[parent]
            above["parent"] = parent
        on_edge = np.zeros(len(starts), bool)
        edge_of = np.zeros(len(starts), np.int8)
        if not last_pass:
            on_edge[-1] = known[-1, depth]
            edge_of[-1] = 1
            if known[0, depth]:
                on_edge[0], edge_of[0] = True, 0
        if len(waiting):
            keyed = on_edge[above.pop("parent")]
            above["parent_key"] = np.where(keyed, edge_of[parent], -1)
        inside = real & ~on_edge
        own_leaf = (inside & (kids == 0)).astype(np.int64)
        own_saved = np.where(inside, (convs - 1) * chars, 0)

        for at in np.flatnonzero(on_edge).tolist():
            edge = int(edge_of[at])
            entry = carried[edge]
            for name, values in zip(_CARRIED, (chars, convs, kids, leaves, saved, smallest), strict=True):
                entry[name][depth] = int(values[at])
            if ends[at]:
                listed = low[starts[at] : starts[at] + ends[at]]
                ends_out.append((edges[edge][1][depth], int(listed[0]), ",".join(map(str, listed.tolist()))))
        if known[-1, depth]:
            carried[1]["chars"][depth] = int(chars[-1])

        waiting = starts[inside]
        found.append(
            {
                "conv_id": smallest[inside],
                "depth": np.full(len(waiting), depth),
                "n_convs": convs[inside],
                "n_children": kids[inside],
                "n_leaves": leaves[inside] + own_leaf[inside],
                "saved_tokens": saved[inside] + own_saved[inside],
                "starts": waiting,
                "ends": ends[inside],
            }
        )
        below_leaves[starts] += own_leaf
        below_saved[starts] += own_saved
        inner_starts = np.zeros(rows, np.int64)
        inner_starts[waiting] = 1

    for nodes in found:
        count = len(nodes["conv_id"])
        if not count:
            continue
        depth = int(nodes["depth"][0])
        sides = nodes.get("parent_key")
        sides = np.full(count, -1) if sides is None else sides
        above_keys = [edges[side][1][depth - 1] if side >= 0 else None for side in sides.tolist()]
        parents = pa.array(nodes.get("parent_conv_id", np.zeros(count, np.int64)), mask=(sides >= 0) | (depth == 0))
        digests = [
            hashlib.sha256(",".join(map(str, low[at : at + n].tolist())).encode()).hexdigest() if n else _NO_ENDS
            for at, n in zip(nodes["starts"].tolist(), nodes["ends"].tolist(), strict=True)
        ]
        columns = {name: pa.array(nodes[name]) for name in _NUMBERS if name != "parent_conv_id"}
        columns |= {"parent_conv_id": parents, "parent_key": pa.array(above_keys, pa.binary())}
        if first_pass:
            columns["ends_sha256"] = pa.array(digests)
        if not first_pass or last_pass:
            prefixes = [hashlib.md5(paths[at][: HASH * depth], usedforsecurity=False).digest() for at in nodes["starts"].tolist()]
            columns["key"] = pa.array(prefixes, pa.binary())
        yield from _batches(_NODE, count, columns)
    if last_pass:
        return
    if ends_out:
        keys, lows, texts = zip(*ends_out, strict=True)
        columns = {"key": pa.array(keys, pa.binary()), "low": pa.array(lows), "ids": pa.array(texts)}
        yield from _batches(_ENDS, len(keys), columns)
    sent = [0, 1] if paths[0] != paths[-1] else [0]
    columns = {name: pa.array([carried[edge][name] for edge in sent], _LISTS) for name in _CARRIED}
    at = [edges[edge][0] for edge in sent]
    columns |= {"path": pa.array([paths[row] for row in at], pa.binary()), "low": pa.array(low[at])}
    yield from _batches(_CARRY, len(sent), columns)


def _batches(kind: int, count: int, columns: dict[str, pa.Array]) -> Iterator[pa.RecordBatch]:
    columns = {"kind": pa.array(np.full(count, kind, np.int32)), **columns}
    every = [columns[name] if name in columns else pa.nulls(count, of) for name, of in _TYPES.items()]
    batch = pa.RecordBatch.from_arrays(every, names=list(_TYPES))
    for at in range(0, count, _OUT_ROWS):
        yield batch.slice(at, _OUT_ROWS)


def _blocks(batches: Iterator[pa.RecordBatch], first_pass: bool, cells: int) -> Iterator[Block]:
    """Runs of sorted rows of a bounded number of cells."""
    paths: list[bytes] = []
    low: list[int] = []
    values: dict[str, list] = {name: [] for name in _CARRIED}
    widest = 0

    def block() -> Block:
        arrays = {name: np.array(items, np.int64) for name, items in values.items()}
        return Block(paths, np.array(low, np.int64), arrays)

    for batch in batches:
        columns = {name: batch.column(name).to_pylist() for name in ("path", "low", "chars")}
        others = [] if first_pass else [batch.column(name).to_pylist() for name in _CARRIED]
        for at, path in enumerate(columns["path"]):
            wide = len(path) // HASH + 1
            if len(paths) >= LEAST_ROWS and (len(paths) + 1) * max(widest, wide) > cells:
                yield block()
                paths, low, widest = [], [], 0
                values = {name: [] for name in _CARRIED}
            widest = max(widest, wide)
            paths.append(path)
            low.append(columns["low"][at])
            if first_pass:
                values["chars"] += [0, *columns["chars"][at]]
                values["convs"] += [1] * wide
                values["least"] += [low[-1]] * wide
                for name in ("kids", "leaves", "saved"):
                    values[name] += [0] * wide
            else:
                for name, items in zip(_CARRIED, others, strict=True):
                    values[name] += items[at]
    if paths:
        yield block()


# Passes


def _pass(rows: DataFrame, tasks: int, first_pass: bool, last_pass: bool, cells: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The last block has all rows, which have been counted.
        for block in _blocks(batches, first_pass, 1 << 60 if last_pass else cells):
            yield from solve(block, first_pass=first_pass, last_pass=last_pass)

    # The range is dealt by ids too, so copies of one conversation, however many, are many tasks' work.
    dealt = rows.repartition(1) if last_pass else rows.repartitionByRange(tasks, "path", "low")
    return staged(dealt.sortWithinPartitions("path", "low").mapInArrow(run, _OUT), "trie")


def _ends(found: DataFrame) -> DataFrame:
    """``key, ends_sha256`` of the nodes whose ends lie in several blocks: digests over their lists, streamed in order.

    A digest has to see its ids one after the other. Blocks send them as texts, so a node with any number of
    ends is a row per block here, of which a task holds one at a time.
    """

    def work(rows):
        current, running = None, hashlib.sha256()
        for key, ids in rows:
            if current is not None and key != current:
                yield current, running.hexdigest()
                running = hashlib.sha256()
            elif current is not None:
                running.update(b",")
            current = key
            running.update(ids.encode())
        if current is not None:
            yield current, running.hexdigest()

    dealt = found.repartition("key").sortWithinPartitions("key", "low").select("key", "ids")
    return map_rows(dealt, work, "key binary, ends_sha256 string")


def trie(found: DataFrame, *, cells: int = CELLS) -> DataFrame:
    """Every node of the trie of sequences ``conv_id, turns``, the root too, one row each.

    ``conv_id`` is the node's smallest member and with ``depth`` names the node, ``parent_conv_id`` the
    parent's; ``n_convs, n_children, n_leaves, saved_tokens, ends_sha256`` as in the module's queries.
    Conversations without turns are members of the root alone; no conversations give no nodes.
    Memory of a task is that of a block of ``cells`` matrix cells; one conversation is always within one block.
    """
    rows = staged(_rows(found), "trie-rows")
    passes: list[DataFrame] = []
    while True:
        size = rows.agg(
            F.count(F.lit(1)), F.max(F.octet_length("path")), F.sum(F.octet_length("path").cast("bigint") * 2 + 64)
        ).first()
        count, longest, total = size
        if not count:
            break
        last = count <= LEAST_ROWS or count * (longest // HASH + 1) <= cells // 4
        setting = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        # Rows of later passes are few, so their tasks follow their bytes alone.
        tasks = max(setting if not passes else 1, -(-total // BYTES_PER_TASK))
        first = not passes
        if first:
            last = False
        passes.append(_pass(rows, tasks, first, last, cells))
        if last:
            break
        rows = passes[-1].where(F.col("kind") == _CARRY).select("path", "low", *_CARRIED)
    if not passes:
        return found.sparkSession.createDataFrame([], NODES)
    names = [*_NUMBERS, "ends_sha256", "key", "parent_key"]
    first, *later = [one.where(F.col("kind") == _NODE).select(names) for one in passes]
    edges = staged(reduce(DataFrame.unionByName, later).drop("ends_sha256"), "trie-edges")
    ends = _ends(passes[0].where(F.col("kind") == _ENDS))
    edges = edges.join(ends, "key", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_NO_ENDS)))
    # A parent on the edge of a block was not known there. Edges are a few rows per block.
    parents = edges.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent"))
    nodes = first.unionByName(edges.select(names)).drop("key")
    settled = nodes.where("parent_key is null").withColumn("parent", F.lit(None).cast("bigint"))
    open_ = nodes.where("parent_key is not null").join(limited_broadcast(parents), "parent_key")
    every = settled.unionByName(open_)
    return every.select(
        *[F.coalesce("parent_conv_id", "parent").alias(name) if name == "parent_conv_id" else name for name in _NUMBERS],
        "ends_sha256",
    )


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of rebuilt conversations."""
    return trie(rebuilt(sequences(conversations)))
