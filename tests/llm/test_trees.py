"""The manifest of a dataset and the trie of conversations against brute force."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from sluice.llm import merkle, trie

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, total bigint, grp string"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def brute_tree(leaves):
    """The root, and per leaf its path of (place, run)."""
    level, paths, at = list(leaves), [[] for _ in leaves], list(range(len(leaves)))
    while len(level) > 1:
        runs = [level[i : i + 16] for i in range(0, len(level), 16)]
        for leaf, place in enumerate(at):
            paths[leaf].append((place % 16, runs[place // 16]))
            at[leaf] = place // 16
        level = [h("".join(run)) for run in runs]
    return level[0], paths


def brute_audit(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row[1]].append(row)
    names = sorted(groups, key=lambda name: (name is not None, (name or "").encode()))
    trees = []
    for name in names:
        members = sorted(groups[name], key=lambda row: (row[0] is not None, row[0] or 0, leaf_of(row)))
        trees.append((members, *brute_tree([leaf_of(row) for row in members])))
    root, upper = brute_tree([subroot for _, subroot, _ in trees])
    found = []
    for (members, subroot, paths), above in zip(trees, upper, strict=True):
        for row, path in zip(members, paths, strict=True):
            steps = path + above
            proof = "".join("".join(d for i, d in enumerate(run) if i != place) for place, run in steps)
            value = leaf_of(row)
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None:
                changed = "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4])
                value = leaf_of((*row[:4], changed))
            for place, run in steps:
                value = h("".join([*run[:place], value, *run[place + 1 :]]))
            found.append((row[0], leaf_of(row), subroot, root, h(proof), len(proof) // 64, value, value == root))
    return sorted(found, key=repr)


def rows_of(seed, count):
    rng = random.Random(seed)
    sources = [None, "", "a", "ß", "zz", "\U0001f600"]
    odd = [(None, None, None, None, None), (None, "a", "en", 3, "ABC"), (7, "a", "en", 3, ""), (7, "a", "en", 3, "")]
    return odd + [
        (rng.randrange(count), rng.choice(sources) if i % 3 else "hot", None, i, rng.choice(["Abc É", None, "", "x" * 3000]))
        for i in range(count)
    ]


@pytest.mark.parametrize("levels", [(2, 3), (1, 1)])
def test_manifest(spark, monkeypatch, levels):
    monkeypatch.setattr(merkle, "LEAF_LEVELS", levels[0])
    monkeypatch.setattr(merkle, "LEVELS", levels[1])
    rows = rows_of(3, 900)
    frame = spark.createDataFrame([(*row, 1, "clash") for row in rows], SCHEMA)
    found = merkle.audit(frame).collect()
    assert sorted(map(tuple, found), key=repr) == brute_audit(rows)
    assert any(not row.verified for row in found) and any(row.verified for row in found)


def test_manifest_of_many_groups(spark):
    rows = [(i, f"s{i % 300}", "en", i, "Text") for i in range(600)]
    frame = spark.createDataFrame([(*row, 1, "clash") for row in rows], SCHEMA)
    assert sorted(map(tuple, merkle.audit(frame).collect()), key=repr) == brute_audit(rows)


def test_manifest_of_few_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert merkle.audit(empty).collect() == []
    one = [(1, "a", "en", 4, "Text")]
    found = merkle.audit(spark.createDataFrame([(*one[0], 1, "x")], SCHEMA)).collect()
    assert [tuple(row) for row in found] == brute_audit(one)
    assert found[0].leaf == found[0].root and found[0].proof_sha256 == h("")


def test_manifest_nodes(spark):
    rows = [(i, "a" if i % 4 else "b", "en", i, "Text") for i in range(700)]
    built = merkle.build(spark.createDataFrame([(*row, 1, "x") for row in rows], SCHEMA))
    nodes = {(row.tree, row.level, row.place): row.digest for row in merkle.nodes(built).collect()}
    groups = {row.source: row for row in built.groups.collect()}
    for name in ("a", "b"):
        level = [leaf_of(row) for row in rows if row[1] == name]
        assert groups[name].n_leaves == len(level)
        depth = 0
        while len(level) > 1:
            level = [h("".join(level[i : i + 16])) for i in range(0, len(level), 16)]
            depth += 1
            for place, digest in enumerate(level):
                assert nodes.pop(("1" + name, depth, place)) == digest
        assert groups[name].subroot == level[0]
    assert nodes == {("", 1, 0): built.root.first()[0]}


def test_sweeps_agree_with_levels():
    for count in (1, 2, 15, 16, 17, 31, 255, 256, 257, 300):
        leaves = [h(str(i)) for i in range(count)]
        top = merkle.height(count, 9)
        nodes = merkle.forward(leaves, top)
        root, paths = brute_tree(leaves)
        assert (nodes[-1].digest if nodes else leaves[0]) == root
        chains = dict(merkle.backward(nodes, count, top, ()))
        assert [merkle.listed(chains[i]) for i in range(count)] == [[(p, "".join(run)) for p, run in path] for path in paths]
        assert {merkle.folded(leaves[i], chains[i]) for i in range(count)} == {root}


# Conversations


def brute_trie(paths):
    """Nodes of ``{conv_id: [(role, text), ...]}``."""
    nodes = defaultdict(list)
    for conv, path in paths.items():
        for depth in range(len(path) + 1):
            nodes[tuple(path[:depth])].append(conv)
    kids = defaultdict(list)
    for node in nodes:
        if node:
            kids[node[:-1]].append(node)
    subtree = {}
    for node in sorted(nodes, key=len, reverse=True):
        own = (len(nodes[node]) - 1) * len(node[-1][1]) if node else 0
        below = [subtree[kid] for kid in kids[node]]
        subtree[node] = (sum(b[0] for b in below) or 1, own + sum(b[1] for b in below))
    found = []
    for node, members in nodes.items():
        ends = sorted(conv for conv in members if len(paths[conv]) == len(node))
        parent = min(nodes[node[:-1]]) if node else None
        found.append(
            (min(members), len(node), parent, len(members), len(kids[node]), *subtree[node], h(",".join(map(str, ends))))
        )
    return sorted(found, key=repr)


def brute_rebuilt(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {conv: [turn[2:] for turn in sorted(turns)] for conv, turns in own.items()}
    found = {}
    for conv, turns in own.items():
        n = zlib.crc32(str(conv).encode()) % 6
        found[conv] = own.get(conv - conv % 100, [])[:n] + turns[n:]
    return found


TURNS = "conv_id bigint, turn bigint, role string, text string, key string, path string"


def turns_of(seed, count, words):
    rng = random.Random(seed)
    rows = []
    for conv in rng.sample(range(10 * count), count):
        for turn in range(rng.choice([1, 2, 3, 5, 9])):
            rows.append((conv, turn if turn else None, rng.choice([None, "user"]), rng.choice(words)))
    return rows + [(100, turn, "user", f"turn {turn}") for turn in range(120)] + [(None, 1, "user", "x")]


@pytest.mark.parametrize(("words", "cells"), [(["a", "b", None, "é😀"], 400_000), (["a", "b", None, "é😀"], 60), (["same"], 40)])
def test_trie(spark, words, cells):
    rows = turns_of(5, 400, words)
    frame = spark.createDataFrame([(*row, "clash", "clash") for row in rows], TURNS)
    found = trie.trie(trie.rebuilt(trie.sequences(frame)), cells=cells)
    assert sorted(map(tuple, found.collect()), key=repr) == brute_trie(brute_rebuilt(rows))


def test_trie_of_copies(spark):
    """Most conversations are one and the same: its ends lie in many blocks."""
    rows = [(conv, turn, "user", f"t{turn}") for conv in range(1, 1500) for turn in range(2) if conv % 100]
    rows += [(5000, 0, "user", "other"), (5001, 1, None, "y" * 100_000)]
    frame = spark.createDataFrame([(*row, "clash", "clash") for row in rows], TURNS)
    found = trie.trie(trie.sequences(frame), cells=200)
    own = defaultdict(list)
    for conv, _, role, text in rows:
        own[conv].append((role or "", text))
    assert sorted(map(tuple, found.collect()), key=repr) == brute_trie(own)


def test_trie_of_no_turns(spark):
    assert trie.conversation_trie(spark.createDataFrame([], TURNS)).collect() == []
    # Of these, the first turns are replaced by those of a conversation that is not there.
    rows = [(conv, 0, "user", "x", "", "") for conv in range(1, 60) if zlib.crc32(str(conv).encode()) % 6]
    (root,) = trie.conversation_trie(spark.createDataFrame(rows, TURNS)).collect()
    assert (root.depth, root.n_convs, root.n_children, root.n_leaves, root.saved_tokens) == (0, len(rows), 0, 1, 0)
    assert root.ends_sha256 == h(",".join(str(row[0]) for row in rows)) and root.parent_conv_id is None


def test_dense_ids():
    hashes = np.array([[5, 1], [0, 9], [5, 1], [5, 0]], np.uint64)
    assert trie._dense(hashes).tolist() == [2, 0, 2, 1]
    assert trie._dense(hashes[:0]).tolist() == []
