"""The prefix trie against dictionaries of prefixes."""

import hashlib
import random
import zlib

import pytest

from millrace.llm import queries, trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, conv string, place string, block int"
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(paths):
    """The rows of the trie of {conversation: [(role, text)]}."""
    members = {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members.setdefault(tuple(path[:d]), []).append(c)
    children = {p: [q for q in members if len(q) == len(p) + 1 and q[: len(p)] == p] for p in members}
    rows = []
    for path, own in members.items():
        below = [q for q in members if q[: len(path)] == path]
        saved = sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in below if q)
        ends = ",".join(map(str, sorted(c for c in own if len(paths[c]) == len(path))))
        rows.append((
            min(own), len(path), min(members[path[:-1]]) if path else None, len(own), len(children[path]),
            sum(not children[q] for q in below), saved, hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(rows, key=repr)


def found(nodes, ends):
    whole = nodes.join(queries.member_digests(ends), ["depth", "k1", "k2"], "left").fillna({"ends_sha256": queries.EMPTY_SHA256})
    return sorted(map(tuple, whole.select(*NAMES).collect()), key=repr)


def frame(spark, paths, rng):
    rows = [(c, n, role, text, "clash", "x", 1) for c, path in paths.items() for n, (role, text) in enumerate(path)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("width", [1, 3, 4])
def test_nodes_equal_brute_force(spark, width):
    rng = random.Random(width)
    paths = {c: [(rng.choice("ua"), rng.choice(["", "é", "b"])) for _ in range(rng.randint(1, 11))] for c in range(-20, 60)}
    paths |= {c: [("u", "hi"), ("a", "ho")] for c in range(100, 130)}
    paths[300] = paths[301] = [("u", "x" * 100_000)] * 30
    turns = trie.placed(trie.hashed_turns(frame(spark, paths, rng), "conv_id", "turn", "role", "text"))
    paths |= {400: [], 401: []}
    ids = spark.createDataFrame([(c,) for c in paths], "conv bigint")
    assert found(*trie.trie(turns, ids, width)) == brute(paths)


def test_rebuilt_conversations(spark):
    rng = random.Random(3)
    own = {c: [(rng.choice(["user", "assistant"]), f"t{rng.randint(0, 2)}") for _ in range(rng.randint(1, 12))] for c in rng.sample(range(-30, 90), 70)}
    rows = [(c, n, role, text, None, None, None) for c, path in own.items() for n, (role, text) in enumerate(path)]
    rows += [(*row, None, None, None) for row in [(500, None, None, "first"), (500, 1, "user", None), (None, 1, "user", "lost")]]
    own[500] = [("", "first"), ("user", "")]
    paths = {}
    for c, path in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        paths[c] = own.get(base, [])[:h] + path[h:]
    assert any(not p for p in paths.values())
    turns, ids = queries.rebuilt(spark.createDataFrame(rows, SCHEMA))
    assert found(*trie.trie(turns, ids)) == brute(paths)


def test_empty_table(spark):
    turns, ids = queries.rebuilt(spark.createDataFrame([], SCHEMA))
    assert found(*trie.trie(turns, ids)) == []


def test_only_turnless_conversations(spark):
    turns, _ = queries.rebuilt(spark.createDataFrame([], SCHEMA))
    ids = spark.createDataFrame([(9,), (4,)], "conv bigint")
    assert found(*trie.trie(turns, ids)) == brute({4: [], 9: []})
