"""Components against brute force over all pairs, and odd rows."""

import random
import re

import pytest
from pyspark.sql import functions as F

from millrace.llm import jaccard
from millrace.llm.components import components


def sets_of(rows):
    out = {}
    for key, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
        grams = {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()
        out.setdefault(key, []).append(grams)
    return out


def brute(rows):
    sets = sets_of(r for r in rows if r[0] is not None)
    items = [(k, s) for k, own in sets.items() for s in own if s]
    parent = {k: k for k in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, s) in enumerate(items):
        for b, t in items[i + 1 :]:
            if 100 * len(s & t) >= 75 * len(s | t):
                a_, b_ = root(a), root(b)
                parent[max(a_, b_)] = min(a_, b_)
    return {k: root(k) for k in sets}, sets


def made(seed):
    rng = random.Random(seed)
    common = [f"c{i}" for i in range(30)]
    rows = [(0, "X  y"), (1, "x y"), (2, None), (3, ""), (4, " \n"), (None, "x y"), (5, "one two three four five six"), (5, "x y"), (6, "x y z")]
    for g in range(8):
        base = [f"g{g}w{i}" for i in range(rng.choice([6, 20, 60]))]
        for k in range(rng.choice([1, 3, 25])):
            words = list(base)
            for _ in range(rng.randrange(4)):
                words[rng.randrange(len(words))] = f"n{rng.randrange(10**6)}"
            rows.append((100 + 100 * g + k, " ".join(words)))
    rows += [(2000 + i, " ".join([*common, *(f"t{i}_{j}" for j in range(rng.choice([3, 6, 30])))])) for i in range(40)]
    rows += [rows[10], rows[10]]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, seed):
    rows = made(seed)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).withColumn("node", F.lit(1)).withColumn("h", F.lit(2))
    expected, sets = brute(rows)
    found = jaccard.classes(frame).collect()
    assert len(found) == len(rows)
    for row in found:
        assert row.component_id == (None if row.doc_id is None else expected[row.doc_id])
        assert row.doc_id is None or row.n_shingles in {len(s) for s in sets[row.doc_id]}
    left = jaccard.unique(frame)
    assert left.columns == frame.columns
    kept = sorted(r.doc_id for r in left.where("doc_id is not null").collect())
    assert kept == sorted(set(expected.values())) and left.where("doc_id is null").count() == 1


def test_pairs_at_the_limit(spark):
    """21 shared of 28 shingles link, 21 of 29 do not."""
    words = [f"w{i}" for i in range(25)]
    rows = [(1, " ".join(words + ["a", "b", "c"])), (2, " ".join(words + ["d", "e", "f", "g"])), (11, " ".join("v" + w for w in words + ["a", "b", "c", "x"])), (12, " ".join("v" + w for w in words + ["d", "e", "f", "g"]))]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in jaccard.classes(frame).collect()} == brute(rows)[0] == {1: 1, 2: 1, 11: 11, 12: 12}


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.classes(frame).count() == 0 and jaccard.unique(frame).count() == 0


def test_components_of_a_long_path(spark):
    links = [(i, i + 1) for i in range(60)] + [(200, 100), (100, 150)]
    found = components(spark.createDataFrame(links, "a long, b long"))
    assert {r.node: r.component for r in found.collect()} == {**{i: 0 for i in range(61)}, 100: 100, 150: 100, 200: 100}


def test_map_columns_pass(spark):
    docs = spark.createDataFrame([(i, "one two three four five six", {"k": i}) for i in (1, 1, 2)], "doc_id long, text string, extra map<string,int>")
    assert [r["doc_id"] for r in jaccard.unique(docs).collect()] == [1]
