"""The impact-ordered search against all inner products."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import impacts

SCHEMA = "vec_id bigint, embedding array<double>, score string, rank string, shard int"


LONG = 2**63


def brute(rows, k=10, divisor=100):
    best = {}
    for i, v, *_ in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        best.setdefault(i, set()).add(tuple(math.floor(1024 * x) for x in v))
    found = []
    for q in sorted(i for i in best if i % divisor == 0):
        scores = {}
        for own in best[q]:
            for i, vectors in best.items():
                for v in vectors if i != q else ():
                    scores[i] = max(scores.get(i, -math.inf), max(-LONG, min(LONG - 1, sum(a * b for a, b in zip(own, v, strict=False)))))
        order = sorted(scores, key=lambda i: (-scores[i], i))[:k]
        found += [(q, n, i, scores[i]) for n, i in enumerate(order, 1)]
    return found


def found(spark, rows, **options):
    frame = spark.createDataFrame([(*r, "clash", "x", 1) for r in rows], SCHEMA)
    return sorted(map(tuple, impacts.top(frame, F.col("vec_id") % 100 == 0, **options).collect()))


def vectors(seed, count, width, centres=0):
    rng = np.random.default_rng(seed)
    out = rng.normal(size=(count, width))
    if centres:
        out = rng.normal(size=(centres, width))[rng.integers(centres, size=count)] + 0.1 * out
    return out


@pytest.mark.parametrize("width,centres", [(64, 0), (16, 20), (3, 0)])
def test_members_are_proven(width, centres):
    """Whatever is left out of a shard lies below its k best; structure lets processing stop early."""
    values = np.floor(1024 * vectors(width, 3000, width, centres)).astype(np.int64)
    shard = impacts.Shard.build(values, np.arange(3000), np.arange(3001))
    share = []
    for query in values[::100]:
        scores = values @ query
        may, read = impacts.members(shard, query, 11)
        assert set(np.argsort(-scores, kind="stable")[:11]) <= set(may) or set(np.flatnonzero(scores > np.sort(scores)[-12])) <= set(may)
        assert len(may) < 3000
        share.append(read / values.size)
        floor = float(np.sort(scores)[-3])
        assert set(np.flatnonzero(scores >= floor)) <= set(impacts.members(shard, query, 11, floor)[0])
    assert np.mean(share) < 0.9


def test_postings_hold_every_component_once():
    values = np.floor(100 * vectors(1, 500, 7)).astype(np.int64)
    shard = impacts.Shard.build(values, np.arange(500), np.arange(501), levels=5)
    for c in range(7):
        own = shard.postings[shard.ends[c * 5] : shard.ends[c * 5 + 5]]
        assert sorted(own) == list(range(500))
        for level in range(5):
            part = values[shard.postings[shard.ends[c * 5 + level] : shard.ends[c * 5 + level + 1]], c]
            assert ((part - shard.low[c]) // shard.step[c] == level).all()


def test_equals_brute_force_over_many_shards(spark):
    rows = [(i, v.tolist()) for i, v in enumerate(vectors(5, 1500, 12, 30))]
    rng = random.Random(2)
    hot = vectors(6, 1, 12)[0].tolist()
    rows += [(2000 + i, hot) for i in range(300)]  # one vector in many rows
    rows += [(i, rows[rng.randint(0, 1400)][1]) for i in range(3000, 3100)]
    rows += rng.sample(rows, 200)  # repeated rows
    assert found(spark, rows, shard=128) == brute(rows)


def test_odd_vectors(spark):
    rows = [(i, [float(i % 7 - 3), 0.5, -i / 9.0]) for i in range(120)]
    rows += [
        (None, [1.0, 1.0, 1.0]), (200, None), (201, [1.0, None, 0.0]), (300, [math.nan, 0.0, 0.0]), (400, [math.inf, 1.0, 1.0]),
        (500, [0.0, 0.0, 0.0]), (600, []), (700, [2.0]), (701, [1.0, 2.0, 3.0, 4.0, 5.0]), (800, [1.0, -2.0, 3.0, -4.0, 5.0, 1.0]),
        (50, [9.0, 9.0, 9.0]), (50, [8.0, 8.0, 8.0]), (100, [-1.0, 7.0, 2.0]), (900, [-0.0, 1e-9, -1e-9]),
    ]
    assert found(spark, rows) == brute(rows)


def test_ids_with_many_vectors(spark):
    rows = [(i % 12, [float(i), 1.0]) for i in range(400)] + [(i, [0.1 * i, 1.0]) for i in range(100, 140)] + [(100, [3.0, 3.0])]
    assert found(spark, rows, k=5, shard=64) == brute(rows, k=5)


def test_large_components(spark):
    rows = [(i, [(-1.0) ** i * 10.0**i, 1.0, 3.0]) for i in range(0, 13)] + [(100, [1e9, -1e8, 1.0]), (200, [-1e12, 1e12, 5.0])]
    assert found(spark, rows) == brute(rows)
    assert len(found(spark, [(0, [1e300]), (1, [1e300]), (2, [-1e300])])) == 2


def test_few_rows_and_empty_table(spark):
    assert found(spark, []) == []
    assert found(spark, [(100, [1.0, 2.0])]) == []
    assert found(spark, [(100, [1.0, 2.0]), (7, [1.0, 2.0])]) == brute([(100, [1.0, 2.0]), (7, [1.0, 2.0])])
