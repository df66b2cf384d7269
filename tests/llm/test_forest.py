"""Recall against brute force, exact scores, and odd vectors."""

import numpy as np
from pyspark.sql import functions as F

from millrace.llm import forest


def brute(ids, x, query, own, k):
    far = np.sqrt(((x - query) ** 2).sum(axis=1))
    order = [i for i in np.lexsort((ids, far)) if ids[i] != own][:k]
    return [(int(ids[i]), float(far[i])) for i in order]


def test_recall_and_scores(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    local = rows.toPandas()
    ids, x = local.vec_id.to_numpy(), np.array(local.embedding.tolist(), dtype=float)
    found = forest.nearest(rows, F.col("vec_id") % 100 == 0).collect()
    hits = 0
    for query in range(0, len(ids), 100):
        mine = [(r.vec_id, r.score) for r in sorted((r for r in found if r.query_id == query), key=lambda r: r["rank"])]
        assert len(mine) == 10 and mine == sorted(mine, key=lambda m: (m[1], m[0]))
        true = brute(ids, x, x[ids == query][0], query, 10)
        hits += len({m[0] for m in mine} & {t[0] for t in true})
        known = {i: s for i, s in brute(ids, x, x[ids == query][0], query, len(ids))}
        assert all(abs(known[i] - s) < 1e-12 for i, s in mine)
    assert hits >= 0.9 * 10 * len(range(0, len(ids), 100))


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, None), (3, [0.0, -0.0]), (4, [nan, 1.0]), (5, [None, 1.0]), (6, [1.0]), (None, [1.0, 2.0]), (7, [2.0, 2.0]), (100, [2.0, 3.0]), (8, [inf, 5.0]), (200, [0.0, 0.0]), (9, [])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("vec", F.lit(1)).withColumn("ids", F.lit(1))
    found = forest.nearest(frame, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in found] == [(0, 1, 1), (0, 2, 7), (0, 3, 100), (100, 1, 7), (100, 2, 0), (100, 3, 1)]
    assert forest.nearest(frame.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_a_hot_vector_keeps_the_smallest_ids(spark):
    frame = spark.range(3000).select(F.col("id").alias("vec_id"), F.when(F.col("id") % 3 > 0, F.array(F.lit(1.0), F.lit(1.0))).otherwise(F.array(F.rand(1), F.rand(2))).alias("embedding"))
    found = forest.nearest(frame, F.col("vec_id") == 100).orderBy("rank").collect()
    assert [r.vec_id for r in found] == [1, 2, 4, 5, 7, 8, 10, 11, 13, 14] and {r.score for r in found} == {0.0}


def test_a_query_of_another_length_takes_no_part_in_a_small_table(spark):
    rows = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, 3.0]), (2, [2.0, 2.0]), (100, [1.0])], "vec_id long, embedding array<double>")
    found = forest.nearest(rows, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.vec_id) for r in found] == [(0, 1), (0, 2)]


def test_leaves_in_blocks_give_the_same_neighbours(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.normal(size=(600, 8)))], "vec_id long, embedding array<double>")
    whole = sorted(map(tuple, forest.nearest(rows, F.col("vec_id") % 100 == 0).collect()))
    monkeypatch.setattr(forest, "GROUP", 10)
    assert sorted(map(tuple, forest.nearest(rows, F.col("vec_id") % 100 == 0).collect())) == whole
