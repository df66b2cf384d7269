"""Targets against repeated sharing, balance of the flight, and odd rows."""

from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import mixing


def shared(sizes):
    """Targets by sharing the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(names)}
    target, capped, left = {}, set(), 1.5 * sum(sizes.values())
    while True:
        open_ = [s for s in names if s not in capped]
        if not open_:
            return target
        rest = left - sum(target[s] for s in capped)
        for s in open_:
            target[s] = rest * weight[s] / sum(weight[o] for o in open_)
        above = [s for s in open_ if target[s] > 2 * sizes[s] + 1e-9]
        if not above:
            return target
        for s in above:
            target[s], _ = 2.0 * sizes[s], capped.add(s)


@pytest.mark.parametrize("sizes", [{"a": 10}, {"a": 100, "b": 1, "c": 1, None: 7}, {"z": 0, "y": 0}, {"é": 5, "z": 50, "a": 3, "b": 9, None: 100}])
def test_targets(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, size long")
    found = {r.source: r.target for r in mixing.targets(rows).collect()}
    assert found.keys() == sizes.keys()
    for source, target in shared(sizes).items():
        assert abs(found[source] - target) < 1e-6


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.floats(0, 1), st.integers(0, 500), st.floats(0, 0.999)), max_size=60))
def test_the_flight_keeps_both_totals(units):
    chance, words, noise = (np.array(c, dtype=float) for c in (zip(*units, strict=True) if units else ([], [], [])))
    moved = mixing.flight(chance, words, noise)
    assert ((moved >= 0) & (moved <= 1)).all()
    assert ((moved > mixing.NEAR) & (moved < 1 - mixing.NEAR)).sum() < 3
    assert abs(moved.sum() - chance.sum()) < 1e-5 and abs(moved @ words - chance @ words) < 1e-3
    landed = mixing.landed(chance, words, noise)
    assert set(landed.tolist()) <= {0.0, 1.0}


def test_chances_are_kept_on_average():
    rng = np.random.default_rng(1)
    chance, words = np.full(12, 0.3), rng.integers(1, 100, 12).astype(float)
    runs = np.mean([np.round(mixing.flight(chance, words, rng.random(12))) for _ in range(800)], axis=0)
    assert np.abs(runs - 0.3).max() < 0.12


def documents(spark):
    rng = np.random.default_rng(2)
    rows = [(i, "w " * int(rng.integers(1, 60)), f"s{i % 4}") for i in range(900)]
    rows += [(1000, None, "s1"), (1001, "", None), (None, "a b c", None), (None, "a b c", None), *[rows[1]] * 7]
    return rows, spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, source string, size int")


def test_words_come_near_and_reruns_agree(spark):
    rows, frame = documents(spark)
    found = mixing.mixed(frame).collect()
    assert len(found) == len(rows)
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    source_of = {r[0]: r[2] for r in rows}
    for row in found:
        source = source_of[row.doc_id]
        sizes[source] += row.size
        taken[source] += row.taken
        target[source] = row.target
        assert row.taken in (0, row.size, 2 * row.size)
    for source, aim in shared(sizes).items():
        assert abs(target[source] - aim) < 1e-6 and abs(taken[source] - aim) <= max(12, 0.01 * aim)
    again = mixing.mixed(frame.repartition(5)).collect()
    assert Counter(map(tuple, found)) == Counter(map(tuple, again))


def test_the_mixture_has_the_rows_that_are_taken(spark):
    _, frame = documents(spark)
    mixture = mixing.mixture(frame)
    assert mixture.columns == frame.columns
    words = Counter()
    for row in mixture.collect():
        words[row.doc_id] += len((row.text or "").split())
    taken = Counter()
    for row in mixing.mixed(frame).collect():
        taken[row.doc_id] += row.taken
    assert +words == +taken


def test_empty_table(spark):
    _, frame = documents(spark)
    assert mixing.mixed(frame.limit(0)).count() == 0 and mixing.mixture(frame.limit(0)).count() == 0


def test_map_columns_pass(spark):
    docs = spark.createDataFrame([(i // 2, "a b c d", "s", {"k": i % 2}) for i in range(40)], "doc_id long, text string, source string, extra map<string,int>")
    assert mixing.mixture(docs).columns == docs.columns and mixing.mixture(docs).count() > 0


def rounds_of(units, monkeypatch, **more):
    """The decided units, and the undecided units that each round started with."""
    sizes, plain = [], mixing.flown

    def counted(frame):
        sizes.append(frame.count())
        return plain(frame)

    monkeypatch.setattr(mixing, "flown", counted)
    rows = mixing.decided(units, **more).collect()
    return rows, sizes


def units_of(spark, counts):
    """Units of sources, ``counts`` giving how many each has; every third chance is decided already."""
    rng = np.random.default_rng(3)
    rows = [
        (int(k), source, int(rng.integers(1, 60)), [0.4, 0.75, 1.0][k % 3])
        for k, source in enumerate(s for s, n in counts.items() for _ in range(n))
    ]
    return rows, spark.createDataFrame(rows, "key long, source string, size long, chance double")


def check_totals(rows, found, near):
    assert Counter((r.key, r.source, r.size) for r in found) == Counter(r[:3] for r in rows)
    assert all(min(r.chance, 1 - r.chance) < 1e-6 for r in found)
    aim, taken = defaultdict(float), defaultdict(float)
    for _, source, size, chance in rows:
        aim[source] += size * chance
    for r in found:
        taken[r.source] += r.size * round(r.chance)
    assert all(abs(aim[s] - taken[s]) <= near for s in aim)


def test_many_small_sources_take_one_round(spark, monkeypatch):
    rows, units = units_of(spark, {f"s{i}": 2 for i in range(3_000)} | {None: 2})
    found, sizes = rounds_of(units, monkeypatch, shard=500)
    assert len(sizes) == 1
    check_totals(rows, found, 60)


def test_rounds_grow_with_the_logarithm_of_the_largest_source(spark, monkeypatch):
    rows, units = units_of(spark, {"hot": 6_000, None: 500} | {f"s{i}": 3 for i in range(400)})
    found, sizes = rounds_of(units, monkeypatch, shard=40)
    assert len(sizes) <= 4 and all(b <= a / 8 for a, b in zip(sizes, sizes[1:], strict=False))
    check_totals(rows, found, 60)
    again, _ = rounds_of(units.repartition(7), monkeypatch, shard=40)
    assert Counter(map(tuple, found)) == Counter(map(tuple, again))


def test_rounds_end_with_the_smallest_shards(spark, monkeypatch):
    rows, units = units_of(spark, {"a": 90, "b": 1})
    found, _ = rounds_of(units, monkeypatch, shard=1)
    check_totals(rows, found, 60)
