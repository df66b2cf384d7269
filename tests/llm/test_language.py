"""Forward-backward against all labellings, held-out accuracy, code-switched and odd texts."""

from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import language

DOCS = "/root/testdata/sf0.01/documents.parquet"


@pytest.fixture(scope="module")
def field(spark):
    return language.fit(spark.read.parquet(DOCS))


def test_posteriors_equal_the_sum_over_all_labellings():
    rng = np.random.default_rng(1)
    emitted, moves = rng.normal(size=(5, 1, 3)), rng.normal(size=(3, 3))
    weights, marginals, pairs = 0.0, np.zeros((5, 3)), np.zeros((3, 3))
    for labels in product(range(3), repeat=5):
        score = sum(emitted[t, 0, k] for t, k in enumerate(labels)) + sum(moves[a, b] for a, b in zip(labels, labels[1:], strict=False))
        w = np.exp(score)
        weights += w
        for t, k in enumerate(labels):
            marginals[t, k] += w
        for a, b in zip(labels, labels[1:], strict=False):
            pairs[a, b] += w
    found, expected = language.posterior(emitted, moves)
    assert np.allclose(found[:, 0], marginals / weights) and np.allclose(expected, pairs / weights)


def test_padding_changes_nothing():
    rng = np.random.default_rng(2)
    field = language.Field([], [])
    field.moves = rng.normal(size=(3, 3))
    scores = rng.normal(size=(7, 3))
    texts = [[0, 1, 2, 3, 4, 5, 6], [3], [], [6, 5]]
    found = dict(language.marginals_of(field, texts, scores))
    assert sorted(found) == [0, 1, 3]
    for i, own in found.items():
        alone, _ = language.posterior(scores[texts[i]][:, None], field.moves)
        assert np.allclose(own, alone[:, 0])


def test_held_out_accuracy(spark, field):
    docs = spark.read.parquet(DOCS).select("doc_id", "text", "lang", language.held_out(F.col("doc_id")).alias("held_out"))
    found = language.identified(docs, field).where("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in found]) > 0.98
    assert all(0 <= r.score <= 1 for r in found)


def test_code_switched_words(spark):
    docs = [r for r in spark.read.parquet(DOCS).select("doc_id", "text", "lang").orderBy("doc_id").collect() if r.lang in ("en", "fr")]
    field = language.fit(spark.read.parquet(DOCS))
    first = lambda lang: next(r.text for r in docs if r.lang == lang and len(r.text) > 900)
    english, french = ([w for w in first(lang).split() if language.usable(w)][40:60] for lang in ("en", "fr"))
    (_, score, runs), *_ = language.read(field, [" ".join(english + french)], True)
    labels = [r["lang"] for r in runs for _ in range(r["words"])]
    right = sum(a == b for a, b in zip(labels, ["en"] * 20 + ["fr"] * 20, strict=False))
    assert right >= 36 and 0.4 < score < 0.65


def test_odd_texts(spark, field):
    rows = [(1, None, None), (2, "", "en"), (3, "12 34 ...", "en"), (None, "the of and", None), (5, "É", "fr"), (5, "É", "fr"), (6, "the\u2028of " * 60_000, "en")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("clash"))
    found = language.identified(frame, field, runs=True).collect()
    assert len(found) == len(rows)
    for row in found:
        if row.doc_id in (1, 2, 3):
            assert (row.lang_pred, row.score) == ("und", 0.0)
        else:
            assert row.lang_pred in field.labels
    assert language.identified(frame.limit(0), field).count() == 0
    kept = language.accepted(frame, field)
    assert kept.columns == frame.columns and kept.where("doc_id in (1, 2, 3)").count() == 0


def test_nothing_to_learn_from(spark):
    frame = spark.createDataFrame([(1, "some words", None)], "doc_id long, text string, lang string")
    found = language.identified(frame, language.fit(frame)).first()
    assert (found.lang_pred, found.score) == ("und", 0.0)
    alone = spark.createDataFrame([(i, "some words", "xx") for i in range(8)], "doc_id long, text string, lang string")
    assert language.identified(alone, language.fit(alone)).first().lang_pred == "xx"


def test_long_words_are_spelled_in_parts(monkeypatch):
    """The slots of a word cut into parts are those of the word as a whole."""
    import numpy as np

    for part in (5, 7, 64):
        monkeypatch.setattr(language, "PART_CHARS", part)
        for word in ("a", "abcdé", "x" * 62, "y" * 63, "z" * 64, "".join(chr(97 + i * i % 26) for i in range(501))):
            whole, _ = language.spelled([word])
            parts = np.concatenate(list(language.spelled_in_parts(word)))
            assert sorted(parts.tolist()) == sorted(whole.tolist())


def test_a_word_of_twenty_megabytes_takes_little_memory():
    import tracemalloc

    field = language.Field(["de", "en"], [("de", ["haus", "baum"] * 30), ("en", ["house", "tree"] * 30)])
    word = "Zm9vYmFy" * 2_500_000
    tracemalloc.start()
    found = language.read(field, [word, "a house"], False)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found[1][0] == "en" and found[0][0] in ("de", "en")
    assert peak < 300_000_000


def test_text_in_four_languages_is_accepted(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    field = language.fit(docs)
    by_lang = {r["lang"]: r["text"].split()[:60] for r in docs.where("length(text) > 800 and lang is not null").select("lang", "text").collect()}
    assert len(by_lang) == 4
    switched = " ".join(" ".join(by_lang[k][i : i + 20]) for i in range(0, 60, 20) for k in sorted(by_lang))
    rows = spark.createDataFrame([(1, switched, "x"), (2, "12 34 -- !!", "x"), (3, None, "x")], "doc_id long, text string, lang string")
    assert [r["doc_id"] for r in language.accepted(rows, field).collect()] == [1]
