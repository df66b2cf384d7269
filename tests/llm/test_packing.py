"""Tokens against the tokenizer, best fit against a scan, and exact round trips."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from millrace.llm import matrices, packing
from millrace.llm.tokens import Encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def both():
    plain = Tokenizer.from_file(PATH)
    plain.encode_special_tokens = True
    return Encoder(PATH), plain


def expected(plain, text):
    return [*plain.encode(text or "", add_special_tokens=False).ids, 0]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=" \n\t\r\x0b\x1cab's1²é½.,<|>\u0085\u3000🙂", max_size=20), max_size=5))
def test_ids_are_the_tokenizers(both, texts):
    found = both[0].encode(pa.array(texts, pa.string()))
    assert [f.tolist() for f in found] == [expected(both[1], t) for t in texts]


def test_ids_of_odd_texts(both):
    texts = [None, "", "<|endoftext|>", "a  b\n\n c", "it's we'll", "word " * 5000, "x" * 3000]
    assert [f.tolist() for f in both[0].encode(pa.array(texts))] == [expected(both[1], t) for t in texts]


def scanned(lengths, window):
    """Best fit decreasing by looking at every window."""
    rooms = []
    for need in sorted(lengths, reverse=True):
        fits = [i for i, r in enumerate(rooms) if r >= need]
        if fits:
            rooms[min(fits, key=lambda i: rooms[i])] -= need
        else:
            rooms.append(window - need)
    return sorted(rooms)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=60), st.sampled_from([64, 100, 127]))
def test_best_fit_equals_a_scan(lengths, window):
    numbers, offsets, opened = packing.best_fit(np.array(lengths, dtype=np.int64), window)
    ends = [0] * opened
    for number, offset, length in sorted(zip(numbers.tolist(), offsets.tolist(), lengths, strict=True)):
        assert ends[number] == offset
        ends[number] = offset + length
    assert sorted(window - e for e in ends) == scanned(lengths, window)


def documents(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choices(["alpha", "of", "zebra.", "ñu\n"], k=rng.choice([1, 30, 400, 3000]))), "clash") for i in range(60)]
    rows += [(100, None, "x"), (101, "", "x"), (None, "no id", "x"), rows[0], rows[0]]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, ids string")


@pytest.mark.parametrize("way", ["pieces", "matrices"])
def test_every_id_lies_in_one_piece(spark, both, way):
    rows, frame = documents(spark)
    if way == "pieces":
        found = packing.pieces(frame, PATH, with_ids=True).collect()
    else:
        found = matrices.unpacked(matrices.rows(frame, PATH), with_ids=True).collect()
    whole = defaultdict(list)
    for row in found:
        assert zlib.crc32(np.array(row.ids, dtype="<u4").tobytes()) == row.ids_crc32 and len(row.ids) == row.length
        whole[row.doc_id].append((row.start, row.ids, row.doc_tokens))
    for doc_id, text, _ in rows[1:-2]:
        ids = expected(both[1], text)
        assert [i for _, own, _ in sorted(whole[doc_id]) for i in own] == ids
        assert {n for _, _, n in whole[doc_id]} == {len(ids)}
    assert len(whole[0]) == 3 * len({s for s, _, _ in whole[0]})
    ends = defaultdict(int)
    for row in sorted(found, key=lambda r: (r.sequence_id, r.offset)):
        assert row.offset == ends[row.sequence_id]
        ends[row.sequence_id] += row.length
    assert max(ends.values()) <= packing.WINDOW


def test_rows_hold_lengths_resets_and_padding(spark):
    _, frame = documents(spark)
    for row in matrices.rows(frame, PATH).collect():
        ids = np.frombuffer(row.ids, dtype="<u2")
        assert len(ids) == packing.WINDOW and row.cu_seqlens[0] == 0 and row.resets == row.cu_seqlens[:-1]
        assert (ids[row.cu_seqlens[-1] :] == matrices.PAD).all() and len(row.segments) == len(row.resets)
        positions = matrices.positions(row.cu_seqlens)
        assert np.flatnonzero(positions[: row.cu_seqlens[-1]] == 0).tolist() == row.resets


def test_empty_table(spark):
    _, frame = documents(spark)
    assert packing.pieces(frame.limit(0), PATH).count() == 0
    assert matrices.unpacked(matrices.rows(frame.limit(0), PATH)).count() == 0


def test_a_buffer_ends_soon_after_it_is_full():
    texts = pa.array(["q7" * 250_000] * 20)  # each character is a token
    batch = pa.RecordBatch.from_arrays([pa.array(range(20)), texts], ["doc_id", "text"])
    sizes = [sum(map(len, ids)) for _, ids in packing.buffers(iter([batch]), PATH)]
    assert sum(sizes) == 20 * 500_001
    assert max(sizes) <= packing.BUFFER_TOKENS + 2_500_000
