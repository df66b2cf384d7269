"""Archives: round trip, dictionary frame, revisits, and odd rows."""

import base64
import hashlib
import random
import struct
from collections import Counter

import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import warc


def digest(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def records(n):
    rng = random.Random(1)
    page = lambda i: f"<html><head><title>page {i}</title></head><body><p>{' '.join(rng.choices(['alpha', 'beta', 'gamma', 'delta'], k=80))}</p>"
    rows = [{"key": i, "url": f"http://e.x/{i}", "copy": 1, "digest": hashlib.sha1(page(i).encode()).hexdigest(), "is_response": False, "first_key": 0, "first_url": None, "bytes": 3, "body": None} for i in range(n)]
    return [warc.record(r) for r in rows]


def test_a_file_starts_with_its_dictionary_and_each_record_is_a_frame():
    raw = records(400)
    data = warc.archive(raw)
    assert data[:4] == struct.pack("<I", 0x184D2A5D)
    size = struct.unpack("<I", data[4:8])[0]
    dictionary = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(data[8 : 8 + size]))
    first = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj()
    assert first.decompress(data[8 + size :]) == raw[0]
    assert list(warc.records_of(data)) == raw


@settings(max_examples=30, deadline=None)
@given(st.lists(st.binary(max_size=300), min_size=1, max_size=6))
def test_any_bytes_come_back(raw):
    assert list(warc.records_of(warc.archive(raw))) == raw


@given(st.one_of(st.none(), st.integers(-(2**63), 2**63 - 1)), st.text())
def test_keys_come_back_from_names(key, label):
    assert warc.key_of(warc.record_id(key, label)) == key


def test_pages_come_back(spark, tmp_path):
    rows = [(1, "u\n x", "a", 1), (1, "u\n x", "a", 2), (2, None, "a", 3), (None, "v", "a", 4), (None, "v", None, 5), (None, "v", None, 6), (-5, "q", "", 7), (7, "z", "é" * 200_000, 8), (8, "w", "b", 9)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, digest int")
    folder = str(tmp_path / "warc")
    found = [r.asDict() for r in warc.read(spark, folder, warc.write(frame, folder), with_payload=True).collect()]
    assert len(found) == len(rows)
    payloads = {hashlib.sha1((t or "").encode()).digest(): (t or "").encode() for _, _, t, _ in rows}
    by_digest = Counter(base64.b32encode(d).decode() for d in payloads)
    responses = [r for r in found if r["record_type"] == "response"]
    assert Counter(r["payload_digest"] for r in responses) == by_digest
    assert all(digest(bytes(r["payload"])) == r["payload_digest"] for r in responses)
    first = {r["payload_digest"]: r["key"] for r in responses}
    assert first[digest(b"a")] == 1 and first[digest(b"")] == -5
    revisits = Counter((r["key"], r["payload_bytes"], r["refers_to"]) for r in found if r["record_type"] == "revisit")
    assert revisits == Counter([(1, 1, 1), (2, 1, 1), (None, 1, 1), (None, 0, -5), (None, 0, -5)])


def test_small_payloads_can_stay_responses(spark, tmp_path):
    frame = spark.createDataFrame([(1, "u", "a"), (2, "u", "a"), (3, "u", "abcd"), (4, "u", "abcd")], "page_id long, url string, html string")
    folder = str(tmp_path / "warc")
    found = warc.read(spark, folder, warc.write(frame, folder, least_bytes=2)).collect()
    assert {r.key: r.record_type for r in found} == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_empty_table(spark, tmp_path):
    frame = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read(spark, str(tmp_path), warc.write(frame, str(tmp_path))).count() == 0
