"""Web archives with one Zstandard dictionary per file and one frame per record.

Pages become WARC 1.1 records. Equal payloads are stored once: the record with the smallest key is a
response, the others are revisits that refer to it. Each file starts with a skippable frame that holds
the dictionary, which is trained on records of that very file, spread evenly over it; then each
record is a frame of its own, so that it can be read alone given the dictionary.

Files are written by the tasks through ``pyarrow.fs`` to a folder that all executors share. A name
is made of partition and counter, and rows are sorted first, so a task that runs again replaces its
own files by the same ones; a file appears under its name only when it is complete.

Cases: a null payload is empty; a null url gives no target; a null key comes after all others and
refers to nothing. Among rows that share payload and key, the first by url is the response; of
wholly equal rows one is. An empty table writes no file and reads as no record. A file with too few
records to train on has no dictionary. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import written

#: Raw bytes of records after which a file is closed; also what a task holds.
FILE_BYTES = 16_000_000
DICTIONARY_BYTES = 32_768
#: Bytes of records to train a dictionary on, as a multiple of its size.
TRAINING = 64
LEVEL = 3
DATE = "2024-01-01T00:00:00Z"
SKIPPABLE = struct.pack("<I", 0x184D2A5D)
FRAME = struct.pack("<I", 0xFD2FB528)
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
READ_BYTES = 65_536


def base32(hexadecimal: str) -> str:
    return base64.b32encode(bytes.fromhex(hexadecimal)).decode()


def record_id(key: int | None, label: str) -> str:
    """A name whose lower half is the key; the upper half tells records of one key apart."""
    high = int.from_bytes(hashlib.sha1(label.encode()).digest()[:8]) >> 4
    high |= (0xF << 60) if key is None else 0
    text = f"{high:016x}{(key or 0) & 0xFFFFFFFFFFFFFFFF:016x}"
    return f"<urn:uuid:{text[:8]}-{text[8:12]}-{text[12:16]}-{text[16:20]}-{text[20:]}>"


def key_of(name: str) -> int | None:
    text = name.strip("<>").rpartition(":")[2].replace("-", "")
    low = int(text[16:], 16)
    return None if text[0] == "f" else low - (1 << 64) if low >> 63 else low


def target(url: str) -> str:
    return "".join(f"%{ord(c):02X}" if c <= " " or c == "\x7f" else c for c in url)


def record(row: dict) -> bytes:
    """One record in WARC 1.1 format, its block an HTTP response without a body for revisits."""
    label = f"{row['url']}|{row['copy']}|{row['digest']}"
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if row['is_response'] else 'revisit'}",
        f"WARC-Record-ID: {record_id(row['key'], label)}",
        f"WARC-Date: {DATE}",
    ]
    if row["url"] is not None:
        head.append(f"WARC-Target-URI: {target(row['url'])}")
    head.append(f"WARC-Payload-Digest: sha1:{base32(row['digest'])}")
    if not row["is_response"]:
        head.append(f"WARC-Profile: {REVISIT}")
        if row["first_key"] is not None:
            first = f"{row['first_url']}|1|{row['digest']}"
            head.append(f"WARC-Refers-To: {record_id(row['first_key'], first)}")
    body = (row["body"] or b"") if row["is_response"] else b""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['bytes']}\r\n\r\n".encode()
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(http) + len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + http + body + b"\r\n\r\n"


def archive(records: list[bytes], dictionary_bytes: int = DICTIONARY_BYTES, level: int = LEVEL) -> bytes:
    """The bytes of one file."""
    total = sum(map(len, records))
    step = max(1, round(total / (TRAINING * dictionary_bytes)))
    parts, dictionary = [], None
    try:
        dictionary = zstandard.train_dictionary(dictionary_bytes, records[::step], level=level)
    except zstandard.ZstdError:  # too few or too small records
        pass
    if dictionary is not None:
        packed = zstandard.ZstdCompressor(level=19).compress(dictionary.as_bytes())
        parts += [SKIPPABLE, struct.pack("<I", len(packed)), packed]
        dictionary.precompute_compress(level=level)
    compressor = zstandard.ZstdCompressor(level=level, dict_data=dictionary, write_checksum=True)
    return b"".join([*parts, *map(compressor.compress, records)])


def records_of(data: bytes) -> Iterator[bytes]:
    """The records of a file in order, each from its own frame."""
    view, at, dictionary = memoryview(data), 0, None
    if data[:4] == SKIPPABLE:
        (size,) = struct.unpack("<I", data[4:8])
        packed, at = data[8 : 8 + size], 8 + size
        raw = zstandard.ZstdDecompressor().decompress(packed) if packed[:4] == FRAME else packed
        dictionary = zstandard.ZstdCompressionDict(raw)
    decompressor = zstandard.ZstdDecompressor(dict_data=dictionary)
    while at < len(data):
        frame, out = decompressor.decompressobj(), []
        while not frame.eof:
            if at >= len(data):
                raise ValueError("the last frame is cut off")
            out.append(frame.decompress(view[at : at + READ_BYTES]))
            at = min(at + READ_BYTES, len(data))
        at -= len(frame.unused_data)
        yield b"".join(out)


def parsed(raw: bytes) -> dict:
    """What a record says: key, url, bytes, digest, type, refers_to and payload (None for revisits)."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    response = fields["WARC-Type"] == "response"
    if response and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"{fields['WARC-Record-ID']}: the payload is damaged")
    refers = fields.get("WARC-Refers-To")
    return {
        "key": key_of(fields["WARC-Record-ID"]),
        "url": fields.get("WARC-Target-URI"),
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": fields["WARC-Type"],
        "refers_to": None if refers is None else key_of(refers),
        "payload": payload if response else None,
    }


def planned(frame: DataFrame, key: str, url: str, payload: str, least_bytes: int) -> DataFrame:
    """One row per record to write, with its body if it is a response.

    Bodies are shuffled once, and at most one per distinct payload and task.
    """
    text = F.coalesce(F.col(f"`{payload}`").cast("string"), F.lit(""))
    rows = frame.select(
        F.col(f"`{key}`").cast("bigint").alias("key"), F.col(f"`{url}`").cast("string").alias("url"), text.alias("text")
    ).withColumn("digest", F.sha1("text"))
    light = rows.groupBy("digest", "key", "url").agg(
        F.count(F.lit(1)).alias("copies"), F.max(F.octet_length("text").cast("bigint")).alias("bytes")
    )
    light = written(light, "warc-keys")
    rank = F.struct(F.col("key").isNull().alias("k0"), F.col("key").alias("k"), F.col("url").isNull().alias("u0"), F.col("url").alias("u"))
    heads = written(light.groupBy("digest").agg(F.min(rank).alias("head")), "warc-heads")
    plan = light.join(heads, "digest").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")))
    is_head = F.col("key").eqNullSafe(F.col("head.k")) & F.col("url").eqNullSafe(F.col("head.u")) & (F.col("copy") == 1)
    plan = plan.select(
        "digest",
        "key",
        "url",
        "copy",
        "bytes",
        (is_head | (F.col("bytes") < least_bytes)).alias("is_response"),
        F.col("head.k").alias("first_key"),
        F.col("head.u").alias("first_url"),
    )
    plan = written(plan, "warc-plan")
    bodies = rows.groupBy("digest").agg(F.first("text").alias("body")).withColumn("body", F.encode("body", "UTF-8"))
    responses = plan.where("is_response").join(bodies, "digest")
    revisits = plan.where("not is_response").withColumn("body", F.lit(None).cast("binary"))
    return responses.unionByName(revisits)


def write(frame: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html", least_bytes: int = 0) -> DataFrame:
    """Write the frame's records below ``folder``; returns (file, records, bytes) of the files written."""
    plan = planned(frame, key, url, payload, least_bytes).sortWithinPartitions("digest", "key", "url", "copy")
    columns = plan.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        files, base = pyarrow.fs.FileSystem.from_uri(folder)
        files.create_dir(base, recursive=True)
        number, held, size = 0, [], 0

        def close() -> pa.RecordBatch:
            nonlocal number, held, size
            name = f"part-{context.partitionId():06d}-{number:06d}.warc.zst"
            hidden = f"{base}/_{name}-{context.taskAttemptId()}"
            data = archive(held)
            with files.open_output_stream(hidden) as out:
                out.write(data)
            files.move(hidden, f"{base}/{name}")
            done = pa.RecordBatch.from_pydict({"file": [name], "records": [len(held)], "bytes": [len(data)]})
            number, held, size = number + 1, [], 0
            return done

        for batch in batches:
            for i in range(batch.num_rows):
                raw = record({c: batch.column(k)[i].as_py() for k, c in enumerate(columns)})
                held.append(raw)
                size += len(raw)
                if size >= FILE_BYTES:
                    yield close()
        if held:
            yield close()

    return written(plan.mapInArrow(run, "file string, records bigint, bytes bigint"), "warc-files")


def read(spark: SparkSession, folder: str, manifest: DataFrame, with_payload: bool = False) -> DataFrame:
    """The records of the files that a manifest names."""
    schema = "key bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
    schema += ", payload binary" if with_payload else ""
    if manifest.isEmpty():
        return spark.createDataFrame([], schema)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)
    names = [n.split(" ")[0] for n in schema.split(", ")]
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    arrow = pa.schema(list(zip(names, types[: len(names)], strict=True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                held = []
                for raw in records_of(batch.column(0)[i].as_py()):
                    found = parsed(raw)
                    held.append({n: found[n] for n in names})
                    if len(held) >= 2000:
                        yield pa.RecordBatch.from_pylist(held, schema=arrow)
                        held = []
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=arrow)

    file = F.element_at(F.split("path", "/"), -1)
    listed = files.withColumn("file", file).join(manifest.select("file"), "file", "left_semi")
    return listed.select("content").mapInArrow(run, schema)
