"""The operators applied to the driver's tables, with the SQL that gives the same rows."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm import blocks, forest, impacts, jaccard, language, made_pages, matrices, mixing, packing, quality, repair, sql, trie, urls, warc
from millrace.llm.common import shuffle_partitions, slices, written
from millrace.session import scratch_path


TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = quality.statistics(table(spark, sf_dir, "documents"), ["doc_id", "lang", "source"])
    return quality.judged(stats).select(
        "doc_id", *[F.col("m")[c].alias(c) for c in quality.COUNTS], "base_failed", "kept", "distance"
    )


def op2_dictionary_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "llm/warc")
    manifest = warc.write(table(spark, sf_dir, "pages"), folder)
    records = warc.read(spark, folder, manifest)
    return records.select(
        F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pieces(table(spark, sf_dir, "documents"), TOKENIZER)


def op4_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op7_cube_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"))


def op8_rare_first_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.classes(table(spark, sf_dir, "documents"))


def op9_packed_matrices(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = written(matrices.rows(table(spark, sf_dir, "documents"), TOKENIZER), "matrices")
    return matrices.unpacked(packed)


URL_RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]


def op5_recurrent_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    labeller = blocks.Labeller().fit(made_pages.training(blocks.PAGES, blocks.SEED))
    return blocks.extracted(table(spark, sf_dir, "pages").select("page_id", "url", "html"), labeller)


def op6_url_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.filtered(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict", "score")


def op10_crf_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    field = language.fit(docs)
    rows = docs.select("doc_id", "text", language.held_out(F.col("doc_id")).alias("held_out"))
    return language.identified(rows, field).drop("text")


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with a fault made by the checksum of their key: dropped, emptied, cut, repeated or of role user."""
    conv, turn = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn"))
    fault = F.crc32(F.concat(conv, F.lit(":"), turn)) % 20
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    rows = conversations.where(fault != 0).select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(role).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.sequence(F.lit(1), F.when(fault == 3, 2).otherwise(1))).alias("copy"),
    )
    return rows.drop("copy")


def digests(edits: DataFrame) -> DataFrame:
    """(conv, audit, repaired_sha256) of edits that come in order of conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, letters, state, kind = None, [], None, None
        done: list[tuple] = []

        def end() -> None:
            done.append((conv, "".join(letters), (state or hashlib.sha256()).hexdigest()))

        for whole in batches:
            kind = whole.column(0).type
            for batch in slices(iter([whole]), 3):
                for own, edit, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if letters and own != conv:
                        end()
                        letters, state = [], None
                    conv = own
                    letters.append(edit)
                    if edit != "D":
                        line = f"{role}:{text}".encode()
                        if state is None:
                            state = hashlib.sha256(line)
                        else:
                            state.update(b"\n")
                            state.update(line)
                if done:
                    yield rows(done, kind)
                    done.clear()
        if letters:
            end()
            yield rows(done, kind)

    def rows(done: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
        convs, audits, hashes = zip(*done, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(convs, kind), pa.array(audits), pa.array(hashes)], names=["conv", "audit", "repaired_sha256"])

    kind = edits.schema["conv"].dataType.simpleString()
    return edits.mapInArrow(run, f"conv {kind}, audit string, repaired_sha256 string")


EMPTY_SHA256 = hashlib.sha256().hexdigest()


def op11_grammar_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    edits, faults = repair.repaired(damaged(conversations))
    found = faults.join(digests(edits).withColumnRenamed("conv", "c"), F.col("conv").eqNullSafe(F.col("c"))).drop("c")
    ids = conversations.select("conv_id").distinct()
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    texts = [F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(EMPTY_SHA256)).alias("repaired_sha256")]
    return ids.join(found, F.col("conv_id").eqNullSafe(F.col("conv")), "left").select("conv_id", *counts, *texts)


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (conv, place, id, bytes) of conversations that begin with the first turns of another, and all ids."""
    turns = written(trie.placed(trie.hashed_turns(conversations, "conv_id", "turn", "role", "text")), "trie-turns")
    ids = conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("bigint").alias("conv")).distinct()
    taken = (F.crc32(F.col("conv").cast("string")) % 9).alias("h")
    heads = ids.select("conv", taken, (F.col("conv") - F.col("conv") % 5).alias("base")).where("h > 0")
    starts = turns.where("place <= 8").withColumnRenamed("conv", "base")
    head = heads.join(starts, "base").where("place <= h").select("conv", F.lit(0).alias("part"), "place", "id", "bytes")
    tail = turns.where(F.col("place") > F.crc32(F.col("conv").cast("string")) % 9).select("conv", F.lit(1).alias("part"), "place", "id", "bytes")
    order = Window.partitionBy("conv").orderBy("part", "place")
    both = head.unionByName(tail).select("conv", F.row_number().over(order).cast("bigint").alias("place"), "id", "bytes")
    return both, ids


def member_digests(ends: DataFrame) -> DataFrame:
    """(depth, k1, k2, ends_sha256): the conversations that end at a node, in order, as a stream."""
    dealt = ends.repartition(shuffle_partitions(ends.sparkSession), "k1", "k2").sortWithinPartitions("k1", "k2", "depth", "conv")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state, done = None, None, []
        names = ["depth", "k1", "k2", "ends_sha256"]

        def rows() -> pa.RecordBatch:
            columns = list(zip(*done, strict=True))
            done.clear()
            return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in columns[:3]], pa.array(columns[3])], names=names)

        for batch in batches:
            depth, k1, k2, conv = (c.to_pylist() for c in batch.columns)
            for own, member in zip(zip(depth, k1, k2, strict=True), conv, strict=True):
                if own != node:
                    if node is not None:
                        done.append((*node, state.hexdigest()))
                    node, state = own, hashlib.sha256(str(member).encode())
                else:
                    state.update(f",{member}".encode())
            if done:
                yield rows()
        if node is not None:
            done.append((*node, state.hexdigest()))
            yield rows()

    return dealt.select("depth", "k1", "k2", "conv").mapInArrow(run, "depth bigint, k1 bigint, k2 bigint, ends_sha256 string")


def op12_rollup_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes, ends = trie.trie(*rebuilt(table(spark, sf_dir, "conversations")))
    whole = nodes.join(member_digests(ends), ["depth", "k1", "k2"], "left")
    counts = ["depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    return whole.select("conv_id", *counts, F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"))


def op13_impact_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return impacts.top(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


QUERIES = {
    "op13_impact_order": op13_impact_order,
    "op12_rollup_trie": op12_rollup_trie,
    "op11_grammar_repair": op11_grammar_repair,
    "op8_rare_first_join": op8_rare_first_join,
    "op5_recurrent_blocks": op5_recurrent_blocks,
    "op4_projection_forest": op4_projection_forest,
    "op7_cube_mix": op7_cube_mix,
    "op2_dictionary_warc": op2_dictionary_warc,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op9_packed_matrices": op9_packed_matrices,
    "op1_robust_outliers": op1_robust_outliers,
    "op6_url_ratio": op6_url_ratio,
    "op10_crf_language": op10_crf_language,
}
#: Bare base32 of the SHA-1 in ``h``: five hexadecimal digits are four letters.
BASE32 = """array_to_string(list_transform(range(32), lambda k:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      CAST(1 + (CAST('0x' || substr(h, CAST(1 + 5 * (k // 4) AS INTEGER), 5) AS BIGINT) >> (15 - 5 * (k % 4))) % 32 AS INTEGER), 1)), '')"""

ORACLES: dict[str, str] = {
    "op2_dictionary_warc": f"""
        WITH hashed AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h FROM pages),
        ranked AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM hashed)
        SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, {BASE32} AS payload_digest,
               CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first THEN first END AS refers_to
        FROM ranked""",
    "op8_rare_first_join": r"""
        WITH RECURSIVE words AS (
          SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
        shingles AS (
          SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s
          FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 4))) AS i FROM words WHERE len(w) > 0)),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
        links AS (
          SELECT a.doc_id AS a, b.doc_id AS b
          FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
          JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
          GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))),
        reached AS (
          SELECT doc_id AS a, doc_id AS b FROM documents
          UNION SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a),
        classes AS (SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY 1)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id FROM classes LEFT JOIN sizes USING (doc_id)""",
    "op11_grammar_repair": sql.REPAIR,
    "op12_rollup_trie": sql.TRIE,
    "op13_impact_order": sql.TOP_PRODUCTS,
}
