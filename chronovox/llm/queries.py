"""The queries over this subpackage's operators, and SQL for those that it can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, common, conversation_repair, language_id, line_dedup, packing, quality, secret_scan, simhash, token_count, token_files, token_ids, top_k, warc

BYTE_BPE, WORD_BPE, PIECES = "byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"
END_ID, SEQUENCE = 2, 1024


def joined(kinds: tuple[str, ...]) -> F.Column:
    one = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    return F.array_join(F.transform(F.filter("secrets", lambda s: s["kind"].isin(*kinds)), one), ",")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(common.table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, secret_scan.BASE_KINDS), F.sha2(joined(secret_scan.BASE_KINDS), 256).alias("base_sha256"), joined(secret_scan.KINDS).alias("spans"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = token_ids.encode(common.table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(common.table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = line_dedup.drop_repeated_lines(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return clean.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    judged = quality.assess(docs, quality.fit(docs, common.table(spark, sf_dir, "labels")))
    return judged.select("doc_id", *quality.METRICS, "base_failed", "kept", "score")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = common.shared_dir(spark, "warc")
    warc.write(common.table(spark, sf_dir, "pages"), folder)
    return warc.read(spark, folder)


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(common.table(spark, sf_dir, "documents"))
    return found.select(F.col("key").alias("doc_id"), F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k.top_k(common.table(spark, sf_dir, "embeddings"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = packing.pieces(common.table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), SEQUENCE, END_ID)
    return packing.pack(parts, "length", SEQUENCE)


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = common.shared_dir(spark, "token-files")
    token_files.write(common.table(spark, sf_dir, "documents"), folder, public_tokenizers.path(BYTE_BPE), end_id=END_ID)
    return token_files.read_documents(spark, folder)


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = conversation_repair.damage(common.table(spark, sf_dir, "conversations"))
    return conversation_repair.report(conversation_repair.repair(turns))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(common.table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), public_tokenizers.path(PIECES))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0
    docs = common.table(spark, sf_dir, "documents").withColumn("held_out", held)
    model = language_id.fit(docs.filter("NOT held_out"))
    return language_id.predict(docs, model, keep=("held_out",))


QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_bpe": op2_bpe,
    "op3_token_count": op3_token_count,
    "op4_line_dedup": op4_line_dedup,
    "op5_packing": op5_packing,
    "op6_quality": op6_quality,
    "op7_warc": op7_warc,
    "op8_simhash": op8_simhash,
    "op9_token_files": op9_token_files,
    "op10_top_k": op10_top_k,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_alignment": op12_alignment,
    "op13_language_id": op13_language_id,
}

ORACLE_SQL: dict[str, str] = {
    "op4_line_dedup": """
        WITH numbered AS (
            SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents
        ), lines AS (
            SELECT row, doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS place FROM numbered
        ), keyed AS (
            SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines
        ), frequent AS (
            SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT row) >= 10
        )
        SELECT doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE f.key IS NULL), '')) AS kept_sha256
        FROM keyed LEFT JOIN frequent f USING (key) GROUP BY row, doc_id
    """,
    "op7_warc": """
        WITH payloads AS (
            SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS digest FROM pages
        ), targets AS (
            SELECT digest, max(page_id) AS target FROM payloads GROUP BY digest
        )
        SELECT page_id, payload_bytes,
               array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + list_sum([
                   ((strpos('0123456789abcdef', substr(digest, 1 + (5 * i + j) // 4, 1)) - 1) >> (3 - (5 * i + j) % 4) & 1) << (4 - j) for j in range(5)])::INT, 1) for i in range(32)], '') AS payload_digest,
               CASE WHEN page_id = target THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> target THEN target END AS refers_to
        FROM payloads JOIN targets USING (digest)
    """,
    "op10_top_k": """
        WITH vectors AS (
            SELECT vec_id, [floor(256 * x::DOUBLE)::BIGINT for x in embedding] AS v FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
            FROM vectors q JOIN vectors c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
        )
        SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
        FROM scored QUALIFY rank <= 5
    """,
}
