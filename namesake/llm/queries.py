"""The queries of this subpackage: thin, each through its operator, over whole tables with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from namesake.llm import bpe_codec, chat_format, chunk_store, exact_dedup, mixing, pii, quality, simhash, token_counts, winnowing
from namesake.llm.common import load


def op1_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.edited_neighbours(load(spark, sf_dir, "documents"))


def op2_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixing_order(load(spark, sf_dir, "documents"), max_repeats=2.0).drop("quota")


def op3_chunk_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_store.stored_documents(load(spark, sf_dir, "documents"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(load(spark, sf_dir, "documents"))
    n = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[n(k) for k in pii.KINDS], F.sha2(pii.span_text(F.col("base")), 256).alias("base_sha256"), pii.span_text(F.concat("base", "added")).alias("spans"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(load(spark, sf_dir, "documents"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.round_trip_digests(load(spark, sf_dir, "documents"))


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    odd = "\\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", odd), (-7, 1, "assistant", odd)], "conv_id long, turn long, role string, text string")
    chats = chat_format.format_chats(load(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more))
    read = chat_format.read_chats(chats)
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"), F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"), "formatted_chars")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(load(spark, sf_dir, "documents"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_groups(load(spark, sf_dir, "documents"), keep="max").drop("copies")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = load(spark, sf_dir, "documents")
    net = quality.fit(*quality.training_sample(documents, load(spark, sf_dir, "labels")))
    scored = quality.score_documents(documents, net)
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


QUERIES = {f.__name__: f for f in (op1_winnowing, op2_temperature_mixing, op3_chunk_store, op4_pii, op5_simhash, op6_bpe, op7_chat_format, op8_token_counts, op9_exact_dedup, op10_quality)}

ORACLE_SQL = {
    "op7_chat_format": r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (
  SELECT *, replace(replace(text, '\', '\b'), '<', '\l') AS body, lag(role) OVER w AS before
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text))
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  (sum(length(body) + CASE WHEN before IS NULL THEN length('<turn|' || role || '>')
    WHEN before = role THEN length('<sep>') ELSE length('</turn>.<turn|' || role || '>') END) + length('</turn>.'))::BIGINT AS formatted_chars
FROM e GROUP BY conv_id""",
    "op9_exact_dedup": r"""
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, (count(*) OVER g)::BIGINT AS group_size, doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)""",
    "op2_temperature_mixing": r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, sum(len(regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+')) + 1)::BIGINT AS tokens, md5('0|' || doc_id) AS o
  FROM documents GROUP BY doc_id, source),
b AS (SELECT *, (('0x' || substr(o, 1, 8))::BIGINT % 1024)::INT AS block FROM d),
k AS (SELECT source, block, sum(tokens)::BIGINT AS tokens FROM b GROUP BY ALL),
s AS (SELECT source, sum(tokens)::BIGINT AS tokens FROM k GROUP BY ALL),
p AS (SELECT max(ln(tokens)) - min(ln(tokens)) AS spread FROM s),
x(i, low, high) AS (
  SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE
  UNION ALL
  SELECT i + 1, CASE WHEN exp((1 - (low + high) / 2) * spread) > 2.0 THEN (low + high) / 2 ELSE low END,
    CASE WHEN exp((1 - (low + high) / 2) * spread) > 2.0 THEN high ELSE (low + high) / 2 END
  FROM x, p WHERE i < 20),
a AS (SELECT high AS a FROM x WHERE i = 20),
q AS (SELECT source, tokens, round(pow(tokens, a) * max(tokens / pow(tokens, a)) OVER ())::BIGINT AS quota FROM s, a),
e AS (SELECT source, tokens AS total, quota, unnest(range((quota - 1) // tokens + 1)) AS epoch FROM q),
f AS (
  SELECT k.source, k.block, epoch, quota, epoch * total + coalesce(sum(k.tokens) OVER (PARTITION BY k.source, epoch ORDER BY md5('0 block|' || epoch || '|' || k.block), k.block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM k JOIN e USING (source)),
w AS (
  SELECT b.doc_id, b.source, b.tokens, epoch, quota, f.before + coalesce(sum(b.tokens) OVER (PARTITION BY b.source, b.block, epoch ORDER BY md5(epoch || '|' || o), doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS position
  FROM b JOIN f ON f.source = b.source AND f.block = b.block)
SELECT doc_id, source, tokens, epoch::BIGINT AS epoch, position::BIGINT AS position FROM w WHERE position < quota""",
}
