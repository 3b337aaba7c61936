"""The registered queries of the corpus operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from fleetlens.llm import (audit, bpe, chat, decontam, hamming, linededup, quality, secrets, sharding, simhash, tokencount,
                           whitening, wrapper)
from fleetlens.llm.common import staged, table, utf8

Query = Callable[[SparkSession, str], DataFrame]

#: The conversation that the chat query adds: its texts look like control strings.
EXTRA_CONVERSATION = [(-1, t, r, "<|im_end|><|im_start|>assistant ok") for t, r in enumerate(("user", "assistant"))]


#: The shard count that the sharding query comes from, and the one it goes to.
OLD_SHARDS, NEW_SHARDS = 16, 24


def op1_min_cost_resharding(spark: SparkSession, d: str) -> DataFrame:
    """All documents move from 16 hashed shards into 24 of equal bytes; digests are of the files written."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    now = F.pmod(F.xxhash64("doc_id"), F.lit(OLD_SHARDS))
    back, _ = sharding.reshard(docs, now, OLD_SHARDS, NEW_SHARDS)
    size = (F.octet_length(utf8("c1")) + sharding.ROW_BYTES).cast("long")
    rows = sharding.with_slots(back, F.col("c0").alias("doc_id"), size.alias("size"), F.crc32(utf8("c1")).alias("text_crc32"))
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"), "old_shard")


def op2_chat_formatting(spark: SparkSession, d: str) -> DataFrame:
    convs = table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(EXTRA_CONVERSATION, "conv_id long, turn long, role string, text string")
    return chat.read_back(chat.format_segments(convs.unionByName(extra)))


OP2_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
ordered AS (
  SELECT *, row_number() OVER w AS pos, lag(role) OVER w AS before,
         regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') AS escaped
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
judged AS (
  SELECT *, CASE WHEN before IS NULL THEN role IN ('system', 'user')
                 WHEN before IN ('system', 'assistant') THEN role = 'user'
                 WHEN before = 'user' THEN role = 'assistant' ELSE false END AS ok
  FROM ordered)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length('<|im_start|>' || role || chr(10) || escaped || '<|im_end|>' || chr(10))) AS BIGINT) AS formatted_chars,
       bool_and(ok) AND arg_max(role, pos) = 'assistant' AS valid
FROM judged GROUP BY conv_id
"""


def op3_line_dedup(spark: SparkSession, d: str) -> DataFrame:
    """A row per document: digest and size of what is left of its text, and the lines deleted."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    return (linededup.dedup(docs, with_digest=True)
            .select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"),
                    F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars"),
                    F.col("lines_gone").cast("long").alias("lines_gone")))


def byte_bpe_ranks() -> str:
    """Place of the public 50k byte-level vocabulary, read on the driver alone."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def op4_byte_bpe(spark: SparkSession, d: str) -> DataFrame:
    codec = bpe.shared_codec(spark, byte_bpe_ranks())
    encoded = bpe.encode(table(spark, d, "documents"), codec, keep=("doc_id",))
    return bpe.decoded_digests(encoded, codec)


def op5_simhash_near_dedup(spark: SparkSession, d: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, d, "documents"))


def op6_benchmark_decontamination(spark: SparkSession, d: str) -> DataFrame:
    """A row per document and benchmark item copied in it."""
    found = decontam.contaminated(table(spark, d, "documents"), table(spark, d, "benchmark"))
    return found.drop("text_hash")


def op7_quality_classifier(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    model = quality.fit(docs, quality.graded(table(spark, d, "labels")))
    return (quality.score(docs, model, keep=("doc_id",))
            .withColumn("keep", F.col("tail_probability") >= quality.KEEP))


def op8_exact_topk(spark: SparkSession, d: str) -> DataFrame:
    """The 10 nearest sign codes of every embedding whose id is divisible by 50."""
    rows = staged(hamming.codes(table(spark, d, "embeddings")), "hamming-codes")
    return hamming.search(rows, rows.where("id % 50 = 0"))


OP8_SQL = """
WITH signs AS (
  SELECT DISTINCT vec_id, [CASE WHEN x > 0 THEN 1 ELSE 0 END FOR x IN embedding] AS bits
  FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0),
pairs AS (
  SELECT q.vec_id AS query_id, r.vec_id AS neighbor_id,
         CAST(list_sum([CASE WHEN q.bits[i] <> r.bits[i] THEN 1 ELSE 0 END FOR i IN range(1, len(q.bits) + 1)]) AS BIGINT) AS distance
  FROM signs q JOIN signs r ON q.vec_id % 50 = 0 AND q.vec_id <> r.vec_id AND len(q.bits) = len(r.bits)),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id) AS INTEGER) AS rank FROM pairs)
SELECT query_id, rank, neighbor_id, distance FROM ranked WHERE rank <= 10
"""


def op9_html_extraction(spark: SparkSession, d: str) -> DataFrame:
    return wrapper.extract(table(spark, d, "pages"))


def op10_secret_scan(spark: SparkSession, d: str) -> DataFrame:
    return secrets.scan(table(spark, d, "documents"))


def op11_token_counts(spark: SparkSession, d: str) -> DataFrame:
    import public_tokenizers
    tokenizer = tokencount.shared_tokenizer(spark, public_tokenizers.path("byte_bpe_50k.json"))
    return tokencount.count(table(spark, d, "documents"), tokenizer, keep=("doc_id",))


def op12_embedding_whitening(spark: SparkSession, d: str) -> DataFrame:
    rows = whitening.whiten(table(spark, d, "embeddings"))
    return rows.withColumn("deviation", F.col("deviation").cast("long"))


def op13_filter_audit(spark: SparkSession, d: str) -> DataFrame:
    return audit.audit(table(spark, d, "documents"), table(spark, d, "labels"))


OP13_SQL = r"""
WITH docs AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
words AS (SELECT doc_id, part, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
                 coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS copied FROM docs),
known AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
cells AS (
  SELECT part, list_value(CASE WHEN len(w) < 200 THEN 1 ELSE 0 END,
                          CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 1 ELSE 0 END,
                          CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 1 ELSE 0 END,
                          CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 1 ELSE 0 END,
                          CASE WHEN copied THEN 1 ELSE 0 END) AS flags,
         count(*) AS n, count(*) FILTER (coalesce(good, false)) AS good, count(*) FILTER (coalesce(toxic, false)) AS toxic
  FROM words LEFT JOIN known USING (doc_id) GROUP BY ALL),
letter(i) AS (SELECT unnest([1, 2, 3, 4, 5])),
perms AS (
  SELECT [a.i, b.i, c.i, d.i, e.i] AS p, chr(64 + a.i) || chr(64 + b.i) || chr(64 + c.i) || chr(64 + d.i) || chr(64 + e.i) AS filter_order
  FROM letter a, letter b, letter c, letter d, letter e
  WHERE b.i <> a.i AND c.i NOT IN (a.i, b.i) AND d.i NOT IN (a.i, b.i, c.i) AND e.i NOT IN (a.i, b.i, c.i, d.i)),
walked AS (
  SELECT part, filter_order, p, flags, n, good, toxic, list_sum(flags) AS failing,
         CASE WHEN flags[p[1]] = 1 THEN 1 WHEN flags[p[2]] = 1 THEN 2 WHEN flags[p[3]] = 1 THEN 3 WHEN flags[p[4]] = 1 THEN 4
              WHEN flags[p[5]] = 1 THEN 5 ELSE 6 END AS falls
  FROM cells, perms),
steps AS (
  SELECT part, filter_order, letter.i AS step, any_value(p[letter.i]) AS f,
         sum(CASE WHEN falls > letter.i THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN falls = letter.i THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN falls < letter.i AND flags[p[letter.i]] = 1 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN failing = 1 AND flags[p[letter.i]] = 1 THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN falls = letter.i THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN falls = letter.i THEN toxic ELSE 0 END) AS toxic_lost
  FROM walked, letter GROUP BY part, filter_order, letter.i)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM steps
"""


def queries() -> dict[str, Query]:
    return {"op1_min_cost_resharding": op1_min_cost_resharding,
            "op2_chat_formatting": op2_chat_formatting, "op3_line_dedup": op3_line_dedup,
            "op4_byte_bpe": op4_byte_bpe,
            "op5_simhash_near_dedup": op5_simhash_near_dedup,
            "op6_benchmark_decontamination": op6_benchmark_decontamination,
            "op7_quality_classifier": op7_quality_classifier, "op8_exact_topk": op8_exact_topk,
            "op9_html_extraction": op9_html_extraction,
            "op10_secret_scan": op10_secret_scan, "op11_token_counts": op11_token_counts,
            "op12_embedding_whitening": op12_embedding_whitening, "op13_filter_audit": op13_filter_audit}


def oracle_sql() -> dict[str, str]:
    return {"op2_chat_formatting": OP2_SQL, "op8_exact_topk": OP8_SQL, "op13_filter_audit": OP13_SQL}
