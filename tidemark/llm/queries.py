"""The queries op1 to op10: each operator over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat_format, exact_dedup, jaccard_join, packing, quality_rules, substring_dedup, token_files, toxicity, warc, word_bpe
from .common import scratch_path, table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lexicon = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_documents(docs, lexicon)


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = jaccard_join.JaccardParams(k=3, num=9, den=10)
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"), p).withColumnRenamed("id", "doc_id")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = spark.sql("SELECT -7L AS conv_id, t AS turn, if(t = 0, 'user', 'assistant') AS role, '</s>[INST] ok [/INST]' AS text FROM (SELECT explode(array(0L, 1L)) AS t)")
    back = chat_format.read_back(chat_format.format_chats(turns.unionByName(tricky)))
    said = F.concat_ws("", F.transform("turns", lambda t: F.concat(F.coalesce(t["role"], F.lit("")), F.lit("\n"), t["text"], F.lit("\n"))))
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op5_token_id_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files_round_trip(table(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.write_warcs(table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    back = warc.read_records(index, with_payload=False)
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_bpe.encode_decode(table(spark, sf_dir, "documents"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.substring_dedup(table(spark, sf_dir, "documents"), substring_dedup.SubstringParams(k=13))
    return out.select(F.col("id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.quality_rules(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "class_distance", "word_distance")


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), capacity=2048, end_id=0)


QUERIES = {f.__name__: f for f in (op1_toxicity, op2_ngram_jaccard_join, op3_exact_dedup, op4_chat_formatting, op5_token_id_output, op6_warc, op7_bpe_encode_decode, op8_substring_dedup, op9_quality_rules, op10_best_fit_packing)}

_WORDS = r"list_filter(regexp_split_to_array(coalesce({}, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

ORACLE_SQL = {
    "op2_ngram_jaccard_join": rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, {_WORDS.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS g FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), inter AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2
), link AS (
  SELECT a, b FROM inter JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 90 * (x.n + y.n - k)
), reach(id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.id, l.b FROM reach r JOIN link l ON l.a = r.other
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT id AS doc_id, min(other) AS component_id FROM reach GROUP BY id) c USING (doc_id)
""",
    "op3_exact_dedup": r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h FROM documents
), k AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY h ORDER BY n DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size FROM d
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, h AS text_sha256 FROM k
""",
    "op4_chat_formatting": r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), m AS (
  SELECT *, coalesce(role <> lag(role) OVER (PARTITION BY conv_id ORDER BY turn), true) AS opens,
    length(regexp_replace(text, '([<\[\\])', '\1\\', 'g')) AS text_len, length(regexp_replace(role, '([<\[\\])', '\1\\', 'g')) AS role_len
  FROM t
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  (sum(text_len) + sum(CASE WHEN opens THEN role_len + 10 + 8 + 4 ELSE 6 END))::BIGINT AS formatted_chars
FROM m GROUP BY conv_id
""",
    "op6_warc": r"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), g AS (
  SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) ELSE page_id END AS top FROM p
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN top = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN top <> page_id THEN top END AS refers_to FROM g
""",
    "op8_substring_dedup": rf"""
WITH d AS (
  SELECT doc_id, {_WORDS.format("text")} AS w FROM documents
), win AS (
  SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS p FROM d
), keyed AS (
  SELECT doc_id, p, md5(array_to_string(w[p:p + 12], ' ')) AS s FROM win
), seen AS (
  SELECT s, min(doc_id) AS first FROM keyed GROUP BY s
), rep AS (
  SELECT doc_id, p FROM keyed JOIN seen USING (s) WHERE first < doc_id
), gone AS (
  SELECT DISTINCT doc_id, p + i AS q FROM rep, range(13) r(i)
), tok AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS q FROM d
)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(x.n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(x.kept, '')) AS kept_sha256
FROM d LEFT JOIN (
  SELECT tok.doc_id, count(gone.q) AS n_removed, string_agg(word, ' ' ORDER BY tok.q) FILTER (gone.q IS NULL) AS kept
  FROM tok LEFT JOIN gone ON gone.doc_id = tok.doc_id AND gone.q = tok.q GROUP BY tok.doc_id
) x ON x.doc_id = d.doc_id
""",
}
