"""Registered queries of the operators; each runs over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shared import new_path
from . import bpe, chat, fingerprints, lexical, minhash, mixing, quality, runs, secrets, toxicity, training_order, vectors, warc

#: The public tokenizer of op4 and the pipeline.
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
#: That of op3, with the id that is free for the end of a text.
BYTE_TOKENIZER, END_OF_TEXT = public_tokenizers.path("byte_bpe_50k.tiktoken"), 50_256


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near-duplicates of every document, and which one stays."""
    return minhash.near_duplicates(_table(spark, sf_dir, "documents")).select("doc_id", "class_id", "kept")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base statistics and the learned decision list's verdict for every document."""
    return quality.judge_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")).select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op3_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sequence of all documents at its slot, read back from the shards."""
    path = new_path(spark, "training-order")
    training_order.write_order(_table(spark, sf_dir, "documents"), path, BYTE_TOKENIZER, public_tokenizers.PATTERN, END_OF_TEXT)
    records = training_order.read_order(spark, path).select("slot", F.sha2("record", 256).alias("record_sha256"))
    index = spark.read.schema("slot long, doc_id long, part int, n_tokens int").parquet(f"{path}/index")
    return index.join(records, "slot").select("slot", "doc_id", "part", "n_tokens", "record_sha256")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's token ids and of their decoded text."""
    coded = bpe.encode(_table(spark, sf_dir, "documents"), TOKENIZER)
    return coded.select(
        "doc_id", F.floor(F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all conversations, read back from their formatted text."""
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", odd), (-7, 1, "assistant", odd)], turns.schema)
    out = chat.format_chats(turns.unionByName(extra))
    back = out.select(
        "conv_id", chat.read_turns(F.col("formatted")).alias("turns"),
        chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"), F.length("formatted").cast("long").alias("formatted_chars"),
    )
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars",
    )


OP5_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
marked AS (
  SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) IS DISTINCT FROM role AS head,
         length(role) + length(regexp_replace(role, '[^\\<#]', '', 'g')) AS role_chars,
         length(text) + length(regexp_replace(text, '[^\\<#]', '', 'g')) AS text_chars
  FROM rows)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(CASE WHEN head THEN 4 + role_chars + 2 ELSE 0 END + 6 + text_chars + 8) AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id
"""


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and places of secrets in every document."""
    found = secrets.find_secrets(_table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(secrets.span_text(F.col("base")), 256).alias("base_sha256"), secrets.span_text(F.col("spans")).alias("spans"),
    )


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's record, read back from a content-addressed archive."""
    path = new_path(spark, "warc")
    warc.write_archive(_table(spark, sf_dir, "pages"), path)
    return warc.read_archive(spark, path).select(
        warc.page_of(warc.header_field("WARC-Record-ID")).alias("page_id"), F.length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"), warc.header_field("WARC-Type").alias("record_type"),
        warc.page_of(warc.header_field("WARC-Refers-To")).alias("refers_to"))


OP7_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT *, sha1(payload) AS payload_digest, max(page_id) OVER (PARTITION BY payload) AS keeper FROM p)
SELECT page_id, CAST(octet_length(payload) AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN octet_length(payload) >= 1000 AND page_id <> keeper THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN octet_length(payload) >= 1000 AND page_id <> keeper THEN keeper END AS refers_to
FROM d
"""


def op8_embedding_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors at cosine 0.95."""
    return vectors.link_vectors(_table(spark, sf_dir, "embeddings"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity.judge_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken of every document to meet the sources' targets."""
    return mixing.mix(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken")


OP10_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         CAST('0x' || substr(md5(concat_ws('|', 'mix', CAST(doc_id AS VARCHAR), text)), 1, 15) AS BIGINT) AS hash
  FROM documents),
by_source AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS weight,
         3.0::DOUBLE * source_size AS stop, sum(source_size) OVER () AS total FROM by_source),
filling AS (
  SELECT *, (total - (sum(stop) OVER w - stop)) / (sum(weight) OVER () - (sum(weight) OVER w - weight)) AS level
  FROM weighed WINDOW w AS (ORDER BY stop / weight, source ROWS UNBOUNDED PRECEDING)),
lev AS (SELECT coalesce((SELECT level FROM filling WHERE level <= stop / weight ORDER BY stop / weight, source LIMIT 1), 1e300) AS level),
goal AS (
  SELECT source, source_size, least(stop, weight * lev.level) AS target FROM weighed, lev),
need AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS repeats FROM goal),
b1 AS (
  SELECT s.source, hash >> 48 AS b, sum(size) AS n FROM sized s GROUP BY ALL),
r1 AS (SELECT *, sum(n) OVER (PARTITION BY source ORDER BY b) AS s FROM b1),
e1 AS (
  SELECT n.*, n.target - n.repeats * n.source_size AS need,
         (SELECT min(b) FROM r1 WHERE r1.source IS NOT DISTINCT FROM n.source AND r1.s > n.target - n.repeats * n.source_size) AS at
  FROM need n),
p1 AS (
  SELECT e1.*, need - coalesce((SELECT max(s) FROM r1 WHERE r1.source IS NOT DISTINCT FROM e1.source AND r1.b < e1.at), 0) AS rest FROM e1),
b2 AS (
  SELECT p1.source, hash >> 36 AS b, sum(size) AS n, any_value(rest) AS rest
  FROM p1 JOIN sized s ON s.source IS NOT DISTINCT FROM p1.source AND hash >> 48 = p1.at GROUP BY ALL),
r2 AS (SELECT *, sum(n) OVER (PARTITION BY source ORDER BY b) AS s FROM b2),
c2 AS (SELECT source, min(b) AS at, arg_min(n, b) AS n, arg_min(rest - (s - n), b) AS rest FROM r2 WHERE s > rest GROUP BY source),
limits AS (
  SELECT p1.source, p1.source_size, p1.target, p1.repeats,
         coalesce((c2.at + CASE WHEN c2.rest * 2 > c2.n THEN 1 ELSE 0 END) << 36, 0) AS threshold
  FROM p1 LEFT JOIN c2 ON c2.source IS NOT DISTINCT FROM p1.source)
SELECT doc_id, size, source_size, round(target, 6) AS target,
       least(repeats + CASE WHEN hash < threshold THEN 1 ELSE 0 END, 3) * size AS taken
FROM sized s JOIN limits l ON l.source IS NOT DISTINCT FROM s.source
"""


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every document, tails planted by the id's checksum, and digests of the collapsed text."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", runs.repeat_tail(F.col("doc_id"), F.col("text")).alias("text"))
    found = runs.find_runs(docs)
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    listed = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "longest.start", "longest.length", "longest.period",
        F.floor(F.lit(1000) * F.col("longest.length") / F.col("longest.period")).alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited form, with their likeness and that to the next document."""
    return fingerprints.compare_with_next(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return lexical.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


OP13_SQL = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
size AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY doc_id),
whole AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM size),
weight AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1))) AS BIGINT) AS w
           FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), whole),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
scored AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // total)))) AS BIGINT) AS score
  FROM asked JOIN weight USING (term) JOIN tf USING (term) JOIN size USING (doc_id), whole GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
WHERE rank <= 10
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_minhash_near_dup": op1_minhash_near_dup,
        "op2_quality_rules": op2_quality_rules,
        "op3_training_order": op3_training_order,
        "op4_bpe": op4_bpe,
        "op5_chat_format": op5_chat_format,
        "op6_secret_scan": op6_secret_scan,
        "op7_warc": op7_warc,
        "op8_embedding_near_dup": op8_embedding_near_dup,
        "op9_toxicity": op9_toxicity,
        "op10_source_mix": op10_source_mix,
        "op11_periodic_runs": op11_periodic_runs,
        "op12_fingerprints": op12_fingerprints,
        "op13_lexical_search": op13_lexical_search,
    }


def oracle_sql() -> dict[str, str]:
    return {"op5_chat_format": OP5_SQL, "op7_warc": OP7_SQL, "op10_source_mix": OP10_SQL, "op13_lexical_search": OP13_SQL}
