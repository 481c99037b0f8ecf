"""The corpus pipeline: five stages over ``documents``, each written before the next reads it.

All stages but the last return the columns of ``documents``, extra and clashing ones included,
and none of them crashes on an empty table, which gives an empty one. Repeated rows are rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewise.llm import bpe, minhash, mixing, quality, secrets
from sitewise.shared import materialize

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the base rules and the learned decision list keep.

    Null, empty and very short texts fail the base rules and go. Without labels only the base
    rules hold; a row without a label is judged like any other. Null ids stay as they are.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.judge_quality(docs, labels).where("kept").select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates: that of the smallest id, null ids last.

    Texts without a word are each a class of their own and stay. Of rows that repeat the kept id
    and text one stays.
    """
    return minhash.keep_one(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with each secret in a text replaced by a mark and n_chars counted anew.

    Null texts stay null and hold nothing; n_chars stays where nothing was found.
    """
    names = docs.columns
    rows = docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"))
    found = secrets.find_secrets(rows, keep=("row",)).withColumn("__text", F.col("row.text"))
    clean = secrets.with_redacted(found, "__text", "spans", "__clean")
    new = {"text": F.col("__clean"), "n_chars": F.when(F.size("spans") > 0, F.length("__clean").cast("long")).otherwise(F.col("row.n_chars"))}
    return clean.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in names])


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix of sources takes them, up to three times.

    A null source is a source of its own, the last in order. Texts without a word have size 0
    and add nothing, whether taken or not; ties of the hash take the same side everywhere.
    """
    return mixing.repeat_rows(docs)


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, ids_sha256, decoded_sha256) of each row; null and empty texts have no tokens."""
    coded = bpe.encode(docs, TOKENIZER, lean=True)
    return coded.select(
        "doc_id", F.floor(F.length("ids") / 4).cast("long").alias("n_tokens"), "ids",
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("source_mix", source_mix),
    ("bpe_tokens", bpe_tokens),
]
#: Learned rules, similarity classes and BPE have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
