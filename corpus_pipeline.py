"""The corpus pipeline: quality rules, near-dedup, substring dedup, decontamination, tokens."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.llm import byte_bpe, decontamination, minhash_dedup, quality_rules, substring_dedup
from creditloom.llm.common import release
from creditloom.session import materialize

TOKENIZER = "byte_bpe_multi_50k.tiktoken"
#: No SQL can express hashing, latent vectors and merges.
ORACLE_SQL = None


def _kept(docs: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose id has a row in ``verdicts``; the columns of ``docs``.

    Rows that repeat an id are kept or dropped together; rows without an id go.
    """
    ids = verdicts.select(F.col("doc_id").alias("__id")).distinct()
    return docs.join(ids, F.col("doc_id").cast("long") == F.col("__id"), "left_semi")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep. Null or empty text goes, and so does a null id."""
    return _kept(docs, quality_rules.judged(docs).where("kept"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near duplicates (five words, 0.8)."""
    return _kept(docs, minhash_dedup.near_duplicates(docs).where("kept"))


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages are cut from all documents but the first; a document left without words goes.

    ``n_chars``, if there is such a column, follows the new text.
    """
    found = substring_dedup.without_passages(docs, substring_dedup.repeated_passages(docs))
    found = found.where(r"text RLIKE '[^\\x20\\x09-\\x0D]'")
    if "n_chars" in found.columns:
        kind = docs.schema["n_chars"].dataType
        found = found.withColumn("n_chars", F.char_length("text").cast(kind))
    return found.select(*docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    leaks = decontamination.contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    ids = leaks.select(F.col("doc_id").alias("__id")).distinct()
    return docs.join(ids, F.col("doc_id").cast("long") == F.col("__id"), "left_anti")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_tokens, exact): the token ids; exact says that they decode to the text."""
    path = public_tokenizers.path(TOKENIZER)
    ids = byte_bpe.encode(docs, path, public_tokenizers.PATTERN)
    found = ids.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), F.sha2(byte_bpe.decoded("ids", path), 256).alias("__decoded"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.sha2(F.encode("text", "UTF-8"), 256).alias("__text"))
    texts = texts.groupBy("doc_id").agg(F.collect_set("__text").alias("__texts"))
    return found.join(texts, "doc_id").select("doc_id", "ids", "n_tokens", F.array_contains("__texts", F.col("__decoded")).alias("exact"))


STAGES = [
    ("quality rules", quality),
    ("near duplicates", near_duplicates),
    ("repeated passages", passages),
    ("decontamination", decontaminated),
    ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written to the shared folder and read again; shuffle files go with their stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        release(spark)
    return docs
