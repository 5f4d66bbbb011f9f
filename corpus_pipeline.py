"""From raw documents to token ids, one operator a stage, each stage written and read again."""

from __future__ import annotations

import os
import sys

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from canopy.llm import bpe, langid, mixing, simhash, substring  # noqa: E402
from canopy.llm.batches import free_name  # noqa: E402
from canopy.session import apply_settings, drop_folder, new_folder  # noqa: E402

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language, short and ambiguous ones under their likeliest; those without letters go.

    Where no document has a label there is no language to tell, and all documents stay.
    """
    apply_settings(spark)
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = langid.fit(docs, ~held_out)
    if not model.languages:
        return docs
    lang, score = free_name(docs, "told"), free_name(docs, "told_score")
    told = langid.predict(docs, model, lang=lang, score=score)
    return told.where(F.col(lang) != langid.UNKNOWN).drop(lang, score)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: 3-word shingles, 2 bits."""
    apply_settings(spark)
    return simhash.keep_first(docs, shingle=3, distance=2)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words under a 50-word window that an earlier document has go; a document may be left empty."""
    apply_settings(spark)
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    kept = substring.remove_repeats(docs, one_space=False, carry=others)
    kept = kept.select("doc_id", "text", *([f"rest.{c}" for c in others]))
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources at their target weights; a document is there as often as the mix takes it."""
    apply_settings(spark)
    return mixing.take(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE of every text, checked by decoding: a text that does not come back fails the job."""
    apply_settings(spark)
    ids = bpe.encode(docs, public_tokenizers.path(VOCABULARY), verify=True)
    return ids.select("doc_id", "lang", "source", "n_tokens", "ids")


STAGES = [
    ("language ID", languages),
    ("SimHash near-dedup", near_copies),
    ("substring dedup", passages),
    ("mixing", mixture),
    ("byte-level BPE", tokens),
]

# Language ID and SimHash cannot be said in SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read as the next input.

    A stage's folder goes once the next stage is written; the last one stays, as the result reads it.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    read = None
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            folder = new_folder(spark, f"stage-{i}")
            docs.write.parquet(folder)
            docs = spark.read.parquet(folder)
            if read:
                drop_folder(spark, read)
            read = folder
    return docs
